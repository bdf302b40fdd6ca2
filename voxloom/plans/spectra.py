"""Queries: spectrograms and what is done with their scores; a vector stands for 8 bands of 8 frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import storage
from ..functions import signal as G
from ..functions import spectra as S
from ..functions import text as T
from ..functions import vectors as V
from ..operators import integrity as I
from ..operators.scan import with_previous
from ..sources.manifest import read_sidecar
from . import bindings as B

R = lambda c, n=6: F.round(c, n)
BANDS = 8
STFT_SIZES = (32, 16)


def _bands(vec: str, frames: Column | int = 8) -> Column:
    size = F.lit(frames) if isinstance(frames, int) else frames
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.transform(F.slice(vec, b * 8 + 1, size), lambda x: F.abs(x)))


def _pairs(spark, sf):
    pairs = with_previous(B.vectors(spark, sf), "label", ["vec_id"], "vec", "before").where("before IS NOT NULL")
    return pairs.select("vec_id", "vec", "before", _bands("before").alias("p"), _bands("vec").alias("t"))


def cepstral_distortion(spark, sf):
    return _pairs(spark, sf).select("vec_id", R(S.cepstral_distortion(F.col("p"), F.col("t"))).alias("mcd"))


def pitch_similarity(spark, sf):
    track = lambda v: F.transform(v, lambda x: F.when(x > 0.1, x * 1000).otherwise(0.0))
    d = _pairs(spark, sf).select("vec_id", S.pitch_difference(track("before"), track("vec")).alias("d"))
    return d.select("vec_id", R("d.difference").alias("difference"), R("d.similarity").alias("similarity"))


def training_similarity(spark, sf):
    s = _pairs(spark, sf).select("vec_id", S.training_similarity(F.col("p"), F.col("t")).alias("s"))
    return s.select("vec_id", *(R(f"s.{n}").alias(n) for n in [*S.SIMILARITY_WEIGHTS, "perceptual_loss"]))


def voice_loss(spark, sf):
    style = F.transform("vec", lambda x: x * 1.45)
    d = S.with_stft_distance(_pairs(spark, sf), "before", "vec", "stft", STFT_SIZES)
    s = d.select("vec_id", S.voice_loss(F.col("p"), F.col("t"), style, (F.col("vec_id") % 20).cast("int"), 0.01, F.col("stft"), perceptual=True).alias("s"))
    return s.select("vec_id", *(R(f"s.{n}").alias(n) for n in ("l1_loss", "mse_loss", "freq_loss", "stft_loss", "style_reg_loss", "perceptual_loss", "total_loss")))


def stft_levels(spark, sf):
    """Log spectra of each vector as a signal, the mean of every frame."""
    v = S.with_log_spectra(B.vectors(spark, sf).select("vec_id", "vec"), "vec", "s", STFT_SIZES)
    sizes = v.select("vec_id", F.posexplode("s").alias("size", "frames"))
    return sizes.select("vec_id", "size", F.posexplode("frames").alias("frame", "x")).select("vec_id", "size", "frame", R(V.mean(F.col("x"))).alias("level"))


def voice_similarity(spark, sf):
    """Six losses, with weights as a run's configuration file has them; one weight is left to the fixed one."""
    path = storage.folder(spark)
    spark.createDataFrame([(0.3, 0.25, 0.2, 0.15, 0.05)], ", ".join(f"{n} double" for n in list(S.VOICE_WEIGHTS)[:5])).coalesce(1).write.json(f"{path}/config")
    config = read_sidecar(spark, f"{path}/config").withColumn("smoothness_weight", F.lit(None).cast("double"))
    weights = config.select(F.struct(*S.VOICE_WEIGHTS).alias("w")).scalar()
    s = _pairs(spark, sf).select("vec_id", S.voice_losses(F.col("p"), F.col("t"), F.col("vec")).alias("s"))
    return s.select("vec_id", *(R(f"s.{n}").alias(n) for n in ("mel_l1", "spectral_conv", "cosine", "centroid", "norm_reg", "smoothness")), R(S.weighed_losses(F.col("s"), weights)).alias("total_loss"))


def perceptual_similarity(spark, sf):
    track = lambda v: F.transform(v, lambda x: F.when(x > 0.1, x * 1000).otherwise(0.0))
    s = _pairs(spark, sf).select("vec_id", S.perceptual_similarity(F.col("p"), F.col("t"), track("before"), track("vec")).alias("s"))
    return s.select("vec_id", *(R(f"s.{n}").alias(n) for n in ("cosine", "correlation", "convergence", "pitch", "centroid", "score")))


def mean_spectrum(spark, sf):
    v = B.vectors(spark, sf).select("label", _bands("vec", (4 + F.col("vec_id") % 5).cast("int")).alias("s"))
    return S.mean_padded(v, "s", "label").select("label", "band", "frame", R("x").alias("x"))


def mean_components(spark, sf):
    maps = B.table(spark, sf, "events").select("user_id", F.create_map("event_type", "value").alias("m"))
    return S.mean_of_maps(maps, "user_id", "m").select("user_id", "key", R("mean").alias("mean"))


def merged_maps(spark, sf):
    first = F.create_map("event_type", "value", F.lit("rank"), F.lit(0.0))
    both = T.merged(first, F.create_map(F.lit("click"), F.lit(-1.0), F.lit("rank"), F.lit(7.0)))
    return B.table(spark, sf, "events").select("event_id", F.size(both).alias("n"), both["click"].alias("click"), both["rank"].alias("rank"), both[F.col("event_type")].alias("own"))


def half_deviations(spark, sf):
    timbre, style = V.halves(F.col("vec"), B.DIMS)
    half = lambda x, name: F.struct(F.lit(name).alias("half"), x.alias("x"))
    rows = B.vectors(spark, sf).select("label", F.explode(F.array(half(timbre, "timbre"), half(style, "style"))).alias("h")).select("label", "h.half", F.explode("h.x").alias("x"))
    return rows.groupBy("label", "half").agg(R(F.avg("x")).alias("mean"), R(F.stddev_samp("x")).alias("std"))


def rescaled_index(spark, sf):
    return B.table(spark, sf, "events").select("event_id", G.rescaled_index(F.col("event_id"), 22_050).cast("long").alias("i"))


def time_stamps(spark, sf):
    return B.table(spark, sf, "events").select("event_id", *(T.stamp(F.col("ts"), form).alias(form) for form in T.STAMPS))


def delete_list(spark, sf):
    return I.delete_list(B.listing(spark, sf), B.labels(spark, sf), "doc_id", F.col("quality") == 1)


def clean_for_upload(spark, sf):
    rows = B.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 100 / 100.0).alias("confidence"), (F.col("n_chars") / 200.0).alias("duration"))
    return I.clean_for_upload(rows, B.listing(spark, sf), "doc_id", F.col("duration").between(0.5, 10.0), 0.5)[1]


_L = "p AS (SELECT vec_id, embedding AS e, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings), l AS (SELECT vec_id, i // 8 AS band, i % 8 AS t, abs(b[i + 1]::DOUBLE) AS x, abs(e[i + 1]::DOUBLE) AS y FROM p, (SELECT unnest(range(64)) AS i) WHERE b IS NOT NULL)"
_TRAIN = f"""{_L}, a AS (SELECT vec_id, 1 - sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS cosine_loss, sqrt(sum((x - y) * (x - y))) / (sqrt(sum(y * y)) + 1e-8) AS spectral_convergence, avg(abs(ln(greatest(x, 1e-5)) - ln(greatest(y, 1e-5)))) AS log_l1_loss FROM l GROUP BY vec_id),
    c AS (SELECT vec_id, 1 - avg(r) AS freq_correlation_loss FROM (SELECT vec_id, band, (avg(x * y) - avg(x) * avg(y)) / ((stddev_samp(x) + 1e-8) * (stddev_samp(y) + 1e-8)) AS r FROM l GROUP BY vec_id, band) GROUP BY vec_id),
    m AS (SELECT vec_id, avg(abs(u - v)) AS centroid_loss FROM (SELECT vec_id, t, sum(band * x) / (sum(x) + 1e-8) AS u, sum(band * y) / (sum(y) + 1e-8) AS v FROM l GROUP BY vec_id, t) GROUP BY vec_id),
    s AS (SELECT *, 0.3 * cosine_loss + 0.2 * spectral_convergence + 0.2 * log_l1_loss + 0.2 * freq_correlation_loss + 0.1 * centroid_loss AS perceptual_loss FROM a JOIN c USING (vec_id) JOIN m USING (vec_id))"""
_STFT = """o AS (SELECT n, f, k, f * n // 4 + k - n // 2 AS j, 0.5 - 0.5 * cos(2 * pi() * k / n) AS w FROM (SELECT unnest([32, 16]) AS n), (SELECT unnest(range(17)) AS f), (SELECT unnest(range(32)) AS k) WHERE k < n AND f <= 256 // n),
    x AS (SELECT vec_id, n, f, k, w * embedding[CASE WHEN j < 0 THEN -j WHEN j > 63 THEN 126 - j ELSE j END + 1]::DOUBLE AS x FROM embeddings, o),
    z AS (SELECT vec_id, n, f, q, ln(greatest(sqrt(sum(x * cos(2 * pi() * q * k / n)) ** 2 + sum(x * sin(2 * pi() * q * k / n)) ** 2) / sqrt(n * 0.375::DOUBLE), 1e-5)) AS v FROM x, (SELECT unnest(range(17)) AS q) WHERE q <= n // 2 GROUP BY vec_id, n, f, q)"""
SQL = {
    "stft_levels": f"WITH {_STFT} SELECT vec_id, CAST(CASE n WHEN 32 THEN 0 ELSE 1 END AS INTEGER) AS size, CAST(f AS INTEGER) AS frame, round(avg(v), 6) AS level FROM z GROUP BY vec_id, n, f",
    "voice_similarity": f"""WITH {_TRAIN}, d AS (SELECT vec_id, avg(abs(x - y)) AS mel_l1 FROM l GROUP BY vec_id),
    e AS (SELECT vec_id, (sqrt(sum(v * v)) - 0.15) ** 2 AS norm_reg, avg(abs(v)) * 0.1 AS smoothness FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY vec_id)
    SELECT vec_id, round(mel_l1, 6) AS mel_l1, round(spectral_convergence, 6) AS spectral_conv, round(cosine_loss, 6) AS cosine, round(centroid_loss, 6) AS centroid, round(norm_reg, 6) AS norm_reg, round(smoothness, 6) AS smoothness,
      round(0.3 * mel_l1 + 0.25 * spectral_convergence + 0.2 * cosine_loss + 0.15 * centroid_loss + 0.05 * norm_reg + 0.099250419143429 * smoothness, 6) AS total_loss FROM s JOIN d USING (vec_id) JOIN e USING (vec_id)""",
    "perceptual_similarity": f"""WITH {_L}, a AS (SELECT vec_id, sum(x * y) / sqrt(sum(x * x) * sum(y * y)) AS cosine, corr(x, y) AS correlation, sqrt(sum((x - y) ** 2) / sum(y * y)) AS convergence FROM l GROUP BY vec_id),
    c AS (SELECT vec_id, corr(u, v) AS centroid FROM (SELECT vec_id, t, sum(band * x) / (sum(x) + 1e-8) AS u, sum(band * y) / (sum(y) + 1e-8) AS v FROM l GROUP BY vec_id, t) GROUP BY vec_id),
    h AS (SELECT vec_id, greatest(0.0, coalesce(1 - abs(p - q) / q, 0)) AS pitch FROM (SELECT vec_id, avg(x) FILTER (x > 0.1) AS p, avg(y) FILTER (y > 0.1) AS q FROM (SELECT vec_id, b[i + 1]::DOUBLE * 1000 / 1000 AS x, e[i + 1]::DOUBLE AS y FROM p, (SELECT unnest(range(64)) AS i) WHERE b IS NOT NULL) GROUP BY vec_id))
    SELECT vec_id, round(cosine, 6) AS cosine, round(correlation, 6) AS correlation, round(convergence, 6) AS convergence, round(pitch, 6) AS pitch, round(centroid, 6) AS centroid,
      round(greatest(0.0, least(1.0, 0.3 * cosine + 0.3 * correlation + 0.2 * (1 - least(convergence, 1.0)) + 0.1 * pitch + 0.1 * coalesce(centroid, 0))), 6) AS score FROM a JOIN c USING (vec_id) JOIN h USING (vec_id)""",
    "cepstral_distortion": f"WITH {_L}, c AS (SELECT vec_id, t, k, sum((x - y) * cos(pi() * (band + 0.5::DOUBLE) * k / 8)) * sqrt(CASE WHEN k = 0 THEN 1 ELSE 2 END / 8::DOUBLE) AS c FROM l, (SELECT unnest(range(8)) AS k) GROUP BY vec_id, t, k) SELECT vec_id, round(avg(d), 6) AS mcd FROM (SELECT vec_id, t, sqrt(sum(c * c)) AS d FROM c GROUP BY vec_id, t) GROUP BY vec_id",
    "pitch_similarity": f"WITH {_L.replace('abs', '')} SELECT vec_id, round(abs(a - b), 6) AS difference, round(greatest(0, coalesce(1 - abs(a - b) / b, 0)), 6) AS similarity FROM (SELECT vec_id, avg(x * 1000) FILTER (x > 0.1) AS a, avg(y * 1000) FILTER (y > 0.1) AS b FROM l GROUP BY vec_id)",
    "training_similarity": f"WITH {_TRAIN} SELECT vec_id, round(cosine_loss, 6) AS cosine_loss, round(spectral_convergence, 6) AS spectral_convergence, round(log_l1_loss, 6) AS log_l1_loss, round(freq_correlation_loss, 6) AS freq_correlation_loss, round(centroid_loss, 6) AS centroid_loss, round(perceptual_loss, 6) AS perceptual_loss FROM s",
    "voice_loss": f"""WITH {_STFT}, {_TRAIN}, b AS (SELECT vec_id, lag(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS old FROM embeddings),
    r AS (SELECT vec_id, avg(d) AS stft_loss FROM (SELECT b.vec_id, z.n, avg(abs(z.v - y.v)) AS d FROM b JOIN z ON z.vec_id = b.vec_id JOIN z y ON y.vec_id = b.old AND y.n = z.n AND y.f = z.f AND y.q = z.q GROUP BY b.vec_id, z.n) GROUP BY vec_id),
    d AS (SELECT vec_id, avg(abs(x - y)) AS l1_loss, avg((x - y) * (x - y)) AS mse_loss FROM l GROUP BY vec_id),
    f AS (SELECT vec_id, 0.5 * avg(abs(dx - dy)) AS freq_loss FROM (SELECT vec_id, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM l WINDOW w AS (PARTITION BY vec_id, t ORDER BY band)) GROUP BY vec_id),
    g AS (SELECT vec_id, CASE WHEN vec_id % 20 > 10 AND stddev_samp(v) > 0.18 THEN sum(v * v) * 0.01 ELSE 0 END AS style_reg_loss FROM (SELECT vec_id, unnest(embedding)::DOUBLE * 1.45 AS v FROM embeddings) GROUP BY vec_id),
    q AS (SELECT vec_id, l1_loss, mse_loss, freq_loss, stft_loss, style_reg_loss, CASE WHEN vec_id % 20 > 5 THEN perceptual_loss * 0.1 ELSE 0 END AS perc, CASE WHEN vec_id % 20 >= 5 THEN least(0.15, (vec_id % 20 - 4) / 10.0 * 0.15) ELSE 0 END::DOUBLE AS w FROM s JOIN d USING (vec_id) JOIN f USING (vec_id) JOIN g USING (vec_id) JOIN r USING (vec_id))
    SELECT vec_id, round(l1_loss, 6) AS l1_loss, round(mse_loss, 6) AS mse_loss, round(freq_loss, 6) AS freq_loss, round(stft_loss, 6) AS stft_loss, round(style_reg_loss, 6) AS style_reg_loss, round(perc, 6) AS perceptual_loss, round((0.55 - w) * l1_loss + 0.25 * mse_loss + 0.05 * freq_loss + 0.15 * stft_loss + w * perc + style_reg_loss, 6) AS total_loss FROM q""",
    "mean_spectrum": "WITH l AS (SELECT label, vec_id, i // 8 AS band, i % 8 AS frame, 4 + vec_id % 5 AS n, abs(embedding[i + 1]::DOUBLE) AS x FROM embeddings, (SELECT unnest(range(64)) AS i)), w AS (SELECT *, min(x) FILTER (frame < n) OVER (PARTITION BY vec_id) AS low, max(n) OVER (PARTITION BY label) AS longest FROM l) SELECT label, CAST(band AS INTEGER) AS band, CAST(frame AS INTEGER) AS frame, round(avg(CASE WHEN frame < n THEN x ELSE low END), 6) AS x FROM w WHERE frame < longest GROUP BY ALL",
    "mean_components": "SELECT user_id, event_type AS key, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2",
    "merged_maps": "SELECT event_id, CAST(CASE WHEN event_type = 'click' THEN 2 ELSE 3 END AS INTEGER) AS n, -1.0::DOUBLE AS click, 7.0::DOUBLE AS rank, CASE WHEN event_type = 'click' THEN -1.0 ELSE value END AS own FROM events",
    "half_deviations": "SELECT label, half, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM (SELECT label, CASE WHEN i < 32 THEN 'timbre' ELSE 'style' END AS half, embedding[i + 1]::DOUBLE AS x FROM embeddings, (SELECT unnest(range(64)) AS i)) GROUP BY label, half",
    "rescaled_index": "SELECT event_id, event_id * 22050 // 16000 AS i FROM events",
    "time_stamps": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS compact, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events",
    "delete_list": "SELECT doc_id, CASE WHEN good IS NULL THEN 'orphaned' ELSE 'rejected' END AS reason FROM (SELECT DISTINCT doc_id FROM documents WHERE lang = 'en') LEFT JOIN (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good FROM labels GROUP BY doc_id) USING (doc_id) WHERE good IS NULL OR NOT good",
    "clean_for_upload": "WITH c AS (SELECT doc_id, n_chars / 200.0 BETWEEN 0.5 AND 10 AS good FROM documents WHERE n_chars % 100 / 100.0 >= 0.5), g AS (SELECT doc_id FROM c WHERE good), h AS (SELECT DISTINCT doc_id FROM documents WHERE lang = 'en') SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM c) AS confident, (SELECT count(*) FROM g) AS clean, (SELECT count(*) FROM g WHERE doc_id IN (FROM h)) AS kept, (SELECT count(*) FROM h WHERE doc_id NOT IN (FROM g)) AS n_orphaned, (SELECT count(DISTINCT doc_id) FROM g WHERE doc_id NOT IN (FROM h)) AS n_missing, (SELECT count(doc_id) - count(DISTINCT doc_id) FROM g) AS n_repeated, (SELECT count(*) > 0 AND count(*) = count(DISTINCT doc_id) AND bool_and(doc_id IN (FROM h)) FROM g) AS valid",
}
QUERIES = {name: globals()[name] for name in SQL}
