"""Queries: vectors and signals."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import augment as A
from ..functions import pitch as P
from ..functions import rates as S
from ..functions import signal as G
from ..functions import vectors as V
from ..operators import quality as Q
from ..operators import search as N
from ..operators.scan import row_numbers, with_previous
from . import bindings as B

R = lambda c, n=6: F.round(c, n)
RATE = 24_000


def vector_stats(spark, sf):
    timbre, style = V.halves(F.col("vec"), B.DIMS)
    v = B.vectors(spark, sf).select("vec_id", V.describe(timbre).alias("t"), V.describe(style).alias("s"))
    return v.select("vec_id", *(R(f"{h}.{c}").alias(f"{n}_{c}") for h, n in (("t", "timbre"), ("s", "style")) for c in ("mean", "std", "min", "max", "range")))


def vector_health(spark, sf):
    h = B.vectors(spark, sf).select(V.health(F.transform(F.col("vec"), lambda x: x * 25)).alias("h")).select("h.*")
    return h.groupBy(*h.columns).agg(F.count("*").alias("n"))


def mean_pool_voice(spark, sf):
    return B.voices(spark, sf).select("label", F.posexplode("vec").alias("pos", "x")).select("label", "pos", R("x").alias("x"))


def active_dims(spark, sf):
    return V.dim_std(B.voices(spark, sf), "vec").agg(F.count("*").alias("dims"), F.count_if(F.col("std") > 0.02).alias("active"))


def dimension_stats(spark, sf):
    return V.dim_std(B.vectors(spark, sf), "vec").select("pos", R("mean").alias("mean"), R("std").alias("std"))


def embedding_stats(spark, sf):
    timbre, style = V.halves(F.col("vec"), B.DIMS)
    steps = V.adjacent_distance(B.vectors(spark, sf), "label", "vec_id", "vec")
    return steps.groupBy("label").agg(R(F.avg(V.mean(timbre))).alias("timbre_mean"), R(F.avg(V.mean(style))).alias("style_mean"), R(F.avg("step_l2")).alias("mean_step"))


def pairwise_distance(spark, sf):
    return N.pairwise_distances(B.voices(spark, sf), "label", "vec").select("a", "b", R("distance").alias("distance"))


def diversity(spark, sf):
    d = N.pairwise_distances(B.voices(spark, sf), "label", "vec").agg(F.avg("distance").alias("d"), F.count("*").alias("pairs"))
    return d.select("pairs", R("d").alias("mean_distance"), F.when(F.col("d") < 0.01, "collapsed").when(F.col("d") < 0.1, "low").otherwise("good").alias("diversity"))


def _with_previous(spark, sf):
    return with_previous(B.vectors(spark, sf), "label", ["vec_id"], "vec", "before").where("before IS NOT NULL")


def voice_drift(spark, sf):
    d = _with_previous(spark, sf).select("vec_id", V.drift(F.col("before"), F.col("vec")).alias("d"))
    return d.select("vec_id", *(R(f"d.{c}").alias(c) for c in ("cosine", "l2", "l1", "max_change")), (R("d.norm_change_pct", 5) + 0.0).alias("norm_change_pct"), V.drift_label(F.col("d.cosine")).alias("verdict"))


def top_changed_dims(spark, sf):
    d = _with_previous(spark, sf).select("vec_id", V.drift(F.col("before"), F.col("vec")).alias("d"))
    return d.select("vec_id", F.array_join("d.top_dims", ",").alias("dims"))


def nearest_voice(spark, sf):
    n = N.nearest(B.vectors(spark, sf), B.voices(spark, sf), "vec_id", "vec", "label", "vec")
    return n.select("vec_id", "best", R("best_score").alias("best_score"))


def preferred_voice(spark, sf):
    return V.preferred(B.table(spark, sf, "part"), "p_name", ["azure", "blue", "green", "red", "part", "a"]).select("name", "rank")


def similarity_scores(spark, sf):
    before = F.col("before")
    d = _with_previous(spark, sf).select("vec_id", V.cosine(before, F.col("vec")).alias("cos"), V.pearson(before, F.col("vec")).alias("corr"), V.spectral_convergence(before, F.col("vec")).alias("sc"), V.mse(before, F.col("vec")).alias("mse"))
    score = V.perceptual_score(F.col("cos"), F.col("corr"), F.col("sc"), F.lit(0.5), F.lit(None).cast("double"))
    weighted = V.weighted_similarity({"cosine": F.col("cos"), "convergence": 1 - F.least("sc", F.lit(1.0)), "level": F.exp(-F.col("mse"))}, {"cosine": 0.5, "convergence": 0.3, "level": 0.2})
    return d.select("vec_id", R("corr").alias("corr"), R("sc").alias("convergence"), R(score).alias("perceptual"), R(weighted).alias("weighted"), V.similarity_label(score, F.col("sc") * 3, F.col("cos")).alias("verdict"))


def bin_centroids(spark, sf):
    return B.vectors(spark, sf).select("vec_id", R(V.bin_centroid(F.transform(F.col("vec"), lambda x: F.abs(x)))).alias("centroid"))


def length_smoothing(spark, sf):
    s = V.smoothed(B.vectors(spark, sf), "label", "vec_id", "vec")
    return s.select("vec_id", F.posexplode("smoothed").alias("pos", "x")).select("vec_id", "pos", R("x").alias("x"))


def smoothness(spark, sf):
    s = V.adjacent_distance(B.vectors(spark, sf), "label", "vec_id", "vec")
    return s.groupBy("label").agg(R(F.avg("step_sq") * 0.1).alias("loss"), R(F.avg("step_l2")).alias("mean_step"))


def length_expand(spark, sf):
    v = B.voices(spark, sf).select("label", V.norm(F.col("vec")).alias("n"), F.explode(V.length_expanded(F.col("vec"))).alias("e"))
    return v.select("label", F.col("e.length_idx").alias("length_idx"), R(F.col("n") * F.col("e.factor")).alias("norm"))


def length_lookup(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", V.length_index(F.length("text")).alias("length_idx"))


def middle_row(spark, sf):
    v = B.vectors(spark, sf)
    n = v.groupBy("label").agg(F.floor(F.count("*") / 2).alias("mid"))
    numbered = row_numbers(v.select("label", "vec_id"), "label", ["vec_id"], "i")
    return numbered.join(n, "label").where("i - 1 = mid").select("label", "vec_id")


def health_clamp(spark, sf):
    """Both halves of voices of twice the size, the style half moved to a mean of 0.05."""
    v = B.vectors(spark, sf).select("vec_id", "label", *(h.alias(n) for h, n in zip(V.halves(F.transform(F.col("vec"), lambda x: x * 2), B.DIMS), ("timbre", "style"), strict=True)))
    out = v
    for half in ("timbre", "style"):
        sd = v.select("label", F.explode(half).alias("x")).groupBy("label").agg(F.stddev_samp("x").alias(f"{half}_sd"))
        most = v.groupBy("label").agg(F.max(V.norm(F.col(half))).alias(f"{half}_most"))
        out = out.join(sd, "label").join(most, "label")
    middle = {"timbre": F.lit(0.0), "style": F.lit(0.05)}
    out = out.select("vec_id", *(V.health_clamped(F.col(h), F.col(f"{h}_sd"), F.col(f"{h}_most"), middle[h]).alias(h) for h in middle))
    return out.select("vec_id", *(R(V.norm(F.col(h))).alias(f"{h}_norm") for h in middle), *((R(V.mean(F.col(h))) + 0.0).alias(f"{h}_mean") for h in middle))


def pca_variance(spark, sf):
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    v = B.vectors(spark, sf).select(array_to_vector("vec").alias("v"))
    model = PCA(k=2, inputCol="v", outputCol="p").fit(v)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(model.explainedVariance)], "component int, share double")


def signal_metrics(spark, sf):
    m = B.vectors(spark, sf).select("vec_id", G.metrics(F.col("vec")).alias("m"), G.zero_crossing_half(F.col("vec")).alias("zcr_half")).select("vec_id", "m.*", "zcr_half")
    return m.select("vec_id", *(R(c).alias(c) for c in m.columns[1:]))


def frame_snr(spark, sf):
    return B.vectors(spark, sf).select("vec_id", R(G.frame_snr_db(F.col("vec"), 8)).alias("snr_db"), R(G.trimmed_snr_db(F.col("vec"))).alias("trimmed_db"))


def enhancement_choice(spark, sf):
    """Signals scaled by 1, 10 and 100, so that quiet and loud ones occur; the centroid is that of the samples, scaled to a frequency."""
    v = B.vectors(spark, sf).withColumn("vec", F.transform(F.col("vec"), lambda x: x * F.pow(F.lit(10.0), F.col("label") % 3)))
    m = v.select(G.level_db(F.col("vec")).alias("level"), (V.bin_centroid(F.transform(F.col("vec"), lambda x: F.abs(x))) * 80).alias("centroid"), G.rms(F.col("vec")).alias("rms"), G.silence_ratio(F.col("vec")).alias("silence"))
    return m.groupBy(F.array_join(G.enhancement_methods(F.col("level"), F.col("centroid"), F.col("rms"), F.col("silence"), RATE), ",").alias("methods")).agg(F.count("*").alias("n"))


def _long(df, column):
    return df.select("vec_id", F.posexplode(column).alias("pos", "x")).select("vec_id", "pos", R("x").alias("x"))


def peak_normalized(spark, sf):
    return _long(B.vectors(spark, sf), G.peak_normalize(F.col("vec")))


def rms_normalized(spark, sf):
    return _long(B.vectors(spark, sf), G.rms_normalize(F.col("vec")))


def loudness_normalized(spark, sf):
    return _long(B.vectors(spark, sf), G.scaled_to_peak(F.col("vec"), -0.1))


def trimmed_silence(spark, sf):
    t = B.vectors(spark, sf).select("vec_id", G.trim_silence(F.col("vec"), -20.0).alias("t"))
    return t.select("vec_id", F.size("t").alias("n"), R(V.total(F.col("t"))).alias("total"))


def padded_signals(spark, sf):
    p = B.vectors(spark, sf).select("vec_id", G.pad_or_cut(F.col("vec"), 40).alias("cut"), G.pad_or_cut(F.col("vec"), 80).alias("padded"), G.padded_slice(F.col("vec"), F.lit(10), F.lit(60), F.lit(5), F.lit(10)).alias("part"))
    return p.select("vec_id", *(F.size(c).alias(f"n_{c}") for c in ("cut", "padded", "part")), *(R(V.total(F.col(c))).alias(c) for c in ("cut", "padded", "part")))


def chunks_joined(spark, sf):
    bounds = G.chunk_bounds(F.size("vec"), 20, 4)
    v = B.vectors(spark, sf).withColumn("chunks", F.transform(bounds, lambda b: F.slice("vec", b["start"] + 1, b["end"] - b["start"])))
    return v.select("vec_id", F.size("chunks").alias("n_chunks"), (G.joined_chunks(F.col("chunks"), 4) == F.col("vec")).alias("whole"))


def unfolded_frames(spark, sf):
    f = B.vectors(spark, sf).select("vec_id", F.posexplode(G.unfold(F.col("vec"), 16, 8)).alias("frame", "f"))
    return f.select("vec_id", "frame", R(G.rms(F.col("f"))).alias("rms"))


def downmixed(spark, sf):
    timbre, style = V.halves(F.col("vec"), B.DIMS)
    return _long(B.vectors(spark, sf), G.downmix(F.array(timbre, style)))


def signal_gate(spark, sf):
    m = B.vectors(spark, sf).select(F.size("vec").alias("n"), G.peak(F.col("vec")).alias("peak"), G.frame_snr_db(F.col("vec"), 8).alias("snr"), G.dc_offset(F.col("vec")).alias("dc"))
    found = Q.issues(Q.Thresholds(min_snr_db=6.0, max_duration=100.0, max_dc_offset=0.03), F.col("n") / 10.0, F.col("peak"), F.col("snr"), F.col("dc"))
    return m.groupBy(F.array_join(found, ",").alias("issues")).agg(F.count("*").alias("n"))


def spectral_ratios(spark, sf):
    s = B.vectors(spark, sf).select("vec_id", G.spectral_ratios(F.col("vec"), RATE).alias("s")).select("vec_id", "s.*")
    return s.select("vec_id", *(R(c).alias(c) for c in s.columns[1:]))


def pitch_stats(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.pitch_stats(F.col("vec"), 2000.0, 64, 16).alias("p")).select("vec_id", "p.*")


def log_mel(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.log_mel(F.col("vec"), RATE, 64, 16, 8).alias("mel"))


def stft_centroid(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.stft_centroid(F.col("vec"), RATE, 32).alias("centroid"))


def log_spectra(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.log_spectra(F.col("vec"), (32, 16)).alias("spectra"))


def spectral_subtraction(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.spectral_subtraction(F.col("vec"), 16).alias("clean"))


def resampled(spark, sf):
    """Each vector as a signal of 24 kHz at 16 kHz."""
    x = B.vectors(spark, sf).select("vec_id", F.posexplode(S.resample(F.col("vec"), 24_000, 16_000)).alias("pos", "x"))
    return x.select("vec_id", "pos", (R("x") + 0.0).alias("x"))


def resampled_rows(spark, sf):
    """All vectors of a label as one signal in rows of 64 samples, from 16 to 24 kHz: levels of the rows."""
    v = row_numbers(B.vectors(spark, sf), "label", ["vec_id"], "i").select("label", ((F.col("i") - 1) * B.DIMS).alias("start"), "vec")
    out = S.resample_rows(v, "label", "start", "vec", 16_000, 24_000)
    return out.select("label", "start", F.size("vec").alias("n"), R(V.total(F.transform("vec", lambda x: x * x))).alias("energy"))


def augmented(spark, sf):
    """The signals as a training step sees them; the step is the id's remainder by three."""
    step = F.col("vec_id") % 3
    a = B.vectors(spark, sf).select("vec_id", F.posexplode(A.augmented(F.col("vec"), F.col("vec_id"), step)).alias("pos", "x"))
    return a.select("vec_id", "pos", (R("x") + 0.0).alias("x"))


def pitch_corrected(spark, sf):
    """A voice-like tone for each vector, of 150 to 209 Hz at 8 kHz, moved to 180 Hz: its length, and whether its crossings of zero are those of the target."""
    pitch = F.col("vec_id") % 60 + 150
    tone = F.transform(F.sequence(F.lit(0), F.lit(1599)), lambda i: F.sin(i * pitch * (2 * math.pi / 8000)) * 0.5)
    moved = B.vectors(spark, sf).select("vec_id", tone.alias("x")).select("vec_id", P.pitch_corrected(F.col("x"), 8000, 180.0).alias("x"))
    crossings = F.size(F.filter(F.zip_with(F.slice("x", 1, 1599), F.slice("x", 2, 1599), lambda a, b: F.signum(a) * F.signum(b)), lambda c: c < 0))
    return moved.select("vec_id", F.size("x").alias("n"), (F.abs(crossings - 72) <= 3).alias("on_target"))


def high_passed(spark, sf):
    return _long(B.vectors(spark, sf), G.high_pass(F.col("vec"), RATE))


def voice_features(spark, sf):
    return B.vectors(spark, sf).select("vec_id", G.voice_features(F.col("vec"), RATE).alias("features"))


_V = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings)"
_POOL = "(SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY label, pos)"
_VOICE = f"(SELECT label, list(m ORDER BY pos) AS vec FROM {_POOL} GROUP BY label)"
_PREV = f"(SELECT * FROM (SELECT vec_id, label, vec, lag(vec) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM {_V}) WHERE prev IS NOT NULL)"


def _norm(v):
    return f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"


def _dot(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"


def _l2(a, b):
    return f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


def _pop(v):
    return f"sqrt(list_sum(list_transform({v}, lambda x: (x - list_avg({v})) * (x - list_avg({v})))) / len({v}))"


_COS = f"{_dot('prev', 'vec')} / ({_norm('prev')} * {_norm('vec')})"
_STEP = f"(SELECT label, vec, {_l2('vec', 'prev')} AS s FROM (SELECT vec_id, label, vec, lag(vec) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM {_V}))"
_CEN = lambda v: f"list_transform({v}, lambda x: x - list_avg({v}))"
_SIG = "list_transform(vec, lambda x: sign(x))"
_MS = "(list_sum(list_transform(vec, lambda x: x * x)) / 64)"
_PEAK = "list_max(list_transform(vec, lambda x: abs(x)))"
_SNR = f"10 * log10({_MS} / (quantile_cont(p, 0.1) + 1e-10))"
_FRAMES = "(SELECT vec_id, vec, list_sum(list_transform(vec[i + 1:i + 8], lambda x: x * x)) / 8 AS p FROM (SELECT vec_id, vec, unnest(range(0, 56, 8)) AS i FROM " + _V + "))"


def _posx(expr, source=_V):
    return f"SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x, 6) AS x FROM (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM (SELECT vec_id, {expr} AS v FROM {source}))"


_SCORE = "0.3 * cos + 0.3 * corr + 0.2 * (1 - least(sc, 1.0)) + 0.1 * 0.5"
SQL = {
    "vector_stats": "SELECT vec_id, " + ", ".join(f"round(list_avg({v}), 6) AS {h}_mean, round({_pop(v)}, 6) AS {h}_std, round(list_min({v}), 6) AS {h}_min, round(list_max({v}), 6) AS {h}_max, round(list_max({v}) - list_min({v}), 6) AS {h}_range" for h, v in (("timbre", "t"), ("style", "s"))) + f" FROM (SELECT vec_id, vec[1:32] AS t, vec[33:64] AS s FROM {_V})",
    "vector_health": f"SELECT false AS has_nan, false AS has_inf, {_PEAK} > 10 AS extreme_values, {_pop('vec')} < 0.01 AS flat, {_pop('vec')} > 1.0 AS unstable, count(*) AS n FROM (SELECT list_transform(vec, lambda x: x * 25) AS vec FROM {_V}) GROUP BY ALL",
    "mean_pool_voice": f"SELECT label, CAST(pos AS INTEGER) AS pos, round(m, 6) AS x FROM {_POOL}",
    "active_dims": f"SELECT count(*) AS dims, count(*) FILTER (sd > 0.02) AS active FROM (SELECT pos, stddev_samp(m) AS sd FROM {_POOL} GROUP BY pos)",
    "dimension_stats": "SELECT CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY pos",
    "embedding_stats": f"SELECT label, round(avg(list_avg(vec[1:32])), 6) AS timbre_mean, round(avg(list_avg(vec[33:64])), 6) AS style_mean, round(avg(s), 6) AS mean_step FROM {_STEP} GROUP BY label",
    "pairwise_distance": f"SELECT a.label AS a, b.label AS b, round({_l2('a.vec', 'b.vec')}, 6) AS distance FROM {_VOICE} a JOIN {_VOICE} b ON a.label < b.label",
    "diversity": f"SELECT count(*) AS pairs, round(avg(d), 6) AS mean_distance, CASE WHEN avg(d) < 0.01 THEN 'collapsed' WHEN avg(d) < 0.1 THEN 'low' ELSE 'good' END AS diversity FROM (SELECT {_l2('a.vec', 'b.vec')} AS d FROM {_VOICE} a JOIN {_VOICE} b ON a.label < b.label)",
    "voice_drift": f"SELECT vec_id, round(cosine, 6) AS cosine, round(l2, 6) AS l2, round(l1, 6) AS l1, round(max_change, 6) AS max_change, round(pct, 5) + 0.0 AS norm_change_pct, CASE WHEN cosine > 0.95 THEN 'very similar' WHEN cosine > 0.85 THEN 'similar' WHEN cosine > 0.7 THEN 'moderate change' ELSE 'large change' END AS verdict FROM (SELECT vec_id, {_COS} AS cosine, {_l2('vec', 'prev')} AS l2, list_sum(list_transform(list_zip(vec, prev), lambda p: abs(p[1] - p[2]))) AS l1, list_max(list_transform(list_zip(vec, prev), lambda p: abs(p[1] - p[2]))) AS max_change, ({_norm('vec')} - {_norm('prev')}) / {_norm('prev')} * 100 AS pct FROM {_PREV})",
    "top_changed_dims": f"SELECT vec_id, string_agg(pos::VARCHAR, ',' ORDER BY r) AS dims FROM (SELECT vec_id, pos, row_number() OVER (PARTITION BY vec_id ORDER BY d DESC, pos) AS r FROM (SELECT vec_id, abs(unnest(vec) - unnest(prev)) AS d, generate_subscripts(vec, 1) - 1 AS pos FROM {_PREV})) WHERE r <= 5 GROUP BY vec_id",
    "nearest_voice": f"SELECT vec_id, best, round(s, 6) AS best_score FROM (SELECT vec_id, c.label AS best, {_l2('v.vec', 'c.vec')} ** 2 / 64 - {_dot('v.vec', 'c.vec')} / ({_norm('v.vec')} * {_norm('c.vec')}) AS s, row_number() OVER (PARTITION BY vec_id ORDER BY s, c.label) AS r FROM {_V} v, {_VOICE} c) WHERE r = 1",
    "preferred_voice": "SELECT name, CAST(rank AS INTEGER) AS rank FROM (SELECT p_name AS name, CASE WHEN contains(p_name, 'azure') THEN 0 WHEN contains(p_name, 'blue') THEN 1 WHEN contains(p_name, 'green') THEN 2 WHEN contains(p_name, 'red') THEN 3 WHEN contains(p_name, 'part') THEN 4 WHEN contains(p_name, 'a') THEN 5 END AS rank FROM part) WHERE rank IS NOT NULL ORDER BY rank, name LIMIT 1",
    "similarity_scores": f"SELECT vec_id, round(corr, 6) AS corr, round(sc, 6) AS convergence, round(greatest(0, least(1, {_SCORE})), 6) AS perceptual, round(0.3 * (1 - least(sc, 1.0)) + 0.5 * cos + 0.2 * exp(-mse), 6) AS weighted, CASE WHEN {_SCORE} > 0.85 THEN 'excellent' WHEN {_SCORE} > 0.7 THEN 'good' WHEN {_SCORE} > 0.5 THEN 'fair' ELSE 'poor' END || ' | ' || CASE WHEN sc * 3 < 2 THEN 'timbre very close' WHEN sc * 3 < 4 THEN 'timbre close' WHEN sc * 3 < 6 THEN 'timbre similar' ELSE 'timbre different' END || ' | ' || CASE WHEN cos > 0.9 THEN 'pitch very close' WHEN cos > 0.7 THEN 'pitch close' WHEN cos > 0.5 THEN 'pitch similar' ELSE 'pitch different' END AS verdict FROM (SELECT vec_id, {_COS} AS cos, {_dot(_CEN('prev'), _CEN('vec'))} / ({_norm(_CEN('prev'))} * {_norm(_CEN('vec'))}) AS corr, {_l2('prev', 'vec')} / ({_norm('vec')} + 1e-8) AS sc, {_l2('prev', 'vec')} ** 2 / 64 AS mse FROM {_PREV})",
    "bin_centroids": f"SELECT vec_id, round(list_sum(list_transform(vec, lambda x, i: abs(x) * (i - 1))) / (list_sum(list_transform(vec, lambda x: abs(x))) + 1e-8), 6) AS centroid FROM {_V}",
    "length_smoothing": _posx("CASE WHEN prev IS NULL THEN vec ELSE list_transform(list_zip(prev, vec), lambda p: 0.2 * p[1] + (1 - 0.2) * p[2]) END", f"(SELECT vec_id, vec, lag(vec) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM {_V})"),
    "smoothness": f"SELECT label, round(avg(s * s) * 0.1, 6) AS loss, round(avg(s), 6) AS mean_step FROM {_STEP} GROUP BY label",
    "length_expand": f"SELECT label, CAST(i AS INTEGER) AS length_idx, round({_norm('vec')} * (1 + i / 510.0::DOUBLE * 0.05), 6) AS norm FROM {_VOICE}, range(0, 510) r(i)",
    "length_lookup": "SELECT doc_id, CAST(greatest(0, least(length(text) - 1, 509)) AS INTEGER) AS length_idx FROM documents",
    "middle_row": "SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) // 2 AS mid FROM embeddings) WHERE i = mid",
    "health_clamp": f"""WITH h AS (SELECT vec_id, label, half, CASE WHEN half = 0 THEN 0.0 ELSE 0.05 END AS middle, list_transform(vec[half * 32 + 1:half * 32 + 32], lambda x: x * 2) AS v FROM {_V}, (SELECT unnest([0, 1]) AS half)),
        s AS (SELECT label, half, stddev_samp(x) AS sd FROM (SELECT label, half, unnest(v) AS x FROM h) GROUP BY label, half),
        n AS (SELECT label, half, max({_norm('v')}) AS most FROM h GROUP BY label, half),
        c AS (SELECT vec_id, half, CASE WHEN (sd > 0.2 OR most > 1.0) AND {_norm('v')} > 0.6 THEN list_transform(v, lambda x: (x - list_avg(v)) * 0.14 / (list_stddev_samp(v) + 1e-8) + middle) ELSE v END AS v FROM h JOIN s USING (label, half) JOIN n USING (label, half))
        SELECT t.vec_id, round({_norm('t.v')}, 6) AS timbre_norm, round({_norm('y.v')}, 6) AS style_norm, round(list_avg(t.v), 6) + 0.0 AS timbre_mean, round(list_avg(y.v), 6) + 0.0 AS style_mean FROM c t JOIN c y ON t.vec_id = y.vec_id AND t.half = 0 AND y.half = 1""",
    "signal_metrics": f"SELECT vec_id, round(peak, 6) AS peak, round(sqrt(ms), 6) AS rms, round(20 * log10(peak / (sqrt(ms) + 1e-8)), 6) AS dynamic_range_db, round(len(list_filter(vec, lambda x: abs(x) > 0.95)) / 64, 6) AS clipping_ratio, round(list_sum(vec) / 64, 6) AS dc_offset, round(len(list_filter(list_zip(sg[1:63], sg[2:64]), lambda p: p[1] <> p[2])) / 64, 6) AS zcr, round(len(list_filter(vec, lambda x: abs(x) < 0.01 * peak)) / 64, 6) AS silence_ratio, round(10 * log10(ms + 1e-10), 6) AS level_db, round(list_sum(list_transform(list_zip(sg[1:63], sg[2:64]), lambda p: abs(p[2] - p[1]) / 2)) / 63, 6) AS zcr_half FROM (SELECT vec_id, vec, {_PEAK} AS peak, {_MS} AS ms, {_SIG} AS sg FROM {_V})",
    "frame_snr": f"SELECT vec_id, round({_SNR}, 6) AS snr_db, round(20 * log10(list_sum(s[58:64]) / 7 / (list_sum(s[1:6]) / 6 + 1e-8)), 6) AS trimmed_db FROM (SELECT vec_id, vec, p, list_sort(list_transform(vec, lambda x: abs(x))) AS s FROM {_FRAMES}) GROUP BY vec_id, vec, s",
    "enhancement_choice": f"""WITH v AS (SELECT list_transform(vec, lambda x: x * power(10.0, label % 3)) AS vec FROM {_V}),
        m AS (SELECT 10 * log10({_MS} + 1e-10) AS level, 80 * list_sum(list_transform(list_zip(vec, range(64)), lambda p: abs(p[1]) * p[2])) / (list_sum(list_transform(vec, lambda x: abs(x))) + 1e-8) AS centroid, sqrt({_MS}) AS rms, len(list_filter(vec, lambda x: abs(x) < 0.01 * {_PEAK})) / 64 AS silence FROM v)
        SELECT concat_ws(',', CASE WHEN level < 15 AND level < 12 THEN 'deepfilter' END, CASE WHEN level < 15 AND level < 5 THEN 'spectral_subtraction' END, CASE WHEN centroid < 24000 * 0.1 THEN 'resemble_enhance' END,
        CASE WHEN rms < 0.1 OR silence > 0.3 THEN 'pitch_correction' END, CASE WHEN (rms < 0.1 OR silence > 0.3) AND rms < 0.05 THEN 'metricgan' END) AS methods, count(*) AS n FROM m GROUP BY 1""",
    "peak_normalized": _posx("list_transform(c, lambda x: x * power(10, -3.0 / 20) / list_max(list_transform(c, lambda y: abs(y))))", f"(SELECT vec_id, list_transform(vec, lambda x: x - list_sum(vec) / 64) AS c FROM {_V})"),
    "rms_normalized": _posx(f"list_transform(vec, lambda x: x * 0.1 / (sqrt(ms) + 1e-8))", f"(SELECT vec_id, vec, {_MS} AS ms FROM {_V})"),
    "loudness_normalized": _posx("list_transform(vec, lambda x: x * power(10, -0.1 / 20) / pk)", f"(SELECT vec_id, vec, {_PEAK} AS pk FROM {_V})"),
    "trimmed_silence": f"SELECT vec_id, CAST(len(t) AS INTEGER) AS n, round(list_sum(t), 6) AS total FROM (SELECT vec_id, CASE WHEN len(l) > 0 THEN vec[list_min(l):list_max(l)] ELSE vec END AS t FROM (SELECT vec_id, vec, list_filter(range(1, 65), lambda i: 20 * log10(abs(vec[i]) + 1e-8) > -20) AS l FROM {_V}))",
    "padded_signals": f"SELECT vec_id, 40 AS n_cut, 80 AS n_padded, 65 - 6 AS n_part, round(list_sum(vec[1:40]), 6) AS cut, round(list_sum(vec), 6) AS padded, round(list_sum(vec[6:64]), 6) AS part FROM {_V}",
    "chunks_joined": "SELECT vec_id, CAST(ceil((64 - 20) / 16.0) AS INTEGER) + 1 AS n_chunks, true AS whole FROM embeddings",
    "unfolded_frames": f"SELECT vec_id, CAST(i // 8 AS INTEGER) AS frame, round(sqrt(list_sum(list_transform(vec[i + 1:i + 16], lambda x: x * x)) / 16), 6) AS rms FROM (SELECT vec_id, vec, unnest(range(0, 49, 8)) AS i FROM {_V})",
    "downmixed": _posx("list_transform(list_zip(vec[1:32], vec[33:64]), lambda p: (p[1] + p[2]) / 2)"),
    "signal_gate": f"SELECT concat_ws(',', CASE WHEN peak < 0.01 THEN 'too_quiet' WHEN peak > 0.99 THEN 'clipping' END, CASE WHEN snr < 6 THEN 'low_snr' END, CASE WHEN abs(dc) > 0.03 THEN 'dc_offset' END) AS issues, count(*) AS n FROM (SELECT {_SNR} AS snr, {_PEAK} AS peak, list_sum(vec) / 64 AS dc FROM {_FRAMES} GROUP BY vec_id, vec) GROUP BY 1",
}
_SIGNAL = "(SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS j FROM embeddings)"
#: The zero-phase filter as a matrix: the response at the frequencies of the signal followed by its mirror image.
FILTER_SQL = """f AS (SELECT k, power(least(k, 128 - k) * 24000.0 / 128 / 80, 8) / (1 + power(least(k, 128 - k) * 24000.0 / 128 / 80, 8)) AS r FROM (SELECT unnest(range(128)) AS k)),
    h AS (SELECT i, j, sum(r * (cos(2 * pi() * k * (i - j) / 128) + cos(2 * pi() * k * (i + j + 1) / 128))) / 128 AS w FROM f, (SELECT unnest(range(64)) AS i), (SELECT unnest(range(64)) AS j) GROUP BY i, j)"""
SQL["high_passed"] = f"WITH {FILTER_SQL} SELECT vec_id, CAST(i AS INTEGER) AS pos, round(sum(w * x), 6) + 0.0 AS x FROM {_SIGNAL} JOIN h USING (j) GROUP BY vec_id, i"
SQL["resampled"] = f"""WITH w AS (SELECT m, j, 0.95 * 2 / 3 * CASE WHEN t = 0 THEN 1 ELSE sin(pi() * t) / (pi() * t) END * cos(pi() * t / 48) ** 2 AS w FROM (SELECT m, j, (j - m * 1.5::DOUBLE) * (0.95::DOUBLE * 2 / 3) AS t FROM (SELECT unnest(range(43)) AS m), (SELECT unnest(range(64)) AS j)) WHERE abs(t) < 24)
    SELECT vec_id, CAST(m AS INTEGER) AS pos, round(sum(w * x), 6) + 0.0 AS x FROM {_SIGNAL} JOIN w USING (j) GROUP BY vec_id, m"""
SQL["resampled_rows"] = """WITH i AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding FROM embeddings),
    x AS (SELECT label, i * 64 + unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS x FROM i),
    o AS (SELECT label, i, unnest(range((i * 64 * 3 + 1) // 2, ((i + 1) * 64 * 3 + 1) // 2)) AS m FROM i),
    k AS (SELECT unnest(range(-26, 27)) AS k),
    y AS (SELECT o.label, o.i, o.m, sum(x * 0.95 * CASE WHEN t = 0 THEN 1 ELSE sin(pi() * t) / (pi() * t) END * cos(pi() * t / 48) ** 2) AS y
      FROM (SELECT label, i, m, m * 2 // 3 + k AS j, (m * 2 // 3 + k - m * 2 / 3::DOUBLE) * 0.95 AS t FROM o, k) o JOIN x USING (label, j) WHERE abs(t) < 24 GROUP BY o.label, o.i, o.m)
    SELECT label, CAST((i * 64 * 3 + 1) // 2 AS BIGINT) AS start, CAST(count(*) AS INTEGER) AS n, round(sum(y * y), 6) AS energy FROM y GROUP BY label, i"""
_U = lambda draw: f"(CAST(('0x' || substr(md5('42:' || vec_id || ':' || vec_id % 3 || ':{draw}'), 1, 13))::UBIGINT AS DOUBLE) / 4503599627370496)"
_LINEAR = lambda source, factor: f"""(SELECT * EXCLUDE (v), list_transform(range(CAST(floor(len(v) * {factor}) AS BIGINT)), lambda i: v[CAST(least(floor(greatest(0.0::DOUBLE, (i + 0.5) / {factor} - 0.5)), len(v) - 1) AS BIGINT) + 1]
    + (greatest(0.0::DOUBLE, (i + 0.5) / {factor} - 0.5) - least(floor(greatest(0.0::DOUBLE, (i + 0.5) / {factor} - 0.5)), len(v) - 1)) * (v[CAST(least(floor(greatest(0.0::DOUBLE, (i + 0.5) / {factor} - 0.5)) + 1, len(v) - 1) AS BIGINT) + 1] - v[CAST(least(floor(greatest(0.0::DOUBLE, (i + 0.5) / {factor} - 0.5)), len(v) - 1) AS BIGINT) + 1])) AS v FROM {source})"""  # noqa: E731
SQL["augmented"] = f"""WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, CASE WHEN {_U(0)} < 0.3 THEN 0.98::DOUBLE + {_U(1)} * 0.04::DOUBLE ELSE 1.0::DOUBLE END AS a, CASE WHEN {_U(2)} < 0.2 THEN 0.99::DOUBLE + {_U(3)} * 0.02::DOUBLE ELSE 1.0::DOUBLE END AS b, CASE WHEN {_U(4)} < 0.5 THEN 0.95::DOUBLE + {_U(5)} * 0.1::DOUBLE ELSE 1.0::DOUBLE END AS g FROM embeddings)
    SELECT vec_id, CAST(unnest(range(len(v))) AS INTEGER) AS pos, round(unnest(list_transform(v, lambda x: x * g)), 6) + 0.0 AS x FROM {_LINEAR(_LINEAR("f", "a"), "b")}"""
SQL["pitch_corrected"] = "SELECT vec_id, 1600 AS n, true AS on_target FROM embeddings"
_ROWS_ONLY = ["pca_variance", "spectral_ratios", "pitch_stats", "log_mel", "stft_centroid", "log_spectra", "spectral_subtraction", "voice_features"]
QUERIES = {name: globals()[name] for name in [*SQL, *_ROWS_ONLY]}
