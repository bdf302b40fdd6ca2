"""Queries: gates, reports, integrity, splits and names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import integrity as I
from ..operators import quality as Q
from ..operators import splits as S
from ..operators.quantiles import exact_quantiles
from . import bindings as B

GATE = Q.Thresholds(max_dc_offset=0.03)
R = lambda c, n=6: F.round(c, n)


def _gated(spark, sf):
    m = B.measured(spark, sf)
    found = Q.issues(GATE, F.col("duration"), F.col("peak"), F.col("snr_db"), F.col("dc_offset"))
    return m.withColumn("issues", found).withColumn("is_good", F.size("issues") == 0).withColumn("score", Q.overall_score(F.col("snr_db"), None, F.col("peak")))


def confidence_distribution(spark, sf):
    d = Q.confidence_distribution(B.confidences(spark, sf), "event_type")
    return d.select("event_type", "n", *(R(c).alias(c) for c in ("mean", "min", "max")), "below_08", "below_09")


def confidence_filter_report(spark, sf):
    r = Q.confidence_report(B.confidences(spark, sf), 0.8)
    return r.select("total", "kept", "rejected", *(R(c).alias(c) for c in r.columns[3:]))


def confidence_filtered(spark, sf):
    return Q.filter_confidence(B.confidences(spark, sf), 0.8).select("event_id", R("confidence").alias("confidence"))


def confidence_whatif(spark, sf):
    return Q.confidence_whatif(B.confidences(spark, sf), [0.5, 0.6, 0.7, 0.8, 0.9]).withColumn("pct", R("pct"))


def quality_gate_rows(spark, sf):
    g = _gated(spark, sf)
    return g.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "duration", F.array_join("issues", ",").alias("issues"), "is_good", R("score", 10).alias("score"))


def rejection_reasons(spark, sf):
    return Q.reason_counts(_gated(spark, sf))


def rejection_details(spark, sf):
    g = _gated(spark, sf).select("duration", "snr_db", F.explode("issues").alias("code"))
    return g.select(Q.reason_text(F.col("duration"), F.col("snr_db"), F.col("code")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def quality_report(spark, sf):
    r = Q.quality_report(_gated(spark, sf))
    return r.select("total", "kept", "rejected", R("mean_score").alias("mean_score"), R("rejection_rate").alias("rejection_rate"))


def quality_summary_stats(spark, sf):
    metrics = ["duration", "peak", "snr_db", "dc_offset"]
    g = _gated(spark, sf)
    parts = [Q.summary_stats(x, metrics).withColumn("rows", F.lit(name)) for name, x in (("all", g), ("kept", g.where("is_good")))]
    out = parts[0].unionByName(parts[1])
    return out.select("rows", "metric", *(R(c).alias(c) for c in ("mean", "std", "min", "max", "median")))


def metric_quantiles(spark, sf):
    """Exact quantiles of each metric and of the times of the events, whose values crowd in few of the first bins."""
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    parts = [(B.measured(spark, sf), ["peak", "snr_db", "dc_offset"]), (B.events(spark, sf).select(F.col("value"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")), ["value", "us"])]
    rows = [(m, p, float(v)) for df, columns in parts for m, found in exact_quantiles(df, columns, probabilities, sorted_at_once=1000).items() for p, v in found.items()]
    return spark.createDataFrame(rows, "metric string, p double, value double").select("metric", "p", R("value").alias("value"))


def archive_gate_buckets(spark, sf):
    m = B.measured(spark, sf)
    out = None
    for mode, t in (("normal", Q.Thresholds(max_dc_offset=0.03, max_duration=15.0)), ("aggressive", Q.Thresholds(max_dc_offset=0.03, max_duration=15.0).aggressive())):
        said = Q.messages(t, F.col("duration"), F.col("peak"), F.col("snr_db"), F.col("dc_offset"), F.lit(0.0), F.lit(0.0))
        part = m.select(F.explode(said).alias("m")).groupBy(Q.reason_bucket(F.col("m")).alias("bucket")).agg(F.count("*").alias("n")).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out.where("bucket IS NOT NULL")


def _all_metrics(spark, sf):
    """lineitem with all metrics of a gate: 0.02 to 0.83 s long, so many rows are too short to be analysed."""
    l = B.table(spark, sf, "lineitem")
    return l.select((F.col("l_quantity") / 60).alias("duration"), (F.col("l_discount") * 10).alias("peak"), (F.col("l_extendedprice") / 1000).alias("snr_db"), (F.col("l_tax") - 0.04).alias("dc_offset"), (F.col("l_tax") * 2).alias("low_freq"), (F.col("l_discount") / 5).alias("clipping"))


def gate_all_metrics(spark, sf):
    """How often each combination of reasons occurs, with the score's sum: low frequencies, clipping and rows under the analysis minimum included."""
    c = F.col
    m = _all_metrics(spark, sf)
    issues = Q.issues(GATE, c("duration"), c("peak"), c("snr_db"), c("dc_offset"), c("low_freq"))
    score = Q.overall_score(c("snr_db"), c("low_freq"), c("peak"))
    return m.groupBy(F.array_join(issues, ",").alias("issues")).agg(F.count("*").alias("n"), R(F.sum(score), 4).alias("score"))


def archive_messages(spark, sf):
    """The stricter gate's messages with every metric measured, by their text up to the value, and by bucket."""
    c = F.col
    t = Q.Thresholds(max_dc_offset=0.03, max_clipping=0.008, max_low_freq=0.1)
    said = Q.messages(t, c("duration"), c("peak"), c("snr_db"), c("dc_offset"), c("low_freq"), c("clipping"))
    rows = _all_metrics(spark, sf).select(F.explode(said).alias("m"))
    return rows.groupBy(F.substring_index("m", ":", 1).alias("message"), Q.reason_bucket(c("m")).alias("bucket")).agg(F.count("*").alias("n"))


def duration_gate(spark, sf):
    m = B.manifest(spark, sf)
    state = F.coalesce(F.get(Q.issues(Q.Thresholds(), F.col("duration")), F.lit(0)), F.lit("kept"))
    return m.groupBy("lang", state.alias("state")).agg(F.count("*").alias("n"))


def duration_histogram30(spark, sf):
    return Q.histogram(B.manifest(spark, sf), "duration", 30)


def asr_segment_filter(spark, sf):
    return Q.segment_filter(B.segments(spark, sf)).select("conv_id", "turn", R("start").alias("start"), R("end").alias("end"))


def asr_confidence(spark, sf):
    s = B.segments(spark, sf).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "avg_logprob"))).alias("segments"))
    return s.select("conv_id", R(Q.confidence_from_logprob(Q.mean_logprob(F.col("segments")))).alias("confidence"))


def valid_transcripts(spark, sf):
    t = B.segments(spark, sf).withColumn("error", F.when(F.col("role") == "system", "no speech"))
    return Q.valid_transcripts(t).groupBy("role").agg(F.count("*").alias("n"))


def training_row_guards(spark, sf):
    m = B.manifest(spark, sf).select("doc_id", F.length("text").alias("n_phonemes"), (F.length("text") + 2).alias("n_tokens"), "duration")
    return Q.training_rows(m).select("doc_id")


def vad_segments(spark, sf):
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    named = B.segments(spark, sf).select("conv_id", F.length("text").alias("n"), number.alias("i")).where("n * 50 >= 700")
    return named.select(F.format_string("conv%d_segment_%04d.wav", "conv_id", "i").alias("name"), (F.col("n") * 50).cast("long").alias("duration_ms"))


def size_categories(spark, sf):
    d = B.manifest(spark, sf).groupBy("source").agg(F.sum(F.octet_length("text") / 1e4).alias("mb"), F.count("*").alias("n"))
    return d.select("source", "n", Q.size_category_mb(F.col("mb")).alias("by_size"), Q.size_category_count(F.col("n")).alias("by_count"))


def processing_estimate(spark, sf):
    d = B.manifest(spark, sf).groupBy("lang").agg(F.sum("duration").alias("total"), F.count("*").alias("n"))
    mode = F.when(F.col("lang") == "en", "fast").when(F.col("lang") == "de", "quality").when(F.col("lang") == "fr", "balanced").otherwise("other")
    return d.select("lang", R(Q.processing_seconds(F.col("total"), F.col("n"), mode)).alias("seconds"))


def dataset_recommendations(spark, sf):
    d = B.measured(spark, sf).agg(F.avg("duration").alias("d"), F.avg("peak").alias("p"), F.avg("snr_db").alias("s"), F.stddev_samp("peak").alias("sd"))
    return d.select(F.array_join(Q.recommendations(F.col("d"), F.col("p"), F.col("s"), F.col("sd")), ",").alias("advice"))


def orphans(spark, sf):
    return I.orphans(B.listing(spark, sf), B.labels(spark, sf), ["doc_id"]).select("doc_id")


def missing(spark, sf):
    return I.missing(B.listing(spark, sf), B.labels(spark, sf), ["doc_id"]).select("doc_id")


def referenced_semi(spark, sf):
    return I.referenced(B.listing(spark, sf), B.labels(spark, sf), ["doc_id"]).select("doc_id", "length")


def integrity_report(spark, sf):
    return I.integrity_report(B.listing(spark, sf), B.labels(spark, sf), "doc_id")


def integrity_by_source(spark, sf):
    named = B.labels(spark, sf).join(B.table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return I.integrity_report(B.listing(spark, sf), named, "doc_id", by="source")


def payload_accounting(spark, sf):
    return I.accounting(B.listing(spark, sf), B.labels(spark, sf), "doc_id", F.col("quality") == 1)


def resume_pending(spark, sf):
    """Orders are done when one of their items came back."""
    orders, done = B.table(spark, sf, "orders"), B.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return I.pending(orders, done, "o_orderkey").select("o_orderkey")


def source_routing(spark, sf):
    p = B.table(spark, sf, "pages").select("url").unionByName(B.table(spark, sf, "documents").select(F.col("source").alias("url")))
    return p.groupBy(I.source_kind(F.col("url")).alias("kind")).agg(F.count("*").alias("n"))


def validate_manifest(spark, sf):
    m = B.labels(spark, sf).select("doc_id", F.nullif("quality", F.lit(0)).alias("quality"), F.nullif("toxic", F.lit(1)).alias("toxic"))
    return I.validate(m, B.listing(spark, sf), "doc_id", ["quality", "toxic"])


def dedup_first(spark, sf):
    return S.dedup_first(B.manifest(spark, sf).select("doc_id", "text", "lang"), "text", "doc_id").select("doc_id", "lang")


def split_assign(spark, sf):
    return S.assign_split(B.manifest(spark, sf).select("doc_id"), "doc_id").select("doc_id", "rn", "split")


def split_stats(spark, sf):
    s = S.split_stats(S.assign_split(B.manifest(spark, sf).select("doc_id", "duration"), "doc_id"))
    return s.select("split", "segments", *(R(c).alias(c) for c in ("seconds", "hours", "mean_seconds")))


def segment_names(spark, sf):
    s = S.segment_names(S.assign_split(B.manifest(spark, sf).select("doc_id"), "doc_id"), "rn")
    return s.select("doc_id", "split", "split_name", F.format_string("segment_%04d.wav", F.col("rn") - 1).alias("global_name"))


def sample_k(spark, sf):
    return S.sample_k(B.manifest(spark, sf), "doc_id", 50).select("doc_id")


def sampled_duration_estimate(spark, sf):
    m = B.manifest(spark, sf)
    return S.sample_k(m, "doc_id", 10).agg(R(F.avg("duration") * m.agg(F.count("*").alias("n")).scalar()).alias("estimate"))


def rotating_sample(spark, sf):
    n = B.table(spark, sf, "benchmark").agg(F.count("*").alias("n")).scalar()
    return B.events(spark, sf).select("event_id", F.pmod("event_id", n).alias("sample"))


def union_of_splits(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", "lang")
    en, fr, rest = docs.where("lang = 'en'"), docs.where("lang = 'fr'"), docs.where("lang IS NULL OR lang NOT IN ('en', 'fr')")
    return en.unionByName(fr).unionByName(rest).groupBy("lang").agg(F.count("*").alias("n"))


_MEASURED = "(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS duration, l_discount * 10 AS peak, l_extendedprice / 1000 AS snr_db, l_tax - 0.04 AS dc_offset FROM lineitem)"
_ALL = "(SELECT l_quantity / 60 AS duration, l_discount * 10 AS peak, l_extendedprice / 1000 AS snr_db, l_tax - 0.04 AS dc_offset, l_tax * 2 AS low_freq, l_discount / 5 AS clipping FROM lineitem)"
_ISSUES = """CASE WHEN duration < 0.05 THEN ['too_short', 'too_short_for_analysis'] ELSE list_filter([
  CASE WHEN duration < 0.5 THEN 'too_short' END, CASE WHEN duration > 10 THEN 'too_long' END,
  CASE WHEN peak < 0.01 THEN 'too_quiet' WHEN peak > 0.99 THEN 'clipping' END, CASE WHEN snr_db < 15 THEN 'low_snr' END,
  CASE WHEN abs(dc_offset) > 0.03 THEN 'dc_offset' END], lambda x: x IS NOT NULL) END"""
_SCORE = "least(1.0, snr_db / 20) * CASE WHEN peak < 0.5 THEN least(1.0, peak / 0.5) ELSE 1 - (peak - 0.5) / 0.5 END"
_GATED = f"(SELECT *, len(issues) = 0 AS is_good FROM (SELECT *, {_ISSUES} AS issues, {_SCORE} AS score FROM {_MEASURED}))"
_CONF = "(SELECT event_id, event_type, user_id, greatest(0.0, least(1.0, 1 + (-value / 10) / 10)) AS confidence FROM events)"
_SEG = """(SELECT conv_id, turn, role, text, CAST(turn AS DOUBLE) AS s, turn + length(text) / 20.0 AS e,
  CASE WHEN role <> 'system' THEN -(length(text) % 30) / 20.0 END AS lp, CASE WHEN turn > 0 THEN (conv_id % 10) / 10.0 END AS ns FROM conversations)"""
_SPLIT = """(SELECT doc_id, duration, rn, CASE WHEN rn <= floor(t * 0.8::DECIMAL(10,6)) THEN 'train' WHEN rn <= floor(t * 0.8::DECIMAL(10,6)) + floor(t * 0.1::DECIMAL(10,6)) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT doc_id, n_chars / 200.0 AS duration, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS rn, count(*) OVER () AS t FROM documents))"""


def _messages(snr):
    return f"""SELECT CASE WHEN m LIKE '%SNR%' THEN 'Low SNR' WHEN m LIKE '%DC offset%' THEN 'DC offset' WHEN m LIKE '%too short%' THEN 'Too short' WHEN m LIKE '%too long%' THEN 'Too long' ELSE 'Too quiet' END AS bucket
  FROM (SELECT unnest([CASE WHEN snr_db < {snr} THEN 'SNR' END, CASE WHEN abs(dc_offset) > 0.03 THEN 'DC offset' END, CASE WHEN duration < 0.5 THEN 'too short' END, CASE WHEN duration > 15 THEN 'too long' END, CASE WHEN peak < 0.01 THEN 'quiet' END]) AS m FROM {_MEASURED}) WHERE m IS NOT NULL"""


_STATS = "round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, round(median(v), 6) AS median"
_LONG = "SELECT is_good, unnest(['duration', 'peak', 'snr_db', 'dc_offset']) AS metric, unnest([duration, peak, snr_db, dc_offset]) AS v FROM "
_P = "[0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]::DOUBLE[]"
_HAVE = "(SELECT DISTINCT doc_id FROM documents WHERE lang = 'en')"

SQL = {
    "confidence_distribution": f"SELECT CASE WHEN grouping(event_type) = 1 THEN 'ALL' ELSE event_type END AS event_type, count(*) AS n, round(avg(confidence), 6) AS mean, round(min(confidence), 6) AS min, round(max(confidence), 6) AS max, count(*) FILTER (confidence < 0.8) AS below_08, count(*) FILTER (confidence < 0.9) AS below_09 FROM {_CONF} GROUP BY ROLLUP (event_type)",
    "confidence_filter_report": f"SELECT count(*) AS total, count(*) FILTER (confidence >= 0.8) AS kept, count(*) FILTER (confidence < 0.8) AS rejected, round(coalesce(avg(confidence), 0), 6) AS mean_before, round(coalesce(min(confidence), 1), 6) AS min_before, round(coalesce(max(confidence), 0), 6) AS max_before, round(coalesce(avg(confidence) FILTER (confidence >= 0.8), 0), 6) AS mean_after, round(coalesce(min(confidence) FILTER (confidence >= 0.8), 1), 6) AS min_after, round(coalesce(max(confidence) FILTER (confidence >= 0.8), 0), 6) AS max_after FROM {_CONF}",
    "confidence_filtered": f"SELECT event_id, round(confidence, 6) AS confidence FROM {_CONF} WHERE confidence >= 0.8",
    "confidence_whatif": f"SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (confidence < t) AS below, count(*) AS total, round(count(*) FILTER (confidence < t) * 100.0::DOUBLE / count(*), 6) AS pct FROM {_CONF}, (SELECT unnest([0.5::DOUBLE, 0.6, 0.7, 0.8, 0.9]) AS t) GROUP BY t",
    "quality_gate_rows": f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, duration, array_to_string(issues, ',') AS issues, is_good, round(score, 10) AS score FROM {_GATED}",
    "rejection_reasons": f"SELECT reason, count(*) AS n FROM (SELECT unnest(issues) AS reason FROM {_GATED}) GROUP BY reason",
    "rejection_details": f"SELECT CASE code WHEN 'too_short' THEN printf('too_short_%.1fs', duration) WHEN 'too_long' THEN printf('too_long_%.1fs', duration) WHEN 'low_snr' THEN 'low_snr_' || CAST(CAST(snr_db AS DECIMAL(12,1)) AS VARCHAR) || 'dB' ELSE code END AS reason, count(*) AS n FROM (SELECT duration, l_ext AS snr_db, unnest(issues) AS code FROM (SELECT *, CAST(CAST(snr_db AS VARCHAR) AS DECIMAL(18,9)) AS l_ext FROM {_GATED})) GROUP BY 1",
    "quality_report": f"SELECT count(*) AS total, count(*) FILTER (is_good) AS kept, count(*) FILTER (NOT is_good) AS rejected, round(coalesce(avg(score) FILTER (is_good), 0), 6) AS mean_score, round(count(*) FILTER (NOT is_good)::DOUBLE / count(*), 6) AS rejection_rate FROM {_GATED}",
    "quality_summary_stats": f"SELECT 'all' AS rows, metric, {_STATS} FROM ({_LONG} {_GATED}) GROUP BY metric UNION ALL SELECT 'kept', metric, {_STATS} FROM ({_LONG} {_GATED}) WHERE is_good GROUP BY metric",
    "metric_quantiles": " UNION ALL ".join(f"SELECT '{m}' AS metric, unnest({_P}) AS p, round(unnest(quantile_cont(CAST({m} AS DOUBLE), {_P})), 6) AS value FROM {t}" for t, ms in ((_MEASURED, ("peak", "snr_db", "dc_offset")), ("(SELECT value, epoch_us(ts) AS us FROM events)", ("value", "us"))) for m in ms),
    "archive_gate_buckets": f"SELECT bucket, count(*) AS n, 'normal' AS mode FROM ({_messages(15)}) GROUP BY bucket UNION ALL SELECT bucket, count(*), 'aggressive' FROM ({_messages(20)}) GROUP BY bucket",
    "gate_all_metrics": f"SELECT issues, count(*) AS n, round(sum(least(1.0, snr_db / 20) * (1 - low_freq) * CASE WHEN peak < 0.5 THEN least(1.0, peak / 0.5) ELSE 1 - (peak - 0.5) / 0.5 END), 4) AS score FROM (SELECT *, array_to_string(CASE WHEN duration < 0.05 THEN ['too_short', 'too_short_for_analysis'] ELSE list_filter([CASE WHEN duration < 0.5 THEN 'too_short' END, CASE WHEN peak < 0.01 THEN 'too_quiet' WHEN peak > 0.99 THEN 'clipping' END, CASE WHEN snr_db < 15 THEN 'low_snr' END, CASE WHEN abs(dc_offset) > 0.03 THEN 'dc_offset' END, CASE WHEN low_freq > 0.1 THEN 'low_frequency_noise' END], lambda x: x IS NOT NULL) END, ',') AS issues FROM {_ALL}) GROUP BY issues",
    "archive_messages": f"SELECT m[1] AS message, m[2] AS bucket, count(*) AS n FROM (SELECT unnest([CASE WHEN snr_db < 15 THEN ['Low SNR', 'Low SNR'] END, CASE WHEN clipping > 0.008 THEN ['High clipping', 'Clipping'] END, CASE WHEN abs(dc_offset) > 0.03 THEN ['High DC offset', 'DC offset'] END, CASE WHEN low_freq > 0.1 THEN ['High low-frequency noise', 'Low frequency noise'] END, CASE WHEN duration < 0.5 THEN ['too short', 'Too short'] END, CASE WHEN peak < 0.01 THEN ['too quiet', 'Too quiet'] END]) AS m FROM {_ALL}) WHERE m IS NOT NULL GROUP BY ALL",
    "duration_gate": "SELECT lang, CASE WHEN n_chars / 200.0 < 0.5 THEN 'too_short' WHEN n_chars / 200.0 > 10 THEN 'too_long' ELSE 'kept' END AS state, count(*) AS n FROM documents GROUP BY 1, 2",
    "duration_histogram30": "WITH d AS (SELECT n_chars / 200.0::DOUBLE AS x FROM documents), m AS (SELECT min(x) AS lo, max(x) AS hi FROM d) SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin, count(*) AS n FROM d, m GROUP BY 1",
    "asr_segment_filter": f"SELECT conv_id, turn, round(s, 6) AS start, round(e, 6) AS \"end\" FROM {_SEG} WHERE coalesce(ns, 0) <= 0.4 AND coalesce(lp, -10) >= -1 AND e - s BETWEEN 1 AND 10 AND regexp_matches(text, '\\w')",
    "asr_confidence": f"SELECT conv_id, round(greatest(0.0, least(1.0, 1 + avg(coalesce(lp, 0)) / 10)), 6) AS confidence FROM {_SEG} GROUP BY conv_id",
    "valid_transcripts": "SELECT role, count(*) AS n FROM conversations WHERE text <> '' AND role <> 'system' GROUP BY role",
    "training_row_guards": "SELECT doc_id FROM documents WHERE length(text) BETWEEN 1 AND 510 AND length(text) + 2 >= 3 AND n_chars / 200.0 <= 30",
    "vad_segments": "SELECT printf('conv%d_segment_%04d.wav', conv_id, i) AS name, duration_ms FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, length(text)) - 1 AS i, length(text) * 50 AS duration_ms FROM conversations) WHERE duration_ms >= 700",
    "size_categories": "SELECT source, n, CASE WHEN mb < 100 THEN 'small (<100MB)' WHEN mb < 1000 THEN 'medium (100MB-1GB)' WHEN mb < 10000 THEN 'large (1GB-10GB)' ELSE 'very large (>10GB)' END AS by_size, CASE WHEN n < 1e3 THEN 'n<1K' WHEN n < 1e4 THEN '1K<n<10K' WHEN n < 1e5 THEN '10K<n<100K' WHEN n < 1e6 THEN '100K<n<1M' ELSE 'n>1M' END AS by_count FROM (SELECT source, sum(strlen(text) / 1e4) AS mb, count(*) AS n FROM documents GROUP BY source)",
    "processing_estimate": "SELECT lang, round(sum(n_chars / 200.0) * CASE lang WHEN 'en' THEN 0.5 WHEN 'de' THEN 2.0 ELSE 1.0 END + 5 * count(*), 6)::DOUBLE AS seconds FROM documents GROUP BY lang",
    "dataset_recommendations": f"SELECT concat_ws(',', CASE WHEN avg(duration) < 2 THEN 'short_samples' END, CASE WHEN avg(peak) < 0.01 THEN 'quiet' END, CASE WHEN avg(snr_db) < 20 THEN 'noisy' END, CASE WHEN stddev_samp(peak) > 0.02 THEN 'uneven_level' END) AS advice FROM {_MEASURED}",
    "orphans": "SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)",
    "missing": "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')",
    "referenced_semi": "SELECT doc_id, n_chars AS length FROM documents WHERE lang = 'en' AND doc_id IN (SELECT doc_id FROM labels)",
    "integrity_report": f"SELECT (SELECT count(*) FROM {_HAVE}) AS n_files, (SELECT count(DISTINCT doc_id) FROM labels) AS n_referenced, (SELECT count(*) FROM {_HAVE} WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_orphaned, (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM {_HAVE})) AS n_missing, (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id IN (SELECT doc_id FROM {_HAVE})) AS n_matched, coalesce((SELECT string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FROM (SELECT doc_id FROM {_HAVE} WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 10)), '') AS first_orphaned, coalesce((SELECT string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM {_HAVE}) ORDER BY doc_id LIMIT 10)), '') AS first_missing",
    "integrity_by_source": "WITH h AS (SELECT DISTINCT source, doc_id, true AS a FROM documents WHERE lang = 'en'), m AS (SELECT DISTINCT source, doc_id, true AS b FROM labels JOIN documents USING (doc_id)) SELECT source, count(a) AS n_files, count(b) AS n_referenced, count(*) FILTER (b IS NULL) AS n_orphaned, count(*) FILTER (a IS NULL) AS n_missing, count(*) FILTER (a AND b) AS n_matched FROM h FULL JOIN m USING (source, doc_id) GROUP BY source",
    "payload_accounting": "SELECT CASE WHEN doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars > 0) THEN 'missing' WHEN quality = 1 THEN 'kept' ELSE 'rejected' END AS state, count(*) AS n FROM labels GROUP BY 1",
    "resume_pending": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "source_routing": "SELECT CASE WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') OR starts_with(url, 'www.') THEN 'url' ELSE 'local' END AS kind, count(*) AS n FROM (SELECT url FROM pages UNION ALL SELECT source FROM documents) GROUP BY 1",
    "validate_manifest": "SELECT 'error' AS severity, 'null_quality' AS code, count(*) AS n FROM labels WHERE quality = 0 HAVING count(*) > 0 UNION ALL SELECT 'error', 'null_toxic', count(*) FROM labels WHERE toxic = 1 HAVING count(*) > 0 UNION ALL SELECT 'warning', 'payload_missing', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') HAVING count(*) > 0 UNION ALL SELECT 'warning', 'duplicate_key', count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1) HAVING count(*) > 0",
    "dedup_first": "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1",
    "split_assign": f"SELECT doc_id, rn, split FROM {_SPLIT}",
    "split_stats": f"SELECT CASE WHEN grouping(split) = 1 THEN 'ALL' ELSE split END AS split, count(*) AS segments, round(sum(duration::DOUBLE), 6) AS seconds, round(sum(duration::DOUBLE) / 3600, 6) AS hours, round(sum(duration::DOUBLE) / count(*), 6) AS mean_seconds FROM {_SPLIT} GROUP BY ROLLUP (split)",
    "segment_names": f"SELECT doc_id, split, printf('segment_%05d.wav', row_number() OVER (PARTITION BY split ORDER BY rn) - 1) AS split_name, printf('segment_%04d.wav', rn - 1) AS global_name FROM {_SPLIT}",
    "sample_k": "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id LIMIT 50",
    "sampled_duration_estimate": "SELECT round(avg(d) * (SELECT count(*) FROM documents), 6) AS estimate FROM (SELECT n_chars / 200.0::DOUBLE AS d FROM documents ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id LIMIT 10)",
    "rotating_sample": "SELECT event_id, event_id % (SELECT count(*) FROM benchmark) AS sample FROM events",
    "union_of_splits": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
}
QUERIES = {name: globals()[name] for name in SQL}
