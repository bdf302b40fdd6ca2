"""Queries: the streaming operators, run over all that is there and then stopped."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import plugins as P
from ..functions import signal as G
from ..operators.series import alerts
from ..streaming import monitor as M
from . import bindings as B
from .voices import FILTER_SQL


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as they come, from one file or a folder of part files."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")  # a pattern, as a stream takes no single file


def stream_dedup_keys(spark, sf):
    folder = storage.folder(spark)
    keys = _stream(spark, sf).select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    M.run_available(keys, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _last_update(spark, df, key: str, *values: str) -> DataFrame:
    """Run the stream over all that is there; of each key's updates the last."""
    folder = storage.folder(spark)
    M.run_available(df, f"{folder}/out", f"{folder}/state", mode="update").awaitTermination()
    out = M.BatchSink(f"{folder}/out").read(spark)
    return out.groupBy(key).agg(F.max_by(F.struct(*values), "batch").alias("r")).select(key, "r.*")


def stream_latest_by_tag(spark, sf):
    return _last_update(spark, M.latest_by_tag(_stream(spark, sf), "event_type", "ts", "event_id"), "event_type", "latest")


def stream_epochs_once(spark, sf):
    """Summaries written once for each event of a day, and lines of batches between them."""
    folder = storage.folder(spark)
    day = F.dayofmonth("ts")
    summary = F.format_string("Epoch %d/31 Summary: Training Loss: %.2f Validation Loss: %.2f", day, day / 4, day / 8)
    line = F.when(F.col("event_type") == "view", F.format_string("[Epoch %d/31] Batch %d/9 | Loss: 1.5 | Avg: 1.0", day, day % 9)).otherwise(summary)
    epochs = M.epochs_once(M.parsed(_stream(spark, sf).select(line.alias("value"))))
    M.run_available(epochs, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def stream_alerts(spark, sf):
    """Alerts in a table of committed batches; the last batch is given to the sink once more."""
    folder = storage.folder(spark)
    tag = F.when(F.col("event_type") == "error", "train_loss").when(F.col("event_type") == "view", "timbre_mean").otherwise("other")
    found = _stream(spark, sf).withColumn("tag", tag).withColumn("v", F.when(F.col("tag") == "train_loss", F.col("value") / 10).otherwise(F.col("value") / 500 - 0.5))
    M.run_available(alerts(found, "tag", "v").select("event_id", "alert"), f"{folder}/out", f"{folder}/state", mode="update").awaitTermination()
    sink = M.BatchSink(f"{folder}/out")
    last = sink.read(spark).agg(F.max("batch")).first()[0]
    if last is not None:
        sink(sink.read(spark).where(F.col("batch") == last).drop("batch"), last)
    return sink.read(spark).select("event_id", "alert")


def stream_recent(spark, sf):
    """The latest 100 values of each type of event, as list state."""
    recent = M.recent_values(_stream(spark, sf).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))), "event_type", "at", "value", 100)
    return _last_update(spark, recent, "run", "mean", "n").select(F.col("run").alias("event_type"), F.round("mean", 6).alias("mean"), "n")


def voice_activity(spark, sf):
    """Frames of 4 samples; one quiet frame is bridged, a stretch of one frame dropped."""
    return P.voice_activity(B.vectors(spark, sf), "vec", 4, 0.016, hangover=1, least=2).select("vec_id", "start", "end")


def model_rows(spark, sf):
    out = P.with_model(B.vectors(spark, sf), "vec", lambda: 0.3, lambda limit, v: 1 / int(max(abs(v)) < limit), "double")
    good, bad = P.quarantine(out)
    return good.agg(F.count("*").alias("n")).withColumn("state", F.lit("ok")).unionByName(bad.agg(F.count("*").alias("n")).withColumn("state", F.lit("failed")))


def projected(spark, sf):
    rng = np.random.default_rng(7)
    layers = [(rng.normal(size=(32, B.DIMS)), np.zeros(32)), (rng.normal(size=(8, 32)) * 0.1, np.zeros(8))]
    return B.vectors(spark, sf).select("vec_id", P.project(F.col("vec"), layers).alias("out"))


def enhanced_levels(spark, sf):
    """Without offset and lowest frequencies, trimmed, at a peak of -3 dB."""
    filtered = G.high_passed(B.vectors(spark, sf).select("vec_id", G.remove_dc(F.col("vec")).alias("x")), "x", 24_000.0)
    clean = filtered.select("vec_id", G.scaled_to_peak(G.trim_silence(F.col("x"), -20.0), -3.0).alias("x"))
    return clean.select("vec_id", F.size("x").alias("n"), F.round(G.peak(F.col("x")), 6).alias("peak"), F.round(G.rms(F.col("x")), 6).alias("rms"))


SQL = {
    "stream_dedup_keys": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_latest_by_tag": "SELECT event_type, arg_max(event_id, ts) AS latest FROM events GROUP BY event_type",
    "stream_epochs_once": "SELECT DISTINCT CAST(dayofmonth(ts) AS INTEGER) AS epoch, round(dayofmonth(ts) / 4 + 1e-9, 2) AS train_loss, round(dayofmonth(ts) / 8 + 1e-9, 2) AS val_loss FROM events WHERE event_type <> 'view'",
    "stream_alerts": "SELECT event_id, CASE WHEN event_type = 'error' THEN 'loss_high' ELSE 'timbre_drift' END AS alert FROM events WHERE (event_type = 'error' AND value / 10 > 10) OR (event_type = 'view' AND abs(value / 500 - 0.5) > 0.35)",
    "stream_recent": "SELECT event_type, round(avg(value), 6) AS mean, count(*) AS n FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 100 GROUP BY event_type",
    "voice_activity": """WITH f AS (SELECT vec_id, i // 4 AS k, list_sum(list_transform(embedding[i + 1:i + 4], lambda x: x::DOUBLE * x::DOUBLE)) / 4 > 0.016 AS loud FROM (SELECT vec_id, embedding, unnest(range(0, 64, 4)) AS i FROM embeddings)),
      b AS (SELECT vec_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY vec_id ORDER BY k) <= 2 THEN 0 ELSE 1 END AS new FROM f WHERE loud), g AS (SELECT vec_id, k, sum(new) OVER (PARTITION BY vec_id ORDER BY k) AS grp FROM b)
      SELECT vec_id, CAST(min(k) * 4 AS INTEGER) AS start, CAST(max(k) * 4 + 4 AS INTEGER) AS "end" FROM g GROUP BY vec_id, grp HAVING max(k) - min(k) >= 1""",
    "model_rows": "SELECT count(*) FILTER (m < 0.3) AS n, 'ok' AS state FROM (SELECT list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS m FROM embeddings) UNION ALL SELECT count(*) FILTER (m >= 0.3), 'failed' FROM (SELECT list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS m FROM embeddings)",
}
SQL["enhanced_levels"] = f"""WITH {FILTER_SQL}, s AS (SELECT vec_id, j, x - avg(x) OVER (PARTITION BY vec_id) AS x FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS j FROM embeddings)),
    y AS (SELECT vec_id, i, sum(w * x) AS x FROM s JOIN h USING (j) GROUP BY vec_id, i),
    e AS (SELECT vec_id, min(i) FILTER (20 * log10(abs(x) + 1e-8) > -20) AS a, max(i) FILTER (20 * log10(abs(x) + 1e-8) > -20) AS b FROM y GROUP BY vec_id),
    t AS (SELECT y.vec_id, x FROM y JOIN e ON e.vec_id = y.vec_id AND i BETWEEN coalesce(a, 0) AND coalesce(b, 63))
    SELECT vec_id, CAST(count(*) AS INTEGER) AS n, round(max(abs(x)) * power(10, -3.0 / 20) / max(abs(x)), 6) AS peak, round(sqrt(avg(x * x)) * power(10, -3.0 / 20) / max(abs(x)), 6) AS rms FROM t GROUP BY vec_id"""
QUERIES = {name: globals()[name] for name in [*SQL, "projected"]}
