"""Queries: metric series, sessions and alerts over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from . import bindings as B

R = lambda c, n=6: F.round(c, n)


def loss_running(spark, sf):
    r = S.running_mean(B.events(spark, sf), "user_id", ["ts", "event_id"], "value")
    return r.select("event_id", R("running_mean", 10).alias("running_mean"), "running_best")


def bounded_history(spark, sf):
    return S.bounded_mean(B.events(spark, sf), "user_id", ["ts", "event_id"], "value", 20).select("event_id", R("recent_mean").alias("recent_mean"))


def loss_changes(spark, sf):
    return S.changes(B.events(spark, sf), "user_id", ["ts", "event_id"], "value").select("event_id", R("change").alias("change"), "trend")


def last_20(spark, sf):
    return S.last_rows(B.events(spark, sf), "event_type", ["ts", "event_id"], 20).select("event_type", "event_id", "from_last")


def latest_per_tag(spark, sf):
    return S.latest(B.events(spark, sf), "event_type", ["ts", "event_id"], "event_id", "value")


def _epochs(spark, sf):
    return B.events(spark, sf).groupBy("user_id", "day").agg(F.min("value").alias("loss"))


def best_epoch(spark, sf):
    return S.best_epoch(_epochs(spark, sf), "user_id", "day", "loss", first=5)


def early_stopping(spark, sf):
    return S.early_stopping(_epochs(spark, sf), "user_id", "day", "loss", delta=0.5, patience=3)


def stage_time_share(spark, sf):
    return S.time_share(B.events(spark, sf), "event_type", "value").select("event_type", R("seconds", 4).alias("seconds"), R("pct").alias("pct"))


def activity_sessions(spark, sf):
    s = S.sessions(B.events(spark, sf).select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", "6 hours")
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


def alerts(spark, sf):
    tag = F.when(F.col("event_type") == "error", "train_loss").when(F.col("event_type") == "view", "timbre_mean").otherwise("other")
    e = B.events(spark, sf).withColumn("tag", tag).withColumn("v", F.when(F.col("tag") == "train_loss", F.col("value") / 10).otherwise(F.col("value") / 500 - 0.5))
    return S.alerts(e, "tag", "v").select("event_id", "alert")


def epoch_eta(spark, sf):
    return _epochs(spark, sf).select("user_id", "day", R(S.eta_seconds(F.col("loss"), F.col("day") - 1, F.lit(30))).alias("eta"), R(S.ramp_weight(F.col("day"), 5, 10, 0.3)).alias("weight"))


def loss_spread(spark, sf):
    return _epochs(spark, sf).groupBy("day").agg(R(F.stddev_pop("loss")).alias("spread"), F.min("loss").alias("best"), R(F.avg("loss")).alias("mean"))


def latest_checkpoint(spark, sf):
    names = _epochs(spark, sf).select(F.format_string("model_epoch%d.pt", F.col("day") * 7).alias("name")).distinct()
    return S.latest_checkpoint(names, "name")


_E = "(SELECT user_id, dayofmonth(ts) AS day, min(value) AS loss FROM events GROUP BY 1, 2)"
_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id"
SQL = {
    "loss_running": f"SELECT event_id, round(avg(value) {_W} ROWS UNBOUNDED PRECEDING), 10) AS running_mean, min(value) {_W} ROWS UNBOUNDED PRECEDING) AS running_best FROM events",
    "bounded_history": f"SELECT event_id, round(avg(value) {_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS recent_mean FROM events",
    "loss_changes": f"SELECT event_id, round(d, 6) AS change, CASE WHEN d IS NULL THEN 'first' WHEN d < 0 THEN 'better' WHEN d > 0 THEN 'worse' ELSE 'same' END AS trend FROM (SELECT event_id, value - lag(value) {_W}) AS d FROM events)",
    "last_20": "SELECT event_type, event_id, CAST(r AS INTEGER) AS from_last FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 20",
    "latest_per_tag": "SELECT event_type, event_id, value FROM (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "best_epoch": f"SELECT user_id, CAST(day AS INTEGER) AS best_epoch, loss AS best_value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY loss, day) AS r FROM {_E} WHERE day >= 5) WHERE r = 1",
    "early_stopping": f"""WITH RECURSIVE e AS (SELECT user_id, day, loss, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM {_E}),
      f AS (SELECT user_id, i, loss AS best, 0 AS bad, CAST(NULL AS BIGINT) AS stopped FROM e WHERE i = 1
        UNION ALL SELECT e.user_id, e.i, CASE WHEN f.stopped IS NULL AND e.loss < f.best - 0.5 THEN e.loss ELSE f.best END,
          CASE WHEN f.stopped IS NOT NULL THEN f.bad WHEN e.loss < f.best - 0.5 THEN 0 ELSE f.bad + 1 END,
          CASE WHEN f.stopped IS NOT NULL THEN f.stopped WHEN e.loss >= f.best - 0.5 AND f.bad + 1 >= 3 THEN e.day END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
      SELECT user_id, best, CAST(bad AS INTEGER) AS bad_epochs, stopped AS stopped_at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i DESC) AS r FROM f) WHERE r = 1""",
    "stage_time_share": "SELECT event_type, round(sum(value), 4) AS seconds, round(100.0 * sum(value) / (SELECT sum(value) FROM events), 6) AS pct FROM events GROUP BY event_type",
    "activity_sessions": "SELECT user_id, min(us) AS start_us, max(us) + 21600000000 AS end_us, count(*) AS n FROM (SELECT user_id, us, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 21600000000 THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s",
    "alerts": "SELECT event_id, CASE WHEN event_type = 'error' THEN 'loss_high' ELSE 'timbre_drift' END AS alert FROM events WHERE (event_type = 'error' AND value / 10 > 10) OR (event_type = 'view' AND abs(value / 500 - 0.5) > 0.35)",
    "epoch_eta": f"SELECT user_id, CAST(day AS INTEGER) AS day, round(CASE WHEN day > 1 THEN loss * (30 - (day - 1)) END, 6) AS eta, round(CASE WHEN day >= 5 THEN least(0.3::DOUBLE, greatest(0.0::DOUBLE, (day - 4) / 10 * 0.3::DOUBLE)) ELSE 0 END, 6) AS weight FROM {_E}",
    "loss_spread": f"SELECT CAST(day AS INTEGER) AS day, round(stddev_pop(loss), 6) AS spread, min(loss) AS best, round(avg(loss), 6) AS mean FROM {_E} GROUP BY day",
    "latest_checkpoint": f"SELECT printf('model_epoch%d.pt', max(day) * 7) AS latest FROM {_E}",
}
QUERIES = {name: globals()[name] for name in SQL}
