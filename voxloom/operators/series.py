"""Training logs and metric series: running values, folds, sessions and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan


def running_mean(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Add the mean and the least value so far; a group of any size is scanned by as many tasks as it needs, see ``scan``."""
    rows = scan.carried(scan.ranged(df, group, order), group, order, value)
    mean, best = scan.running(rows, group, order, value)
    return scan.bare(rows.withColumn("running_mean", mean).withColumn("running_best", best))


def bounded_mean(df: DataFrame, group: str, order: list[str], value: str, rows: int) -> DataFrame:
    """Add the mean of the last ``rows`` values, this one included."""
    parts = scan.carried(scan.ranged(df, group, order), group, order, value, tail=max(rows - 1, 1))
    return scan.bare(parts.withColumn("recent_mean", scan.recent_mean(group, order, value, rows)))


def changes(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Add the difference to the value before and what it means; null for the first."""
    d = F.col("change")
    rows = scan.with_previous(df, group, order, value, "_before").withColumn("change", F.col(value) - F.col("_before")).drop("_before")
    return rows.withColumn("trend", F.when(d.isNull(), "first").when(d < 0, "better").when(d > 0, "worse").otherwise("same"))


def last_rows(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The last n rows of each group; Spark limits the ranking before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*(F.desc(c) for c in order)))
    return df.withColumn("from_last", rank).where(F.col("from_last") <= n)


def latest(df: DataFrame, group: str, order: list[str], *values: str) -> DataFrame:
    return df.groupBy(group).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("r")).select(group, "r.*")


def best_epoch(df: DataFrame, group: str, epoch: str, value: str, first: int = 0) -> DataFrame:
    """The earliest epoch, from ``first`` on, with the least value."""
    ok = df.where(F.col(epoch) >= first)
    return ok.groupBy(group).agg(F.min(F.struct(F.col(value).alias("v"), F.col(epoch).alias("e"))).alias("b")).select(group, F.col("b.e").alias("best_epoch"), F.col("b.v").alias("best_value"))


def early_stopping(df: DataFrame, group: str, epoch: str, value: str, delta: float = 1e-4, patience: int = 5) -> DataFrame:
    """(group, best, bad_epochs, stopped_at): a value counts as better only if it beats the last accepted best by more than delta.

    A fold over each group's ordered epochs; a group is one run, so its array is
    as long as the run has epochs.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(value).cast("double").alias("v"))))
    start = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("bad"), F.lit(None).cast("long").alias("stopped"))

    def step(acc: Column, x: Column) -> Column:
        better = x["v"] < acc["best"] - delta
        bad = F.when(better, 0).otherwise(acc["bad"] + 1)
        stop = F.when(bad >= patience, x["e"].cast("long"))
        done = acc["stopped"].isNotNull()
        return F.when(done, acc).otherwise(F.struct(F.when(better, x["v"]).otherwise(acc["best"]).alias("best"), bad.alias("bad"), stop.alias("stopped")))

    folded = df.groupBy(group).agg(F.aggregate(ordered, start, step).alias("s"))
    return folded.select(group, F.col("s.best").alias("best"), F.col("s.bad").alias("bad_epochs"), F.col("s.stopped").alias("stopped_at"))


def time_share(df: DataFrame, stage: str, seconds: str) -> DataFrame:
    """(stage, seconds, pct); 0 where nothing took time."""
    whole = df.agg(F.sum(seconds).alias("s")).scalar()
    return df.groupBy(stage).agg(F.sum(seconds).alias("seconds")).withColumn("pct", F.coalesce(F.try_divide(100.0 * F.col("seconds"), whole), F.lit(0.0)))


def sessions(df: DataFrame, group: str, ts: str, gap: str) -> DataFrame:
    """(group, start, end, n) of activity with no pause as long as the gap; end is the last event plus the gap."""
    return df.groupBy(group, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(group, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def alerts(df: DataFrame, tag: str, value: str) -> DataFrame:
    """Rows that break a rule: |timbre mean| over 0.35, training loss over 10."""
    rule = F.when((F.col(tag) == "timbre_mean") & (F.abs(value) > 0.35), "timbre_drift").when((F.col(tag) == "train_loss") & (F.col(value) > 10), "loss_high")
    return df.withColumn("alert", rule).where("alert IS NOT NULL")


def eta_seconds(epoch_seconds: Column, epoch: Column, epochs: Column) -> Column:
    """Null at epoch 0: not known yet."""
    return F.when(epoch > 0, epoch_seconds * (epochs - epoch))


def ramp_weight(epoch: Column, start: int, ramp: int, most: float) -> Column:
    return F.when(epoch >= start, F.least(F.lit(most), F.greatest(F.lit(0.0), (epoch - start + 1) / ramp * most))).otherwise(0.0)


def latest_checkpoint(names: DataFrame, column: str) -> DataFrame:
    """The name with the largest epoch number (epoch100 is after epoch20)."""
    epoch = F.regexp_extract(column, r"epoch(\d+)", 1).try_cast("int")
    return names.groupBy().agg(F.max_by(column, epoch).alias("latest"))
