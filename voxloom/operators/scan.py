"""Running values over long groups: an order of ranges, scans inside each, and what is carried between them.

Rows are dealt by ranges of (group, order), so a group of any size takes as many
tasks as its rows need.  A range is scanned by windows of its own; what it must
know of the ranges before (sums, least values, the last rows) is folded from one
row for each range and group.  At most one group goes on from one range to the
next, so there are fewer carried rows than ranges and they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage

RANGE, PLACE, CARRY = "_range", "_place", "_carry"


def ranged(df: DataFrame, group: str, order: list[str], n_ranges: int | None = None) -> DataFrame:
    """Rows with the number of their range, dealt and sorted by (group, order).  ``order`` must tell all rows of a group apart.

    They are checkpointed, as ranges that were sampled again could differ.
    """
    n = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return storage.checkpoint(df.repartitionByRange(n, group, *order)).withColumn(RANGE, F.spark_partition_id())


def local(group: str, order: list[str]):
    """The window of a range's part of a group."""
    return Window.partitionBy(RANGE, group).orderBy(*order)


def carried(rows: DataFrame, group: str, order: list[str], value: str, tail: int = 0) -> DataFrame:
    """Add the place in the range from 1 and a struct of what the earlier ranges of the group have: total, n, least, and the last ``tail`` values in order.

    Null values add nothing to total, n and least, and stand in the tail.
    """
    up = local(group, order)
    placed = rows.withColumn(PLACE, F.row_number().over(up))
    at = F.struct(*order, F.col(value).alias("_value"))
    parts = placed.groupBy(RANGE, group).agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.min(value).alias("least"))
    if tail:  # the last rows of each part, of which only these few leave it
        down = Window.partitionBy(RANGE, group).orderBy(*(F.desc(c) for c in order))
        last = placed.withColumn("_last", F.row_number().over(down)).where(F.col("_last") <= tail)
        tails = last.groupBy(RANGE, group).agg(F.transform(F.array_sort(F.collect_list(at)), lambda r: r["_value"]).alias("tail"))
        same = parts[RANGE].eqNullSafe(tails[RANGE]) & parts[group].eqNullSafe(tails[group])
        parts = parts.join(tails, same).select(*(parts[c] for c in parts.columns), "tail")
    before = Window.partitionBy(group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    folds = [F.sum("total").over(before).alias("total"), F.sum("n").over(before).alias("n"), F.min("least").over(before).alias("least")]
    if tail:
        kept = F.flatten(F.collect_list("tail").over(before))
        folds.append(F.slice(kept, F.greatest(F.size(kept) - tail + 1, F.lit(1)), F.lit(tail)).alias("tail"))
    earlier = F.count("*").over(before)
    carry = parts.select(RANGE, F.col(group).alias("_group"), F.struct(*folds).alias(CARRY), earlier.alias("_earlier")).where("_earlier > 0").drop("_earlier")
    return placed.join(F.broadcast(carry.withColumnRenamed(RANGE, "_r")), (F.col(RANGE) == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")), "left").drop("_r", "_group")


def running(rows: DataFrame, group: str, order: list[str], value: str) -> tuple[Column, Column]:
    """Mean and least value from the group's first row to this one, for carried rows."""
    up = local(group, order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.sum(value).over(up), F.lit(0.0)) + F.coalesce(F.col(CARRY)["total"], F.lit(0.0))
    n = F.count(value).over(up) + F.coalesce(F.col(CARRY)["n"], F.lit(0))
    return F.try_divide(total, n), F.least(F.min(value).over(up), F.col(CARRY)["least"])


def recent_mean(group: str, order: list[str], value: str, size: int) -> Column:
    """Mean of this row and the ``size - 1`` before it, for rows carried with that tail."""
    near = local(group, order).rowsBetween(1 - size, 0)
    missing = F.greatest(F.lit(size) - F.col(PLACE), F.lit(0))
    tail = F.coalesce(F.col(CARRY)["tail"], F.array().cast("array<double>"))
    halo = F.filter(F.slice(tail, F.greatest(F.size(tail) - missing + 1, F.lit(1)), missing), lambda x: x.isNotNull())
    total = F.coalesce(F.sum(value).over(near), F.lit(0.0)) + F.aggregate(halo, F.lit(0.0), lambda a, x: a + x)
    return F.try_divide(total, F.count(value).over(near) + F.size(halo))


def _with_neighbour(df: DataFrame, group: str, order: list[str], value: str, name: str, ahead: bool) -> DataFrame:
    rows = ranged(df, group, order)
    last = (F.min_by if ahead else F.max_by)(value, F.struct(*order))
    over = Window.partitionBy(group).orderBy(F.desc(RANGE) if ahead else RANGE)
    carry = rows.groupBy(RANGE, group).agg(last.alias("_last")).select(F.col(RANGE).alias("_r"), F.col(group).alias("_group"), F.lag("_last").over(over).alias(CARRY), F.row_number().over(over).alias("_i")).where("_i > 1").drop("_i")
    through = Window.partitionBy(RANGE, group).orderBy(*(F.desc(c) if ahead else F.col(c) for c in order))
    seen = rows.withColumn(PLACE, F.row_number().over(through)).withColumn(name, F.lag(value).over(through))
    joined = seen.join(F.broadcast(carry), (F.col(RANGE) == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")), "left").drop("_r", "_group")
    return bare(joined.withColumn(name, F.when(F.col(PLACE) > 1, F.col(name)).otherwise(F.col(CARRY))))


def with_previous(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add the value, of any type, of the row before in the group; null for the first."""
    return _with_neighbour(df, group, order, value, name, ahead=False)


def with_next(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add the value, of any type, of the row behind in the group; null for the last."""
    return _with_neighbour(df, group, order, value, name, ahead=True)


def row_numbers(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add the place in the group, from 1."""
    rows = ranged(df, group, order)
    before = Window.partitionBy(group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(RANGE, group).agg(F.count("*").alias("_n"))
    carry = parts.select(F.col(RANGE).alias("_r"), F.col(group).alias("_group"), F.sum("_n").over(before).alias(CARRY)).where(F.col(CARRY).isNotNull())
    joined = rows.join(F.broadcast(carry), (F.col(RANGE) == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")), "left").drop("_r", "_group")
    return bare(joined.withColumn(name, F.row_number().over(local(group, order)) + F.coalesce(F.col(CARRY), F.lit(0))))


def bare(df: DataFrame) -> DataFrame:
    return df.drop(RANGE, PLACE, CARRY)
