"""Deduplication, reproducible splits, naming and sampling.

Row numbers over a whole table are taken in two steps: numbers inside buckets of
the order key, then offsets from the bucket counts.  So no task ever holds all
rows, as a window without partitions would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with equal key the first in order; nulls are equal.

    Rows meet by the SHA-256 of the key, so long keys travel once, inside their
    row, and are neither sorted nor compared.  A task gives one row for each key
    that it has, so a hot key costs one row a task.
    """
    first = df.groupBy(F.sha2(F.col(key).cast("string").cast("binary"), 256).alias("_h")).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("r"))
    return first.select("r.*")


def shuffle_key(identity: Column, seed: int) -> Column:
    return F.md5(F.concat(identity.cast("string"), F.lit(f":{seed}")).cast("binary"))


#: Rows that a bucket of the numbering stands for.
BUCKET_ROWS = 100_000


def numbered(df: DataFrame, order_key: Column, tie: str, name: str = "rn", digits: int | None = None) -> DataFrame:
    """Global row number from 1 in the order of a hexadecimal key, then ``tie``.

    Without ``digits`` the buckets follow the number of rows; their counts are broadcast.
    """
    if digits is None:
        digits, rows = 2, df.count()
        while rows > BUCKET_ROWS * 16**digits and digits < 5:
            digits += 1
    keyed = df.withColumn("_key", order_key).withColumn("_bucket", F.substring("_key", 1, digits))
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))  # at most 16 ** digits rows
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_bucket", before.alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", tie))
    return keyed.withColumn("_inside", inside).join(F.broadcast(offsets), "_bucket").withColumn(name, F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before", "_key")


def assign_split(df: DataFrame, id_col: str, seed: int = 42, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """Exact sizes: floor(n * train), floor(n * validation), the rest is test; the order is the hash of id and seed."""
    if abs(sum(ratios) - 1) >= 1e-5:
        raise ValueError("split ratios must add up to 1")
    rows = numbered(df, shuffle_key(F.col(id_col), seed), id_col)
    train = F.floor(F.col("_total") * F.lit(ratios[0]).cast("decimal(10,6)"))
    validation = F.floor(F.col("_total") * F.lit(ratios[1]).cast("decimal(10,6)"))
    split = F.when(F.col("rn") <= train, "train").when(F.col("rn") <= train + validation, "validation").otherwise("test")
    return rows.withColumn("split", split).drop("_total")


def split_stats(df: DataFrame, duration: str = "duration") -> DataFrame:
    """Segments, seconds, hours and mean duration for each split and for all."""
    rolled = df.rollup("split").agg(F.grouping("split").alias("g"), F.count("*").alias("segments"), F.sum(duration).alias("seconds"))
    return rolled.select(
        F.when(F.col("g") == 1, "ALL").otherwise(F.col("split")).alias("split"), "segments", "seconds", (F.col("seconds") / 3600).alias("hours"), F.coalesce(F.try_divide(F.col("seconds"), F.col("segments")), F.lit(0.0)).alias("mean_seconds")
    )


def segment_names(df: DataFrame, order: str) -> DataFrame:
    """Zero-padded names that restart in each split; ``order`` numbers all rows, and a split's rows follow each other in it."""
    first = df.groupBy("split").agg(F.min(order).alias("_first"))  # splits are runs of consecutive numbers
    return df.join(F.broadcast(first), "split").withColumn("split_name", F.format_string("segment_%05d.wav", F.col(order) - F.col("_first"))).drop("_first")


def sample_k(df: DataFrame, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """A reproducible sample without replacement: the first k by hash; a top-k, so no full sort."""
    return df.orderBy(shuffle_key(F.col(id_col), seed), id_col).limit(k)
