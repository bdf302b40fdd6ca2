"""Text files by physical lines: their numbers, and the first of them, over files that are read in pieces.

Spark splits large files, so a line's number is that inside its piece plus the
lines of the pieces before it.  A piece is bounded by the reader's split size and
is counted where it is read; the counts are a row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numbered_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, line, value) of every line from 1, blank ones included; a line break at the end of a file starts no line.

    ``path`` is a file or a folder; an empty file has no lines.
    """
    m = F.col("_metadata")
    read = spark.read.option("pathGlobFilter", pattern).text(path).select(m["file_path"].alias("file"), m["file_block_start"].alias("piece"), "value")
    placed = read.withColumn("at", F.monotonically_increasing_id())  # rises through a piece, in the order of its lines
    inside = F.row_number().over(Window.partitionBy("file", "piece").orderBy("at"))
    sizes = read.groupBy("file", "piece").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("file", "piece", before.alias("before"))
    return placed.withColumn("inside", inside).join(offsets, ["file", "piece"]).select("file", (F.col("before") + F.col("inside")).alias("line"), "value")


def first_lines(spark: SparkSession, path: str, k: int, pattern: str = "*") -> DataFrame:
    """(file, line, value) of the first ``k`` physical lines of each file; blank and malformed ones count.

    Only the pieces that hold them are numbered; what lies behind is counted, not sorted.
    """
    m = F.col("_metadata")
    read = spark.read.option("pathGlobFilter", pattern).text(path).select(m["file_path"].alias("file"), m["file_block_start"].alias("piece"), "value")
    sizes = read.groupBy("file", "piece").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = sizes.select("file", "piece", before.alias("before")).where(F.col("before") < k)
    placed = read.withColumn("at", F.monotonically_increasing_id())
    inside = F.row_number().over(Window.partitionBy("file", "piece").orderBy("at"))
    kept = placed.withColumn("inside", inside).where(F.col("inside") <= k).join(needed, ["file", "piece"])
    return kept.select("file", (F.col("before") + F.col("inside")).alias("line"), "value").where(F.col("line") <= k)


def sampled_rows(spark: SparkSession, path: str, schema: T.StructType | str, k: int, pattern: str = "metadata.jsonl") -> DataFrame:
    """(file, line, row, problem): what the first ``k`` physical lines of each file hold as JSON.

    A blank line has the problem ``blank``, one that is no JSON object ``malformed``; both have a null row and count towards k.
    """
    lines = first_lines(spark, path, k, pattern)
    blank = F.trim("value") == ""
    found = F.from_json("value", schema)
    whole = F.get_json_object("value", "$").isNotNull() & F.startswith(F.ltrim("value"), F.lit("{"))
    problem = F.when(blank, "blank").when(~whole, "malformed")
    return lines.select("file", "line", F.when(problem.isNull(), found).alias("row"), problem.alias("problem"))
