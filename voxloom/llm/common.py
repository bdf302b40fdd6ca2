"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of letters and digits after lower-casing A-Z: everything but the other ASCII characters.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words on text whose A-Z are still upper case.
ALNUM_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; set a folder only where none is set, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files that every executor can read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have, for helper columns."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def require_absent(df: DataFrame, *names: str) -> None:
    """Output columns may not clash with input columns."""
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"input already has the output columns {sorted(clash)}; rename them first")


#: A group with more than one in so many rows is hot; there are fewer hot groups than this.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, how: str = "inner") -> DataFrame:
    """Join each row to the one row of its group, without gathering a large group in one task.

    ``groups`` has one row for each key and its number of rows in ``size``.  Those
    with over a thousandth of all rows are fewer than a thousand, so they are
    broadcast; no other group is large enough to unbalance the shuffled join.
    """
    added = [c for c in groups.columns if c != key]
    seen = rows.join(F.broadcast(groups.where(F.col(size) * HOT_SHARE > n_rows)), key, "left")
    cold = seen.where(F.col(size).isNull()).drop(*added).join(groups, key, how)
    return seen.where(F.col(size).isNotNull()).unionByName(cold)


OCCURRENCES = "array<struct<start:int,end:int,found:string>>"


def no_occurrences() -> Column:
    return F.array().cast(OCCURRENCES)


def occurrences(text: Column, regex: Column) -> Column:
    """Leftmost non-overlapping matches with their code point offsets (end exclusive).

    The pieces between matches and the matches are zipped, so each is computed
    once for a row; offsets are running sums of their lengths.
    """
    parts = F.zip_with(F.split(text, regex, -1), F.regexp_extract_all(text, regex, F.lit(0)), lambda piece, found: F.struct(F.length(piece).alias("gap"), found.alias("found")))
    start = lambda acc, x: acc["at"] + x["gap"]
    step = lambda acc, x: F.struct(
        (start(acc, x) + F.coalesce(F.length(x["found"]), F.lit(0))).alias("at"),
        F.when(x["found"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(start(acc, x).alias("start"), (start(acc, x) + F.length(x["found"])).alias("end"), x["found"].alias("found")))).alias("out"),
    )
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), no_occurrences().alias("out")), step, lambda acc: acc["out"])


#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20


def word_pieces(line: bytes) -> Iterator[list[bytes]]:
    """The words of a line of words and spaces, in lists of about ``PIECE_BYTES``."""
    at = 0
    while at < len(line):
        end = line.find(b" ", at + PIECE_BYTES)
        end = len(line) if end < 0 else end
        yield line[at:end].split()
        at = end


def releasing(work):
    """``work`` on a task's batches; behind the last one Arrow's unused memory goes back to the system, as a Python worker lives on into later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return run
