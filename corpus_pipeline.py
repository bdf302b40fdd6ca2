"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents``, but for the last, which returns the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import common
from voxloom.llm.decontamination import decontaminate
from voxloom.llm.exact_dedup import exact_dedup
from voxloom.llm.near_dedup import near_dedup
from voxloom.llm.packing import pack, tokenizer_file
from voxloom.llm.quality import THRESHOLD, score_quality, train_field


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold stay; the field is fitted on the labelled documents among them."""
    score = common.fresh_name(docs, "score")
    field = train_field(docs, common.table(spark, sf_dir, "labels"))
    scored = score_quality(docs, field, name=score)
    return scored.where(scored[score] >= THRESHOLD).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, directly or over others, the one with the smallest id stays."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark text stay."""
    return decontaminate(docs, common.table(spark, sf_dir, "benchmark")).where("n_hit = 0").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences of 2048."""
    return pack(docs, tokenizer_file())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", benchmark), ("packing", packing)]
#: SQL can express neither the line classifier nor the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
