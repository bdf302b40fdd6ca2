"""How the driver tables stand for the library's data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as transcripts: the log probability is -value / 10."""
    from ..operators.quality import confidence_from_logprob

    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", confidence_from_logprob(-F.col("value") / 10).alias("confidence"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as manifest rows of n_chars / 200 seconds."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", (F.col("n_chars") / 200.0).alias("duration"))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as measured rows; whole rows are the identity."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").alias("duration"), (F.col("l_discount") * 10).alias("peak"), (F.col("l_extendedprice") / 1000).alias("snr_db"), (F.col("l_tax") - 0.04).alias("dc_offset")
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents as payloads."""
    return table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "source", F.col("n_chars").alias("length"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversation turns as ASR segments."""
    t = table(spark, sf_dir, "conversations")
    n = F.length("text")
    return t.select(
        "conv_id", "turn", "role", "text", F.col("turn").cast("double").alias("start"), (F.col("turn") + n / 20.0).alias("end"), F.when(F.col("role") != "system", -(n % 30) / 20.0).alias("avg_logprob"), F.when(F.col("turn") > 0, (F.col("conv_id") % 10) / 10.0).alias("no_speech_prob")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pooled voice for each label, of which there are ten."""
    from ..functions.vectors import mean_pool

    return mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
