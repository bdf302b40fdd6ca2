"""Manifest, listing and state sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import class_coverage
from ..schema import MANIFEST, METRIC, SPLITS, VOICE

AUDIO = "*.{wav,mp3,m4a,flac}"


def read_manifest(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """The rows of all splits under ``root``: ``metadata.jsonl`` in a split's folder, or the files of ``write_manifest``; absent splits give no rows.

    Strict: a malformed line is an error.  Else malformed lines and rows without
    a file name or a text are left out; see ``manifest_problems``.
    """
    rows = _lines(spark, root, strict)
    return rows if strict else rows.where("_corrupt_record IS NULL AND file_name IS NOT NULL AND text IS NOT NULL").drop("_corrupt_record")


def manifest_problems(spark: SparkSession, root: str) -> DataFrame:
    """(split, problem, n) of lines that the permissive read leaves out."""
    problem = F.when(F.col("_corrupt_record").isNotNull(), "malformed").when(F.col("file_name").isNull() | F.col("text").isNull(), "missing_key")
    return _lines(spark, root, False).select("split", problem.alias("problem")).where("problem IS NOT NULL").groupBy("split", "problem").agg(F.count("*").alias("n"))


def _lines(spark: SparkSession, root: str, strict: bool) -> DataFrame:
    text = spark.read.option("pathGlobFilter", "{metadata.jsonl,part-*.txt}").option("recursiveFileLookup", "true").text(root)
    rows = text.select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]+$", 1).alias("folder")).where(F.trim("value") != "")
    rows = rows.where(F.col("folder").isin(*SPLITS))
    schema = T.StructType([*MANIFEST.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = rows.select("folder", F.from_json("value", MANIFEST if strict else schema, {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return parsed.select("r.*", "folder").withColumn("split", F.coalesce("split", "folder")).drop("folder")


def list_payloads(spark: SparkSession, root: str, pattern: str = AUDIO, recursive: bool = True) -> DataFrame:
    """(path, file_name, folder, length, modificationTime); contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return found.select("path", F.substring_index("path", "/", -1).alias("file_name"), F.element_at(F.split("path", "/"), -2).alias("folder"), "length", "modificationTime")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").json(path)


def read_voices(spark: SparkSession, path: str) -> DataFrame:
    """Voices in either layout: (voice_id, length_idx, vec) or one row for each voice, which stands for all lengths."""
    voices = spark.read.parquet(path)
    if "length_idx" in voices.columns:
        return voices
    return voices.withColumn("length_idx", F.explode(F.sequence(F.lit(0), F.lit(509)))).select("voice_id", "length_idx", "vec")


def voice_files(listing: DataFrame, prefixes: tuple[str, ...] = ("af_", "am_"), folder: str = "voices", suffix: str = ".pt") -> DataFrame:
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | F.startswith("file_name", F.lit(p))
    return listing.where((F.col("folder") == folder) & F.endswith("file_name", F.lit(suffix)) & wanted)


def write_manifest(df: DataFrame, root: str) -> None:
    """One folder of JSON lines for each split, all in one commit that replaces what was there, so a split without rows has none left."""
    df.select("split", F.to_json(F.struct(*(c for c in df.columns))).alias("value")).write.mode("overwrite").partitionBy("split").text(root)


def replace_table(df: DataFrame, path: str) -> str:
    """Write beside ``path`` and return the new folder: a table that is being read is never overwritten."""
    target = f"{path.rstrip('/')}.{uuid.uuid4().hex[:8]}"
    df.write.parquet(target)
    return target


def write_voices(df: DataFrame, path: str) -> None:
    """(voice_id, vec), or with a length_idx the rows of all lengths, as ``read_voices`` takes them."""
    df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in VOICE.fields if f.name in df.columns)).write.mode("overwrite").parquet(path)


def metric_rows(df: DataFrame, tags: list[str], ts: str = "ts", run: str = "run", epoch: str = "epoch", step: str = "step") -> DataFrame:
    """A row of the metric table for each tag of each wide row; nulls are left out."""
    long = df.select(F.col(ts).alias("ts"), F.col(run).alias("run"), F.col(epoch).alias("epoch"), F.col(step).alias("step"), F.explode(F.array(*(F.struct(F.lit(t).alias("tag"), F.col(t).cast("double").alias("value")) for t in tags))).alias("m"))
    return long.select("ts", "run", "epoch", "step", "m.*").where("value IS NOT NULL").select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in METRIC.fields))


def append_metrics(rows: DataFrame, path: str) -> None:
    """Add to the metric table, a folder for each run."""
    rows.write.mode("append").partitionBy("run").parquet(path)


def write_token_analysis(histogram: DataFrame, path: str) -> None:
    """The histogram and the coverage of its classes as JSON."""
    histogram.write.mode("overwrite").json(f"{path}/tokens")
    write_report(class_coverage(histogram), f"{path}/summary")


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def dataset_card(stats: DataFrame, report: DataFrame, title: str) -> str:
    """Markdown from aggregates: a row for each split and for each reason."""
    lines = [f"# {title}", "", "| split | segments | hours |", "|---|---|---|"]
    lines += [f"| {r['split']} | {r['segments']} | {r['hours']:.2f} |" for r in stats.orderBy("split").collect()]
    lines += ["", "| reason | rows |", "|---|---|"]
    lines += [f"| {r['reason']} | {r['n']} |" for r in report.orderBy(F.desc("n"), "reason").collect()]
    return "\n".join(lines) + "\n"
