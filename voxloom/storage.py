"""Where intermediate tables go: only folders that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str | None:
    """The cluster's ``spark.checkpoint.dir``; none is needed under a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared


def folder(spark: SparkSession) -> str:
    """A new folder for the output of a run."""
    shared = _shared(spark)
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="stream-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Rows as files in the shared folder; partitions and the order inside them stay."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(_shared(df.sparkSession) or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)
