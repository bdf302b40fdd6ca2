"""A curation run as stages of DataFrame -> DataFrame, each committed once and skipped when resumed."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import time_share
from .lease import Lease

Stage = Callable[[DataFrame], DataFrame]
LOG = "stage string, path string, seconds double, rows long, at double"


@dataclass
class Run:
    """Stages in order over one folder; a stage's name in ``skip`` passes its input on."""

    spark: SparkSession
    folder: str
    stages: list[tuple[str, Stage]]
    skip: set[str] = field(default_factory=set)
    lease_seconds: float = 3600.0

    def log(self) -> DataFrame:
        """Append-only commits; the last of a stage counts."""
        try:
            return self.spark.read.schema(LOG).json(f"{self.folder}/_stages")
        except AnalysisException:
            return self.spark.createDataFrame([], LOG)

    def committed(self) -> dict[str, str]:
        return {r["stage"]: r["path"] for r in self.log().groupBy("stage").agg(F.max_by("path", "at").alias("path")).collect()}  # a row for each stage

    def execute(self, source: DataFrame, restart: bool = False) -> DataFrame:
        """Run what isn't committed yet (all with ``restart``) and return the last stage's result.

        One run at a time has the folder: another that is started meanwhile ends
        with ``Held``.  Each stage renews the lease before it commits, so a run
        whose lease ran out and went to another commits nothing more.
        """
        with Lease(self.spark, self.folder, self.lease_seconds).held() as lease:
            return self._execute(source, restart, lease)

    def _execute(self, source: DataFrame, restart: bool, lease: Lease) -> DataFrame:
        done, now = {} if restart else self.committed(), source
        for name, stage in self.stages:
            if name in self.skip:
                continue
            if name in done:
                now = self.spark.read.parquet(done[name])
                continue
            began = time.time()
            path = f"{self.folder}/{name}/{int(began * 1000)}"
            stage(now).write.parquet(path)
            now = self.spark.read.parquet(path)
            lease.renew()
            row = (name, path, time.time() - began, now.count(), began)
            self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").json(f"{self.folder}/_stages")
            done = {k: v for k, v in done.items() if k in [n for n, _ in self.stages[: [n for n, _ in self.stages].index(name)]]}
        return now

    def timings(self) -> DataFrame:
        return time_share(self.log(), "stage", "seconds")
