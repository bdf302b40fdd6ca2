"""Structured Streaming over training logs and metric events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..functions.text import parse_log_line


def tail(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as they arrive; the checkpoint of the query keeps the offsets over restarts."""
    return spark.readStream.text(folder)


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Progress of batches and summaries of epochs, told apart by ``type``; lines without an epoch or a loss are left out."""
    return lines.select(parse_log_line(F.col(column)).alias("p"), *(c for c in lines.columns if c != column)).select("p.*", *(c for c in lines.columns if c != column)).where("epoch IS NOT NULL AND (loss IS NOT NULL OR train_loss IS NOT NULL)")


def epochs_once(lines: DataFrame, run: str | None = None) -> DataFrame:
    """(epoch, train_loss, val_loss) of each epoch's first summary; the state is a row for each epoch (of each run)."""
    keys = [run, "epoch"] if run else ["epoch"]
    return lines.where("type = 'epoch'").dropDuplicates(keys).select(*keys, "train_loss", "val_loss")


def first_of_batch(lines: DataFrame, ts: str | None = None, late: str = "1 hour") -> DataFrame:
    """One row for each (epoch, batch) of the progress lines, the first that arrives.

    With an arrival time the state of a key is dropped once the watermark is
    ``late`` behind it; without one it is kept for the life of the query, which
    is bounded by the batches of a run.
    """
    lines = lines.where("type = 'batch'")
    if ts is None:
        return lines.dropDuplicates(["epoch", "batch"])
    return lines.withWatermark(ts, late).dropDuplicatesWithinWatermark(["epoch", "batch"])


STATUS = "run string, last long, mean double, n long, status string"


class _RecentValues(StatefulProcessor):
    """The latest ``n`` values of a run as list state, and a timer that fires when the run has been quiet for ``quiet_ms``."""

    def __init__(self, order: str, value: str, n: int, quiet_ms: int, ttl_ms: int | None) -> None:
        self.order, self.value, self.n, self.quiet_ms, self.ttl_ms = order, value, n, quiet_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getListState("values", "at long, value double", self.ttl_ms)

    def _report(self, key: tuple, kept: list[tuple], status: str) -> pd.DataFrame:
        mean = sum(v for _, v in kept) / len(kept) if kept else None
        return pd.DataFrame({"run": [str(key[0])], "last": [kept[-1][0] if kept else None], "mean": [mean], "n": [len(kept)], "status": [status]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        kept = [tuple(r) for r in self.values.get()]
        for some in rows:
            kept = sorted([*kept, *zip(some[self.order].astype("int64").tolist(), some[self.value].astype(float).tolist(), strict=True)])[-self.n :]
        self.values.put(kept)
        for old in self.handle.listTimers():
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)
        yield self._report(key, kept, "active")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._report(key, [tuple(r) for r in self.values.get()], "quiet")

    def close(self) -> None:
        pass


def recent_values(events: DataFrame, run: str, order: str, value: str, n: int = 100, quiet_seconds: float = 60, keep_seconds: float | None = None) -> DataFrame:
    """(run, last, mean, n, status) of the latest ``n`` values of each run: ``active`` after every batch with rows of it, ``quiet`` once when none came for a while.

    Values of null runs are left out.  A buffer that no row has reached for
    ``keep_seconds`` is given up.  Start it with ``run_continuously`` or
    ``run_available``, which choose the state store that lists and timers need.
    """
    processor = _RecentValues(order, value, n, int(quiet_seconds * 1000), int(keep_seconds * 1000) if keep_seconds else None)
    known = events.where(F.col(run).isNotNull() & F.col(order).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(run).transformWithStateInPandas(processor, STATUS, "Update", "ProcessingTime")


def new_files(spark: SparkSession, folder: str, pattern: str = "*", each: int = 1) -> DataFrame:
    """Whole files (path, content and time) as they arrive, at most ``each`` a batch; the query's checkpoint keeps which are done."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", each).load(folder)


def latest_by_tag(events: DataFrame, tag: str, order: str, value: str) -> DataFrame:
    """The value of the latest row of each tag; of rows that are equally late the largest value."""
    return events.groupBy(tag).agg(F.max(F.struct(F.col(order).alias("at"), F.col(value).alias("latest"))).alias("r")).select(tag, "r.latest", "r.at")


def activity(events: DataFrame, group: str, ts: str, gap: str, late: str) -> DataFrame:
    """Sessions by event time, with late rows up to the watermark."""
    return events.withWatermark(ts, late).groupBy(group, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))


def stop_early(events: DataFrame, run: str, epoch: str, value: str, delta: float = 1e-4, patience: int = 5) -> DataFrame:
    """(run, best, bad_epochs, stopped_at) after each batch of epochs, from a small state for each run."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, bad, stopped = state.get if state.exists else (float("inf"), 0, -1)
        for rows in batches:
            for e, v in rows.sort_values(epoch)[[epoch, value]].itertuples(index=False):
                if stopped < 0:
                    best, bad = (v, 0) if v < best - delta else (best, bad + 1)
                    stopped = int(e) if bad >= patience else -1
        state.update((best, bad, stopped))
        yield pd.DataFrame({"run": [str(key[0])], "best": [best], "bad_epochs": [bad], "stopped_at": [None if stopped < 0 else stopped]})

    return events.groupBy(run).applyInPandasWithState(update, "run string, best double, bad_epochs int, stopped_at long", "best double, bad int, stopped long", "update", GroupStateTimeout.NoTimeout)


class BatchSink:
    """A table of batches that counts a batch only once it is committed, by its number.

    The rows of a batch go to a folder of their own, then its number to the
    commits.  A batch that comes again after a failure overwrites what was left
    of it, and one that is committed already is skipped, so no row counts twice.
    """

    def __init__(self, path: str) -> None:
        self.rows, self.commits = f"{path}/rows", f"{path}/commits"

    def _committed(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        at = f"{self.commits}/batch={'*' if number is None else number}"
        return spark.read.schema("batch long").option("basePath", self.commits).option("pathGlobFilter", "*.parquet").parquet(at)

    def is_committed(self, spark: SparkSession, number: int) -> bool:
        try:
            return not self._committed(spark, number).isEmpty()
        except AnalysisException:  # no such folder
            return False

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if self.is_committed(spark, number):
            return
        batch.write.mode("overwrite").parquet(f"{self.rows}/batch={number}")
        spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(f"{self.commits}/batch={number}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of committed batches, with the number of their batch."""
        done = self._committed(spark).select("batch").distinct()
        return spark.read.option("basePath", self.rows).parquet(f"{self.rows}/batch=*").join(F.broadcast(done), "batch", "left_semi")


#: Lists, lifetimes and timers need the state store on disk; it is fixed for a query at its first start.
_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Waiting timers ask for one batch after another, so a run over what is there would never end.
_ONLY_DATA = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def _started(writer: DataStreamWriter, spark: SparkSession, settings: dict[str, str]) -> StreamingQuery:
    """A query takes its settings when it starts; the session gets its own back."""
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run_continuously(df: DataFrame, sink: BatchSink, checkpoint: str, interval: str = "5 seconds", mode: str = "update") -> StreamingQuery:
    """Poll every ``interval`` until the query is stopped; a restart with the same checkpoint goes on where it ended."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(processingTime=interval)
    return _started(writer, df.sparkSession, _STATE)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write all that is there and stop, as Parquet or, for updates, into a ``BatchSink``; a second call goes on where the first ended.  No timer fires."""
    if mode == "append":
        return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(BatchSink(path)).trigger(availableNow=True)
    return _started(writer, df.sparkSession, _STATE | _ONLY_DATA)
