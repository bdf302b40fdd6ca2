"""Streams over folders: what arrives later goes on from what was there."""

import datetime as dt
import os
import time

import numpy as np
from pyspark.sql import functions as F

from voxloom.functions import plugins as P
from voxloom.plans import live
from voxloom.streaming import monitor as M

LINE = "[Epoch {}/5] Batch {}/9 | Loss: {} | Avg: 1.0 | Text: x"


def _run(df, folder, mode="append"):
    M.run_available(df, f"{folder}/out", f"{folder}/state", mode).awaitTermination()


def test_log_lines_once_over_restarts(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("\n".join([LINE.format(1, 1, 2.5), LINE.format(1, 1, 9.9), "noise", LINE.format(1, 2, 2.0)]))
    for more in (None, [LINE.format(1, 2, 7.7), LINE.format(2, 1, 1.5)]):
        if more:
            (logs / "b.log").write_text("\n".join(more))
        _run(M.first_of_batch(M.parsed(M.tail(spark, str(logs)))), tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/out").orderBy("epoch", "batch").collect()
    assert [(r["epoch"], r["batch"]) for r in rows] == [(1, 1), (1, 2), (2, 1)]
    assert rows[0]["loss"] in (2.5, 9.9) and rows[1]["loss"] == 2.0 and rows[2]["loss"] == 1.5


def _events(spark, folder, rows):
    spark.createDataFrame(rows, "run string, epoch long, ts timestamp, value double").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema("run string, epoch long, ts timestamp, value double").parquet(f"{folder}/in")


def _at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def _out(spark, folder):
    return M.BatchSink(f"{folder}/out").read(spark)


def test_recent_values_keep_the_last_values_over_restarts(spark, tmp_path):
    for part in (range(6), range(6, 8)):
        _run(M.recent_values(_events(spark, tmp_path, [("a", i, _at(i), float(i * i)) for i in part] + [(None, 9, _at(9), 1.0)]), "run", "epoch", "value", 3), tmp_path, "update")
    rows = {r["last"]: r for r in _out(spark, tmp_path).collect()}
    assert {r["run"] for r in rows.values()} == {"a"} and {r["status"] for r in rows.values()} == {"active"}
    assert rows[5]["mean"] == np.mean([9, 16, 25]) and rows[7]["mean"] == np.mean([25, 36, 49]) and rows[7]["n"] == 3


def test_early_stopping_over_batches(spark, tmp_path):
    for part in ([(0, 1.0), (1, 0.99995)], [(2, 0.99985), (3, 2.0), (4, 2.0)]):
        _run(M.stop_early(_events(spark, tmp_path, [("a", e, _at(e), v) for e, v in part]), "run", "epoch", "value", 1e-4, 2), tmp_path, "update")
    rows = sorted(_out(spark, tmp_path).collect(), key=lambda r: r["batch"])
    assert (rows[0]["best"], rows[0]["bad_epochs"], rows[0]["stopped_at"]) == (1.0, 1, None)
    assert (rows[1]["best"], rows[1]["bad_epochs"], rows[1]["stopped_at"]) == (0.99985, 2, 4)


def test_latest_by_tag_and_sessions(spark, tmp_path):
    rows = [("a", 1, _at(0), 1.0), ("a", 2, _at(3), 5.0), ("a", 3, _at(3), 4.0), ("a", 4, _at(30), 0.5), ("b", 1, _at(1), 2.0)]
    events = _events(spark, tmp_path, rows)
    _run(M.latest_by_tag(events, "run", "ts", "value"), tmp_path / "latest", "update")
    assert {r["run"]: r["latest"] for r in _out(spark, tmp_path / "latest").collect()} == {"a": 0.5, "b": 2.0}
    _run(M.activity(events, "run", "ts", "10 minutes", "5 minutes"), tmp_path / "sessions", "append")
    closed = spark.read.parquet(f"{tmp_path}/sessions/out").select("run", "n").collect()
    assert {("a", 3)} <= {tuple(r) for r in closed}


def test_files_are_processed_one_at_a_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in ("ab", "c"):
        for name in part:
            (tmp_path / f"in/{name}.txt").write_bytes(name.encode() * 3)
        _run(M.new_files(spark, str(tmp_path / "in"), "*.txt").select("path", F.length("content").alias("n")), tmp_path, "update")
    rows = _out(spark, tmp_path).collect()
    assert sorted(r["path"][-5:] for r in rows) == ["a.txt", "b.txt", "c.txt"] and sorted(r["batch"] for r in rows) == [0, 1, 2]


def test_streams_over_a_folder_table(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    table.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    assert live.stream_dedup_keys(spark, str(tmp_path)).count() == table.select("user_id", "event_type").distinct().count()
    assert live.stream_latest_by_tag(spark, str(tmp_path)).count() == table.select("event_type").distinct().count()


def _wait(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "nothing came"
        time.sleep(0.5)


def test_a_timer_fires_after_a_restart_with_the_values_from_before(spark, tmp_path):
    sink = M.BatchSink(f"{tmp_path}/out")
    statuses = lambda: [(r["status"], r["n"], r["mean"]) for r in sink.read(spark).orderBy("batch").collect()] if os.path.isdir(f"{tmp_path}/out/commits") else []
    recent = lambda rows, quiet: M.recent_values(_events(spark, tmp_path, rows), "run", "epoch", "value", 4, quiet_seconds=quiet)
    query = M.run_continuously(recent([("a", i, _at(i), float(i)) for i in range(3)], 600), sink, f"{tmp_path}/state", "1 second")
    try:
        _wait(lambda: statuses())
    finally:
        query.stop()
    assert statuses() == [("active", 3, 1.0)]
    query = M.run_continuously(recent([("a", 3, _at(3), 3.0), ("a", 4, _at(4), 4.0)], 2), sink, f"{tmp_path}/state", "1 second")
    try:
        _wait(lambda: any(s == "quiet" for s, _, _ in statuses()))
    finally:
        query.stop()
    assert statuses() == [("active", 3, 1.0), ("active", 4, 2.5), ("quiet", 4, 2.5)]


def test_a_buffer_is_given_up_after_its_time(spark, tmp_path):
    for part in (range(3), range(3, 5)):
        _run(M.recent_values(_events(spark, tmp_path, [("a", i, _at(i), float(i)) for i in part]), "run", "epoch", "value", 9, keep_seconds=0.2), tmp_path, "update")
        time.sleep(1)
    assert sorted((r["batch"], r["n"]) for r in _out(spark, tmp_path).collect()) == [(0, 3), (1, 2)]


def test_epochs_are_taken_once_and_batches_apart(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    summary = "Epoch {}/5 Summary: Training Loss: {} Validation Loss: {}"
    (logs / "a.log").write_text("\n".join([LINE.format(1, 1, 2.5), summary.format(1, 1.25, 1.5), summary.format(1, 9.0, 9.0), "Epoch 2/5 Summary: Validation Loss: 3"]))
    for more in (None, [summary.format(1, 7.0, 7.0), summary.format(2, 1.0, 1.75), LINE.format(2, 1, 1.5)]):
        if more:
            (logs / "b.log").write_text("\n".join(more))
        _run(M.epochs_once(M.parsed(M.tail(spark, str(logs)))), tmp_path / "epochs")
        _run(M.first_of_batch(M.parsed(M.tail(spark, str(logs)))).select("epoch", "batch", "loss"), tmp_path / "batches")
    epochs = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/epochs/out").collect()))
    assert epochs in ([(1, 1.25, 1.5), (2, 1.0, 1.75)], [(1, 9.0, 9.0), (2, 1.0, 1.75)])
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/batches/out").collect())) == [(1, 1, 2.5), (2, 1, 1.5)]


def test_a_batch_counts_once_it_is_committed_and_only_once(spark, tmp_path):
    sink = M.BatchSink(str(tmp_path / "alerts"))
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "event_id long")
    sink(rows(1, 2), 0)
    sink(rows(1, 2), 0)
    rows(3, 4).write.parquet(f"{sink.rows}/batch=1")  # a writer that was lost before its commit
    assert sorted(r["event_id"] for r in sink.read(spark).collect()) == [1, 2] and not sink.is_committed(spark, 1)
    sink(rows(3, 4), 1)
    sink(rows(99), 0)  # committed, so it is not written again
    sink(rows(), 2)
    assert sorted((r["batch"], r["event_id"]) for r in sink.read(spark).collect()) == [(0, 1), (0, 2), (1, 3), (1, 4)]


def test_voice_activity_by_hand(spark):
    on, off = [1.0, -1.0], [0.0, 0.0]
    signal = off + on + off + on + off * 2 + on + off * 3 + on * 3 + [1.0]
    df = spark.createDataFrame([(1, signal), (2, None), (3, []), (4, [1.0]), (5, [None, 3.0])], "id long, x array<double>")
    found = lambda **k: sorted((r["id"], r["start"], r["end"]) for r in P.voice_activity(df, "x", 2, 0.5, **k).collect())
    assert found() == [(1, 2, 4), (1, 6, 8), (1, 12, 14), (1, 20, 26), (5, 0, 2)]
    assert found(hangover=1) == [(1, 2, 8), (1, 12, 14), (1, 20, 26), (5, 0, 2)]
    assert found(hangover=2, least=2) == [(1, 2, 14), (1, 20, 26)]
    assert found(hangover=3, least=12) == [(1, 2, 26)]
