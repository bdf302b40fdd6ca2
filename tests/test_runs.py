"""Runs of stages: what is committed is not run again, and a crash loses only the stage it hits."""

import pytest
from pyspark.sql import functions as F

from voxloom.functions import spectra as S
from voxloom.operators import integrity as I
from voxloom.plans.pipeline import Run


def _stages(calls, broken=()):
    def stage(name, change):
        def work(df):
            calls.append(name)
            if name in broken:
                raise RuntimeError(name)
            return change(df)

        return name, work

    return [stage("double", lambda df: df.select((F.col("id") * 2).alias("id"))), stage("odd", lambda df: df.where("id % 4 = 2")), stage("next", lambda df: df.select((F.col("id") + 1).alias("id")))]


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_run_resumes_where_it_broke(spark, tmp_path):
    calls = []
    with pytest.raises(RuntimeError):
        Run(spark, str(tmp_path), _stages(calls, ["next"])).execute(spark.range(4))
    run = Run(spark, str(tmp_path), _stages(calls))
    assert _ids(run.execute(spark.range(4))) == [3, 7]
    assert calls == ["double", "odd", "next", "next"]
    assert set(run.committed()) == {"double", "odd", "next"} and run.log().count() == 3
    assert _ids(run.execute(spark.range(4))) == [3, 7] and len(calls) == 4
    assert abs(run.timings().agg(F.sum("pct")).first()[0] - 100) < 1e-6


def test_restart_and_skip(spark, tmp_path):
    calls = []
    run = Run(spark, str(tmp_path), _stages(calls))
    run.execute(spark.range(4))
    assert _ids(run.execute(spark.range(8), restart=True)) == [3, 7, 11, 15] and len(calls) == 6
    assert _ids(Run(spark, str(tmp_path / "other"), _stages(calls), {"odd"}).execute(spark.range(3))) == [1, 3, 5]


def test_uploads_are_valid_or_not(spark):
    rows = spark.createDataFrame([(1, 0.9, True), (2, None, True), (3, 0.1, True), (4, 0.9, False), (5, 0.9, None)], "k int, confidence double, fine boolean")
    kept, report = I.clean_for_upload(rows, spark.createDataFrame([(1,), (2,), (9,)], "k int"), "k", F.col("fine"))
    row = report.first()
    assert _ids(kept.select(F.col("k").alias("id"))) == [1, 2]
    assert (row["total"], row["confident"], row["clean"], row["kept"], row["n_orphaned"], row["n_missing"], row["valid"]) == (5, 4, 2, 2, 1, 0, True)
    assert not I.clean_for_upload(rows, spark.createDataFrame([(1,)], "k int"), "k", F.col("fine"))[1].first()["valid"]
    assert not I.clean_for_upload(rows.where("k > 9"), spark.createDataFrame([(1,)], "k int"), "k", F.col("fine"))[1].first()["valid"]


def test_spectrograms_of_unequal_length_and_none(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0, 3.0], [2.0, 1.0, 5.0]], [[1.0, 2.0], [2.0, 1.0]]), (2, None, [[1.0], [1.0]]), (3, [], []), (4, [[], []], [[], []]), (5, [[1.0], [2.0]], [[1.0], [2.0]])], "id int, p array<array<double>>, t array<array<double>>")
    rows = {r["id"]: r for r in df.select("id", S.cepstral_distortion(F.col("p"), F.col("t")).alias("mcd"), S.training_similarity(F.col("p"), F.col("t")).alias("s"), S.voice_loss(F.col("p"), F.col("t"), F.array(F.lit(0.1), F.lit(0.2)), F.lit(3)).alias("l")).collect()}
    assert rows[1]["mcd"] == 0 and abs(rows[1]["s"]["cosine_loss"]) < 1e-12 and abs(rows[1]["s"]["freq_correlation_loss"] - 0.5) < 1e-6 and rows[1]["l"]["total_loss"] == 0
    assert all(rows[i]["mcd"] is None and rows[i]["s"] is None for i in (2, 3, 4))
    assert rows[5]["mcd"] == 0 and rows[5]["s"]["freq_correlation_loss"] is None
