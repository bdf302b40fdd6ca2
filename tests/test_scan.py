"""Running values in ranges: equal to one window over each group, and spread where a group is large."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.operators import scan, series

ORDER = ["at", "id"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    found = [("hot", rng.randrange(40), i, rng.choice([None, *range(-3, 9)])) for i in range(3000)] + [(rng.choice(["a", "b", None, "zz"]), rng.randrange(40), i, float(rng.randrange(9))) for i in range(3000, 4000)]
    found += [("none", i, 5000 + i, None) for i in range(200)]
    rng.shuffle(found)
    return spark.createDataFrame([(g, a, i, None if v is None else float(v)) for g, a, i, v in found], "g string, at long, id long, value double").repartition(3)


def _same(got, want, names):
    a, b = ([tuple(r) for r in df.select("id", *names).orderBy("id").collect()] for df in (got, want))
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == pytest.approx(y, abs=1e-9) if None not in x + y else x == y


def test_running_values(spark, rows):
    w = Window.partitionBy("g").orderBy(*ORDER)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    _same(series.running_mean(rows, "g", ORDER, "value"), rows.withColumn("running_mean", F.avg("value").over(up)).withColumn("running_best", F.min("value").over(up)), ["running_mean", "running_best"])
    for size in (1, 2, 20, 1500):
        _same(series.bounded_mean(rows, "g", ORDER, "value", size), rows.withColumn("recent_mean", F.avg("value").over(w.rowsBetween(1 - size, 0))), ["recent_mean"])
    want = rows.withColumn("change", F.col("value") - F.lag("value").over(w))
    _same(series.changes(rows, "g", ORDER, "value"), want, ["change"])


def test_rows_before_and_row_numbers(spark, rows):
    w = Window.partitionBy("g").orderBy(*ORDER)
    vectors = rows.withColumn("v", F.when(F.col("id") % 7 > 0, F.array("id", "at")))
    got = scan.with_previous(vectors, "g", ORDER, "v", "before").withColumn("before", F.to_json(F.struct("before")))
    want = vectors.withColumn("before", F.to_json(F.struct(F.lag("v").over(w).alias("before"))))
    assert sorted((r["id"], r["before"]) for r in got.collect()) == sorted((r["id"], r["before"]) for r in want.collect())
    _same(scan.row_numbers(rows, "g", ORDER, "i"), rows.withColumn("i", F.row_number().over(w)), ["i"])


def test_many_small_ranges_carry_over_all_of_them(spark, rows):
    parts = scan.carried(scan.ranged(rows, "g", ORDER, n_ranges=300), "g", ORDER, "value", tail=60)
    want = rows.withColumn("m", F.avg("value").over(Window.partitionBy("g").orderBy(*ORDER).rowsBetween(-60, 0)))
    _same(parts.withColumn("m", scan.recent_mean("g", ORDER, "value", 61)), want, ["m"])


def test_a_hot_group_takes_all_tasks(spark, rows):
    parts = scan.ranged(rows, "g", ORDER, n_ranges=16)
    sizes = [r["n"] for r in parts.groupBy(scan.RANGE).agg(F.count("*").alias("n")).collect()]
    assert parts.where("g = 'hot'").select(scan.RANGE).distinct().count() >= 10 and max(sizes) < 2 * sum(sizes) / len(sizes)
    plan = series.running_mean(rows, "g", ORDER, "value")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "Window [" in line and "_earlier" not in line]  # the fold of the carried rows has one for each range
    assert scans and all("], [_range" in line for line in scans)


def test_an_empty_table(spark, rows):
    assert series.changes(rows.where("false"), "g", ORDER, "value").collect() == []
