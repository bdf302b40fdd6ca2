"""Exact quantiles against sorted lists, whatever the spread of the values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import quality as Q
from voxloom.operators import quantiles as N

P = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]


def _columns():
    rng = random.Random(1)
    yield "near", [1000 + rng.random() * 1e-9 for _ in range(900)]
    yield "wide", [rng.choice([-1, 1]) * 10 ** rng.uniform(-320, 308) for _ in range(900)]
    yield "hot", [5.0] * 600 + [rng.gauss(0, 1) for _ in range(300)]
    yield "ends", [float("-inf")] * 300 + [float("inf")] * 300 + [0.0, -0.0] * 100 + [1.7e308, -1.7e308] * 50
    yield "gaps", [None if i % 3 else float(i) for i in range(900)]
    yield "large", [float(rng.choice([2**53 - 1, 2**53 - 2, 2**60, -(2**60)])) for _ in range(900)]


def _expected(values, p):
    x = sorted(v for v in values if v is not None)
    at = p * (len(x) - 1)
    a, b = x[math.floor(at)], x[math.ceil(at)]
    return a if a == b else a * (1 - (at - math.floor(at))) + b * (at - math.floor(at))


@pytest.mark.parametrize("sorted_at_once", [0, 20, 1 << 16])
def test_every_spread(spark, sorted_at_once):
    names, columns = zip(*_columns(), strict=True)
    df = spark.createDataFrame(list(zip(*columns, strict=True)), ", ".join(f"{n} double" for n in names)).repartition(5)
    got = N.exact_quantiles(df, names, P, sorted_at_once)
    for name, values in zip(names, columns, strict=True):
        for p in P:
            assert got[name][p] == pytest.approx(_expected(values, p), rel=1e-15, nan_ok=True), (name, p)


def test_nothing_nan_and_wrong_probabilities(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (2.0, None, 3.0)], "a double, b double, c double")
    got = N.exact_quantiles(df, ["a", "b", "c"], [0.0, 1.0])
    assert got["a"] == {0.0: 1.0, 1.0: 2.0} and "b" not in got and got["c"][0.0] == 3.0 and math.isnan(got["c"][1.0])
    assert N.exact_quantiles(df.where("false"), ["a"], [0.5]) == {}
    with pytest.raises(ValueError):
        N.exact_quantiles(df, ["a"], [1.5])


def test_the_state_is_bounded(spark, monkeypatch):
    seen = []
    whole = N._bins_of
    monkeypatch.setattr(N, "_bins_of", lambda counted, ranks: seen.append([c.count() for c in counted]) or whole(counted, ranks))
    df = spark.range(200_000).select((F.col("id") * 0.001 + 1e6).alias("x"))
    got = N.exact_quantiles(df, ["x"], [0.5], sorted_at_once=100)
    assert got["x"][0.5] == pytest.approx(1e6 + 99.9995, abs=1e-9)
    assert len(seen) == 2 and all(n <= N.BINS for counts in seen for n in counts)


def test_summary_of_metrics(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 4.0, None), (4, None, None)], "a int, b double, c double")
    rows = {r["metric"]: r for r in Q.summary_stats(df, ["a", "b", "c"]).collect()}
    assert set(rows) == {"a", "b"} and rows["a"]["median"] == 2.0 and rows["b"]["median"] == 3.0
    assert rows["a"]["std"] == pytest.approx(np.std([1, 2, 4])) and (rows["b"]["min"], rows["b"]["max"]) == (2.0, 4.0)
