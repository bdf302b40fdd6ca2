"""Signal expressions on whole signals: their time is linear in the length, their values those of NumPy."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import signal as G
from voxloom.functions import text as T
from voxloom.functions import vectors as V

EXPRESSIONS = {
    "remove_dc": G.remove_dc,
    "peak_normalize": G.peak_normalize,
    "rms_normalize": G.rms_normalize,
    "silence_ratio": G.silence_ratio,
    "trimmed": lambda x: G.peak_normalize(G.trim_silence(G.remove_dc(x))),
    "frame_snr": lambda x: G.frame_snr_db(G.remove_dc(x), 1024),
    "pearson": lambda x: V.pearson(x, G.remove_dc(x)),
    "std": V.std_pop,
}


def _signals(spark, n, rows=4):
    x = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.sin(i * 0.1) * F.exp(-F.abs(i - n / 2) / (n / 8)) + 0.1)
    return spark.range(rows, numPartitions=1).select("id", x.alias("x")).checkpoint()


def _seconds(df, expression):
    began = time.time()
    df.select(expression(F.col("x")).alias("y")).write.format("noop").mode("overwrite").save()
    return time.time() - began


@pytest.fixture(scope="module")
def signals(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("signals")))
    return _signals(spark, 24_000), _signals(spark, 96_000)


@pytest.mark.parametrize("name", EXPRESSIONS)
def test_time_is_linear_in_the_length(signals, name):
    small, large = signals
    _seconds(small, EXPRESSIONS[name])
    took = min(_seconds(large, EXPRESSIONS[name]) for _ in range(2))
    assert took < 8 * min(_seconds(small, EXPRESSIONS[name]) for _ in range(3)) + 1.0


def test_values_of_a_whole_signal(signals):
    row = signals[0].limit(1).select("x", *(e(F.col("x")).alias(n) for n, e in EXPRESSIONS.items())).first()
    x = np.array(row["x"])
    assert np.allclose(row["remove_dc"], x - x.mean())
    assert np.allclose(row["peak_normalize"], (x - x.mean()) / np.abs(x - x.mean()).max() * 10 ** (-3 / 20))
    assert np.allclose(row["rms_normalize"], x * 0.1 / (np.sqrt((x**2).mean()) + 1e-8))
    assert np.isclose(row["silence_ratio"], (np.abs(x) < 0.01 * np.abs(x).max()).mean())
    assert np.isclose(row["pearson"], 1) and np.isclose(row["std"], x.std())


def test_expressions_of_null_and_empty_signals(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "id int, x array<double>")
    rows = {r["id"]: r for r in df.select("id", *(e(F.col("x")).alias(n) for n, e in EXPRESSIONS.items())).collect()}
    assert rows[1]["remove_dc"] is None and rows[2]["remove_dc"] == []
    assert rows[2]["frame_snr"] is None and rows[2]["silence_ratio"] is None


def test_enhancement_rules_at_their_limits(spark):
    cases = [
        ((4.9, 5000.0, 0.2, 0.0), "deepfilter,spectral_subtraction"),
        ((5.0, 5000.0, 0.2, 0.0), "deepfilter"),
        ((12.0, 5000.0, 0.2, 0.0), ""),
        ((20.0, 2399.0, 0.2, 0.0), "resemble_enhance"),
        ((20.0, 2400.0, 0.2, 0.31), "pitch_correction"),
        ((20.0, 5000.0, 0.049, 0.0), "pitch_correction,metricgan"),
        ((20.0, 5000.0, 0.05, 0.0), "pitch_correction"),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, level double, centroid double, rms double, silence double")
    got = df.orderBy("i").select(F.array_join(G.enhancement_methods(F.col("level"), F.col("centroid"), F.col("rms"), F.col("silence"), 24_000.0), ",")).collect()
    assert [r[0] for r in got] == [want for _, want in cases]


def test_pitch_and_features_of_a_tone(spark):
    t = np.arange(24_000) / 24_000
    df = spark.createDataFrame([(1, (np.sin(2 * np.pi * 200 * t)).tolist()), (2, [0.1] * 100)], "id int, x array<double>")
    rows = {r["id"]: r for r in df.select("id", G.pitch_stats(F.col("x"), 24_000.0).alias("p"), G.voice_features(F.col("x"), 24_000.0).alias("v")).collect()}
    assert abs(rows[1]["p"]["mean"] - 200) < 2 and rows[2]["p"]["mean"] == 0
    for r in rows.values():
        v = np.array(r["v"])
        assert len(v) == 256 and abs(v.mean()) < 1e-9 and abs(v.std(ddof=1) - 0.1) < 1e-6
    v = np.array(rows[1]["v"])
    assert len(set(np.round(v[162:], 12))) == 1 and v[154] > v[162]  # padding behind 162 values; the pitch is over 0


def test_log_lines_of_both_kinds(spark):
    log = "Epoch 3/50 Summary:\n  Training Loss:    1.2500\n  Validation Loss:  1.5000\n[Epoch 3/50] Batch 10/200 | Loss: 1.2345 | Avg: 1.3000 | Text: Loss: x\nEpoch 4/50 Summary: Training Loss: 1.0 Validation Loss: 2.0\nother"
    rows = spark.createDataFrame([(log,)], "log string").select(F.explode(T.joined_summaries(F.col("log"))).alias("line")).select(T.parse_log_line(F.col("line")).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in rows] == [
        ("epoch", 3, 50, None, None, None, None, 1.25, 1.5),
        ("batch", 3, 50, 10, 200, 1.2345, 1.3, None, None),
        ("epoch", 4, 50, None, None, None, None, 1.0, 2.0),
        (None,) * 9,
    ]
