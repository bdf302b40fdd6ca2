"""Other rates, random changes and pitch: against known tones, other cuts and other partitionings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import augment as A
from voxloom.functions import pitch as P
from voxloom.functions import rates as R


def _tone(hz, rate, n):
    return 0.5 * np.sin(2 * np.pi * hz * np.arange(n) / rate)


@pytest.mark.parametrize(("rate", "new_rate"), [(24_000, 16_000), (16_000, 24_000), (44_100, 24_000), (8_000, 48_000), (24_000, 24_000)])
def test_a_tone_keeps_its_wave_and_what_lies_above_is_gone(rate, new_rate):
    n = rate // 2
    y = R.in_new_rate(_tone(440, rate, n), rate, new_rate)
    assert len(y) == -(-n * new_rate // rate)
    inside = slice(200, -200)
    assert np.abs(y - _tone(440, new_rate, len(y)))[inside].max() < 1e-4
    if new_rate < rate:
        high = R.in_new_rate(_tone(0.6 * new_rate, rate, n), rate, new_rate)
        assert np.abs(high)[inside].max() < 2e-3


def test_blocks_and_rows_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(1)
    signals = {"a": rng.normal(size=3000), "b": rng.normal(size=511), "c": rng.normal(size=30)}
    rows = [(k, i, x[i : i + 500].tolist()) for k, x in signals.items() for i in range(0, len(x), 500)]
    whole = {k: R.in_new_rate(x, 441, 240) for k, x in signals.items()}
    monkeypatch.setattr(R, "BLOCK", 17)
    assert all(np.array_equal(R.in_new_rate(x, 441, 240), whole[k]) for k, x in signals.items())
    df = spark.createDataFrame(rows, "key string, start int, samples array<double>").repartition(5)
    found = sorted((r["key"], r["start"], r["samples"]) for r in R.resample_rows(df, "key", "start", "samples", 441, 240).collect())
    for k, y in whole.items():
        parts = [(s, x) for key, s, x in found if key == k]
        assert np.allclose(np.concatenate([x for _, x in parts]), y, atol=1e-12) and all(s == sum(len(p) for _, p in parts[:i]) for i, (s, _) in enumerate(parts))
    short = spark.createDataFrame([("a", 0, [1.0] * 3), ("a", 3, [1.0] * 3)], df.schema)
    with pytest.raises(Exception, match="must hold"):
        R.resample_rows(short, "key", "start", "samples", 441, 240).collect()


def test_null_empty_and_wrong_rates(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1.0, None, 1.0])], "id int, x array<double>")
    rows = {r["id"]: r for r in df.select("id", R.resample(F.col("x"), 2, 4).alias("y"), P.pitch_corrected(F.col("x"), 8000, 100.0).alias("p"), A.augmented(F.col("x"), F.col("id"), F.lit(1)).alias("a")).collect()}
    assert rows[1]["y"] is None and rows[2]["y"] == [] and len(rows[3]["y"]) == 6
    assert rows[1]["p"] is None and rows[2]["p"] == [] and rows[3]["p"] == [1.0, 0.0, 1.0]
    assert rows[1]["a"] is None and rows[2]["a"] == []
    with pytest.raises(ValueError):
        R.resample(F.col("x"), 0, 4)


def test_changes_are_the_same_under_any_partitioning(spark):
    df = spark.range(400).select("id", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.sin(i * 0.1)).alias("x"))
    of = lambda d, step: {r["id"]: r["y"] for r in d.select("id", A.augmented(F.col("x"), F.col("id"), F.lit(step)).alias("y")).collect()}
    first = of(df.repartition(7), 3)
    assert first == of(df.coalesce(1), 3) and first != of(df, 4)
    f = df.select(A.factors(F.col("id"), F.lit(3)).alias("f")).select("f.*").toPandas()
    assert 0.2 < (f["shift"] != 1).mean() < 0.4 and 0.12 < (f.stretch != 1).mean() < 0.28 and 0.4 < (f.gain != 1).mean() < 0.6
    assert f["shift"].between(0.98, 1.02).all() and f.stretch.between(0.99, 1.01).all() and f.gain.between(0.95, 1.05).all()
    lengths = {len(y) for y in first.values()}
    assert len(lengths) > 3 and min(lengths) >= 96 and max(lengths) <= 104
    assert df.limit(1).select(A.augmented(F.col("x"), F.col("id"), F.lit(3), training=False).alias("y")).first()["y"] == df.limit(1).first()["x"]


def _pitch(x, rate):
    """By what the signal repeats itself, whichever of its harmonics is loudest."""
    like = [float(np.dot(x[:-k], x[k:])) / float(np.linalg.norm(x[:-k]) * np.linalg.norm(x[k:])) for k in range(rate // 420, rate // 70)]
    return rate / (rate // 420 + next(i for i, v in enumerate(like) if v > 0.97 * max(like) and v >= max(like[i : i + 20])))


@pytest.mark.parametrize("hz", [110.0, 150.0, 233.0])
def test_a_tone_moves_to_its_target_and_keeps_its_length(hz):
    rate = 16_000
    x = _tone(hz, rate, 16_000) + 0.3 * _tone(2 * hz, rate, 16_000)
    for target in (140.0, 180.0):
        y = P.corrected(x, rate, target)
        assert len(y) == len(x) and abs(_pitch(y, rate) - target) < 0.02 * target
    assert np.abs(P.corrected(x, rate, 180.0, strength=0.0) - x)[800:-800].max() < 0.02
    half = P.corrected(x, rate, 180.0, strength=0.5)
    assert abs(_pitch(half, rate) - 2 * hz * 180 / (hz + 180)) < 0.03 * hz


def test_noise_and_silence_pass():
    noise = np.random.default_rng(3).normal(size=8000) * 0.1
    assert np.abs(P.corrected(noise, 16_000, 150.0) - noise).max() < 0.05
    assert P.corrected(np.zeros(4000), 16_000, 150.0).tolist() == [0.0] * 4000 and P.period_at(noise, 4000, 16_000) is None
