import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voxloom.functions import batches as B
from voxloom.functions import pitch, rates, spectra


def test_parts_hold_every_row_once_and_few_values():
    signals = pa.array([[1.0] * n if n >= 0 else None for n in [3, -1, 0, 50, 2, 2, 2, 9, 0]], pa.list_(pa.float64()))
    cut = list(B.parts(signals, 10))
    assert [i for at, n in cut for i in range(at, at + n)] == list(range(len(signals)))
    assert all(n == 1 or sum(len(x.values or []) + 1 for x in signals.slice(at, n)) <= 10 for at, n in cut)
    assert list(B.parts(signals.slice(0, 0))) == []
    assert B.rows([np.array([1.0, 2.0]), None, np.zeros(0)]).to_pylist() == [[1.0, 2.0], None, []]
    assert B.arrays(signals.slice(1, 2))[0] is None and len(B.arrays(signals.slice(1, 2))[1]) == 0


def test_results_leave_in_parts_and_are_those_of_each_signal(spark):
    rng = np.random.default_rng(4)
    given = [(i, None if i % 11 == 3 else rng.normal(size=int(rng.integers(0, 300))).tolist()) for i in range(60)]
    given += [(60, [0.5, None, 0.25] * 40), *((i, np.sin(np.arange(1600) * i / 900).tolist()) for i in range(61, 161))]  # more than a part
    df = spark.createDataFrame(given, "id int, x array<double>").coalesce(1)
    levels = spectra.with_log_spectra(df, "x", "s", (32, 16))
    got = {r["id"]: r["s"] for r in levels.collect()}
    moved = {r["id"]: r for r in df.select("id", pitch.pitch_corrected(F.col("x"), 8000, 150.0).alias("p"), rates.resample(F.col("x"), 3, 2).alias("r")).collect()}
    for i, x in given:
        whole = None if x is None else np.array(x, float)
        if x is None:
            assert got[i] is moved[i]["p"] is moved[i]["r"] is None
            continue
        assert moved[i]["p"] == pitch.corrected(np.nan_to_num(whole), 8000, 150.0).tolist()
        assert moved[i]["r"] == rates.in_new_rate(np.nan_to_num(whole), 3, 2).tolist()
        if i != 60:
            assert got[i] == (None if not len(x) else [spectra.log_spectrum(whole, n).tolist() for n in (32, 16)])
