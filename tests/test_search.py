"""Blocked search against the plain formula, for any number of blocks and slices."""

import numpy as np
import pytest

from voxloom.operators import search


def _rows(rng, n, dims, names):
    return [(names(i), [float(x) for x in rng.normal(size=dims)]) for i in range(n)]


def _plain(target, voices):
    best = None
    t = np.array(target)
    for name, v in voices:
        v = np.array(v)
        size = np.sqrt(t @ t) * np.sqrt(v @ v)
        if size > 0:
            score = ((t - v) ** 2).mean() - t @ v / size
            best = min(best or (np.inf, ""), (score, name))
    return best


@pytest.mark.parametrize("block", [16 << 20, 700])
def test_nearest_equals_the_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    monkeypatch.setattr(search, "SLICE_ROWS", 50)
    rng = np.random.default_rng(4)
    voices = _rows(rng, 40, 6, lambda i: f"v{i:02d}") + [("zero", [0.0] * 6)]
    voices += [("copy", voices[3][1]), ("a copy", voices[3][1]), voices[5]]
    targets = _rows(rng, 150, 6, lambda i: i % 120) + [(200, voices[3][1]), (201, [0.0] * 6), (202, None), (203, [1.0, 2.0]), (204, [1.0] * 5 + [None]), (None, voices[7][1]), (205, voices[5][1]), (205, voices[5][1])]
    got = search.nearest(spark.createDataFrame(targets, "id long, x array<double>"), spark.createDataFrame(voices, "label string, vec array<double>"), "id", "x", "label", "vec").collect()
    assert len(got) == len({(i, str(x)) for i, x in targets})
    want = sorted([(i, _plain(x, voices) if x and len(x) == 6 and None not in x else None) for i, x in targets[:-1]], key=str)
    for r, (i, best) in zip(sorted(got, key=lambda r: str((r["id"], r["best_score"] and (r["best_score"], r["best"])))), want, strict=True):
        assert r["id"] == i and (r["best"], r["best_score"]) == ((best[1], pytest.approx(best[0], abs=1e-12)) if best else (None, None))
    assert {r["best"] for r in got if r["id"] == 200} == {"a copy"}


@pytest.mark.parametrize("block", [16 << 20, 100])
def test_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    rows = _rows(np.random.default_rng(5), 12, 4, lambda i: f"v{i:02d}")
    got = search.pairwise_distances(spark.createDataFrame(rows, "label string, vec array<double>"), "label", "vec").collect()
    want = {(a, b): np.linalg.norm(np.subtract(x, y)) for a, x in rows for b, y in rows if a < b}
    assert {(r["a"], r["b"]): pytest.approx(r["distance"]) for r in got} == want and len(got) == 66


def test_no_voices_and_voices_of_two_lengths(spark):
    targets = spark.createDataFrame([(1, [1.0])], "id long, x array<double>")
    voices = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "label string, vec array<double>")
    assert [tuple(r) for r in search.nearest(targets, voices.where("false"), "id", "x", "label", "vec").collect()] == [(1, None, None)]
    assert search.nearest(targets.where("false"), voices.where("label = 'a'"), "id", "x", "label", "vec").collect() == []
    assert search.pairwise_distances(voices.where("false"), "label", "vec").collect() == []
    with pytest.raises(ValueError):
        search.nearest(targets, voices, "id", "x", "label", "vec")
