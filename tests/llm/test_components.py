import random

import numpy as np

from voxloom.llm.near_dedup import BANDS, PLACES, ROWS, super_minhash
from voxloom.llm.components import components


def plain(edges):
    root = {}
    for a, b in edges:
        root.setdefault(a, a)
        root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(5)
    cases = [
        [(i, i + 1) for i in range(40)],
        [(50, i) for i in range(49)] + [(60, 61), (61, 60), (7, 7)],
        [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
        [(9, 5), (9, 7), (7, 3), (11, 12)],
    ]
    for edges in cases:
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {k: v for k, v in plain([e for e in edges if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_take_no_rounds_and_many_tasks_still_join(spark, monkeypatch):
    from voxloom.llm import common
    from voxloom.llm import components as C

    made, keep = [], common.checkpoint
    monkeypatch.setattr(common, "checkpoint", lambda df: made.append(1) or keep(df))
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(300)]
    rng.shuffle(edges)
    want = plain([e for e in edges if e[0] != e[1]])
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert len(made) == 2  # a round's plan has over a hundred aggregations, and each task of it stays in the driver's memory
    monkeypatch.setattr(C, "EDGES_PER_TASK", 40)
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert len(made) > 5


def test_variance_and_recall_of_the_signatures():
    rng = np.random.default_rng(11)
    estimates, missed, pairs = [], 0, 0
    for _ in range(120):
        shared, own = 340, 30  # similarity 340 / 400 = 0.85
        words = rng.integers(0, 1 << 63, shared + 2 * own).astype(np.uint64)
        a, b = np.sort(words[: shared + own]), np.sort(np.concatenate([words[:shared], words[shared + own :]]))
        s = super_minhash(np.concatenate([a, b]), np.array([len(a), len(b)]))
        estimates.append((s[0] == s[1]).mean())
        bands = (s[0] == s[1])[: BANDS * ROWS].reshape(ROWS, BANDS).all(0)
        missed, pairs = missed + (not bands.any()), pairs + 1
    assert abs(np.mean(estimates) - 0.85) < 0.01
    assert np.var(estimates) < 1.2 * 0.85 * 0.15 / PLACES  # no more than plain MinHash has
    assert missed / pairs < 0.02
