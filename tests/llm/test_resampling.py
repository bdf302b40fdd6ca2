"""Importance resampling: SQL on edge cases, hashes and merges against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import difference
from voxloom.llm import common, resampling

THIN = "id long, n_features long, weight long, score long, n_words long"


def _words(rng, n):
    return " ".join(rng.choice(["The", "é", "MIT", "a1", "x" * 70, "und", "von", "ß", "日本", "b", "q"]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    docs = [(i, _words(rng, i % 45)) for i in range(300)] + [(400, None), (401, ""), (402, " \n-"), (None, _words(rng, 30)), (403, "one"), (404, "one two"), (405, "A-b C")]
    docs += [(500, _words(random.Random(2), 40))] * 6 + [(500, _words(rng, 40))] + [(600 + i, _words(random.Random(3), 40)) for i in range(100)]
    docs += [(900, " ".join(f"w{i % 977}" for i in range(300_000)))]
    path = str(tmp_path_factory.mktemp("tables"))
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", [(1, _words(rng, 60)), (2, None), (2, "the é")], "item_id long, text string")):
        spark.createDataFrame(rows, schema).toPandas().astype({schema.split()[0]: "Int64"}).to_parquet(f"{path}/{name}.parquet")
    return path


def test_equals_its_sql_on_edge_cases(spark, folder):
    assert difference(resampling.op12_resampling(spark, folder), resampling.OP12_SQL, folder) == ""


def test_features_are_the_crcs_of_their_text(monkeypatch):
    rng = random.Random(4)
    lines = [" ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 90]))) for _ in range(n)).encode() for n in (0, 1, 2, 3, 50, 400)]
    want = []
    for i, line in enumerate(lines):
        w = line.split()
        want += [(i, zlib.crc32(b" ".join(w[k : k + n]))) for n in (1, 2, 3) for k in range(len(w) - n + 1)]
    for size in (1 << 20, 64, 1):
        monkeypatch.setattr(common, "PIECE_BYTES", size)
        got = [(int(o), int(c)) for owners, crcs in resampling.features(lines) for o, c in zip(owners, crcs, strict=True)]
        assert sorted(got) == sorted(want)


def test_tournament_gives_sorted_rows():
    rng = random.Random(5)
    tree, sources = resampling.Tournament(), [sorted((rng.randrange(50), i) for i in range(rng.randrange(30))) for _ in range(37)]
    for s in sources[:20]:
        tree.add(iter(s))
    got = [tree.pop() for _ in range(10)]
    for s in sources[20:]:
        tree.add(iter([x for x in s if x >= got[-1]]))
    while tree.head() is not tree.OUT:
        got.append(tree.pop())
    want = [x for s in sources[:20] for x in s] + [x for s in sources[20:] for x in s if x >= got[9]]
    assert got == sorted(want)
    assert len(tree.heads) == 64


def _expected(rows, percent):
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    draw = percent * len(able) // 100
    return sorted([(*r[:4], k + 1) for k, r in enumerate(able[:draw])] + [(*r[:4], None) for r in [*able[draw:], *(r for r in rows if r[4] < 20)]], key=str)


@pytest.mark.parametrize("percent", [0, 1, 5, 60, 100])
def test_ranks_over_many_runs_and_ranges(spark, percent):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(300)]), rng.randrange(3), rng.randrange(3), rng.choice([7, 7, rng.randrange(-40, 40)]), rng.choice([19, 20, 400])) for _ in range(4000)]
    df = spark.createDataFrame(rows, THIN).repartition(13)
    got = resampling.draw_highest(df, F.col("n_words") >= 20, percent, range_rows=60, piece_rows=5)
    assert sorted(map(tuple, got.collect()), key=str) == _expected(rows, percent)


def test_only_the_drawn_ranges_are_merged(spark, monkeypatch):
    rows = [(i, 1, 1, (i * 7919) % 100_003, 30) for i in range(20_000)]
    df = spark.createDataFrame(rows, THIN).repartition(8)
    seen = []
    cut = resampling._merged
    monkeypatch.setattr(resampling, "_merged", lambda before, draw: seen.append((before, draw)) or cut(before, draw))
    got = resampling.draw_highest(df, F.col("n_words") >= 20, 5, range_rows=100)
    assert [r["rank"] for r in got.where("rank IS NOT NULL").orderBy("rank").collect()] == list(range(1, 1001))
    before, draw = seen[0]
    sizes = np.diff([b for b in before if b <= draw])
    assert draw == 1000 and len(sizes) > 8 and sizes.max() < 3 * sizes.mean()


def test_strings_as_ids_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(f"é{i}", "a b c d " * 8, i, "x") for i in range(60)] + [(None, None, 1, "y")], "doc_id string, text string, score int, rank string")
    target = spark.createDataFrame([], "text string")
    rows = resampling.importance_resample(docs, target).collect()
    assert len(rows) == 61 and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
    assert resampling.importance_resample(docs.where("false"), target).collect() == []
    ids = spark.range(1).select(resampling.noise(F.lit("7")).alias("n")).first()["n"]
    h = int(hashlib.sha256(b"42:7").hexdigest()[:8], 16)
    assert ids == math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
