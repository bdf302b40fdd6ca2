"""Source divergence: the SQL is the brute-force version, on a small table of edge cases."""

import os
import types

import pytest
from pyspark.sql import functions as F

from tests.oracle import difference
from voxloom.llm import common, divergence

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]


def _rows():
    yield from ((i, f"The Été {WORDS[i % 7]} {WORDS[i % 5]} 12x{WORDS[i % 3]} ÉTÉ\n", "en", f"s{i % 4}") for i in range(160))
    yield from ((i, "hot HOT_hot " * 50, "en", "hot") for i in range(200, 300))  # copies: a group with many rows
    yield from ((i, f"rare {i}", "de", f"s{i % 3}") for i in range(300, 320))  # no kept term
    yield from [(400, None, None, None), (401, "", "fr", None), (402, "x", "fr", ""), (403, "alone", "es", "s0"), (None, None, "en", None), (None, "the", None, "s1")]
    yield (500, "the " * 400_000 + "end", "en", "s0")  # longer than a piece
    yield from [(600, "the the", "en", "s2")] * 3


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(list(_rows()), "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_equals_its_sql_on_edge_cases(spark, folder, tmp_path):
    whole = tmp_path / "t"
    whole.mkdir()
    table = spark.read.parquet(f"{folder}/documents.parquet").coalesce(1)
    table.write.parquet(f"{tmp_path}/one")
    part = next(f for f in os.listdir(f"{tmp_path}/one") if f.endswith(".parquet"))
    os.rename(f"{tmp_path}/one/{part}", whole / "documents.parquet")
    got = divergence.op11_divergence(spark, folder)
    assert difference(got, divergence.OP11_SQL, str(whole)) == ""
    rows = got.collect()
    assert {r["value"] for r in rows if r["lang"] == "de"} == {0} and not [r for r in rows if r["lang"] == "es"]
    assert {(r["source"], r["item"]) for r in rows if r["lang"] == "de"} == {(a, b) for a in ("s0", "s1", "s2") for b in ("s0", "s1", "s2") if a != b}


def test_tasks_that_hold_few_terms_count_alike(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").fillna("", ["text", "lang", "source"])
    whole = sorted(map(tuple, divergence.term_counts(docs).collect()))
    line = "aa bbb  c " * 30 + "dddd"
    monkeypatch.setattr(common, "PIECE_BYTES", 7)
    pieces = list(common.word_pieces(line.encode()))
    assert len(pieces) > 20 and [w for p in pieces for w in p] == line.encode().split()
    few = divergence._counted
    limits = dict(few.__globals__, MAX_HELD=3)
    small = types.FunctionType(few.__code__, limits)
    monkeypatch.setattr(divergence, "_counted", small)
    assert sorted(map(tuple, divergence.term_counts(docs).collect())) == whole


def test_shares_are_exact_beyond_long(spark):
    row = spark.range(1).select(divergence._share(F.lit(900_000_000_000_000), F.lit(1_000_000_000_000_007), F.lit(3), 1_000_000_000, 5).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * 900_000_000_000_005 // 1_000_000_000_000_022


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.source_divergence(empty).collect() == []
    clash = spark.createDataFrame([("a a", "en", s, 1, 2, "x") for s in "abc"], "text string, lang string, source string, n long, value long, term string")
    rows = divergence.source_divergence(clash, min_docs=2).collect()
    assert [r["value"] for r in rows if r["part"] == "pair"] == [0] * 6 and not [r for r in rows if r["part"] == "term"]
