"""Language identification: the kernel against sets, the regression against its closed form, held-out accuracy."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from voxloom.llm import language as L

WORDS = {"en": "the of and to in that with from", "de": "der die und von nicht über größe für", "fr": "le les des été où près être avec", "el": "και το να που είναι από δεν"}


def _text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def _rows(n=120):
    rng = random.Random(1)
    return [(i, _text(rng, lang, rng.choice([6, 20, 200])), lang) for i in range(n) for lang in [list(WORDS)[i % 4]]]


def _places(text, longest=L.LONGEST):
    """The kernel's set, place by place, from the text's letters."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    spaced = " " + "".join(c for p, c in zip(" " + letters, letters, strict=False) if c != " " or p != " ")
    out = set()
    for n in range(1, longest + 1):
        for i in range(len(spaced) - n + 1):
            h = 0
            for c in spaced[i : i + n]:
                h = (h + ord(c) + 1) * 0x9E3779B1 & 0xFFFFFFFF
            out.add(((h ^ h >> 15) * 0x85EBCA77 & 0xFFFFFFFF) >> 32 - L.DIM_BITS)
    return out


def test_presence_is_the_set_of_all_runs(monkeypatch):
    rng = random.Random(2)
    texts = ["a", "Ab-c  d9é", " \n", "", None, "x" * 3000, "日本 Σς", "12 34", _text(rng, "el", 900) + "!" + _text(rng, "fr", 40)]
    for chunk in (1 << 18, 7):
        monkeypatch.setattr(L, "CHUNK_CHARS", chunk)
        rows = L.presence(texts)
        for text, row in zip(texts, rows, strict=True):
            want = _places(text) if text and any(c.isalpha() for c in text) else set()
            assert set(np.flatnonzero(row).tolist()) == want, (text, chunk)


def test_regression_on_landmarks_solves_its_equations():
    rng = random.Random(3)
    langs = [lang for lang in WORDS for _ in range(12)]
    rows = L.presence([_text(rng, lang, 15) for lang in langs])
    order = [i for k in range(12) for i in range(k, 48, 12)]
    rows, langs = rows[order], [langs[i] for i in order]
    model = L.fit(np.packbits(rows.astype(bool), axis=1), langs, n_landmarks=20, ridge=0.5)
    x = L._normalised(rows)
    kernel, inner = (x @ x[:20].T).astype(float), (x[:20] @ x[:20].T).astype(float)
    wanted = (np.array(langs)[:, None] == np.array(sorted(WORDS))[None]).astype(float)
    # With all languages alike the minimum of |K a + b - Y|^2 + ridge a' K_mm a has a gradient of 0.
    left = kernel.T @ (kernel @ model.weights + model.bias - wanted) + 0.5 * inner @ model.weights
    assert np.abs(left).max() < 1e-3 and np.abs((kernel @ model.weights + model.bias - wanted).sum(0)).max() < 1e-3


def test_held_out_accuracy(spark, sf_dir):
    large = sf_dir.replace("sf0.001", "sf0.01")
    rows = L.op13_language(spark, large).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(held) / len(held) > 0.98


def test_only_labelled_rows_that_are_not_held_out_teach(spark):
    rows = _rows(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(L.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    a, b = L.train(docs), L.train(wrong)
    assert a.langs == b.langs == sorted(WORDS) and np.array_equal(a.weights, b.weights)
    found = L.sample(docs, max_docs=30, of_lang=10).groupBy("lang").count().collect()
    assert sum(r["count"] for r in found) == 30 and {r["count"] for r in found} == {7, 8}
    assert L.sample(docs, of_lang=5).count() == 20


def test_edge_rows(spark):
    rows = _rows() + [(1, None, "en"), (2, "", "en"), (3, "12 -", "de"), (None, "the of and", "en"), (4, "the of", None), (4, "the of", None), (5, "der die und von " * 100_000, "de"), (5, "und", "de")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, place int, found int")
    out = L.identify(docs, L.train(docs)).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "text", "lang", "place", "found", "lang_pred", "score"}
    for r in out:
        if not r["text"] or r["text"] == "12 -":
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == (r["lang"] or "en")


def test_nothing_to_learn_from_and_nothing_to_read(spark):
    docs = spark.createDataFrame([(1, "the", None), (None, "of", "en")], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in L.identify(docs, L.train(docs)).collect()] == [("und", 0.0)] * 2
    assert L.identify(docs.where("false"), L.train(docs)).collect() == []
    one = spark.createDataFrame([(i, f"word {i}", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in L.identify(one, L.train(one)).collect()} == {"en"}


def test_clashing_names_are_an_error(spark):
    docs = spark.createDataFrame([(1, "the", "en", 1.0)], "doc_id long, text string, lang string, score double")
    try:
        L.identify(docs, L.Model([], np.zeros((0, 4096), np.uint8), np.zeros((0, 0)), np.zeros(0)))
    except ValueError as e:
        assert "score" in str(e)
    else:
        raise AssertionError("a clash went through")
