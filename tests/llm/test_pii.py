from collections import Counter

import numpy as np
import pytest

from voxloom.llm import pii

from .brute import pii_base

CASES = [
    None,
    "",
    "a@b.c%d@e.f g@h @i.j aa@bb. x@y.z.w",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 12.34.56.78",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111111111111111",
    "+1 (663) 555-6869 +12 +123456789012345678 +1234567 8",
    "x" * 60_000 + "@" + "9" * 60_000 + "." + "1." * 3_000,
    "ééé a@b.co ñ 1.1.1.1",
    "write to john (at) mail (dot) com or Mr. Smith, ssn 123-45-6789, call 212-555-0199",
    "7 " * 5_000,
]


def test_base_spans_match_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for row in pii.find_pii(docs).collect():
        text = CASES[row["doc_id"]] or ""
        assert [(s["kind"], s["start"], s["end"]) for s in row["base_spans"]] == pii_base(text), row["doc_id"]
        for s in row["added_spans"]:
            assert s["probability"] >= 0.8
            assert all(s["end"] <= b["start"] or b["end"] <= s["start"] for b in row["base_spans"])


def test_op3_on_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pii.op3_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = pii_base(texts[r["doc_id"]])
        assert r["spans"].startswith(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in base) for k in pii.BASE]


def candidates(rng, n):
    """(votes, features, truth): half of the labelers are weak, and two features tell what the votes leave open."""
    out = []
    for _ in range(n):
        truth = bool(rng.random() < 0.4)
        votes = [(1 if truth == (rng.random() < a) else -1) if rng.random() < 0.5 else 0 for a in (0.85, 0.75, 0.8, 0.7, 0.65)]
        features = [int(rng.integers(0, 2)) for _ in pii.FEATURES]
        features[0], features[3] = (3 if truth == (rng.random() < 0.9) else 0), (2 if truth == (rng.random() < 0.8) else 1)
        out.append((votes, features, truth))
    return out


def test_classifier_has_weights_of_its_own_and_beats_the_vote():
    rng = np.random.default_rng(5)
    rows = candidates(rng, 6_000)
    counted = Counter(("ssn", tuple(v), tuple(f)) for v, f, _ in rows)
    model = pii.fit_span_model([(k, list(v), list(f), n) for (k, v, f), n in counted.items()])
    weights = np.array(model.weights["ssn"])
    assert weights[1 + 2 * len(pii.FEATURES)] > 0.5  # the first feature at level 3, which no labeler sees
    odds = np.log(np.array(model.accuracy["ssn"]) / (1 - np.array(model.accuracy["ssn"])))
    x = pii._design(np.array([f for _, f, _ in rows]))
    by_votes = np.array([np.dot(v, odds) for v, _, _ in rows]) + np.log(model.prior["ssn"] / (1 - model.prior["ssn"]))
    truth = np.array([t for _, _, t in rows])
    with_features = model.votes * by_votes + model.features * (x @ weights)
    right = [((score > 0) == truth).mean() for score in (np.array([np.sum(v) for v, _, _ in rows]), by_votes, with_features)]
    assert right[2] > right[1] + 0.02 and right[2] > right[0] + 0.02


def test_reliabilities_are_those_of_a_kind():
    rows = [("ssn", [1, 0, 1, 0, 0], [0] * 8, 500), ("ssn", [-1, 0, 0, -1, 0], [0] * 8, 500), ("person", [1, 0, -1, 0, 0], [0] * 8, 500), ("person", [0, 1, -1, 0, 0], [0] * 8, 500), ("person", [1, 1, -1, 0, 0], [0] * 8, 900)]
    model = pii.fit_span_model(rows)
    assert model.accuracy["ssn"][2] > 0.8 > model.accuracy["person"][2] and model.prior["person"] != model.prior["ssn"]
    assert set(pii.fit_span_model([]).accuracy) == set(pii.WIDE)


def test_planted_spans_are_added_and_decoys_are_not(spark):
    rng = np.random.default_rng(6)
    good = ["Contact: Dr. Mary Johnson,", "my ssn is {0}-4{1}-67{2}, thanks", "call 4{1}2-4{1}6-77{2} today", "please reach bob{1} [at] mail [dot] com,", "account DE89 3704 0044 0532 0130 {2}"]
    bad = ["part #{0}-00-0000", "order 9{2}-4{1}-0000 invoice", "version 2{2}-1{2}-1234/serial", "item =4{2}-1{2}-5678"]
    rows, want = [], {}
    for i in range(600):
        text = str(rng.choice(good if i % 2 else bad)).format(rng.integers(100, 600), rng.integers(1, 9), rng.integers(10, 99))
        rows.append((i, f"some words {text} and more"))
        want[i] = i % 2
    got = {r["doc_id"]: bool(r["added_spans"]) for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [i for i in got if got[i]]
    assert sum(want[i] for i in found) / len(found) > 0.95 and len(found) > 200


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "Mr. John Smith, a@b.co"), (1, "Mr. John Smith, a@b.co"), (None, None)], "doc_id long, text string")
    rows = pii.find_pii(docs).collect()
    assert len(rows) == 3 and rows[0] == rows[1]
    with pytest.raises(ValueError):
        pii.find_pii(docs.withColumnRenamed("doc_id", "base_spans"))


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, wide int")
    assert pii.find_pii(empty).columns == ["doc_id", "text", "wide", "base_spans", "added_spans"]
    assert pii.find_pii(empty).count() == 0
