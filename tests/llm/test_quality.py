import itertools
import zlib

import numpy as np

from voxloom.llm import quality


def auc(scores, labels):
    order = sorted(zip(scores, labels, strict=True))
    good, bad = [s for s, y in order if y], [s for s, y in order if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 4])
    scores, moves = rng.normal(size=8), rng.normal(size=(2, 2))
    forward, backward = quality.forward_backward(scores, moves, counts)
    got, at = quality._sigmoid(forward + backward), 0
    for n in counts:
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(scores[at + i] * y[i] for i in range(n)) + sum(moves[a, b] for a, b in itertools.pairwise(y)))
            total, good = total + p, good + p * np.array(y)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_chunks_do_not_change_scores(spark, sf_dir):
    texts = [r["text"].encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rng = np.random.default_rng(0)
    field = quality.Field(np.zeros(quality.N_FEATURES), np.ones(quality.N_FEATURES), rng.normal(size=quality.N_FEATURES + 1), rng.normal(size=(2, 2)))
    assert np.allclose(quality.score_texts(texts, field), np.concatenate([quality.score_texts([t], field) for t in texts]))


def test_op2_ranks_held_out_documents(spark, sf_dir):
    large = sf_dir.replace("sf0.001", "sf0.01")
    rows = quality.op2_quality(spark, large).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    tested = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc(*zip(*tested, strict=True)) > 0.97
    assert sum((s >= 0.3) == bool(y) for s, y in tested) / len(tested) > 0.95


def test_nulls_empties_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "\n\n"), (None, "a b"), (3, "x" * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    field = quality.train_field(docs, labels)
    assert [r["score"] for r in quality.score_quality(docs, field).collect()] == [0.5] * 5
    some = spark.createDataFrame([(1, 0), (3, 1), (3, None), (None, 1)], "doc_id long, quality int")
    assert quality.score_quality(docs, quality.train_field(docs, some)).count() == 5


def test_training_sample_is_bounded_in_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_field", lambda lines, labels: seen.append((lines.counts.sum(), len(labels))))
    docs = spark.createDataFrame([(i, "good line\n" * (i % 7)) for i in range(400)] + [(1, "again"), (500, "a\n" * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(501)], "doc_id long, quality int")
    quality.train_field(docs, labels, max_lines=1000)
    quality.train_field(docs, labels, max_lines=400)
    quality.train_field(docs, labels)
    (first, _), (second, _), (whole, n) = seen
    assert 900 < first <= 1000 and 350 < second <= 400 and whole > 5000
    ids = [i for i in [*range(400), 1, 500] if zlib.crc32(str(i).encode()) % 5]
    assert n == len(ids)


def test_many_lines_and_an_empty_table(spark):
    field = quality.Field(np.zeros(quality.N_FEATURES), np.ones(quality.N_FEATURES), np.zeros(quality.N_FEATURES + 1), np.zeros((2, 2)))
    docs = spark.createDataFrame([(1, "a line\n" * 50_000), (1, "a line\n" * 50_000)], "doc_id long, text string")
    assert [r["score"] for r in quality.score_quality(docs, field).collect()] == [0.5, 0.5]
    assert quality.score_quality(docs.where("doc_id > 1"), field).collect() == []
