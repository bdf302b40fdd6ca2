import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from voxloom.llm import packing


def test_word_tokens_equal_whole_text_encoding():
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    texts = ["", " ", "The THE the, the. don't we'll É é é Σ ΑΣ İx a.b,c", "x y z\x1fq \x0b w", "12 3a4 ... !!! a|b '' 's", "naïve\ncafé\r\n\tÅ ﬁ", "<|endoftext|> hello", "中文 字 ab" * 50]
    words = packing.WordTokens(packing.tokenizer_file())
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.EOS], text


def test_cache_may_be_emptied(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    monkeypatch.setattr(packing, "CHUNK_BYTES", 8)
    words = packing.WordTokens(packing.tokenizer_file())
    texts = ["a b c d e", "f g", "a z y x w v"]
    again = packing.WordTokens(packing.tokenizer_file())
    assert [x.tolist() for x in words.encode(texts)] == [x.tolist() for t in texts for x in again.encode([t])]


def check(rows, texts):
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    short = 0
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        short += at < packing.WINDOW
    return short


def test_op5_round_trip(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    short = check(packing.op5_packing(spark, sf_dir).collect(), texts)
    assert short <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b")], "doc_id long, text string")
    rows = packing.pack(docs, packing.tokenizer_file()).collect()
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in rows) == [(1, 1), (2, 1), (3, 3), (3, 3)]
    assert packing.pack(docs.limit(0), packing.tokenizer_file()).count() == 0


def found(docs, used=(0,)):
    shard, mask = packing.Shard(docs), np.zeros(len(docs), bool)
    mask[list(used)] = True
    return shard.neighbours(shard.terms_of(0), mask)


def test_neighbours_rank_by_shared_rare_terms():
    docs = [np.array(x, "<u4") for x in ([5, 6, 7, 9], [5, 8, 8], [6, 7, 9, 1], [1, 2, 3])]
    assert next(found(docs)) == 2
    assert list(packing.fill_order(docs, 0, 100))[:2] == [0, 2]


def test_scores_are_those_of_the_whole_table(spark):
    texts = ["a b c", "a a d", "a", "e f a", "b c d e f", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    tokens = packing.tokenized(docs, packing.tokenizer_file())
    corpus = packing.statistics(tokens).corpus
    words = packing.WordTokens(packing.tokenizer_file())
    want = [np.array(x) for x in words.encode(texts)]
    df = np.bincount(np.concatenate([np.unique(x) for x in want]))
    assert np.allclose(corpus.idf, np.log1p((6 - df + 0.5) / (df + 0.5))) and corpus.mean_length == sum(map(len, want)) / 6
    part = [want[i].astype("<u4") for i in (1, 4)]
    assert np.allclose(packing.Shard(part, corpus).score(np.unique(part[0])), packing.Shard([x.astype("<u4") for x in want], corpus).score(np.unique(part[0]))[[1, 4]])


def test_all_terms_of_the_seed_count():
    seed = np.repeat(np.arange(2, 42), 2)
    for term in range(2, 42):
        docs = [x.astype("<u4") for x in (seed, np.array([term, 99]), np.array([98, 99]))]
        assert list(found(docs)) == [1]


def test_scores_are_the_same_however_many_terms_have_rows(monkeypatch):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 60, rng.integers(1, 40)).astype("<u4") for _ in range(50)]
    whole = [packing.Shard(docs).score(np.unique(d)) for d in docs]
    monkeypatch.setattr(packing, "DENSE_SHARE", 1)
    assert np.allclose(whole, [packing.Shard(docs).score(np.unique(d)) for d in docs], rtol=1e-5)


def test_neighbours_are_in_order_with_ties_by_position():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 8, rng.integers(1, 6)).astype("<u4") for _ in range(300)]
    shard, used = packing.Shard(docs), rng.random(300) < 0.3
    score = shard.score(np.unique(docs[0]))
    want = sorted((i for i in range(1, 300) if score[i] > 0 and not used[i]), key=lambda i: (-score[i], i))
    used[0] = True
    assert list(found(docs, np.flatnonzero(used))) == want
    left = shard.only(~used)
    again = np.flatnonzero(~used)[list(left.neighbours(shard.terms_of(0), np.zeros(left.n, bool)))]
    assert again.tolist() == want


def test_very_long_and_repeated_texts(spark):
    long = " ".join(f"word{i % 977}," for i in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long), (None, "x" * 100_000), (4, "a b")], "doc_id long, text string")
    rows = packing.pack(docs, packing.tokenizer_file()).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset").collect()
    for doc in {r["doc_id"] for r in rows}:
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        assert own[0]["start"] == 0 and all(a["start"] + a["length"] == b["start"] for a, b in zip(own, own[1:], strict=False))
        assert own[-1]["start"] + own[-1]["length"] == own[0]["doc_tokens"]


def test_alike_documents_share_a_task_wherever_they_stand(spark):
    rng = np.random.default_rng(0)
    words = [chr(97 + i) + chr(97 + j) for i in range(20) for j in range(20)]
    texts = [" ".join(rng.choice(words[40 * (i % 10) : 40 * (i % 10) + 40], 60)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        rows = packing.pack(docs, packing.tokenizer_file()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    topics = defaultdict(set)
    for r in rows:
        topics[r["sequence_id"] >> 32].add(r["doc_id"] % 10)
    assert len(topics) > 5 and np.mean([len(x) for x in topics.values()]) < 4


def test_an_id_column_named_like_an_output_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a")], "ids long, text string")
    with pytest.raises(ValueError, match="ids"):
        packing.pack(docs, packing.tokenizer_file(), id_col="ids")


def test_terms_of_many_documents_are_counted_by_one_sort(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [(rng.zipf(1.3, rng.integers(1, 200)) % 300).astype(kind) for kind in ("<u2", "<u4") for _ in range(150)]
    ids, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    want = [np.unique(d, return_counts=True) for d in docs]
    plain = packing.Shard(docs[::5])
    score = np.array([plain.score(t) for t, _ in want])
    df = np.bincount(np.concatenate([t for t, _ in want]), minlength=1 << 16)
    monkeypatch.setattr(np, "unique", None)  # not once for each document
    for shift in (0, 1 << 31):  # keys of 32 and of 64 bits
        doc, terms, n = packing.counted(ids.astype("<u4") + np.uint32(shift), sizes)
        assert doc.tolist() == np.repeat(np.arange(len(docs)), [len(t) for t, _ in want]).tolist()
        assert (terms - shift).tolist() == np.concatenate([t for t, _ in want]).tolist()
        assert n.tolist() == np.concatenate([c for _, c in want]).tolist()
    assert [len(x) for x in packing.counted(ids[:0], sizes[:0])] == [0, 0, 0]
    summary = packing.Summary()
    summary.add(ids, sizes, np.arange(len(docs)))
    assert summary.df.tolist() == df.tolist()
    best = np.concatenate([packing.Shard(docs[::5]).rankings(np.concatenate(docs[at]), sizes[at]) for at in packing._few_tokens(sizes.tolist())])
    assert best.shape == (len(docs), packing.RANKED)
    assert np.allclose(np.take_along_axis(score, best.astype(int), 1), -np.sort(-score, 1)[:, : packing.RANKED], rtol=1e-5)
