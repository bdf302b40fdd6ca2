"""Operators that SQL can express, on a table of edge cases: the driver's SQL is the brute-force version."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import common, decontamination, exact_dedup, near_dedup, repeats, substring_dedup, suffix_dedup

P = " ".join(f"w{i}" for i in range(60))
Q = " ".join(f"q{i} é" for i in range(40))
TEXTS = [
    None, "", " \n\t ", "one", "One two", "one two", "ONE TWO THREE", "one two three", "x" * 200_000,
    P, P, "lead " + P + " tail", P.replace("w30", "other"), P + "\n" + P, P[:-4], "a " + Q, Q + " b", Q + " b", "\x1f".join("abcdefghij" * 8),
    " ".join(["same"] * 500), " ".join(["same"] * 520), "That one, two three four five six seven eight nine ten eleven", "é" * 10, "MIT License", P.upper(),
]
BENCH = [(1, "One two three four five six seven eight nine ten."), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (3, "one two"), (4, None), (5, "..."), (2, "q1 é"), (30, "mit license")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize(
    ("query", "sql"),
    [
        (decontamination.op1_decontamination, decontamination.OP1_SQL),
        (substring_dedup.op4_substring_dedup, substring_dedup.REPEATS_SQL),
        (near_dedup.op6_near_dedup, near_dedup.OP6_SQL),
        (suffix_dedup.op8_suffix_dedup, substring_dedup.REPEATS_SQL),
        (exact_dedup.op9_exact_dedup, exact_dedup.OP9_SQL),
    ],
)
def test_against_sql(spark, folder, query, sql):
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
        result = db.execute(sql)
        names = [x[0] for x in result.description]
        want = sorted(result.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in query(spark, folder).collect())
    assert got == want


@pytest.mark.parametrize("operator", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, exact_dedup.exact_dedup])
def test_other_columns_nulls_and_empty_tables(spark, operator):
    rows = [(None, P, 1), (None, P, 2), (3, P, 3), (4, None, 4), (4, "", None), (5, "lead " + P, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    assert sorted(x["key"] or 0 for x in operator(docs).collect()) == [0, 1, 2, 3, 4, 5]
    assert operator(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        operator(docs.withColumnRenamed("key", operator(docs).columns[-1]))


def test_repeats_with_shared_and_null_ids(spark):
    docs = spark.createDataFrame([(None, P), (7, P), (7, P + " end")], "doc_id long, text string")
    for operator in (substring_dedup.substring_dedup, suffix_dedup.suffix_dedup):
        got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in operator(docs).collect())
        assert got == [(7, 0), (7, 0), (99, 60)]


def test_repeats_in_two_steps_equal_those_in_one(spark, sf_dir, monkeypatch):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    for operator in (substring_dedup.substring_dedup, suffix_dedup.suffix_dedup):
        want = sorted(map(str, operator(docs).drop("text").collect()))
        with monkeypatch.context() as m:
            m.setattr(repeats, "FAN", 8)
            m.setattr(repeats, "REPACK", 5_000)
            assert sorted(map(str, operator(docs).drop("text").collect())) == want


def test_two_steps_use_all_tasks(spark, sf_dir, monkeypatch):
    docs = common.table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents").select("doc_id", "text").repartition(40)
    sizes = []
    dealt = repeats._by_range

    def seen(messages, n_buckets):
        out = dealt(messages, n_buckets)
        held = out.groupBy(F.spark_partition_id()).agg(F.sum(F.length("prints")).alias("n")).collect()
        sizes.append([r["n"] for r in held] + [0] * (out.rdd.getNumPartitions() - len(held)))
        return out

    monkeypatch.setattr(repeats, "FAN", 40)
    monkeypatch.setattr(repeats, "_by_range", seen)
    assert substring_dedup.substring_dedup(docs).count() == docs.count()
    assert len(sizes) == 2 and all(len(s) == 16 and max(s) < 2 * sum(s) / len(s) for s in sizes)
    assert [repeats.range_size(n) for n in (40, 41, 64, 10_000)] == [1, 7, 8, 100]


def test_windows_whose_first_hash_collides_stay(spark, monkeypatch):
    plain = repeats.word_hashes
    monkeypatch.setattr(repeats, "word_hashes", lambda words, second=False: plain(words, True) if second else plain(words) & np.uint64(3))
    texts = [" ".join(f"{c}{i % 7}" for i in range(70)) for c in "abcdefgh"]
    chunk, _ = repeats.chunk_of([t.encode() for t in texts], twice=True)
    prints, valid = chunk.long_prints(50)
    rows = list(repeats.offer(np.repeat(np.arange(8), chunk.counts)[valid], prints[valid], np.zeros(valid.sum(), bool), 1, 1, True))
    assert not [r for r in repeats.meet([r[1:] for r in rows], True)]


def test_removed_runs_are_maximal(spark):
    docs = spark.createDataFrame([(1, P), (2, "x " + P + " y " + P)], "doc_id long, text string")
    for operator in (substring_dedup.substring_dedup, suffix_dedup.suffix_dedup):
        rows = {r["doc_id"]: [tuple(x) for x in r["removed_words"]] for r in operator(docs).collect()}
        assert rows == {1: [], 2: [(1, 61), (62, 122)]}


def test_decontamination_blocks_and_offsets(spark):
    docs = spark.createDataFrame([(1, "É: One, two  THREE four five six seven eight nine TEN! w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    whole = decontamination.decontaminate(docs, items).collect()
    parts = decontamination.decontaminate(docs, items, max_patterns=2).collect()
    assert sorted(whole) == sorted(parts)
    row = next(r for r in whole if r["doc_id"] == 1)
    assert row["n_hit"] == 21 and row["items"] == ["1", "2", "3"]
    assert [row["text"][s["start"] : s["end"]] for s in row["hit_chars"]] == [row["text"][3:]]
    empty = decontamination.decontaminate(docs, items.limit(0)).collect()
    assert all(r["n_hit"] == 0 for r in empty)
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs.withColumnRenamed("doc_id", "items"), items)


def test_a_benchmark_beyond_its_bound_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_BENCHMARK_BYTES", 10)
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    with pytest.raises(ValueError):
        decontamination.decontaminate(items, items)


def test_bloom_filter_of_any_size_gives_the_same_groups(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    want = sorted(exact_dedup.exact_dedup(docs).drop("text").collect())
    assert sorted(exact_dedup.exact_dedup(docs, bits_per_hash=1).drop("text").collect()) == want


def test_a_filter_larger_than_a_broadcast_still_lets_single_rows_pass(spark):
    n = 60_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") < 40_000, F.floor(F.col("id") / 2)).otherwise(F.col("id"))).alias("text"))
    parts = exact_dedup.tested(docs, F.col("text"), "maybe", 16, 512)
    assert len(parts) == -(-20_000 * 16 // 64 // 512)
    sizes = [p.agg(F.count("*"), F.count_if("maybe"), F.count_if(F.expr("maybe AND doc_id >= 40000")), F.count_if(F.expr("NOT maybe AND doc_id < 40000"))).first() for p in parts]
    rows, maybe, wrong, missed = map(sum, zip(*sizes, strict=True))
    assert rows == n and missed == 0 and wrong < 0.02 * 20_000 and maybe == 40_000 + wrong
    got = exact_dedup.exact_dedup(docs, max_filter_words=512).agg(F.count("*"), F.count_if("kept"), F.max("group_size")).first()
    assert tuple(got) == (n, 40_000, 2)


def test_confirmed_links_equal_all_pairs():
    import random

    rng = random.Random(3)
    for _ in range(30):
        base = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(5, 40))]
        texts = []
        for _ in range(rng.randrange(2, 14)):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(9)}"
            texts.append(" ".join(words).encode())
        sets = [set(zip(w, w[1:], w[2:], strict=False)) for w in (t.split() for t in texts)]
        texts, sets = zip(*[(t, s) for i, (t, s) in enumerate(zip(texts, sets, strict=True)) if s not in sets[:i]], strict=True)

        def roots(links):
            at = list(range(len(sets)))
            for a, b in links:
                at = [at[a] if x == at[b] else x for x in at]
            return [at.index(x) for x in at]

        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
        assert roots(near_dedup.confirmed_links(list(texts), 3, 85)) == roots(pairs)


def test_near_groups_in_blocks(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1 :]])) for i in range(50)] + [(99, " ".join(words)), (None, " ".join(words)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(docs).where("doc_id IS NOT NULL").collect())
    assert want == [(i, 0) for i in range(50)] + [(99, 0)]
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 10)
    assert sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(docs).where("doc_id IS NOT NULL").collect()) == want
    left = near_dedup.near_dedup(docs).collect()
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in left) == [-1, -1, 0]
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_clusters_that_fall_apart_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, words = [], [f"w{i}" for i in range(300)]
    for step in range(150):  # a chain that breaks where over eight words change, though such texts still share bands
        for at in rng.integers(0, len(words), rng.integers(3, 12)):
            words[at] = f"s{step}a{at}"
        rows.append((step, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{" ".join(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for _, t in rows)]
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    want = {i: find(i) for i, _ in rows}
    met = []
    whole = near_dedup._against_all
    monkeypatch.setattr(near_dedup, "_against_all", lambda *a: met.append(1) or whole(*a))
    for block, pivots in ((2000, 16), (12, 2)):
        monkeypatch.setattr(near_dedup, "BLOCK_DOCS", block)
        monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs, 3, 85).collect()} == want
    assert met and 1 < len(set(want.values())) < len(rows)


def test_every_text_of_a_repeated_id_has_its_links(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = [" ".join(f"{c}{i}" for i in range(120)) for c in "abcdef"]
    rows = [(1, base[0] + " x"), (2, base[0] + " y"), (2, None), (3, base[1] + " x"), (4, base[1] + " y"), (4, "aa other"), (4, ""), (5, None), (5, None), (6, " ")]
    for doc in rng.integers(10, 40, 60).tolist():
        t = base[rng.integers(2, 6)].split()
        t[rng.integers(0, 120)] = f"z{rng.integers(0, 50)}"
        rows.append((doc, [None, "", " ".join(t), " ".join(t), " ".join(t)][rng.integers(0, 5)]))
    rows += rows[:4]
    sets = [(d, {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())) for d, t in rows for w in [(t or "").split()]]
    root = {d: d for d, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and 100 * len(x & y) >= 85 * len(x | y):
                small, large = sorted((find(a), find(b)))
                root[large] = small
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((d, len(s), find(d), d == find(d)) for d, s in sets)
    for block in (2000, 4):
        monkeypatch.setattr(near_dedup, "BLOCK_DOCS", block)
        assert sorted(map(tuple, near_dedup.near_groups(docs, 3, 85).collect())) == want
    assert len({w[2] for w in want}) < len({w[0] for w in want}) - 5
    with pytest.raises(ValueError):
        near_dedup.near_groups(docs.withColumnRenamed("doc_id", "kept"), id_col="kept")
