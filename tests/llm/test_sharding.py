from bisect import bisect_right

from pyspark.sql import functions as F

from voxloom.llm import sharding


def optimum(weights, n):
    def need(capacity):
        shards, now = 1, 0
        for w in weights:
            if w > capacity:
                return n + 1
            shards, now = (shards + 1, w) if now + w > capacity else (shards, now + w)
        return shards

    low, high = 1, sum(weights)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if need(middle) <= n else (middle + 1, high)
    return low


def check(docs, n):
    rows = sharding.minimax_shards(docs, n).withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    groups, shards = {}, {}
    for r in rows:
        groups.setdefault(r["h"], []).append(r)
        shards.setdefault(r["shard"], []).append(r)
    weights = [sum(r["size"] for r in groups[h]) for h in sorted(groups)]
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in rows)
    assert all(len({r["shard"] for r in g}) == 1 for g in groups.values())
    order = [groups[h][0]["shard"] for h in sorted(groups)]
    assert order == sorted(order) and all(0 <= s < n for s in order)
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    if rows:
        assert max(sum(r["size"] for r in s) for s in shards.values()) == optimum(weights, n)
    return len(rows)


def test_op7_is_optimal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.col("lang").alias("h"))
    assert check(docs.drop("h"), 16) == docs.count()
    assert sharding.op7_sharding(spark, sf_dir).count() == docs.count()
    assert "h" in sharding.minimax_shards(docs).columns


def test_hot_groups_nulls_and_few_groups(spark):
    rows = [(i, "hot" * 50) for i in range(40)] + [(i, f"t{i}" * (i % 7)) for i in range(60)] + [(None, None), (None, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(docs, 5) == 103
    assert check(docs.limit(0), 5) == 0
    assert check(docs.where("text = 'x'"), 5) == 0
    assert check(spark.createDataFrame([(1, "a"), (1, "a")], "doc_id long, text string"), 16) == 2


def test_cells_are_split_until_exact():
    assert bisect_right([0, 1, 2], 1) == 2
    cells = [sharding.Cell(i, 64, w, True) for i, w in enumerate([5, 1, 1, 1, 5, 3])]
    sums = [0, 5, 6, 7, 8, 13, 16]
    assert sharding._smallest(cells, sums, 3, False) == 7 == sharding._smallest(cells, sums, 3, True)
