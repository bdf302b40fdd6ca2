"""Connected components on Spark: every task joins the edges that it has, alternating large and small stars join the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Edges that one task takes; a round over few edges makes few tasks and few shuffle files.
EDGES_PER_TASK = 100_000


def _few(df: DataFrame, n_edges: int) -> DataFrame:
    return df.coalesce(max(1, -(-n_edges // EDGES_PER_TASK)))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some edges as one edge from each node to the smallest one that it reaches over them; that one has no edge of its own."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            child = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[child], nodes[root[child]]
        np.minimum.at(root, high[apart], low[apart])
        while (root != root[root]).any():
            root = root[root]


def _joined(edges: DataFrame) -> DataFrame:
    """Edges with the same components: those of a task, up to ``EDGES_PER_TASK`` at once, as stars."""
    most = EDGES_PER_TASK

    @common.releasing
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(table["child"].to_numpy(), table["parent"].to_numpy())], ["child", "parent"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if held and sum(h.num_rows for h in held) + part.num_rows > most:
                    yield out()
                    held.clear()
                held.append(part)
        if held:
            yield out()

    return edges.select(F.col("child").cast("long"), F.col("parent").cast("long")).mapInArrow(work, "child long, parent long")


def _shape(edges: DataFrame, at_most: int) -> tuple[int, int]:
    """How many edges there are, and how many nodes keep them from being stars around roots."""
    ends = edges.select(F.col("child").alias("node"), F.lit(1).alias("as_child"), F.lit(0).alias("as_parent")).unionByName(edges.select(F.col("parent").alias("node"), F.lit(0).alias("as_child"), F.lit(1).alias("as_parent")))
    roles = _few(ends.groupBy("node").agg(F.sum("as_child").alias("c"), F.max("as_parent").alias("p")), at_most)
    row = roles.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if((F.col("c") > 1) | ((F.col("c") > 0) & (F.col("p") > 0))).alias("bad")).first()
    return row["n"], row["bad"]


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of integers -> (node, root): the smallest node that each node reaches, for nodes with an edge.

    Loops and repeated edges are allowed; no edges give no rows.  Tasks first join
    the edges that they have, then those that are left in as few tasks as hold
    them; where that is more than one, rounds of stars follow.  Every round is
    checkpointed; the number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
    edges = common.checkpoint(_joined(edges))
    n = edges.count()
    edges = common.checkpoint(_joined(_few(edges, n)))
    n, bad = _shape(edges, n)
    while bad:
        both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(edges.select(F.col("parent").alias("u"), F.col("child").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        joined = common.join_groups(both, least.select("u", F.least("u", "m").alias("m"), "n"), "u", "n", 2 * n)
        large = _few(joined.where("v > u").select(F.col("v").alias("child"), F.col("m").alias("parent")), n)
        least = large.groupBy("child").agg(F.min("parent").alias("m"), F.count("*").alias("n"))
        joined = common.join_groups(large, least, "child", "n", n)
        small = joined.select(F.when(F.col("parent") == F.col("m"), F.col("child")).otherwise(F.col("parent")).alias("child"), F.col("m").alias("parent"))
        edges = common.checkpoint(_few(_few(small.where("child <> parent"), n).distinct(), n))
        n, bad = _shape(edges, n)
    roots = edges.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    found = roots.unionByName(edges.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct())
    # The rounds end in few tasks; what is joined to the result is spread over as many as ever.
    return found.repartition(common.shuffle_partitions(edges.sparkSession), "node")
