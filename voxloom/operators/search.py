"""Every target against every voice, in blocks: nearest voices and distances of pairs.

Voices are cut into blocks of bounded size and targets into slices.  A task takes
the voices of a block as one matrix and streams the targets of a slice past it, a
matrix product for each batch, so neither side has to fit anywhere as a whole.
Voices travel once for each slice, targets once for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a block's matrix, and targets of a slice.
BLOCK_BYTES = 16 << 20
SLICE_ROWS = 1_000_000
#: Products are off by rounding; what lies this near to the best is compared again term by term.
NEAR = 1e-9

Compare = Callable[[pa.Array, np.ndarray, pa.Array, np.ndarray], Iterator[pa.RecordBatch]]


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _streamed(compare: Compare):
    """Rows by (block, slice), voices first -> what ``compare(names, voices, ids, targets)`` gives for each run of targets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, voices = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("block", "slice", "kind")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)] if len(keys) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if place != tuple(keys[a, :2]):
                    place, parts, voices = tuple(keys[a, :2]), [], None
                run = batch.slice(a, b - a)
                if keys[a, 2] == 0:
                    parts.append((run.column("name"), _matrix(run.column("vec"))))
                elif parts:
                    if voices is None:
                        voices = pa.concat_arrays([n for n, _ in parts]), np.concatenate([m for _, m in parts])
                    yield from compare(*voices, run.column("id"), _matrix(run.column("vec")))

    return run


def blockwise(targets: DataFrame, voices: DataFrame, compare: Compare, schema: str, dims: int) -> DataFrame:
    """``targets(id, vec)`` and ``voices(name, vec)``, all of ``dims`` doubles, past each other."""
    spark = targets.sparkSession
    voices = voices.distinct()
    n_blocks = max(1, -(-voices.count() * dims * 8 // BLOCK_BYTES))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_slices = max(1, -(-targets.count() // SLICE_ROWS), -(-wanted // n_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    id_type, name_type = targets.schema["id"].dataType, voices.schema["name"].dataType
    fixed = voices.select(dealt(n_blocks, "name", "vec").alias("block"), every(n_slices).alias("slice"), F.lit(0).alias("kind"), "name", F.lit(None).cast(id_type).alias("id"), "vec")
    moving = targets.select(every(n_blocks).alias("block"), dealt(n_slices, "id", "vec").alias("slice"), F.lit(1).alias("kind"), F.lit(None).cast(name_type).alias("name"), "id", "vec")
    rows = fixed.unionByName(moving).repartition(min(n_blocks * n_slices, 4 * wanted + n_blocks), "block", "slice").sortWithinPartitions("block", "slice", "kind")
    return rows.mapInArrow(_streamed(compare), schema)


def _dims(voices: DataFrame) -> int:
    lengths = voices.agg(F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first()
    if lengths["a"] != lengths["b"]:
        raise ValueError(f"voices of {lengths['a']} to {lengths['b']} values can't be compared")
    return lengths["a"] or 0


def _given(df: DataFrame, key: str, name: str, vec: str) -> DataFrame:
    return df.select(F.col(key).alias(name), F.col(vec).cast("array<double>").alias("vec")).where(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))


def _best(names: pa.Array, voices: np.ndarray, ids: pa.Array, targets: np.ndarray) -> Iterator[pa.RecordBatch]:
    voice_norm = np.sqrt((voices * voices).sum(1))
    order = names.to_pylist()
    for at in range(0, len(targets), max(1, (4 << 20) // len(voices))):  # products of 32 MB at most
        some = targets[at : at + max(1, (4 << 20) // len(voices))]
        norm = np.sqrt((some * some).sum(1))
        dot = some @ voices.T
        with np.errstate(divide="ignore", invalid="ignore"):
            score = (norm[:, None] ** 2 + voice_norm**2 - 2 * dot) / voices.shape[1] - dot / (norm[:, None] * voice_norm)
        score[~np.isfinite(score)] = np.inf  # no direction, no candidate
        least = score.min(1, keepdims=True)
        row, col = np.nonzero((score <= least + NEAR * (1 + np.abs(least) + norm[:, None] ** 2)) & np.isfinite(score))
        exact = ((some[row] - voices[col]) ** 2).mean(1) - (some[row] * voices[col]).sum(1) / (norm[row] * voice_norm[col])
        best: dict[int, tuple] = {}
        for r, c, s in zip(row.tolist(), col.tolist(), exact.tolist(), strict=True):
            if r not in best or (s, order[c]) < best[r]:
                best[r] = (s, order[c])
        if best:
            yield pa.RecordBatch.from_arrays([ids.take(pa.array([at + r for r in best])), pa.array([b for _, b in best.values()], names.type), pa.array([s for s, _ in best.values()])], names=["id", "best", "best_score"])


def nearest(targets: DataFrame, voices: DataFrame, target_id: str, target_vec: str, name: str, vec: str) -> DataFrame:
    """(target_id, best, best_score): the voice with the least mse - cosine, the first name on ties, for each distinct id and vector.

    Vectors that are null, hold nulls or have another length than the voices, and
    those without a direction, have a null best.  Without voices all have.
    """
    kind, id_kind = dict(voices.dtypes)[name], dict(targets.dtypes)[target_id]
    known = _given(voices, name, "name", vec)
    key = F.struct(F.col(target_id).alias("id"), F.xxhash64(F.col(target_vec).cast("array<double>")).alias("h")).alias("id")
    every = targets.select(key, F.col(target_vec).alias("vec"))
    rows = every.select("id", F.lit(None).cast(kind).alias("best"), F.lit(None).cast("double").alias("best_score"))
    dims = _dims(known)
    if dims:
        fit = _given(every, "id", "id", "vec").where(F.size("vec") == dims).distinct()
        rows = rows.unionByName(blockwise(fit, known, _best, f"id struct<id:{id_kind},h:bigint>, best {kind}, best_score double", dims))
    least = F.min(F.when(F.col("best_score").isNotNull(), F.struct("best_score", "best"))).alias("b")
    return rows.groupBy("id").agg(least).select(F.col("id.id").alias(target_id), "b.best", "b.best_score")


def pairwise_distances(voices: DataFrame, name: str, vec: str) -> DataFrame:
    """(a, b, distance) for a < b: all pairs of voices with different names."""

    def distances(names: pa.Array, block: np.ndarray, ids: pa.Array, others: np.ndarray) -> Iterator[pa.RecordBatch]:
        left = np.array(names.to_pylist(), object)
        for i, (b, v) in enumerate(zip(ids.to_pylist(), others, strict=True)):
            at = np.flatnonzero(left < b)
            if len(at):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), pa.array([b] * len(at), ids.type), pa.array(np.sqrt(((block[at] - v) ** 2).sum(1)))], names=["a", "b", "distance"])

    kind = dict(voices.dtypes)[name]
    known = _given(voices, name, "name", vec).where("name IS NOT NULL").distinct()
    dims = _dims(known)
    if not dims:
        return known.select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(0.0).alias("distance")).where("false")
    return blockwise(known.select(F.col("name").alias("id"), "vec"), known, distances, f"a {kind}, b {kind}, distance double", dims)
