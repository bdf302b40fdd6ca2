"""Minimax contiguous sharding (DataFrame functions only).

Rows with equal text are one atomic group.  Groups stand in the order of the
64-bit hash of their text, and shards are contiguous runs of that order, so a
row's shard follows from comparing its hash with ``n_shards - 1`` cut values and
no join is needed.  The smallest feasible capacity is found by binary search
with a greedy check.  The search never sees single groups by the million: it
works on cells (hash prefixes) whose sums Spark makes, at most 4096 at first,
and splits only cells in which a cut may fall, until the bound from cells as
atoms meets the bound from cells as divisible stuff.  The capacity is then the
exact optimum over groups.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

FIRST_BITS = 12
MORE_BITS = 8
#: Numbering cells in each shard; the table of their counts has n_shards times as many rows.
SLOT_CELLS = 512


class Cell(NamedTuple):
    low: int  # smallest hash that can be in it
    bits: int  # length of the prefix
    weight: int
    single: bool  # one group only


def _cells(thin: DataFrame, bits: int, inside: list[Cell] = ()) -> list[Cell]:
    if inside:
        prefix = F.shiftright("h", 64 - inside[0].bits)
        thin = thin.where(prefix.isin([c.low >> (64 - c.bits) for c in inside]))
    rows = thin.groupBy(F.shiftright("h", 64 - bits).alias("prefix")).agg(F.sum("size").alias("weight"), (F.min("h") == F.max("h")).alias("single")).collect()  # at most 2**bits, or 2**MORE_BITS a split cell
    return sorted(Cell(r["prefix"] << (64 - bits), bits, r["weight"], r["single"]) for r in rows)


def _cuts(cells: list[Cell], sums: list[int], capacity: int, divisible: bool, start: int = 0) -> list[tuple[int, int]]:
    """Greedy filling: (index of the cell where each next shard starts, weight of that cell that is already used up)."""
    cuts, at, used = [], start, 0
    while True:
        room = sums[at] + used + capacity
        end = bisect_right(sums, room) - 1  # cells before end fit whole
        if end >= len(cells):
            return cuts
        split = room - sums[end] if divisible and not cells[end].single else 0
        if (end, split) == (at, used):
            raise ValueError("capacity below the largest group")
        at, used = end, split
        cuts.append((at, used))


def _smallest(cells: list[Cell], sums: list[int], n_shards: int, divisible: bool) -> int:
    total = sums[-1]
    low = max(-(-total // n_shards), max((c.weight for c in cells if c.single or not divisible), default=0), 1)
    high = max(total, low)
    while low < high:
        middle = (low + high) // 2
        if len(_cuts(cells, sums, middle, divisible)) < n_shards:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(thin: DataFrame, n_shards: int) -> tuple[int, list[int]]:
    """``thin(h, size)`` -> the smallest capacity, and the hash at which each later shard starts (fewer than n_shards - 1 if shards stay empty)."""
    cells = _cells(thin, FIRST_BITS)
    if not cells:
        return 0, []
    while True:
        sums = [0, *accumulate(c.weight for c in cells)]
        most, least = (_smallest(cells, sums, n_shards, divisible) for divisible in (False, True))
        if most == least:
            break
        touched = {at for capacity, divisible in ((most, False), (least, True)) for at, _ in _cuts(cells, sums, capacity, divisible)}
        widest = max(range(len(cells)), key=lambda i: (not cells[i].single, cells[i].weight))
        split = [cells[i] for i in sorted({*touched, widest}) if not cells[i].single]
        kept = [c for c in cells if c not in set(split)]
        for bits in sorted({c.bits for c in split}):
            kept += _cells(thin, min(64, bits + MORE_BITS), [c for c in split if c.bits == bits])
        cells = sorted(kept)

    # Within that capacity, even shards: each takes the least from its fair share on that leaves a feasible rest.
    cuts, at = [], 0
    for left in range(n_shards - 1, 0, -1):
        full = bisect_right(sums, sums[at] + most) - 1
        fair = bisect_right(sums, sums[at] + (sums[-1] - sums[at]) // (left + 1)) - 1
        low, high = min(max(fair, at), full), full
        while low < high:
            middle = (low + high) // 2
            if _fits(cells, sums, most, middle, left):
                high = middle
            else:
                low = middle + 1
        at = low
        if at >= len(cells):
            break
        cuts.append(cells[at].low)
    return most, cuts


def _fits(cells: list[Cell], sums: list[int], capacity: int, start: int, shards: int) -> bool:
    return start >= len(cells) or len(_cuts(cells, sums, capacity, False, start)) < shards


def shard_of(h: Column, cuts: list[int]) -> Column:
    out = F.lit(0)
    for cut in cuts:
        out = out + (h >= F.lit(cut)).cast("int")
    return out


def minimax_shards(docs: DataFrame, n_shards: int = 16, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Add size, shard and slot: contiguous shards by hash order whose largest byte size is the least possible.

    Size is the UTF-8 bytes of the text plus 1 (null: 1).  Rows of equal text
    share a shard; texts whose 64-bit hashes collide count as one group.  Slots
    number a shard's rows from 0 without gaps, in an order that follows from the
    rows (rows that are alike in id and text may change places).  Shards stay
    empty where there are fewer groups than shards.  Null ids are numbered like
    others; an empty table gives no rows.  Columns named like the added ones
    are an error.
    """
    common.require_absent(docs, "size", "shard", "slot")
    h, cell, before = (common.fresh_name(docs, x) for x in ("h", "cell", "before"))
    content = common.text_or_empty(text)
    sized = docs.withColumn("size", F.octet_length(content).cast("long") + 1).withColumn(h, F.xxhash64(content))
    thin = common.checkpoint(sized.select(F.xxhash64(F.col(id_col)).alias("id_hash"), F.col(h).alias("h"), "size"))
    _, cuts = minimax_cuts(thin, n_shards)

    in_cell = lambda id_hash: F.pmod(id_hash, F.lit(SLOT_CELLS))
    counts = thin.groupBy(shard_of(F.col("h"), cuts).alias("shard"), in_cell(F.col("id_hash")).alias(cell)).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", cell, F.coalesce(earlier, F.lit(0)).alias(before))
    placed = sized.withColumn("shard", shard_of(F.col(h), cuts)).withColumn(cell, in_cell(F.xxhash64(F.col(id_col))))
    placed = placed.join(F.broadcast(offsets), ["shard", cell])  # n_shards * SLOT_CELLS rows
    number = F.row_number().over(Window.partitionBy("shard", cell).orderBy(id_col, h))
    return placed.select(*docs.columns, "size", "shard", (F.col(before) + number - 1).alias("slot"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(common.text_or_empty().cast("binary")).alias("text_crc32"))
    return minimax_shards(docs, n_shards=16).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
