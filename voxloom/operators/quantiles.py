"""Exact quantiles of large columns with bounded state.

A rank is found by counting values in bins that keep their order and going on
only in the bin that holds it.  The first bins are a value's sign and the first
digits of its binary logarithm, the later ones equal parts of the bin before, so
a few counts of at most ``BINS`` rows each end at one value or at a bin small
enough to sort.  No task holds more than the bins or one such small bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a bin, and values of one that are sorted at once.
BINS = 1 << 14
SORTED = 1 << 16
#: First bins of a power of two; doubles have exponents from -1074 to 1023.
OF_OCTAVE, EXPONENTS = 8, 1075


@dataclass(frozen=True)
class _Place:
    """Where a rank (from 0) lies: among ``n`` values from ``low`` to ``high`` with ``before`` smaller ones ahead of them."""

    column: str
    rank: int
    before: int
    n: int
    low: float
    high: float

    def open(self, sorted_at_once: int) -> bool:
        return self.low != self.high and not math.isnan(self.high) and self.n > sorted_at_once


def _first_bin(x: Column) -> Column:
    """Rises with the value: 0 for zeros, infinities and NaN behind all others."""
    size = F.floor((F.log2(F.abs(x)) + EXPONENTS) * OF_OCTAVE).cast("int") + 1
    last = (EXPONENTS + 1025) * OF_OCTAVE
    at = F.when(x == 0, 0).when(F.abs(x) == float("inf"), last).otherwise(size)
    return F.when(F.isnan(x), last + 1).when(x < 0, -at).otherwise(at)


def _part(x: Column, low: float, high: float) -> Column:
    """Equal part of [low, high]; halves first, as the difference of large values may overflow."""
    share = (x / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _binned(df: DataFrame, column: str, bin_: Column, key: int) -> DataFrame:
    counted = df.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
    return counted.select(F.lit(key).alias("key"), "*")


def _bins_of(counted: list[DataFrame], ranks: dict[int, list[int]]) -> dict[tuple[int, int], tuple]:
    """(key, rank) -> (before, n, low, high) of the bin that holds the rank, from one job over all counts."""
    if not counted:
        return {}
    every = reduce(DataFrame.unionByName, counted)
    up_to = F.sum("n").over(Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = every.withColumn("up_to", up_to)
    wanted = F.create_map(*(x for key, rs in ranks.items() for x in (F.lit(key), F.array(*(F.lit(r).cast("long") for r in rs)))))
    rows = bins.withColumn("rank", F.explode(F.element_at(wanted, F.col("key")))).where("up_to - n <= rank AND rank < up_to")
    return {(r["key"], r["rank"]): (r["up_to"] - r["n"], r["n"], r["low"], r["high"]) for r in rows.collect()}


def exact_quantiles(df: DataFrame, columns: Iterable[str], probabilities: Iterable[float], sorted_at_once: int = SORTED) -> dict[str, dict[float, float]]:
    """column -> probability -> value, interpolated between the two nearest ranks; columns without values are absent.

    Nulls are left out, NaN is larger than all else.  The table is read once for
    the first count and once for each later one, with the bin's limits as filters
    on the column, so file statistics can skip what lies outside.
    """
    columns, probabilities = list(columns), sorted(set(probabilities))
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities are from 0 to 1")
    values = {c: df.select(F.col(c).cast("double").alias("x")).where("x IS NOT NULL") for c in columns}
    totals = df.agg(*(F.count(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns))).first()
    n = {c: totals[i] for i, c in enumerate(columns) if totals[i]}
    ends = {(c, p): (math.floor(p * (n[c] - 1)), math.ceil(p * (n[c] - 1))) for c in n for p in probabilities}
    ranks = {c: sorted({r for (d, _), pair in ends.items() if d == c for r in pair}) for c in n}

    keys = {i: c for i, c in enumerate(n)}
    found = _bins_of([_binned(values[c], "x", _first_bin(F.col("x")), i) for i, c in keys.items()], {i: ranks[c] for i, c in keys.items()})
    places = [_Place(keys[i], rank, *at) for (i, rank), at in found.items()]
    while any(p.open(sorted_at_once) for p in places):
        todo = sorted({(p.column, p.low, p.high, p.before) for p in places if p.open(sorted_at_once)})
        counted = [_binned(values[c].where(F.col("x").between(low, high)), "x", _part(F.col("x"), low, high), i) for i, (c, low, high, _) in enumerate(todo)]
        number = {t: i for i, t in enumerate(todo)}
        inner: dict[int, list[int]] = {}
        at = {p: number.get((p.column, p.low, p.high, p.before)) for p in places}
        for p, i in at.items():
            if i is not None and p.open(sorted_at_once):
                inner.setdefault(i, []).append(p.rank - p.before)
        found = _bins_of(counted, inner)
        for k, p in enumerate(places):
            if at[p] is not None and p.open(sorted_at_once):
                before, count, low, high = found[at[p], p.rank - p.before]
                places[k] = replace(p, before=p.before + before, n=count, low=low, high=high)

    small = sorted({(p.column, p.low, p.high, p.before) for p in places if p.low != p.high and not math.isnan(p.high)})
    inside = [values[c].where(F.col("x").between(low, high)).agg(F.lit(i).alias("i"), F.array_sort(F.collect_list("x")).alias("x")) for i, (c, low, high, _) in enumerate(small)]
    ordered = {small[r["i"]]: r["x"] for r in reduce(DataFrame.unionByName, inside).collect()} if inside else {}  # each of at most sorted_at_once values
    at = {(p.column, p.rank): ordered[p.column, p.low, p.high, p.before][p.rank - p.before] if (p.column, p.low, p.high, p.before) in ordered else p.high for p in places}

    out: dict[str, dict[float, float]] = {}
    for (c, p), (a, b) in ends.items():
        x, y, share = at[c, a], at[c, b], p * (n[c] - 1) - a
        out.setdefault(c, {})[p] = x if x == y or a == b else x * (1 - share) + y * share
    return out
