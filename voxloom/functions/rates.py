"""Other sampling rates by a polyphase filter, for whole signals and for signals cut into rows.

An output sample is the sum of the input samples near its time under a windowed
sinc that cuts at the lower of the two Nyquist rates.  There are as many different
sets of weights as the reduced ratio has phases, so they are a small table.  A
sample outside the signal counts as 0.  Only ``span`` samples to each side matter:
a signal of any length goes through in blocks, and a signal cut into rows needs
no more than the ends of its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import with_next, with_previous
from . import batches as B

#: Zero crossings of the sinc to each side, and the share of the lower Nyquist rate that passes.
ZEROS, ROLLOFF = 24, 0.95
#: Output samples that are worked out at once.
BLOCK = 1 << 15


@lru_cache(maxsize=16)
def phases(up: int, down: int) -> np.ndarray:
    """Weights (phase, 2 * span) of the inputs from ``span - 1`` before to ``span`` after the one at or before the output's time."""
    cut = min(1.0, up / down) * ROLLOFF
    span = ceil(ZEROS / cut)
    t = (np.arange(2 * span)[None] - span + 1 - np.arange(up)[:, None] / up) * cut
    return np.where(np.abs(t) < ZEROS, cut * np.sinc(t) * np.cos(np.pi * t / 2 / ZEROS) ** 2, 0)


def reduced(rate: int, new_rate: int) -> tuple[int, int]:
    """(up, down) of the ratio in lowest terms."""
    if rate <= 0 or new_rate <= 0:
        raise ValueError(f"rates must be positive, not {rate} and {new_rate}")
    return new_rate // gcd(rate, new_rate), rate // gcd(rate, new_rate)


def part_in_new_rate(before: np.ndarray, x: np.ndarray, after: np.ndarray, start: int, rate: int, new_rate: int) -> np.ndarray:
    """The output samples whose time lies within ``x``, which begins at input sample ``start``; ``before`` and ``after`` are its neighbours' ends."""
    up, down = reduced(rate, new_rate)
    if up == down:
        return x
    weights = phases(up, down)
    span = weights.shape[1] // 2
    edge = lambda e, left: np.concatenate([np.zeros(max(0, span - len(e))), e[-span:]] if left else [e[:span], np.zeros(max(0, span - len(e)))])
    padded = np.concatenate([edge(before, True), x, edge(after, False)])
    near = np.lib.stride_tricks.sliding_window_view(padded, 2 * span)
    first, end = -(-start * up // down), -(-(start + len(x)) * up // down)
    out = np.empty(end - first)
    for at in range(first, end, BLOCK):
        m = np.arange(at, min(at + BLOCK, end))
        place, phase = m * down // up - start + 1, m * down % up
        out[at - first : at - first + len(m)] = np.einsum("ij,ij->i", near[place], weights[phase])
    return out


def in_new_rate(x: np.ndarray, rate: int, new_rate: int) -> np.ndarray:
    """A whole signal; ceil(n * new_rate / rate) samples."""
    return part_in_new_rate(np.zeros(0), np.asarray(x, float), np.zeros(0), 0, rate, new_rate)


def resample(x: Column, rate: int, new_rate: int) -> Column:
    """The signal at the new rate; null stays null, empty stays empty, a null sample counts as 0."""
    reduced(rate, new_rate)

    @F.arrow_udf("array<double>")
    def resampled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at, n in B.parts(batch):
                yield B.rows([None if s is None else in_new_rate(np.nan_to_num(s), rate, new_rate) for s in B.arrays(batch.slice(at, n))])

    return resampled(x.cast("array<double>"))


def resample_rows(df: DataFrame, key: str, start: str, samples: str, rate: int, new_rate: int) -> DataFrame:
    """(key, start, samples) of signals cut into rows, at the new rate; ``start`` counts input samples, then output samples.

    The rows of a key follow each other without gaps.  Each row is worked out on
    its own from the ends of the rows beside it, so a long signal takes many
    tasks.  A row must hold at least the filter's span, but for a key's last.
    """
    up, down = reduced(rate, new_rate)
    span = phases(up, down).shape[1] // 2
    double = df.select(F.col(key).alias("key"), F.col(start).cast("long").alias("start"), F.col(samples).cast("array<double>").alias("x"))
    ends = double.withColumn("head", F.slice("x", 1, span)).withColumn("tail", F.slice("x", F.greatest(F.size("x") - span + 1, F.lit(1)), F.lit(span)))
    met = with_next(with_previous(ends, "key", ["start"], "tail", "before"), "key", ["start"], "head", "after")

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for row in batch.to_pylist():
                x, before, after = (np.nan_to_num(np.array(row[c] or [], float)) for c in ("x", "before", "after"))
                if row["after"] is not None and len(x) < span:
                    raise ValueError(f"a row of {len(x)} samples; all but a signal's last must hold {span}")
                parts.append(part_in_new_rate(before, x, after, row["start"], rate, new_rate))
            starts = [-(-s * up // down) for s in batch.column("start").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(starts, pa.int64()), pa.array(parts, pa.list_(pa.float64()))], names=["key", "start", "x"])

    kind = dict(df.dtypes)[key]
    return met.select("key", "start", "x", "before", "after").mapInArrow(worked, f"key {kind}, start long, x array<double>").toDF(key, start, samples)
