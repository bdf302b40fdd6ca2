"""Pitch moved to a target by overlap-add of re-spaced periods, without a change of length.

Marks follow each other in the signal at its own period, found by autocorrelation
around each mark.  New marks follow each other at the period wanted; each takes two
periods around the nearest old mark under a Hann window.  Where no period is found
the old spacing is kept, so silence and noise pass as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import batches as B

#: Pitches of a voice in Hz, and the least share of a frame's energy that its best lag must explain.
LOWEST, HIGHEST, VOICED = 60.0, 400.0, 0.5


def period_at(x: np.ndarray, at: int, rate: float) -> float | None:
    """The period around a sample, to a fraction of one; none where the signal doesn't repeat."""
    low, high = max(2, int(rate / HIGHEST)), int(rate / LOWEST) + 1
    size = 2 * high
    frame = x[max(0, at - size) : at + size]
    if len(frame) < size:
        return None
    frame = frame - frame.mean()
    energy = np.cumsum(np.concatenate([[0.0], frame * frame]))
    products = np.fft.irfft(np.abs(np.fft.rfft(frame, 2 * len(frame))) ** 2)[: high + 2]
    lags = np.arange(1, len(products))
    norm = np.sqrt((energy[len(frame) - lags]) * (energy[-1] - energy[lags]))
    like = np.concatenate([[1.0], products[1:] / np.maximum(norm, 1e-12)])
    best = like[low : high + 1].max()
    if best < VOICED or energy[-1] < 1e-10 * len(frame):
        return None
    inner = np.arange(low, high + 1)
    peaks = inner[(like[inner] >= like[inner - 1]) & (like[inner] >= like[inner + 1]) & (like[inner] > 0.9 * best)]
    if not len(peaks):
        return None
    k = int(peaks[0])  # the shortest of equal ones: not a multiple
    a, b, c = like[k - 1 : k + 2]
    return k + (0.5 * (a - c) / (a - 2 * b + c) if a - 2 * b + c else 0.0)


def corrected(x: np.ndarray, rate: float, target: float, strength: float = 1.0) -> np.ndarray:
    """The signal with its voiced stretches moved towards ``target`` Hz: all the way at strength 1, not at all at 0."""
    x, plain = np.asarray(x, float), rate / 100
    marks, periods, at = [], [], 0.0
    while at < len(x):
        period = period_at(x, int(at), rate)
        marks.append(at)
        periods.append(period)
        at += period or plain
    if not any(periods):
        return x.copy()
    out, weight, place, k = np.zeros(len(x)), np.zeros(len(x)), 0.0, 0
    while place < len(x):
        while k + 1 < len(marks) and abs(marks[k + 1] - place) <= abs(marks[k] - place):
            k += 1
        own = periods[k] or plain
        size = int(round(own))
        window = np.hanning(2 * size + 1)
        source, goal = int(round(marks[k])) - size, int(round(place)) - size
        first = max(0, -source, -goal)
        last = min(2 * size + 1, len(x) - source, len(x) - goal)
        if last > first:
            out[goal + first : goal + last] += window[first:last] * x[source + first : source + last]
            weight[goal + first : goal + last] += window[first:last]
        step = own if periods[k] is None else own + strength * (rate / target - own)
        place += max(step, 1.0)
    moved = np.where(weight > 1e-3, out / np.maximum(weight, 1e-3), x)
    return moved / max(1.0, float(np.abs(moved).max()))


def pitch_corrected(x: Column, rate: float, target: float, strength: float = 1.0) -> Column:
    """Each signal at its own length; null stays null, empty stays empty, null samples count as 0."""
    if target <= 0 or not 0 <= strength <= 1:
        raise ValueError("a target pitch above 0 and a strength from 0 to 1")

    @F.arrow_udf("array<double>")
    def moved(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at, n in B.parts(batch):
                yield B.rows([None if s is None else corrected(np.nan_to_num(s), rate, target, strength) for s in B.arrays(batch.slice(at, n))])

    return moved(x.cast("array<double>"))
