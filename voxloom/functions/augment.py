"""Small random changes of signals for training, the same on every retry and partitioning.

A random number is a hash of the seed, the row's id, the step and the number of
the draw, so it depends on nothing that a cluster may do otherwise next time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import bound

#: How often each change is made and between what factors.
SHIFT, STRETCH, GAIN = (0.3, 0.98, 0.04), (0.2, 0.99, 0.02), (0.5, 0.95, 0.1)
BITS = 52


def uniform(id_: Column, step: Column, draw: int, seed: int = 42) -> Column:
    """From 0 to below 1: the first 52 bits of a hash; a null id or step counts as empty."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), F.coalesce(step.cast("string"), F.lit("")), F.lit(str(draw)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("double") / F.lit(float(1 << BITS))


def stretched(x: Column, factor: Column) -> Column:
    """floor(n * factor) samples by linear interpolation between sample centres; ends are held."""

    def at(n: Column, i: Column, a: Column, f: Column) -> Column:
        place = F.greatest(F.lit(0.0), (i + 0.5) / f - 0.5)
        low = F.least(F.floor(place), F.lit(n - 1)).cast("int")
        share = place - low
        return F.get(a, low) * (1 - share) + F.get(a, F.least(low + 1, n - 1)) * share

    whole = lambda a, f: F.transform(F.sequence(F.lit(0), F.floor(F.size(a) * f).cast("int") - 1), lambda i: at(F.size(a), i, a, f))
    return bound(x, lambda a: bound(factor, lambda f: F.when(F.floor(F.size(a) * f) >= 1, whole(a, f)).otherwise(F.slice(a, 1, 0))))


def factors(id_: Column, step: Column, seed: int = 42) -> Column:
    """struct(shift, stretch, gain): what a row is changed by in a step, 1 where it isn't."""
    picked = lambda k, often, low, width: F.when(uniform(id_, step, 2 * k, seed) < often, low + uniform(id_, step, 2 * k + 1, seed) * width).otherwise(F.lit(1.0))
    return F.struct(*(picked(k, *spec).alias(name) for k, (name, spec) in enumerate((("shift", SHIFT), ("stretch", STRETCH), ("gain", GAIN)))))


def augmented(x: Column, id_: Column, step: Column, training: bool = True, seed: int = 42) -> Column:
    """The signal of a row in a step: shifted, stretched and made louder or softer, each at random; unchanged when not training."""
    if not training:
        return x
    f = factors(id_, step, seed)
    moved = stretched(stretched(x, f["shift"]), f["stretch"])
    return bound(f["gain"], lambda g: F.transform(moved, lambda s: s * g))
