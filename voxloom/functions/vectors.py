"""Vectors in array columns: similarity, drift, pooling and health, as expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import with_previous


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once for a row.

    Inside a lambda an outer expression would be worked out again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


def mean(vec: Column) -> Column:
    return F.try_divide(total(vec), F.size(vec))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def differences(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def l2(a: Column, b: Column) -> Column:
    return norm(differences(a, b))


def l1(a: Column, b: Column) -> Column:
    return total(F.transform(differences(a, b), lambda x: F.abs(x)))


def max_abs(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda x: F.abs(x)))


def mse(a: Column, b: Column) -> Column:
    return total(F.transform(differences(a, b), lambda x: x * x)) / F.size(a)


def spectral_convergence(a: Column, b: Column) -> Column:
    return l2(a, b) / (norm(b) + 1e-8)


def pearson(a: Column, b: Column) -> Column:
    return bound(_centred(a), lambda x: bound(_centred(b), lambda y: cosine(x, y)))


def _centred(v: Column) -> Column:
    return bound(v, lambda a: bound(mean(a), lambda m: F.transform(a, lambda x: x - m)))


def halves(vec: Column, dims: int) -> tuple[Column, Column]:
    """Timbre and style halves."""
    return F.slice(vec, 1, dims // 2), F.slice(vec, dims // 2 + 1, dims - dims // 2)


def std_pop(vec: Column) -> Column:
    return bound(vec, lambda a: bound(mean(a), lambda m: F.sqrt(F.try_divide(total(F.transform(a, lambda x: (x - m) * (x - m))), F.size(a)))))


def std_samp(vec: Column) -> Column:
    return bound(vec, lambda a: bound(mean(a), lambda m: F.sqrt(F.try_divide(total(F.transform(a, lambda x: (x - m) * (x - m))), F.size(a) - 1))))


def describe(vec: Column) -> Column:
    return F.struct(mean(vec).alias("mean"), std_pop(vec).alias("std"), F.array_min(vec).alias("min"), F.array_max(vec).alias("max"), (F.array_max(vec) - F.array_min(vec)).alias("range"))


def health(vec: Column, extreme: float = 10.0) -> Column:
    sd = std_pop(vec)
    return F.struct(
        F.exists(vec, lambda x: F.isnan(x)).alias("has_nan"),
        F.exists(vec, lambda x: F.abs(x) == float("inf")).alias("has_inf"),
        (max_abs(vec) > extreme).alias("extreme_values"),
        (sd < 0.01).alias("flat"),
        (sd > 1.0).alias("unstable"),
    )


def top_dims(vec: Column, k: int = 5) -> Column:
    """Indices (from 0) of the k largest absolute values, ties by index."""
    ranked = F.array_sort(F.transform(vec, lambda x, i: F.struct((-F.abs(x)).alias("v"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda s: s["i"])


def drift(before: Column, after: Column) -> Column:
    d = differences(after, before)
    return F.struct(
        cosine(before, after).alias("cosine"), l2(after, before).alias("l2"), l1(after, before).alias("l1"), max_abs(d).alias("max_change"), (F.try_divide(norm(after) - norm(before), norm(before)) * 100).alias("norm_change_pct"), top_dims(d).alias("top_dims")
    )


def drift_label(cos: Column) -> Column:
    return F.when(cos > 0.95, "very similar").when(cos > 0.85, "similar").when(cos > 0.7, "moderate change").otherwise("large change")


def similarity_label(score: Column, mcd: Column, f0: Column) -> Column:
    return F.concat_ws(
        " | ",
        F.when(score > 0.85, "excellent").when(score > 0.7, "good").when(score > 0.5, "fair").otherwise("poor"),
        F.when(mcd < 2, "timbre very close").when(mcd < 4, "timbre close").when(mcd < 6, "timbre similar").otherwise("timbre different"),
        F.when(f0 > 0.9, "pitch very close").when(f0 > 0.7, "pitch close").when(f0 > 0.5, "pitch similar").otherwise("pitch different"),
    )


def perceptual_score(cos: Column, corr: Column, convergence: Column, f0: Column, centroid: Column) -> Column:
    zero = lambda x: F.nanvl(F.coalesce(x, F.lit(0.0)), F.lit(0.0))
    score = 0.3 * zero(cos) + 0.3 * zero(corr) + 0.2 * (1 - F.least(convergence, F.lit(1.0))) + 0.1 * zero(f0) + 0.1 * zero(centroid)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def weighted_similarity(terms: dict[str, Column], weights: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for name in sorted(terms):
        out = out + F.lit(float(weights.get(name, 0.0))) * terms[name]
    return out


def bin_centroid(v: Column) -> Column:
    weighted = total(F.transform(v, lambda x, i: x * i.cast("double")))
    return weighted / (total(v) + 1e-8)


def mean_pool(df: DataFrame, group: str, vec: str) -> DataFrame:
    """(group, vec): the mean vector of each group; averages are combined map-side by position."""
    long = df.select(group, F.posexplode(doubles(F.col(vec))).alias("pos", "x"))
    per_dim = long.groupBy(group, "pos").agg(F.avg("x").alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "m")))
    return per_dim.groupBy(group).agg(F.transform(ordered, lambda s: s["m"]).alias("vec"))


def dim_std(df: DataFrame, vec: str) -> DataFrame:
    """(pos, mean, std): sample deviation of each dimension."""
    return df.select(F.posexplode(doubles(F.col(vec))).alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))


def smoothed(df: DataFrame, group: str, order: str, vec: str, previous: float = 0.2) -> DataFrame:
    """previous * the vector before (as it was) + the rest * this one; the first is unchanged."""
    rows = with_previous(df, group, [order], vec, "_before")
    mixed = F.zip_with("_before", F.col(vec), lambda p, x: previous * p + (1 - previous) * x)
    return rows.withColumn("smoothed", F.coalesce(mixed, F.col(vec))).drop("_before")


def adjacent_distance(df: DataFrame, group: str, order: str, vec: str) -> DataFrame:
    """Distance to the vector before; null for the first."""
    rows = with_previous(df, group, [order], vec, "_before")
    return rows.withColumn("step_l2", l2(F.col(vec), F.col("_before"))).withColumn("step_sq", F.pow(F.col("step_l2"), 2)).drop("_before")


def length_expanded(vec: Column, rows: int = 510) -> Column:
    """Array of (length_idx, factor): the vector of length i is the base times factor 1 + i / rows * 0.05."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.struct(i.alias("length_idx"), (1 + i / rows * 0.05).alias("factor")))


def length_index(n: Column, rows: int = 510) -> Column:
    return F.greatest(F.lit(0), F.least(n - 1, F.lit(rows - 1)))


def health_clamped(half: Column, sd: Column, largest: Column, middle: Column, max_std: float = 0.2, target_std: float = 0.14) -> Column:
    """One half of a voice, rescaled to ``target_std`` around ``middle`` where its table is unstable and its norm is over three times ``max_std``.

    ``sd``, ``largest`` and ``middle`` are the sample deviation of the half's values, its largest norm and its mean over the whole voice.
    """
    bad = ((sd > max_std) | (largest > 5 * max_std)) & (norm(half) > 3 * max_std)
    scaled = bound(half, lambda a: bound(F.lit(target_std) / (std_samp(a) + 1e-8), lambda scale: F.transform(_centred(a), lambda x: x * scale)))
    return F.when(bad, bound(middle, lambda m: F.transform(scaled, lambda x: x + m))).otherwise(half)


def preferred(available: DataFrame, name: str, preferences: list[str]) -> DataFrame:
    """The first preference that some available name contains, with the least such name; no row if none."""
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(preferences))):
        rank = F.when(F.contains(F.col(name), F.lit(p)), F.lit(i)).otherwise(rank)
    return available.select(rank.alias("rank"), F.col(name).alias("name")).where("rank IS NOT NULL").orderBy("rank", "name").limit(1)
