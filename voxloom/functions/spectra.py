"""Comparison of spectrograms: arrays of bands, each an array over frames.

Two of them are compared over the frames that both have; a missing or empty
one gives null.  All are array expressions, but for the spectra of signals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches as B
from . import vectors as V
from .vectors import bound, total


def paired(a: Column, b: Column, use) -> Column:
    """``use(a, b)`` with both cut to the frames of the shorter one, each worked out once."""
    frames = lambda x: F.size(F.get(x, F.lit(0)))
    cut = lambda x, n: F.transform(x, lambda band: F.slice(band, 1, n))
    whole = lambda x, y: bound(F.least(frames(x), frames(y)), lambda n: F.when(n > 0, bound(cut(x, n), lambda p: bound(cut(y, n), lambda t: use(p, t)))))
    return bound(a, lambda x: bound(b, lambda y: F.when(x.isNotNull() & y.isNotNull(), whole(x, y))))


def by_frame(spectrum: Column) -> Column:
    """The same values as an array of frames."""
    n = F.size(F.get(spectrum, F.lit(0)))
    frame = lambda t: F.transform(spectrum, lambda band: F.get(band, t))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), frame))


def cepstrum(frame: Column, n: int = 13) -> Column:
    """The first ``n`` orthonormal cosine coefficients of a frame (at most one for each band)."""

    def coefficient(k: Column, x: Column) -> Column:
        terms = F.transform(x, lambda v, j: v * F.cos(F.lit(math.pi) * (j + 0.5) * k / F.size(x)))
        return total(terms) * F.sqrt(F.when(k == 0, 1.0).otherwise(2.0) / F.size(x))

    return bound(frame, lambda x: F.transform(F.slice(F.sequence(F.lit(0), F.lit(n - 1)), 1, F.size(x)), lambda k: coefficient(k, x)))


def cepstral_distortion(a: Column, b: Column, n: int = 13) -> Column:
    """Mean over frames of the distance of their cepstra; the transform is linear, so that of the differences is taken."""

    def distortion(p: Column, t: Column) -> Column:
        changes = by_frame(F.zip_with(p, t, lambda x, y: V.differences(x, y)))
        return V.mean(F.transform(changes, lambda frame: V.norm(cepstrum(frame, n))))

    return paired(a, b, distortion)


def pitch_difference(a: Column, b: Column) -> Column:
    """struct(difference, similarity) of the mean pitch of two tracks, 0 standing for no pitch.

    The similarity is 1 - difference / the second's mean, not under 0.  Where
    one track has no pitch the difference is null and the similarity 0.
    """
    voiced = lambda x: V.mean(F.filter(x, lambda v: v > 0))
    gap = lambda p, t: F.struct(F.abs(p - t).alias("difference"), F.greatest(F.lit(0.0), F.coalesce(1 - F.abs(p - t) / t, F.lit(0.0))).alias("similarity"))
    return bound(voiced(a), lambda p: bound(voiced(b), lambda t: gap(p, t)))


def centroids(spectrum: Column) -> Column:
    """The centre of mass over bands of every frame."""
    return F.transform(by_frame(spectrum), V.bin_centroid)


def band_correlation_loss(p: Column, t: Column) -> Column:
    """1 - the mean over bands of the mean product of the bands' standard scores; null for a single frame."""

    def correlation(x: Column, y: Column) -> Column:
        return V.dot(V._centred(x), V._centred(y)) / F.size(x) / ((V.std_samp(x) + 1e-8) * (V.std_samp(y) + 1e-8))

    return 1 - V.mean(F.zip_with(p, t, correlation))


#: Weights of the training similarity.
SIMILARITY_WEIGHTS = {"cosine_loss": 0.3, "spectral_convergence": 0.2, "log_l1_loss": 0.2, "freq_correlation_loss": 0.2, "centroid_loss": 0.1}


def training_similarity(predicted: Column, target: Column) -> Column:
    """struct of five losses and their weighted sum ``perceptual_loss``; 0 for equal spectrograms, but for the correlation, which is 1 / frames."""

    def losses(p: Column, t: Column) -> Column:
        x, y = F.flatten(p), F.flatten(t)
        log = lambda v: F.transform(v, lambda c: F.ln(F.greatest(c, F.lit(1e-5))))
        terms = {
            "cosine_loss": 1 - V.dot(x, y) / (F.greatest(V.norm(x), F.lit(1e-12)) * F.greatest(V.norm(y), F.lit(1e-12))),
            "spectral_convergence": V.spectral_convergence(x, y),
            "log_l1_loss": V.l1(log(x), log(y)) / F.size(x),
            "freq_correlation_loss": band_correlation_loss(p, t),
            "centroid_loss": V.l1(centroids(p), centroids(t)) / F.size(F.get(p, F.lit(0))),
        }
        named = F.struct(*(c.alias(n) for n, c in terms.items()))
        weighed = lambda s: sum((SIMILARITY_WEIGHTS[n] * s[n] for n in terms), F.lit(0.0))
        return bound(named, lambda s: F.struct(*(s[n].alias(n) for n in terms), weighed(s).alias("perceptual_loss")))

    return paired(predicted, target, losses)


#: Weights of the six terms of a voice's similarity, where a run brings none of its own.
VOICE_WEIGHTS = {
    "mel_l1_weight": 0.23042650977238305,
    "spectral_conv_weight": 0.2822633041696316,
    "cosine_weight": 0.1757828735941619,
    "centroid_weight": 0.18877395866922594,
    "norm_reg_weight": 0.024094526382500217,
    "smoothness_weight": 0.099250419143429,
}
#: Fixed value: the norm that an embedding is held to.
TARGET_NORM = 0.15


def voice_losses(predicted: Column, target: Column, embedding: Column) -> Column:
    """struct of the six losses of a voice; see ``weighed_losses``."""
    held = V.norm(embedding) - TARGET_NORM

    def losses(p: Column, t: Column) -> Column:
        x, y = F.flatten(p), F.flatten(t)
        return F.struct(
            (V.l1(x, y) / F.size(x)).alias("mel_l1"),
            V.spectral_convergence(x, y).alias("spectral_conv"),
            (1 - V.dot(x, y) / (F.greatest(V.norm(x), F.lit(1e-12)) * F.greatest(V.norm(y), F.lit(1e-12)))).alias("cosine"),
            (V.l1(centroids(p), centroids(t)) / F.size(F.get(p, F.lit(0)))).alias("centroid"),
            (held * held).alias("norm_reg"),
            (V.mean(F.transform(embedding, lambda v: F.abs(v))) * 0.1).alias("smoothness"),
        )

    return paired(predicted, target, losses)


def weighed_losses(losses: Column, weights: Column | None = None) -> Column:
    """The weighted sum of a column of ``voice_losses``; lower is more alike.

    ``weights`` is a struct with the names of ``VOICE_WEIGHTS``, as a run's
    configuration has them; one that is null is the fixed one.
    """
    weight = lambda n: F.lit(VOICE_WEIGHTS[n]) if weights is None else F.coalesce(weights[n].cast("double"), F.lit(VOICE_WEIGHTS[n]))
    return sum((weight(n) * losses[n.removesuffix("_weight")] for n in VOICE_WEIGHTS), F.lit(0.0))


def perceptual_similarity(predicted: Column, target: Column, pitch_predicted: Column, pitch_target: Column) -> Column:
    """struct of all that the perceptual score rests on, and the score from 0 to 1.

    The pitch counts by the means of the voiced frames of both tracks, the
    centre of mass by the correlation of its tracks, which is 0 where one is constant.
    """
    pitch = pitch_difference(pitch_predicted, pitch_target)["similarity"]

    def parts(p: Column, t: Column) -> Column:
        x, y = F.flatten(p), F.flatten(t)
        return F.struct(V.cosine(x, y).alias("cosine"), V.pearson(x, y).alias("correlation"), (V.l2(x, y) / V.norm(y)).alias("convergence"), pitch.alias("pitch"), V.pearson(centroids(p), centroids(t)).alias("centroid"))

    score = lambda s: V.perceptual_score(s["cosine"], s["correlation"], s["convergence"], s["pitch"], s["centroid"])
    names = ("cosine", "correlation", "convergence", "pitch", "centroid")
    return bound(paired(predicted, target, parts), lambda s: F.when(s.isNotNull(), F.struct(*(s[n].alias(n) for n in names), score(s).alias("score"))))


def log_spectrum(x: np.ndarray, size: int) -> np.ndarray:
    """Frames x frequencies: logs of the magnitudes, at least 1e-5, over the norm of the window; frames lie around every quarter of a window, ends are mirrored."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    padded = np.pad(x, size // 2, "reflect" if len(x) > size // 2 else "constant")
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[:: size // 4]
    return np.log(np.maximum(np.abs(np.fft.rfft(frames * window)) / np.sqrt((window**2).sum()), 1e-5))


def stft_distance(a: np.ndarray, b: np.ndarray, sizes: tuple[int, ...]) -> float:
    """Mean over the window sizes of the mean distance of the log spectra, over the samples that both signals have."""
    n = min(len(a), len(b))
    return float(np.mean([np.abs(log_spectrum(a[:n], size) - log_spectrum(b[:n], size)).mean() for size in sizes]))


def with_log_spectra(df: DataFrame, signal: str, name: str, sizes: tuple[int, ...] = (1024, 512, 256)) -> DataFrame:
    """Add the spectra of each signal, an array over sizes of arrays over frames; null and empty signals have null."""

    def listed(found: list[list[np.ndarray] | None]) -> pa.Array:
        each = [s for x in found if x is not None for s in x]
        values = np.concatenate([np.zeros(0), *(s.ravel() for s in each)])
        frames = B.lists(pa.array(values, from_pandas=True), [s.shape[1] for s in each for _ in s])
        return B.lists(B.lists(frames, [len(s) for s in each]), [None if x is None else len(x) for x in found])

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in B.parts(batch[signal]):
                part = batch.slice(at, n)
                found = listed([[log_spectrum(x, size) for size in sizes] if x is not None and len(x) else None for x in B.arrays(part[signal])])
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, name])

    return df.mapInArrow(spectra, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))]))


def with_stft_distance(df: DataFrame, a: str, b: str, name: str, sizes: tuple[int, ...] = (1024, 512, 256)) -> DataFrame:
    """Add the distance of two signals' spectra; null where one is null or empty.  A step of its own, so that what follows may use it inside lambdas."""

    def distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[name] = [None if x is None or y is None or not len(x) or not len(y) else stft_distance(np.asarray(x, float), np.asarray(y, float), sizes) for x, y in zip(batch[a], batch[b], strict=True)]
            yield batch

    return df.mapInPandas(distances, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def perceptual_weight(epoch: Column, largest: float = 0.15, start: int = 5, ramp: int = 10) -> Column:
    """Rises over ``ramp`` epochs from ``start`` on; 0 before."""
    return F.when(epoch >= start, F.least(F.lit(largest), F.greatest(F.lit(0.0), (epoch - start + 1) / max(ramp, 1) * largest))).otherwise(0.0)


def voice_loss(predicted: Column, target: Column, style: Column, epoch: Column, strength: float = 0.0, stft: Column | None = None, perceptual: bool = False, start: int = 5) -> Column:
    """struct of the parts of a voice's loss and their sum ``total_loss``.

    ``stft`` is the mean distance of log spectra, 0 without target audio.  The
    style counts after epoch 10 where its deviation is over 0.18; the
    perceptual part, a tenth of ``training_similarity``, after epoch ``start``.
    """
    stft = F.lit(0.0) if stft is None else F.coalesce(stft, F.lit(0.0))
    weight = perceptual_weight(epoch, start=start) if perceptual else F.lit(0.0)
    size = V.norm(style)
    regular = F.when((epoch > 10) & (F.lit(strength) > 0) & (V.std_samp(style) > 0.18), size * size * strength).otherwise(0.0)

    def parts(p: Column, t: Column) -> Column:
        steps = lambda s: F.flatten(F.zip_with(F.slice(s, 2, F.size(s)), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), lambda b, a: V.differences(b, a)))
        x, y = F.flatten(p), F.flatten(t)
        similar = F.when(epoch > start, training_similarity(p, t)["perceptual_loss"] * 0.1).otherwise(0.0) if perceptual else F.lit(0.0)
        frequency = F.when(F.size(p) > 1, 0.5 * V.l1(steps(p), steps(t)) / F.size(steps(p))).otherwise(0.0)
        return F.struct((V.l1(x, y) / F.size(x)).alias("l1_loss"), V.mse(x, y).alias("mse_loss"), frequency.alias("freq_loss"), stft.alias("stft_loss"), regular.alias("style_reg_loss"), similar.alias("perceptual_loss"))

    names = ("l1_loss", "mse_loss", "freq_loss", "stft_loss", "style_reg_loss", "perceptual_loss")
    # The weights of the parts.
    weighed = lambda s: (0.55 - weight) * s["l1_loss"] + 0.25 * s["mse_loss"] + 0.05 * s["freq_loss"] + 0.15 * s["stft_loss"] + weight * s["perceptual_loss"] + s["style_reg_loss"]
    return bound(paired(predicted, target, parts), lambda s: F.struct(*(s[n].alias(n) for n in names), weighed(s).alias("total_loss")))


def mean_padded(df: DataFrame, spectrum: str, group: str) -> DataFrame:
    """(group, band, frame, x): the mean spectrogram of each group, shorter ones going on with their least value."""
    least = F.array_min(F.flatten(spectrum))
    sized = df.select(group, F.col(spectrum).alias("s"), least.alias("low"), F.size(F.get(spectrum, F.lit(0))).alias("n")).where("low IS NOT NULL")
    longest = sized.groupBy(group).agg(F.max("n").alias("longest"))
    bands = sized.join(longest, group).select(group, "low", "longest", F.posexplode("s").alias("band", "x"))
    points = bands.select(group, "low", "band", "x", F.explode(F.sequence(F.lit(0), F.col("longest") - 1)).alias("frame"))
    return points.groupBy(group, "band", "frame").agg(F.avg(F.coalesce(F.get("x", F.col("frame")), F.col("low"))).alias("x"))


def mean_of_maps(df: DataFrame, group: str, column: str) -> DataFrame:
    """(group, key, mean) over the maps of a group; a map without the key doesn't count for it."""
    return df.select(group, F.explode(column).alias("key", "value")).groupBy(group, "key").agg(F.avg("value").alias("mean"))
