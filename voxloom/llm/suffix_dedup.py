"""Substring deduplication with sparse suffix arrays.

Of each document only the suffixes at minimiser positions are retained: in
every run of words as long as a window, the half-window with the least
fingerprint.  Two occurrences of a passage have the same minimisers, so their
suffixes are retained alike.  No suffix is sorted by its words: suffixes meet in
buckets by the fingerprint of their first half-window, and those that meet are
extended to whole windows as ``repeats`` describes.  README says why.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, repeats


def _slide(x: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over x[i : i + width]; behind the end stands ``fill``."""
    step, have = 1, x
    shift = lambda y, k: np.concatenate([y[k:], np.full(min(k, len(y)), fill, y.dtype)])
    while step * 2 <= width:
        have = pick(have, shift(have, step))
        step *= 2
    return pick(have, shift(have, width - step)) if step < width else have


def minimisers(chunk: repeats.Chunk, prints: np.ndarray, valid: np.ndarray, width: int = repeats.WINDOW - repeats.WINDOW // 2 + 1) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose fingerprint is the least of some ``width`` consecutive ones; ties are all retained."""
    most = np.iinfo(np.uint64).max
    h = np.where(valid, prints, most)
    least = _slide(h, width, np.minimum, most)
    reached = _slide(least[::-1], width, np.maximum, 0)[::-1]  # the largest minimum of the runs that hold the position
    return valid & (reached == h), np.ones(len(h), bool)


def suffix_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Remove every word covered by a 50-word window that also starts in a document with a smaller id.

    The rules for words, nulls, short texts and repeated or null ids are those of
    ``substring_dedup``; adds n_words, n_removed, kept_text and removed_words.
    """
    return repeats.remove_repeats(docs, minimisers, text=text, id_col=id_col)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
