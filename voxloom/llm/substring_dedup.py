"""Substring deduplication with fixed-block anchors.

The reference index holds each document's non-overlapping blocks of half a
window; every rolling window of that length probes it.  Any shared window holds
a whole block of either document, so no repeat is missed.  Hits are extended to
whole windows as ``repeats`` describes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, repeats


def every_window(chunk: repeats.Chunk, prints: np.ndarray, valid: np.ndarray, block: int = repeats.WINDOW // 2) -> tuple[np.ndarray, np.ndarray]:
    """All rolling windows probe; those at multiples of the block length are the reference."""
    return valid, chunk.place() % block == 0


def substring_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Remove every word covered by a 50-word window that also starts in a document with a smaller id.

    Words are runs of anything but ASCII white space, unchanged; windows are
    judged on the input.  Adds n_words, n_removed, kept_text (the kept words
    joined by one space) and removed_words (the maximal removed runs, half-open).  Null and empty texts have no words; texts under 50
    words lose none.  Rows with the same id are one document and never remove
    from each other; a null id counts as the largest.  Ids are integers.
    Windows are equal when 128 bits of fingerprint are: among 10**13 windows one
    pair in 10**12 runs would be taken for equal wrongly.  Columns named like the added ones are an error.
    """
    return repeats.remove_repeats(docs, every_window, text=text, id_col=id_col)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
least_doc AS (SELECT g, min(doc_id) AS least_id FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN least_doc USING (g) WHERE doc_id > least_id),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM (SELECT d.doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d JOIN lost USING (doc_id)) x
         WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = x.doc_id AND gone.p = x.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(lost.ps), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN lost.doc_id IS NULL THEN array_to_string(d.w, ' ') ELSE coalesce(kept.t, '') END) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
