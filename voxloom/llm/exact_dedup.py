"""Exact deduplication with a two-pass Bloom filter (DataFrame functions only).

Pass one reads the texts once and counts their 64-bit hashes with a shuffle of
8 bytes for each text, after equal ones of a task were combined.  The hashes
that occur twice, and no others, set three bits each of a Bloom filter.  Pass
two tests every row against the filter: a row of which one bit is not set has
no equal and passes straight through; only the rest are shuffled and compared,
by the SHA-256 of the text.  The filter has no false negatives, so a false
positive costs a shuffled row and nothing else.

The filter has ``bits_per_hash`` bits for each repeated hash, whatever their
number.  What is broadcast at once is bounded by ``max_filter_words`` (8 bytes
each): a larger filter is cut by ranges of the hash, and each range tests its
own rows in a scan of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: 64-bit words in a row of the broadcast filter.
BLOCK = 512
HASHES = 3


def _mask(h: Column) -> Column:
    """Three of the 64 bits of a word, from bits of a second hash."""
    again, mask = F.xxhash64(h, F.lit(7)), F.lit(0).cast("long")
    for i in range(HASHES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(again, 8 * i).bitwiseAND(63).cast("int")))
    return mask


def _slot(h: Column, n_ranges: int, n_words: int) -> tuple[Column, Column]:
    """Range of a hash, and its word in the filter of that range."""
    other = F.xxhash64(h, F.lit(11))
    return F.pmod(h, F.lit(n_ranges)), F.pmod(other, F.lit(n_words))


def repeated_hashes(hashes: DataFrame) -> DataFrame:
    """``hashes(h)`` -> (h) of those that occur twice or more."""
    return hashes.groupBy("h").agg(F.count("*").alias("n")).where("n >= 2").select("h")


def bloom_filter(repeated: DataFrame, n_ranges: int, n_words: int) -> DataFrame:
    """Rows (range, block, words) of the filter, for blocks that have a bit."""
    part, word = _slot(F.col("h"), n_ranges, n_words)
    words = repeated.select(part.alias("range"), word.alias("word"), _mask(F.col("h")).alias("mask")).groupBy("range", "word").agg(F.bit_or("mask").alias("value"))
    entry = F.struct((F.col("word") % BLOCK).cast("int").alias("i"), "value")
    blocks = words.groupBy("range", F.floor(F.col("word") / BLOCK).alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))  # at most BLOCK entries
    return blocks.select("range", "block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("words"))


def tested(docs: DataFrame, text: Column, maybe: str, bits_per_hash: int, max_filter_words: int) -> list[DataFrame]:
    """The rows of ``docs`` by ranges of their hash, with a column ``maybe`` that is true where the text may repeat."""
    h, block, words = (common.fresh_name(docs, x) for x in ("h", "block", "words"))
    repeated = common.checkpoint(repeated_hashes(docs.select(F.xxhash64(text).alias("h"))))
    n_words = max(BLOCK, -(-repeated.count() * bits_per_hash // 64))
    n_ranges = -(-n_words // max_filter_words)
    n_words = -(-n_words // n_ranges)
    bloom = bloom_filter(repeated, n_ranges, n_words)
    bloom = common.checkpoint(bloom) if n_ranges > 1 else bloom
    part, word = _slot(F.col(h), n_ranges, n_words)
    out = []
    for k in range(n_ranges):
        rows = docs.withColumn(h, F.xxhash64(text))
        rows = rows.where(part == k) if n_ranges > 1 else rows
        own = bloom.where(F.col("range") == k).select(F.col("block").alias(block), F.col("words").alias(words))
        rows = rows.withColumn(block, F.floor(word / BLOCK)).join(F.broadcast(own), block, "left")  # at most max_filter_words * 8 bytes
        have = F.coalesce(F.get(words, (word % BLOCK).cast("int")), F.lit(0).cast("long"))
        out.append(rows.select(*docs.columns, (have.bitwiseAND(_mask(F.col(h))) == _mask(F.col(h))).alias(maybe)))
    return out


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits_per_hash: int = 16, max_filter_words: int = 1 << 25) -> DataFrame:
    """Add keep_id, group_size, kept and text_sha256 to every row.

    Rows are equal when their texts are identical after no change; a null text
    counts as empty.  Of equal texts the row with the largest id stays (rows
    that repeat that id too are all marked kept).  Null ids lose against any
    other; a group of null ids only has a null keep_id and ``kept`` true.  An
    empty table gives no rows.  Other columns pass through; columns named like
    the added ones are an error.
    """
    common.require_absent(docs, "keep_id", "group_size", "kept", "text_sha256")
    maybe, key, hot, best, size = (common.fresh_name(docs, x) for x in ("maybe", "key", "hot", "best", "size"))
    content = common.text_or_empty(text)
    sha = F.sha2(content.cast("binary"), 256)
    rows = reduce(DataFrame.unionByName, tested(docs, content, maybe, bits_per_hash, max_filter_words)).withColumn(key, F.when(F.col(maybe), sha))
    groups = common.checkpoint(rows.where(maybe).groupBy(key).agg(F.max(id_col).alias(best), F.count("*").alias(size)).where(F.col(size) > 1))

    # Groups of over a thousandth of all rows are fewer than a thousand; their rows are judged where they are.
    large = groups.where(F.col(size) * common.HOT_SHARE > docs.count()).select(key, F.struct(best, size).alias(hot))
    seen = rows.join(F.broadcast(large), key, "left")
    stay = seen.where(~F.col(maybe) | F.col(hot).isNotNull()).withColumn(best, F.when(F.col(hot).isNotNull(), F.col(f"{hot}.{best}")).otherwise(F.col(id_col))).withColumn(size, F.coalesce(F.col(f"{hot}.{size}"), F.lit(1)))
    stay = stay.withColumn(key, F.coalesce(F.col(key), sha))
    moved = seen.where(F.col(maybe) & F.col(hot).isNull()).join(groups, key, "left")
    moved = moved.withColumn(best, F.when(F.col(size).isNull(), F.col(id_col)).otherwise(F.col(best))).withColumn(size, F.coalesce(F.col(size), F.lit(1)))
    out = [*docs.columns, F.col(best).alias("keep_id"), F.col(size).cast("long").alias("group_size"), F.col(id_col).eqNullSafe(F.col(best)).alias("kept"), F.col(key).alias("text_sha256")]
    return stay.select(*out).unionByName(moved.select(*out))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
