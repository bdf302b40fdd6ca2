"""Audit of how far the sources of a language differ in their use of words.

Plain relational work: the terms of every text are counted by (lang, source),
each language keeps the terms that enough of its documents hold, every group is
crossed with its language's kept terms so that zeros count too, the dense table
joins itself on language and term, and sums of differences are ranked.

A match of the term expression becomes a row only after equal ones of a task
have been added up (``term_counts``), so a frequent term costs a row for each
task and source and not one for each occurrence.  Languages hold most of all
rows each, so the cross is dealt by (lang, bucket of the term).  Everything that
grows with the corpus is shuffled by term; nothing is broadcast or collected.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]``, A-Z as lower case; all others become spaces.
TERM_BYTES = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Distinct (lang, source, term) that a task holds before it gives them out.
MAX_HELD = 300_000

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _given_out(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        columns = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, COUNTS, strict=True)], schema=COUNTS)
    held.clear()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n, docs = held[lang, source]
            before, seen = len(n), set()
            for words in common.word_pieces(text.encode("utf-8", "surrogatepass").translate(TERM_BYTES)):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(n) - before
            if size > MAX_HELD:
                yield from _given_out(held)
                size = 0
    yield from _given_out(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """``docs(lang, source, text)`` without nulls -> (lang, source, term, n, docs): occurrences and documents that hold the term."""
    found = docs.select("lang", "source", "text").mapInArrow(common.releasing(_counted), "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column, scale: int, smoothing: int) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), in whole numbers of any size."""
    exact = lambda x, digits: x.cast(f"decimal({digits},0)")
    return 1 + F.call_function("div", exact(F.lit(scale), 12) * exact(count + smoothing, 20), exact(total + smoothing * terms, 20))


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, top: int = 50, scale: int = 1_000_000_000, smoothing: int = 5) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs.

    Part ``pair``: the distance to each other source of the language, the sum of
    the absolute differences of the shares of all kept terms.  Part ``term``: the
    ``top`` terms whose share in the group is most above that in the language.

    Null texts, languages and sources count as ''.  A language without kept
    terms has pairs of value 0 and no terms; a source alone in its language has
    no pairs.  Repeated rows count each; equal values are ranked by item.  Other
    columns are not looked at.  An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"), F.coalesce(text, F.lit("")).alias("text"))
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = common.checkpoint(term_counts(rows).withColumn("in_lang", in_lang).where(F.col("in_lang") >= min_docs).select("lang", "source", "term", "n"))

    vocabulary = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = vocabulary.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "terms"])

    # A term '' of no share stands in every language, so that languages without terms have their pairs too.
    none = groups.select("lang").distinct().select("lang", F.lit("").alias("term"), F.lit(0).cast("long").alias("lang_n"))
    n_buckets = common.shuffle_partitions(docs.sparkSession)
    bucket = F.pmod(F.xxhash64("term"), F.lit(n_buckets)).cast("int")
    everywhere = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))))
    crossed = vocabulary.unionByName(none).withColumn("bucket", bucket).join(everywhere, ["lang", "bucket"]).drop("bucket")
    counted = crossed.join(kept, ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = lambda count, total: F.when(F.col("term") == "", F.lit(0).cast("long")).otherwise(_share(F.col(count), F.col(total), F.col("terms"), scale, smoothing))
    dense = common.checkpoint(counted.select("lang", "term", "source", "n", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")))

    one, other = dense.select("lang", "term", "source", "p"), dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"))
    halves = one.join(other, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("r"))).alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = halves.select("lang", "value", F.explode(both).alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    terms = dense.where("n > 0 AND p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).where(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(common.table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT i, lang, source, term, count(*) AS n FROM (SELECT i, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
v AS (SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= 30),
c AS (SELECT lang, source, term, sum(t.n) AS n FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM v GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)::HUGEINT) // (coalesce(s.total, 0) + 5 * l.terms)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (v.n + 5)::HUGEINT) // (l.total + 5 * l.terms)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50
"""
