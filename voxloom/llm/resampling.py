"""Importance resampling of documents towards the words of a target set.

The features of a text are its runs of one to three words, hashed to buckets.
Two passes read the texts: one adds up the buckets of all documents and of the
target, the other looks the buckets of every document up in the array of their
gains.  A score is the sum of the gains and a Gumbel variable made from the id,
so the highest scores are a sample without replacement by weight.

Each partition of the scored rows is a run, sorted by Spark and checkpointed in
the shared folder.  Ranges of the score, finer than the draw, are counted; the
ranges that the draw reaches are dealt one to a task, where a tournament tree
merges the pieces of all runs.  A piece joins the tree when its first row is
due, so a task holds no more than one piece of each run.  The merge of the last
range stops at the exact count; whatever lies below is never moved.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .decontamination import BYTE_MAP

N_BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 3
#: Rows of a run that travel together, and rows that a range of scores stands for.
PIECE_ROWS = 4096
RANGE_ROWS = 200_000
MAX_RANGES = 4096

# CRC-32 of "a b" from those of its parts: crc(x + y) = moved(crc(x), length of y) ^ crc(y), where moving is linear in its bits.

_ONE = np.array([[zlib.crc32(b"\0", byte << 8 * k) ^ zlib.crc32(b"\0") for byte in range(256)] for k in range(4)], np.uint32)


def _moved(tables: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    """``crc`` under the operators ``tables[at]``, each of four tables by byte."""
    return tables[at, 0, crc & 255] ^ tables[at, 1, crc >> 8 & 255] ^ tables[at, 2, crc >> 16 & 255] ^ tables[at, 3, crc >> 24]


@lru_cache(maxsize=1024)
def _operator(n: int) -> np.ndarray:
    """What ``n`` more bytes do to a CRC."""
    if n == 1:
        return _ONE
    half = _operator(n // 2)
    twice = _moved(half[None], 0, half)
    return _moved(_ONE[None], 0, twice) if n % 2 else twice


def _block_features(segments: list[tuple[int, int, list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and CRC of the features that end at a word of a segment (owner, words that only lead in, words)."""
    lengths = np.array([len(words) for _, _, words in segments])
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    owner = np.repeat([o for o, _, _ in segments], lengths)
    ends = place >= np.repeat([lead for _, lead, _ in segments], lengths)
    coded = pa.array([w for _, _, words in segments for w in words], pa.binary()).dictionary_encode()
    word, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    crc = np.array([zlib.crc32(w) for w in distinct], np.uint32)[word]
    spaced = np.array([zlib.crc32(b" " + w) for w in distinct], np.uint32)[word]
    sizes, size_of = np.unique([len(w) + 1 for w in distinct], return_inverse=True)
    tables, size = np.stack([_operator(int(n)) for n in sizes]), size_of[word]
    owners, found = [owner[ends]], [crc[ends]]
    for n in range(1, LONGEST):
        crc = np.concatenate([np.zeros(1, np.uint32), _moved(tables, size[1:], crc[:-1]) ^ spaced[1:]])
        owners.append(owner[ends & (place >= n)])
        found.append(crc[ends & (place >= n)])
    return np.concatenate(owners), np.concatenate(found)


def features(lines: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the line and CRC of each feature, in blocks of about a piece of words; the lines hold words and spaces."""
    segments, size = [], 0
    for owner, line in enumerate(lines):
        lead: list[bytes] = []
        for piece in common.word_pieces(line):
            words = lead + piece
            if piece:
                segments.append((owner, len(lead), words))
                lead = words[1 - LONGEST :]
                size += sum(map(len, piece)) + len(piece)
            if size >= common.PIECE_BYTES:
                yield _block_features(segments)
                segments, size = [], 0
    if segments:
        yield _block_features(segments)


def _lines(texts: pa.Array) -> list[bytes]:
    return [(t.as_py() or b"").translate(BYTE_MAP) for t in texts.cast(pa.binary())]


def bucket_counts(docs: DataFrame, text: str = "text", n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows; a task gives at most ``n_buckets`` sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for _, crc in features(_lines(batch.column(0))):
                total += np.bincount(crc % n_buckets, minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    sums = docs.select(text).mapInArrow(common.releasing(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(n_buckets, np.int64)
    for row in sums.collect():  # at most n_buckets rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share of the target to that of the source, one added to every bucket."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1) * float(all_source + n) / (float(s + 1) * float(all_target + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_text: Column, seed: int = 42) -> Column:
    """Thousandths of a standard Gumbel variable, from 32 bits of a hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, gains: np.ndarray, text: str = "text", id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""

    @F.arrow_udf("n_words long, weight long")
    def weigh(texts: pa.Array) -> pa.Array:
        lines, n_buckets = _lines(texts), len(gains)
        weights = np.zeros(len(lines))  # whole numbers, exact as doubles
        for owner, crc in features(lines):
            weights += np.bincount(owner, gains[crc % n_buckets], minlength=len(lines))
        n_words = [sum(map(len, common.word_pieces(line))) for line in lines]
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(weights.astype(np.int64))], names=["n_words", "weight"])

    n = F.col("x.n_words")
    n_features = sum((F.greatest(n - i, F.lit(0)) for i in range(1, LONGEST)), n)
    rows = docs.select(F.col(id_col).alias("id"), weigh(F.col(text)).alias("x"))
    id_text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return rows.select("id", n.alias("n_words"), n_features.alias("n_features"), "x.weight", (F.col("x.weight") + noise(id_text, seed)).alias("score"))


class Tournament:
    """The least head of many sorted sources; each match is played again only on the path of the source that moved."""

    OUT = (math.inf,)

    def __init__(self) -> None:
        self.heads: list[tuple] = [self.OUT]
        self.rest: list[Iterator[tuple]] = [iter(())]
        self.free = [0]
        self.winner = [0, 0]  # nodes from 1; the leaves stand behind them

    def _play(self, leaf: int) -> None:
        node = leaf + len(self.heads)
        while node > 1:
            node //= 2
            a, b = self.winner[2 * node], self.winner[2 * node + 1]
            self.winner[node] = a if self.heads[a] <= self.heads[b] else b

    def add(self, source: Iterator[tuple]) -> None:
        if not self.free:
            n = len(self.heads)
            self.heads += [self.OUT] * n
            self.rest += [iter(())] * n
            self.free = list(range(n, 2 * n))
            self.winner = [0] * (2 * n) + list(range(2 * n))
            for leaf in range(2 * n):
                self._play(leaf)
        leaf = self.free.pop()
        self.rest[leaf] = source
        self.heads[leaf] = next(source, self.OUT)
        self._play(leaf)

    def head(self) -> tuple:
        return self.heads[self.winner[1]]

    def pop(self) -> tuple:
        leaf = self.winner[1]
        row, self.heads[leaf] = self.heads[leaf], next(self.rest[leaf], self.OUT)
        if self.heads[leaf] is self.OUT:
            self.free.append(leaf)
        self._play(leaf)
        return row


def _pieces(ends: list[int], piece_rows: int):
    """Rows of a run -> its pieces (range, head_score, head_id, ids, n_features, weights, scores), none across two ranges; ``ends``: least scores of the ranges, falling."""
    falling = -np.array(ends, np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = batch.column("score").to_numpy()
            part = np.searchsorted(falling, -score, side="left")
            first = np.unique(np.concatenate([np.arange(0, len(score), piece_rows), np.flatnonzero(np.diff(part)) + 1]))
            offsets = pa.array(np.append(first, len(score)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, batch.column(c)) for c in ("id", "n_features", "weight", "score")]
            heads = [pa.array(part[first], pa.int32()), pa.array(score[first]), batch.column("id").take(pa.array(first))]
            yield pa.RecordBatch.from_arrays([*heads, *lists], names=["range", "head_score", "head_id", "ids", "n_features", "weights", "scores"])

    return cut


def _merged(before: list[int], draw: int):
    """Pieces by range and head -> rows with their ranks, up to the draw; ``before``: rows above each range."""

    def rows_of(piece: dict) -> Iterator[tuple]:
        return ((-s, i is None, i, n, w) for i, n, w, s in zip(piece["ids"], piece["n_features"], piece["weights"], piece["scores"], strict=True))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tree, part, rank = Tournament(), None, 0
        for batch in batches:
            for piece in batch.to_pylist():
                head = (-piece["head_score"], piece["head_id"] is None, piece["head_id"])
                while tree.head() is not Tournament.OUT and (part != piece["range"] or rank >= draw or tree.head()[:3] < head):
                    rank += 1
                    yield (*tree.pop(), rank)
                if part != piece["range"]:
                    part, rank = piece["range"], before[piece["range"]]
                if rank >= draw:  # nothing is drawn any more: no need of an order
                    yield from ((*row, rank + 1) for row in rows_of(piece))
                else:
                    tree.add(rows_of(piece))
        while tree.head() is not Tournament.OUT:
            rank += 1
            yield (*tree.pop(), rank)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kinds = [first.schema.field("head_id").type, *[pa.int64()] * 4]
        rows = ranked(chain([first], batches))
        while out := list(islice(rows, PIECE_ROWS)):
            columns = [[r[2] for r in out], [r[3] for r in out], [r[4] for r in out], [-r[0] for r in out], [r[5] if r[5] <= draw else None for r in out]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "n_features", "weight", "score", "rank"])

    return merge


def draw_highest(rows: DataFrame, eligible: Column, percent: int = 5, range_rows: int = RANGE_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``rows(id, n_features, weight, score, ...)`` -> (id, n_features, weight, score, rank): ranks from 1 for the floor(percent * N / 100) highest scores of the N eligible rows, null for all others.

    Ties go to the smaller id; null ids come last.  Rows of one id and score are
    equal but for their features and rank by these.
    """
    spark = rows.sparkSession
    order = [F.desc("score"), F.col("id").asc_nulls_last(), "n_features", "weight"]
    runs = common.checkpoint(rows.select("id", "n_features", "weight", "score", F.coalesce(eligible, F.lit(False)).alias("eligible")).sortWithinPartitions(F.desc("eligible"), *order))
    out = ["id", "n_features", "weight", "score"]
    undrawn = lambda df: df.select(*out, F.lit(None).cast("long").alias("rank"))
    running = runs.where("eligible").select(*out)
    n = running.count()
    draw = percent * n // 100
    if not draw:
        return undrawn(runs)

    # Ranges over twice the share that is drawn; the least score of each is a quantile, whose error is far below that share.
    n_ranges = min(MAX_RANGES, max(common.shuffle_partitions(spark), -(-2 * draw // range_rows)))
    share = min(1.0, 2 * percent / 100)
    quantiles = [1 - share * i / n_ranges for i in range(1, n_ranges + 1)]
    found = running.agg(F.percentile_approx("score", quantiles, F.lit(20 * n_ranges * max(1, round(1 / share)))).alias("q")).first()["q"]
    ends = sorted(set(found), reverse=True)
    kind = dict(rows.dtypes)["id"]
    pieces = running.mapInArrow(_pieces(ends, piece_rows), f"range int, head_score long, head_id {kind}, ids array<{kind}>, n_features array<long>, weights array<long>, scores array<long>")
    counts = {r["range"]: r["n"] for r in pieces.groupBy("range").agg(F.sum(F.size("ids")).alias("n")).collect()}  # at most MAX_RANGES + 1 rows
    before, above = [], 0
    for k in range(len(ends) + 1):
        before.append(above)
        above += counts.get(k, 0)
    last = max(k for k, b in enumerate(before) if b < draw)  # the range where the draw ends

    due = pieces.where(F.col("range") <= last).repartitionById(last + 1, F.col("range")).sortWithinPartitions("range", F.desc("head_score"), F.col("head_id").asc_nulls_last())
    merged = due.mapInArrow(common.releasing(_merged(before, draw)), f"id {kind}, n_features long, weight long, score long, rank long")
    below = runs.where(~F.col("eligible")) if last == len(ends) else runs.where(~F.col("eligible") | (F.col("score") < ends[last]))
    return merged.unionByName(undrawn(below))


def importance_resample(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", id_col: str = "doc_id", percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row; rank is null where it isn't drawn.

    Words are runs of letters, digits and non-ASCII characters, with A-Z in lower
    case.  A null or empty text has no features and weight 0.  Repeated rows
    count each and may be drawn each; a null id hashes as empty and loses ties.
    An empty target gives gains by the documents alone, an empty table no rows.
    Other columns are not looked at.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    drawn = draw_highest(weighed(docs, gains, text, id_col, seed), F.col("n_words") >= min_words, percent)
    return drawn.withColumnRenamed("id", id_col)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "benchmark").select("text"))


#: CRC-32 byte by byte over all distinct features at once: a step of the recursion takes one more byte.
OP12_SQL = r"""
WITH RECURSIVE low AS (SELECT 0 AS side, row_number() OVER () AS i, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, i, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
f AS (SELECT side, i, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) || list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS f FROM w),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
steps AS (SELECT b, list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS b)),
r AS (SELECT f, h, 1 AS k, 4294967295::UBIGINT AS c FROM u
  UNION ALL SELECT f, h, k + 2, xor(v, c >> 8) FROM r JOIN steps ON b = xor(c, ('0x' || substr(h, k, 2))::UBIGINT) & 255 WHERE k < length(h)),
b AS (SELECT f, xor(c, 4294967295::UBIGINT) % 10000 AS b FROM r WHERE k > length(h)),
n AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (f) GROUP BY b),
z AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
g AS (SELECT b, CAST(floor(1000 * ln(CAST(n.t + 1 AS DOUBLE) * CAST(z.s + 10000 AS DOUBLE) / (CAST(n.s + 1 AS DOUBLE) * CAST(z.t + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM n, z),
x AS (SELECT i, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight FROM f JOIN b USING (f) JOIN g USING (b) WHERE side = 0 GROUP BY i),
s AS (SELECT w.i, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::UBIGINT AS DOUBLE) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM w LEFT JOIN x USING (i) WHERE side = 0),
o AS (SELECT i, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n FROM s WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM s LEFT JOIN o USING (i)
"""
