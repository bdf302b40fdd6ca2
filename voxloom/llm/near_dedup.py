"""Near-duplicate groups by SuperMinHash.

1. Each document becomes a set of word shingles and a SuperMinHash signature:
   a shingle's values take the signature's places in the order of its own
   permutation, the j-th value lying between j and j + 1, so a document is done
   as soon as all its values lie below the step that was made.  The permutations
   are the arithmetic progressions modulo the number of places, not shuffled
   ones; README has the variance and the recall that were measured with them.
2. Documents with equal sets are one node from here on.  Signatures are cut into
   bands; nodes that share a band, directly or over others, form a candidate cluster.
3. In each cluster links are confirmed on the full sets.  A document is compared
   with all others of its cluster until no two that were not compared lie in
   different groups, which takes few comparisons where copies hang together and
   loses no link.  A cluster beyond a block is compared inside its blocks, to
   each of which some members of the whole cluster are added.  Two members of
   the largest group that this gives need no comparison; the others meet all
   blocks once more.  So a cluster of copies travels once or twice, whatever its
   size; only one that falls apart is compared block against block.
4. Union-find over the confirmed links gives the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, repeats
from .components import components

#: Places of a signature (a prime, so that each step of a shingle takes another place) and how they are banded.
PLACES, BANDS, ROWS = 127, 25, 5
#: Documents and shingles of a block of a cluster.
BLOCK_DOCS, BLOCK_SHINGLES = 2_000, 2_000_000
#: Members of a cluster of several blocks that are compared with all its blocks first.
PIVOTS = 16
CHUNK_BYTES = 2 << 20
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SIGNATURE = "doc long, n_shingles long, print binary, bands array<long>, h long"
SIGNATURE_TYPE = pa.schema([("doc", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64())), ("h", pa.int64())])


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text, and how many each text has."""
    chunk, _ = repeats.chunk_of([t.translate(LOWER) for t in texts])
    prints, valid = chunk.prints(k)
    short = np.flatnonzero((chunk.counts > 0) & (chunk.counts < k))
    for n in set(chunk.counts[short].tolist()):
        at = chunk.starts[short[chunk.counts[short] == n]]
        prints[at] = chunk.prints(n)[0][at] ^ np.uint64(n)  # not equal to a shingle of k words
        valid[at] = True
    doc = np.repeat(np.arange(len(texts)), chunk.counts)[valid]
    prints = prints[valid]
    order = np.lexsort((prints, doc))
    doc, prints = doc[order], prints[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (prints[1:] != prints[:-1])
    return prints[new], np.bincount(doc[new], minlength=len(texts))


def super_minhash(prints: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of PLACES values for each document; documents without shingles keep the largest value everywhere."""
    out = np.full((len(counts), PLACES), np.iinfo(np.uint64).max)
    flat = out.reshape(-1)
    doc = np.repeat(np.arange(len(counts)), counts)
    stride = 1 + (prints % np.uint64(PLACES - 1)).astype(np.int64)
    place = ((prints >> np.uint64(40)) % np.uint64(PLACES)).astype(np.int64)
    for step in range(PLACES):
        if not len(doc):
            break
        value = (np.uint64(step) << np.uint64(48)) | (repeats._mix(prints + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(16))
        np.minimum.at(flat, doc * PLACES + place, value)
        open_ = (out.max(1) >= np.uint64(step + 1) << np.uint64(48))[doc]
        if not open_.all():
            doc, prints, stride, place = doc[open_], prints[open_], stride[open_], place[open_]
        place = (place + stride) % PLACES
    return out


def _signatures(ids: list[int], texts: list[bytes], hashes: list[int], k: int) -> pa.RecordBatch:
    prints, counts = shingles(texts, k)
    signature = super_minhash(prints, counts)
    bands = np.zeros((len(texts), BANDS), np.uint64)
    for r in range(ROWS):
        bands = repeats._mix(bands + signature[:, r * BANDS : (r + 1) * BANDS])
    ends = np.concatenate([[0], np.cumsum(counts)])
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(repeats._mix(prints ^ salt))]) for salt in (np.uint64(0), _SALT)]
    set_print = np.column_stack([s[ends[1:]] - s[ends[:-1]] for s in sums])
    rows = [
        pa.array(ids, pa.int64()),
        pa.array(counts, pa.int64()),
        pa.array([p.tobytes() if n else None for p, n in zip(set_print, counts.tolist(), strict=True)], pa.binary()),
        pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.view(np.int64).ravel())),
        pa.array(hashes, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(rows, schema=SIGNATURE_TYPE)


_SALT = np.uint64(0xA0761D6478BD642F)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    for ids, texts, hashes in repeats._chunks(batch["doc"], batch["text"], batch["h"]):
        yield ids.tolist(), texts, hashes


def confirmed_links(texts: list[bytes], k: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect what exact comparison of all pairs would connect."""
    prints, counts = shingles(texts, k)
    n = len(texts)
    words, ids = np.unique(prints, return_inverse=True)
    starts = np.cumsum(counts) - counts
    common_words = np.bincount(ids)[ids]
    central = np.add.reduceat(common_words, starts) / counts  # most like the rest first
    group, links = np.arange(n), []
    waiting = np.ones(n, bool)
    mark = np.zeros(len(words), np.int64)
    while True:
        sizes = np.bincount(group[waiting], minlength=n)
        outside = waiting & (group != sizes.argmax())
        if not outside.any():
            return links
        pivot = int(np.argmax(np.where(outside if len(links) or not waiting.all() else waiting, central, -1)))
        waiting[pivot] = False
        own = slice(starts[pivot], starts[pivot] + counts[pivot])
        mark[ids[own]] = 1
        shared = np.add.reduceat(mark[ids], starts)
        mark[ids[own]] = 0
        linked = np.flatnonzero((100 * shared >= percent * (counts + counts[pivot] - shared)) & (group != group[pivot]))
        for other in linked.tolist():
            if group[other] != group[pivot]:
                links.append((pivot, other))
                group[group == group[other]] = group[pivot]


def _blocks(size: str, weight: str) -> Column:
    return F.greatest(F.ceil(F.col(size) / BLOCK_DOCS), F.ceil(F.col(weight) / BLOCK_SHINGLES)).cast("int")


def _outside(members: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """The members (node, h, root, size, n_blocks, n_shingles) of clusters that aren't in the largest group of their cluster so far."""
    known = members.join(groups.select("node", F.col("root").alias("group")), "node", "left").withColumn("group", F.coalesce("group", "node"))
    counted = known.groupBy("root", "group").agg(F.count("*").alias("n"), F.first("size").alias("all"))
    largest = counted.groupBy("root").agg(F.max_by("group", F.struct("n", "group")).alias("largest"), F.first("all").alias("all"))
    rest = common.join_groups(known, largest, "root", "all", n).where(F.col("group") != F.col("largest"))
    return common.checkpoint(rest.select("node", "h", "root", "size", "n_blocks", "n_shingles"))


def _against_all(members: DataFrame, rest: DataFrame, n: int) -> DataFrame:
    """(doc, h, task): blocks of the rest of each cluster, each with all blocks of the cluster in turn."""
    cut = rest.groupBy("root").agg(F.count("*").alias("n_rest"), F.sum("n_shingles").alias("weight"), F.first("size").alias("size")).select("root", "size", _blocks("n_rest", "weight").alias("n_rest"))
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    theirs = common.join_groups(members.drop("size"), cut, "root", "size", n).select("node", "h", "root", "block", numbers("n_rest").alias("other"))
    own = common.join_groups(rest.drop("size"), cut, "root", "size", n).withColumn("other", F.pmod(F.xxhash64("node", "h"), F.col("n_rest")).cast("int")).select("node", "h", "root", numbers("n_blocks").alias("block"), "other")
    return theirs.unionByName(own).distinct().select(F.col("node").alias("doc"), "h", F.xxhash64("root", "block", "other").alias("task"))


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    A document's set holds its distinct shingles of ``k`` words (A-Z in lower
    case; words stand between ASCII white space); fewer words make one shingle
    of all, no words an empty set that is linked with nothing.  Documents are linked when
    100 * shared >= percent * union.  component_id is the smallest id reachable
    over links; the row with that id is kept.  Ids are integers; rows that share
    an id count as one document with the links of all its texts, whose rows share
    a component_id; a row with a null id is linked with nothing, has a null
    component_id and is kept.  An empty table gives no rows; an id column named
    like an added one is an error.
    """
    common.require_absent(docs.select(id_col), "n_shingles", "component_id", "kept")

    @common.releasing
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, hashes in _chunks(batch):
                yield _signatures(ids, texts, hashes, k)

    @common.releasing
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
            found = confirmed_links(texts, k, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

        task, ids, texts, last = None, [], [], None
        for batch in batches:
            for row in zip(batch["task"].to_pylist(), batch["doc"].to_pylist(), batch["h"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                if row[0] != task:
                    if ids:
                        yield links(ids, texts)
                    task, ids, texts, last = row[0], [], [], None
                if row[1:3] != last:  # a repeated row counts once
                    last = row[1:3]
                    ids.append(row[1])
                    texts.append(row[3])
        if ids:
            yield links(ids, texts)

    null_ids = docs.where(F.col(id_col).isNull())
    thin = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), common.text_or_empty(text).alias("text")).withColumn("h", F.xxhash64("text"))
    signed = common.checkpoint(thin.mapInArrow(sign, SIGNATURE))
    n = signed.count()
    filled = signed.where("print IS NOT NULL")
    # A set stands for its rows by one of them: the node is its id, h tells its text from others of that id.
    nodes = filled.groupBy("print").agg(F.min(F.struct("doc", "h")).alias("row"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.max("n_shingles").alias("n_shingles"))
    nodes = common.checkpoint(nodes.select("print", F.col("row.doc").alias("node"), "row.h", "copies", "bands", "n_shingles"))

    bands = nodes.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("size")).where("size > 1")
    candidates = common.join_groups(bands, shared, "key", "size", n * BANDS).select(F.col("first").alias("a"), F.col("node").alias("b"))
    clusters = components(candidates)

    def confirmed(tasks: DataFrame) -> DataFrame:
        rows = thin.join(tasks, ["doc", "h"]).repartition(common.shuffle_partitions(docs.sparkSession), "task").sortWithinPartitions("task", "doc", "h")
        return common.checkpoint(rows.mapInArrow(confirm, "a long, b long"))

    sized = clusters.join(nodes.select("node", "h", "n_shingles"), "node")
    blocks = sized.groupBy("root").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight")).select("root", "size", _blocks("size", "weight").alias("n_blocks"))
    members = common.join_groups(sized, blocks, "root", "size", n).withColumn("block", F.pmod(F.xxhash64("node", "h"), F.col("n_blocks")).cast("int"))
    members = common.checkpoint(members)
    large = members.where("n_blocks > 1")
    pivots = large.groupBy("root", "n_blocks", F.pmod(F.xxhash64("node", "h", F.lit(1)), F.lit(PIVOTS)).alias("of")).agg(F.min(F.struct("node", "h")).alias("row"))
    pivots = pivots.select("row.node", "row.h", "root", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
    links = confirmed(members.select("node", "h", "root", "block").unionByName(pivots).distinct().select(F.col("node").alias("doc"), "h", F.xxhash64("root", "block").alias("task")))
    groups = components(links)
    rest = _outside(large, groups, n)
    if not rest.isEmpty():
        links = links.unionByName(confirmed(_against_all(large, rest, n)))
        groups = components(links)
    again = signed.groupBy("doc").agg(F.count("*").alias("times")).where("times > 1")
    texts_of = common.checkpoint(common.join_groups(filled.select("doc", "print"), again, "doc", "times", n).select("doc", "print").distinct())
    repeats_ids = not texts_of.isEmpty()
    if repeats_ids:  # the sets of a repeated id are one document
        links = links.unionByName(common.join_groups(texts_of, nodes.select("print", "node", "copies"), "print", "copies", n).select(F.col("doc").alias("a"), F.col("node").alias("b")))
        groups = components(links)

    labelled = nodes.select("print", "node", "copies").join(groups, "node", "left").select("print", "copies", F.coalesce("root", "node").alias("component_id"))
    rows = common.join_groups(filled.select("doc", "n_shingles", "print"), labelled, "print", "copies", n).select("doc", "n_shingles", "component_id")
    empty = signed.where("print IS NULL").select("doc", "n_shingles")
    empty = empty.join(groups.select(F.col("node").alias("doc"), "root"), "doc", "left") if repeats_ids else empty.withColumn("root", F.col("doc"))
    rows = rows.unionByName(empty.select("doc", "n_shingles", F.coalesce("root", "doc").alias("component_id")))
    kind = dict(docs.dtypes)[id_col]
    rows = rows.select(F.col("doc").cast(kind).alias(id_col), "n_shingles", F.col("component_id").cast(kind).alias("component_id"), (F.col("doc") == F.col("component_id")).alias("kept"))
    lost = null_ids.select(F.lit(NO_ID).cast("long").alias("doc"), common.text_or_empty(text).alias("text"), F.lit(0).cast("long").alias("h")).mapInArrow(sign, SIGNATURE)
    return rows.unionByName(lost.select(F.lit(None).cast(kind).alias(id_col), "n_shingles", F.lit(None).cast(kind).alias("component_id"), F.lit(True).alias("kept")))


NO_ID = -1


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near duplicates the one with the smallest id.  Rows with null ids stay."""
    dropped = near_groups(docs, k, percent, text, id_col).where("NOT kept").select(id_col).distinct()
    return docs.join(dropped, id_col, "left_anti")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(common.table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=85)


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS g FROM d),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n_shingles, nb.n_shingles HAVING 100 * count(*) >= 85 * (na.n_shingles + nb.n_shingles - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT n.doc_id, n.n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = n.doc_id
"""
