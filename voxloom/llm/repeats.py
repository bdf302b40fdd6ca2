"""Passages of ``window`` words that repeat across documents: the parts that two operators share.

Anchors are runs of half a window.  Two rounds go through the same exchange:

1. Each document offers the fingerprints of its anchors.  A fingerprint that
   occurs in two documents is sent back to them.
2. Shared anchors are extended left and right to the whole windows that hold
   them, whose 128-bit fingerprints (two hashes of different kinds) meet in the
   same way; one that also starts in a document with a smaller id is sent back
   to the document, which joins its windows to maximal repeats and removes them.

Fingerprints travel in packed messages, one for each chunk of documents and
bucket, so a row costs no more than a few bytes for each word.  Where there are
more buckets than ``FAN``, messages go in two steps, first by ranges of about the
square root of their number and there, packed again, by bucket; so their number
grows little faster than the input and not with its square.  A range is cut by
salt, so all tasks take part whatever the number of ranges.  In each step a fingerprint is sent on once,
however many documents have it, and what is already decided is passed on under a
spread key; so a passage that a third of all documents share never gathers in
one task.  Links are never listed in pairs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 50
#: UTF-8 bytes of text that make up a chunk, that are hashed at once, and that a bucket stands for.
CHUNK_BYTES = 4 << 20
HASH_BYTES = 1 << 18
BUCKET_BYTES = 16 << 20
#: Buckets that a chunk writes to at most, and fingerprints that a task packs again at once.
FAN = 8192
REPACK = 4_000_000
#: Replies go out by document and bucket; with few buckets their number would not follow the input.
MIN_BUCKETS = 64
#: A null id counts as larger than any other.
NULL_ID = (1 << 63) - 1
MESSAGE = "to int, bucket int, decided boolean, docs binary, counts binary, flags binary, prints binary"
MESSAGE_TYPE = pa.schema([("to", pa.int32()), ("bucket", pa.int32()), ("decided", pa.bool_()), ("docs", pa.binary()), ("counts", pa.binary()), ("flags", pa.binary()), ("prints", pa.binary())])
REPLY = "doc long, prints binary"
REPLY_TYPE = pa.schema([("doc", pa.int64()), ("prints", pa.binary())])

_BYTE_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. n - 1, modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, HASH_BYTES + 1), base)
        have[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(have)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end], each as if it stood at 0."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _power(inverse, len(values) + 1)[starts]


def _by_place(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of a hash of each byte and its place in the word: unlike a polynomial, no words collide whatever its base."""
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(starts, ends - starts).astype(np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mix(codes + (place << np.uint64(8)) + _WORD_BASE), out=sums[1:])
    return sums[ends] - sums[starts]


def word_hashes(words: list[bytes], second: bool = False) -> np.ndarray:
    """64 bits for each word, whatever stands around it; ``second``: 64 others."""
    out, first, size = [], 0, 0
    for i, word in enumerate(words):
        size += len(word)
        if size >= HASH_BYTES or i == len(words) - 1:
            part = words[first : i + 1]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            ends = np.cumsum(lengths)
            codes = np.frombuffer(b"".join(part), np.uint8).astype(np.uint64) + np.uint64(1)
            summed = _by_place(codes, ends - lengths, ends) if second else _ranges(codes, _BYTE_BASE, ends - lengths, ends)
            out.append(_mix(summed + lengths.astype(np.uint64)))
            first, size = i + 1, 0
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Chunk(NamedTuple):
    hashes: np.ndarray  # of the words
    counts: np.ndarray  # words of each document
    starts: np.ndarray  # first word of each document
    others: np.ndarray | None = None  # second hashes of the words

    def long_prints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``prints`` with a second column of independent hashes."""
        first, valid = self.prints(n)
        second, _ = self._replace(hashes=self.others).prints(n)
        return np.stack([first, second], 1), valid

    def prints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the n words from each word on, and whether they lie in one document."""
        at = np.arange(len(self.hashes))
        valid = at + n <= np.repeat(self.starts + self.counts, self.counts)
        prints = _mix(_ranges(self.hashes, _WORD_BASE, at, np.minimum(at + n, len(at))))
        return prints, valid

    def place(self) -> np.ndarray:
        """Position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.starts, self.counts)


def chunk_of(texts: list[bytes], twice: bool = False) -> tuple[Chunk, list[bytes]]:
    split = [t.split() for t in texts]  # at bytes 0x20 and 0x09 to 0x0D
    words = [w for ws in split for w in ws]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return Chunk(word_hashes(words), counts, np.cumsum(counts) - counts, word_hashes(words, True) if twice else None), words


#: What an operator chooses: (chunk, fingerprints, valid) -> which are offered, which count as reference.
Chooser = Callable[[Chunk, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, dtype: str, width: int) -> np.ndarray:
    """Rows of ``width`` numbers."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize * width, -1).T).view(dtype)


def anchor_keys(prints: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each anchor and 32 more bits, which are all that travel to the bucket."""
    n = np.uint64(n_buckets)
    return (((prints % n) << np.uint64(32)) | ((prints // n) & np.uint64(0xFFFFFFFF)))[:, None]


def _bucket(prints: np.ndarray, n_buckets: int) -> np.ndarray:
    return (prints[:, 0] % np.uint64(n_buckets) if prints.shape[1] > 1 else prints[:, 0] >> np.uint64(32)).astype(np.int32)


def _payload(prints: np.ndarray, to_range: int) -> bytes:
    if prints.shape[1] == 1 and to_range == 1:
        return _planes(prints[:, 0].astype(np.uint32))
    return _planes(np.ascontiguousarray(prints))


def _sorted_runs(keys: list[np.ndarray], prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by fingerprint and then by keys (the last one first), where each run of equal fingerprints starts, and the run of each."""
    order = np.lexsort((*keys, *prints.T[::-1]))
    ordered = prints[order]
    begins = np.flatnonzero(np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)]))
    return order, begins, np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(ordered))))


def _messages(docs: np.ndarray, prints: np.ndarray, flags: np.ndarray, bucket: np.ndarray, n_buckets: int, to_range: int, decided: bool, spread: int) -> Iterator[tuple]:
    """Rows are in the order of their documents.  Messages go to single buckets or to ranges of ``to_range``."""
    part = bucket // to_range
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0]))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        at = order[a:b]
        own, to = docs[at], int(part[at[0]])
        change = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts = np.diff(np.append(change, len(at)))
        yield ((spread + to) % -(-n_buckets // to_range) if decided else to, to, decided, own[change].tobytes(), counts.astype(np.uint32).tobytes(), np.packbits(flags[at]).tobytes(), _payload(prints[at], to_range))


def offer(docs: np.ndarray, prints: np.ndarray, flags: np.ndarray, n_buckets: int, to_range: int, smaller: bool) -> Iterator[tuple]:
    """Messages of what some documents offer.  smaller: only what a smaller id has too is decided (round two), else what two ids have."""
    if not len(docs):
        return
    spread = int(_mix(docs[:1].view(np.uint64))[0] % np.uint64(n_buckets))
    order, begins, run = _sorted_runs([flags, docs] if smaller else [~flags], prints)
    docs, prints, flags = docs[order], prints[order], flags[order]
    least, most = np.minimum.reduceat(docs, begins), np.maximum.reduceat(docs, begins)
    bucket = _bucket(prints, n_buckets)
    known = np.flatnonzero(docs > least[run] if smaller else (least != most)[run])
    for at, decided in ((known, True), (begins, False)):
        at = at[np.argsort(docs[at], kind="stable")]
        if len(at):
            yield from _messages(docs[at], prints[at], flags[at], bucket[at], n_buckets, to_range, decided, spread)


def _replies(docs: np.ndarray, prints: np.ndarray) -> Iterator[tuple]:
    order, begins, _ = _sorted_runs([docs], prints)
    docs, prints = docs[order], prints[order]
    keep = np.ones(len(docs), bool)
    keep[1:] = (docs[1:] != docs[:-1]) | (prints[1:] != prints[:-1]).any(1)
    docs, prints = docs[keep], prints[keep]
    order = np.argsort(docs, kind="stable")
    docs, prints = docs[order], prints[order]
    begins = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(docs)], strict=True):
        yield int(docs[a]), prints[a:b].tobytes()


def _opened(message: tuple, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """docs, fingerprints and flags of a message."""
    bucket, _, docs, counts, flags, prints = message
    docs = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32))
    if len(prints) == 4 * len(docs):
        prints = _from_planes(prints, "<u4", 1).astype(np.uint64) | np.uint64(bucket << 32)
    else:
        prints = _from_planes(prints, "<u8", width)
    return docs, prints, np.unpackbits(np.frombuffer(flags, np.uint8), count=len(prints)).astype(bool)


def meet(messages: list[tuple], smaller: bool) -> Iterator[tuple]:
    """What a bucket's messages decide: (doc, fingerprints)."""
    width, open_ = 2 if smaller else 1, []
    for message in messages:
        if message[1]:
            docs, prints, _ = _opened(message, width)
            yield from _replies(docs, prints)
        else:
            open_.append(_opened(message, width))
    if not open_:
        return
    docs, prints, flag = (np.concatenate(x) for x in zip(*open_, strict=True))
    order, begins, run = _sorted_runs([], prints)  # neighbours in this order have equal fingerprints
    docs, prints, flag = docs[order], prints[order], flag[order]
    least = np.minimum.reduceat(docs, begins)
    if smaller:
        found = docs > least[run]
    else:
        found = ((least != np.maximum.reduceat(docs, begins)) & np.logical_or.reduceat(flag, begins))[run]
    if found.any():
        yield from _replies(docs[found], prints[found])


def _chunks(ids: pa.Array, texts: pa.Array, extra: pa.Array | None = None) -> Iterator[tuple[np.ndarray, list[bytes], list]]:
    keys, part, more, size = [], [], [], 0
    for i, text in enumerate(texts.cast(pa.binary())):
        keys.append(ids[i].as_py())
        part.append(text.as_py() or b"")
        more.append(extra[i].as_py() if extra is not None else None)
        size += len(part[-1])
        if size >= CHUNK_BYTES:
            yield np.array(keys, np.int64), part, more
            keys, part, more, size = [], [], [], 0
    if keys:
        yield np.array(keys, np.int64), part, more


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _member(prints: np.ndarray, replies: list[dict] | None) -> np.ndarray:
    """Which fingerprints were sent back."""
    if not replies or not len(prints):
        return np.zeros(len(prints), bool)
    wanted = np.concatenate([np.frombuffer(r["prints"], "<u8") for r in replies]).reshape(-1, prints.shape[1])
    out = np.isin(prints[:, 0], wanted[:, 0])
    if prints.shape[1] > 1:
        both = lambda p: _mix(p[:, 0]) ^ (p[:, 1] * _BYTE_BASE)
        out &= np.isin(both(prints), both(wanted))
    return out


FIELDS = ["bucket", "decided", "docs", "counts", "flags", "prints"]


def _rows(batch: pa.RecordBatch | pa.Table) -> list[tuple]:
    return list(zip(*(batch[c].to_pylist() for c in FIELDS), strict=True))


def range_size(n_buckets: int) -> int:
    """Buckets of a range; 1 where messages go to their buckets at once."""
    return math.isqrt(n_buckets - 1) + 1 if n_buckets > FAN else 1


def _by_range(messages: DataFrame, n_buckets: int) -> DataFrame:
    """Dealt by range and salt, a task for four buckets' worth of text."""
    salt = F.pmod(F.xxhash64("docs"), F.lit(8 * range_size(n_buckets)))  # many for each task, so that tasks are alike
    return messages.repartition(max(common.shuffle_partitions(messages.sparkSession), -(-n_buckets // 4)), "to", salt)


def _repacked(messages: DataFrame, n_buckets: int, smaller: bool) -> DataFrame:
    """Messages to ranges of buckets -> messages to buckets; equal fingerprints that arrive in a task become one, decided ones go anywhere."""

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            docs, prints, flags = (np.concatenate(x) for x in zip(*waiting, strict=True))
            yield _batch(list(offer(docs, prints, flags, n_buckets, 1, smaller)), MESSAGE_TYPE)

        for batch in batches:
            passed = []
            for message in _rows(batch):
                if message[1]:
                    passed.append((zlib.crc32(message[2]) % n_buckets, *message))
                    continue
                waiting.append(_opened(message, 2 if smaller else 1))
                size += len(waiting[-1][0])
                if size >= REPACK:
                    yield from packed()
                    waiting, size = [], 0
            if passed:
                yield _batch(passed, MESSAGE_TYPE)
        if waiting:
            yield from packed()

    return _by_range(messages, n_buckets).mapInArrow(repack, MESSAGE)


def _meeting(messages: DataFrame, n_buckets: int, smaller: bool) -> DataFrame:
    """Replies to each document: (doc, replies)."""

    def met(table: pa.Table) -> pa.Table:
        rows = list(meet(_rows(table), smaller))
        return pa.Table.from_batches([_batch(rows, REPLY_TYPE)] if rows else [], schema=REPLY_TYPE)

    if n_buckets > FAN:
        messages = _repacked(messages, n_buckets, smaller)
    return messages.groupBy("to").applyInArrow(met, REPLY).groupBy("doc").agg(F.collect_list(F.struct("prints")).alias("replies"))


CLEANED = "n_words long, n_removed long, kept_text string, removed_words array<struct<first:long,end:long>>"
CLEANED_TYPE = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed_words", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))])


def remove_repeats(docs: DataFrame, choose: Chooser, window: int = WINDOW, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Add n_words, n_removed, kept_text and removed_words to every row; see the operators for the rules."""
    common.require_absent(docs, "n_words", "n_removed", "kept_text", "removed_words")
    key, back, out = (common.fresh_name(docs, x) for x in ("key", "replies", "out"))
    half = window // 2
    size = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_buckets = max(MIN_BUCKETS, common.shuffle_partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    to_range = range_size(n_buckets)
    row_key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, _ in _chunks(batch["doc"], batch["text"]):
                chunk, _ = chunk_of(texts)
                prints, valid = chunk.prints(half)
                valid &= np.repeat(chunk.counts >= window, chunk.counts)
                offered, reference = choose(chunk, prints, valid)
                at = np.flatnonzero(offered & valid)
                rows = list(offer(np.repeat(ids, chunk.counts)[at], anchor_keys(prints[at], n_buckets), reference[at], n_buckets, to_range, False))
                if rows:
                    yield _batch(rows, MESSAGE_TYPE)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, replies in _chunks(batch[key], batch[text], batch[back]):
                chunk, _ = chunk_of(texts, twice=True)
                prints, valid = chunk.prints(half)
                keys, shared = anchor_keys(prints, n_buckets), np.zeros(len(prints), bool)
                for a, n, r in zip(chunk.starts.tolist(), chunk.counts.tolist(), replies, strict=True):
                    shared[a : a + n] = _member(keys[a : a + n], r)
                sums = np.concatenate([[0], np.cumsum(shared & valid)])
                whole, inside = chunk.long_prints(window)
                at = np.arange(len(whole))
                inside &= sums[np.minimum(at + window - half + 1, len(at))] > sums[at]
                at = np.flatnonzero(inside)
                rows = list(offer(np.repeat(ids, chunk.counts)[at], whole[at], np.zeros(len(at), bool), n_buckets, to_range, True))
                if rows:
                    yield _batch(rows, MESSAGE_TYPE)

    @F.arrow_udf(CLEANED)
    def cleaned(texts: pa.Array, replies: pa.Array) -> pa.Array:
        rows = []
        for text, reply in zip(texts, replies, strict=True):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            if reply.as_py():
                chunk, words = chunk_of([b" ".join(words)], twice=True)
                prints, valid = chunk.long_prints(window)
                starts = np.flatnonzero(_member(prints, reply.as_py()) & valid)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                keep = np.cumsum(edge)[:-1] == 0
                kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                turns = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8))).reshape(-1, 2)
                spans = [{"first": a, "end": b} for a, b in turns.tolist()]
            else:
                kept, spans = words, []
            rows.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept_text": b" ".join(kept).decode("utf-8", "surrogatepass"), "removed_words": spans})
        return pa.array(rows, CLEANED_TYPE)

    thin = docs.select(row_key.alias("doc"), common.text_or_empty(text).alias("text"))
    # Both joins read the same columns of a table that has no others, so its texts are shuffled once.
    keyed = docs.withColumn(key, row_key)
    carried = keyed if len(docs.columns) <= 2 else keyed.select(key, text)
    to_key = lambda replies: replies.select(F.col("doc").alias(key), F.col("replies").alias(back))
    shared = _meeting(thin.mapInArrow(anchors, MESSAGE), n_buckets, smaller=False)
    removed = _meeting(carried.join(to_key(shared), key).mapInArrow(windows, MESSAGE), n_buckets, smaller=True)
    return keyed.join(to_key(removed), key, "left").withColumn(out, cleaned(F.col(text), F.col(back))).select(*docs.columns, f"{out}.*")
