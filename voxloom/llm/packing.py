"""Lexical retrieval packing.

Document frequencies, the number of documents and their mean length are those
of the whole table, so a BM25 score doesn't depend on how documents are dealt.
Every document ranks a fixed number of leaders, documents taken by hash from the
whole table; in the order of these rankings the table is dealt to tasks, and
inside a task to blocks of bounded token count, the shards of a BM25 inverted
index over token ids.  A window is opened by a seed document (or by the rest of
a document that the window before it cut) and filled with the unused documents
of its shard that score best against all terms of the seed, each cut where the
window ends.  Windows follow each other without gaps, so a task pads its last
window only.

The search of a seed still ends at its shard: documents alike in their ranking
of the leaders share one, others are not found.  README has the measured recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW = 2048
EOS = 1
#: Tokens in one shard of the index, and UTF-8 bytes of text that are tokenised at once.
BLOCK_TOKENS = 1_000_000
CHUNK_BYTES = 6_000_000
#: UTF-8 bytes of text that a task is dealt.
TASK_BYTES = 64 << 20
K1, B = 1.2, 0.75
#: A term that at least one in so many documents of a shard holds has a row over all of them.
DENSE_SHARE = 16
#: Neighbours that are put in order before the others.
SORTED_FIRST = 32
#: Documents that all others rank, at most 256 and the square root of their number, and how many of a ranking count.
LEADERS, RANKED = 256, 8
#: Words whose tokens a Python worker remembers; beyond that, those of the last chunk.
CACHE_WORDS = 400_000
#: Words that one call of the tokenizer encodes.
CALL_WORDS = 5_000
#: Rows whose tokens are returned at once, and rows that rank the leaders at once.
BATCH_ROWS, RANKED_ROWS = 2_000, 256

TAIL = ".,!?;:*|&$%#"
SCHEMA = "{id} {type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after another."""
    ends = np.cumsum(sizes)
    kind = np.int32 if len(ends) and ends[-1] + starts.max() < 1 << 31 else np.int64
    return np.repeat((starts - (ends - sizes)).astype(kind), sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=kind)


def counted(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of documents whose ids follow each other: document, term, how often; by document, then term.  One sort for all."""
    span = int(ids.max(initial=0)) + 1
    kind = np.uint32 if len(sizes) * span < 1 << 32 else np.uint64
    keys = np.repeat(np.arange(len(sizes), dtype=kind) * kind(span), sizes)
    keys += ids.astype(kind, copy=False)
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + kind(1)))
    found = keys[first]
    doc = found // kind(span)
    return doc.astype(np.int32), (found - doc * kind(span)).astype(np.int64), np.diff(first, append=len(keys))


class WordTokens:
    """Token ids of texts, looked up by white-space separated words.

    The tokenizer drops white space and no token crosses it, so a text's ids are
    those of its words.  Letters and a run of punctuation behind them are tokens
    apart, so a word is looked up by its letters; letter words that are new are
    encoded together in one call and told apart by their word-end tokens.  All
    steps work on the distinct words of a chunk as Arrow and NumPy columns.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keys = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, some thousands in one call, as the tokenizer needs a few hundred bytes for each byte of a call."""
        parts = [self._joined(words[i : i + CALL_WORDS]) for i in range(0, len(words), CALL_WORDS)] or [self._each(words)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([sizes for _, sizes in parts])

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or stops[-1] != len(ids):
            return self._each(words)
        return ids, np.diff(stops, prepend=0)

    def _learn(self, keys: pa.Array) -> np.ndarray:
        """Positions of the keys among those that are remembered."""
        at = pc.index_in(keys, value_set=self.keys)
        new = keys.filter(pc.is_null(at))
        letters = pc.utf8_is_alpha(new)
        plain, rest = new.filter(letters), new.filter(pc.invert(letters))
        parts = [self._letters(plain.to_pylist()), self._each(rest.to_pylist())]
        fresh, at = np.asarray(pc.is_null(at)), np.asarray(at.fill_null(0)).astype(np.int64)
        if len(self.keys) + len(new) > CACHE_WORDS:  # what this chunk has stays
            have, at[~fresh] = np.unique(at[~fresh], return_inverse=True)
            starts = np.cumsum(self.sizes) - self.sizes
            self.ids, self.sizes, self.keys = self.ids[ragged(starts[have], self.sizes[have])], self.sizes[have], self.keys.take(pa.array(have, pa.int64()))
        alpha = np.asarray(letters)
        at[np.flatnonzero(fresh)[np.concatenate([np.flatnonzero(alpha), np.flatnonzero(~alpha)])]] = len(self.keys) + np.arange(len(new))
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in parts)])
        self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in parts)])
        self.keys = pa.concat_arrays([self.keys, plain, rest])
        return at

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and how many each has."""
        core = pc.utf8_rtrim(words, TAIL)
        # An upper-case sigma becomes another letter at the end of a word, so the word is taken as it is.
        letters = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring(core, "Σ")))
        keys = pc.if_else(letters, core, words).dictionary_encode()
        at = self._learn(keys.dictionary)[np.asarray(keys.indices)]
        tail = np.where(np.asarray(letters), np.asarray(pc.binary_length(words)) - np.asarray(pc.binary_length(core)), 0)
        known: dict[str, int] = {x: i for i, x in enumerate(["", *TAIL])}
        which, single = np.zeros(len(words), np.int64), np.flatnonzero(tail == 1)
        if len(single):
            _, offsets, data = words.buffers()
            which[single] = _TAIL_NUMBER[np.frombuffer(data, np.uint8)[np.frombuffer(offsets, np.int32)[single + 1] - 1]]
        longer = np.flatnonzero(tail > 1)
        which[longer] = [known.setdefault(w[-n:], len(known)) for w, n in zip(words.take(pa.array(longer, pa.int64())).to_pylist(), tail[longer].tolist(), strict=True)]
        more, more_sizes = self._each(list(known))
        flat = np.concatenate([self.ids, more])
        sizes = np.stack([self.sizes[at], more_sizes[which]], 1)
        starts = np.stack([(np.cumsum(self.sizes) - self.sizes)[at], len(self.ids) + (np.cumsum(more_sizes) - more_sizes)[which]], 1)
        return flat[ragged(starts.ravel(), sizes.ravel())], sizes.sum(1)

    def columns(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Chunk by chunk the first and the last text, their ids with an end id behind each text, and how many ids each has."""
        for first, last in _chunks(np.asarray(pc.binary_length(texts))):
            split = pc.ascii_split_whitespace(texts[first:last])
            words = split.flatten().dictionary_encode()
            ids, sizes = self._words(words.dictionary)
            ids, sizes = np.append(ids, _END), np.append(sizes, 1)
            stops = np.cumsum(np.asarray(pc.list_value_length(split)))
            of = np.insert(np.asarray(words.indices), stops, len(sizes) - 1)
            counts = sizes[of]
            ends = np.cumsum(counts)[stops + np.arange(len(stops))]
            yield first, last, ids[ragged((np.cumsum(sizes) - sizes)[of], counts)], np.diff(ends, prepend=0)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, then the end id."""
        for _, _, ids, sizes in self.columns(pa.array(texts, pa.string())):
            yield from np.split(ids, np.cumsum(sizes)[:-1])


_END = np.array([EOS], "<u4")
_TAIL_NUMBER = np.zeros(256, np.int64)
_TAIL_NUMBER[list(TAIL.encode())] = np.arange(1, len(TAIL) + 1)


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= CHUNK_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


_words: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    if path not in _words:
        _words[path] = WordTokens(path)
    return _words[path]


def forget_words() -> None:
    _words.clear()


class Corpus(NamedTuple):
    """What BM25 takes from the whole table: inverse document frequency by term, mean length in tokens."""

    idf: np.ndarray
    mean_length: float


def corpus_of(n_docs: int, n_tokens: int, df: np.ndarray) -> Corpus:
    return Corpus(np.log1p((n_docs - df + 0.5) / (df + 0.5)), n_tokens / max(n_docs, 1))


class Shard:
    """BM25 inverted index over the token ids of a block of documents; without a corpus the block is all there is."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        length = np.array([len(d) for d in docs], float)
        doc, terms, tf = counted(np.concatenate(docs), length.astype(np.int64))
        sizes = np.bincount(doc, minlength=len(docs))
        corpus = corpus or corpus_of(len(docs), int(length.sum()), np.bincount(terms))
        saturated = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / corpus.mean_length))
        df = np.bincount(terms, minlength=len(corpus.idf))
        self.n, self.starts = len(docs), np.concatenate([[0], np.cumsum(df)])
        self.stops = np.cumsum(sizes)
        self.begins, self.terms, self.length = self.stops - sizes, terms, length.astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self.postings, self.scores = doc[order], (saturated * corpus.idf[terms]).astype(np.float32)[order]
        # Long posting lists are rows over all documents, so that adding them up is one sum.
        often = np.flatnonzero(df * DENSE_SHARE >= max(len(docs), DENSE_SHARE))
        self.row = np.full(len(df), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), len(docs)), np.float32)
        sorted_terms = terms[order]
        long_ = self.row[sorted_terms] >= 0
        self.dense[self.row[sorted_terms[long_]], self.postings[long_]] = self.scores[long_]

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Score of each document against all of the terms."""
        terms = terms[terms < len(self.row)]
        row = self.row[terms]
        out = self.dense[row[row >= 0]].sum(0)
        rare = terms[row < 0]
        sizes = self.starts[rare + 1] - self.starts[rare]
        at = ragged(self.starts[rare], sizes)
        return out + np.bincount(self.postings[at], self.scores[at], self.n)

    def rankings(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For documents whose ids follow each other a row of the shard's documents of best score, one byte for each, ties by position."""
        doc, terms, _ = counted(ids, sizes)
        known = terms < len(self.row)
        doc, terms = doc[known], terms[known]
        row = self.row[terms]
        often, rare = row >= 0, row < 0
        has = np.zeros((len(sizes), len(self.dense)), np.float32)
        has[doc[often], row[often]] = 1
        n = self.starts[terms[rare] + 1] - self.starts[terms[rare]]
        at = ragged(self.starts[terms[rare]], n)
        score = np.bincount(np.repeat(doc[rare].astype(np.int64) * self.n, n) + self.postings[at], self.scores[at], len(sizes) * self.n).reshape(len(sizes), self.n)
        return np.argsort(-(score + has @ self.dense), axis=1, kind="stable")[:, :RANKED].astype(np.uint8)

    def terms_of(self, doc: int) -> np.ndarray:
        return self.terms[self.begins[doc] : self.stops[doc]]

    def only(self, keep: np.ndarray) -> Shard:
        """The shard without the other documents, in the same order."""
        out, number, stays = copy(self), np.cumsum(keep) - 1, keep[self.postings]
        df = np.bincount(np.repeat(np.arange(len(self.row)), np.diff(self.starts))[stays], minlength=len(self.row))
        out.n, out.starts = int(keep.sum()), np.concatenate([[0], np.cumsum(df)])
        out.postings, out.scores, out.dense = number[self.postings[stays]], self.scores[stays], self.dense[:, keep]
        out.begins, out.stops, out.length = self.begins[keep], self.stops[keep], self.length[keep]
        return out

    def neighbours(self, terms: np.ndarray, used: np.ndarray) -> Iterator[int]:
        """Unused documents that hold one of the terms, best first, ties by position."""
        score = self.score(terms)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > SORTED_FIRST:  # mostly a few are asked for
            least = np.partition(score[found], len(found) - SORTED_FIRST)[len(found) - SORTED_FIRST]
            best = found[score[found] >= least]
            yield from best[np.argsort(-score[best], kind="stable")].tolist()
            found = found[score[found] < least]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def fill_order(docs: list[np.ndarray], fill: int, window: int, corpus: Corpus | None = None) -> Iterator[int]:
    """The order in which a shard's documents are laid out, for a window that already holds ``fill`` tokens."""
    shard, number, at = Shard(docs, corpus), np.arange(len(docs)), 0
    used, n_used = np.zeros(len(docs), bool), 0
    ranked: Iterator[int] = iter(())
    for _ in docs:
        pick = next((i for i in ranked if not used[i]), None) if fill else None
        seeds = pick is None
        if seeds:
            while used[at]:
                at += 1
            pick = at
        used[pick] = True
        n_used += 1
        yield int(number[pick])
        crossed = fill + shard.length[pick] >= window
        fill = int(fill + shard.length[pick]) % window
        if crossed or seeds:
            terms, ranked = shard.terms_of(pick), iter(())
            if 2 * n_used > shard.n:
                shard, number = shard.only(~used), number[~used]
                used, n_used, at = np.zeros(shard.n, bool), 0, 0
            if fill:
                ranked = shard.neighbours(terms, used)


def pack_blocks(named: Iterator[tuple[object, np.ndarray]], corpus: Corpus, first_sequence: int, window: int) -> Iterator[dict[str, list]]:
    """(id, tokens) of documents -> columns of pieces, block by block."""
    names, docs, tokens, at = [], [], 0, 0

    def laid_out() -> dict[str, list]:
        nonlocal at
        out: dict[str, list] = {k: [] for k in ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
        for i in fill_order(docs, at % window, window, corpus):
            ids, start = docs[i], 0
            while start < len(ids):
                offset = at % window
                length = min(window - offset, len(ids) - start)
                for column, value in zip(out.values(), (names[i], start, length, ids[start : start + length].astype("<u4").tobytes(), len(ids), first_sequence + at // window, offset), strict=True):
                    column.append(value)
                start, at = start + length, at + length
        return out

    for key, ids in named:
        names.append(key)
        docs.append(ids)
        tokens += len(ids)
        if tokens >= BLOCK_TOKENS:
            yield laid_out()
            names, docs, tokens = [], [], 0
    if docs:
        yield laid_out()


def tokens_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The token ids of each row, of the width in which they were stored."""
    for ids, n in zip(batch["ids"], batch["doc_tokens"].to_pylist(), strict=True):
        raw = ids.as_buffer()
        yield np.frombuffer(raw, f"<u{raw.size // n}")


class Summary:
    """What a task's documents add to the statistics: document frequencies, their number, tokens and least chances."""

    def __init__(self) -> None:
        self.df, self.docs, self.tokens, self.chances = np.zeros(1 << 16, np.int64), 0, 0, np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray, chances: np.ndarray) -> None:
        if len(ids) and ids.max() >= len(self.df):
            self.df = np.concatenate([self.df, np.zeros(int(ids.max()) + 1 - len(self.df), np.int64)])
        self.df += np.bincount(counted(ids, sizes)[1], minlength=len(self.df))
        self.docs, self.tokens = self.docs + len(sizes), self.tokens + len(ids)
        self.chances = np.sort(np.concatenate([self.chances, chances]))[:LEADERS]

    def rows(self) -> Iterator[tuple[str, int, int]]:
        found = np.flatnonzero(self.df)
        yield from (("df", t, n) for t, n in zip(found.tolist(), self.df[found].tolist(), strict=True))
        yield from (("docs", 0, self.docs), ("tokens", 0, self.tokens))
        yield from (("chance", c, 1) for c in self.chances.tolist())


SUMMARY = pa.list_(pa.struct([("kind", pa.string()), ("key", pa.int64()), ("value", pa.int64())]))


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """id, ids, doc_tokens, chance of each row of (id, text), and rows that have only a summary, one for each task.

    chance is a hash of the row; ids have two bytes each where they do.
    """

    @common.releasing
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, summary, schema = word_tokens(tokenizer_path), Summary(), None
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("chance", pa.int64()), ("summary", SUMMARY)])
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                for first, last, ids, sizes in words.columns(part["text"]):
                    ids = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                    summary.add(ids, sizes, np.asarray(part["chance"][first:last]))
                    ends = np.cumsum(np.concatenate([[0], sizes * ids.itemsize]))
                    kind, offset = (pa.binary(), np.int32) if ends[-1] < 1 << 31 else (pa.large_binary(), np.int64)
                    raw = pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(ends.astype(offset)), pa.py_buffer(ids)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([part["id"][first:last], raw, pa.array(sizes, pa.int64()), part["chance"][first:last], pa.nulls(len(sizes), SUMMARY)], schema=schema)
        if schema:
            rows = [dict(zip(("kind", "key", "value"), r, strict=True)) for r in summary.rows()]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, t) for t in schema.types[:-1]] + [pa.array([rows], SUMMARY)], schema=schema)

    kind = dict(docs.dtypes)["id"]
    return docs.withColumn("chance", F.xxhash64("id", "text")).mapInArrow(encoded, f"id {kind}, ids binary, doc_tokens long, chance long, summary array<struct<kind:string,key:long,value:long>>")


def _few_tokens(sizes: list[int]) -> Iterator[slice]:
    """Cut documents so that few rows and tokens are taken at once."""
    first, tokens = 0, 0
    for i, n in enumerate(sizes):
        tokens += n
        if tokens >= BLOCK_TOKENS or i + 1 - first == RANKED_ROWS:
            yield slice(first, i + 1)
            first, tokens = i + 1, 0
    if first < len(sizes):
        yield slice(first, len(sizes))


class Statistics(NamedTuple):
    corpus: Corpus
    last_chance: int  # of the leaders
    n_leaders: int


def statistics(tokens: DataFrame) -> Statistics:
    """Of all documents; the driver gets a row for each term of the vocabulary and one for each leader."""
    rows = common.checkpoint(tokens.where("summary IS NOT NULL").select(F.inline("summary")).groupBy("kind", "key").agg(F.sum("value").alias("value")))
    found = rows.where("kind <> 'chance'").collect()
    size = {r["kind"]: r["value"] for r in found if r["kind"] != "df"}
    terms = [(r["key"], r["value"]) for r in found if r["kind"] == "df"]
    df = np.zeros(max((t for t, _ in terms), default=0) + 1)
    df[[t for t, _ in terms]] = [n for _, n in terms]
    n_leaders = min(LEADERS, math.isqrt(size.get("docs", 0)))
    last = rows.where("kind = 'chance'").select("key").orderBy("key").limit(n_leaders).agg(F.max("key").alias("last")).first()["last"]
    return Statistics(corpus_of(size.get("docs", 0), size.get("tokens", 0), df), last or 0, n_leaders)


def ranked(tokens: DataFrame, known: Statistics) -> DataFrame:
    """Add the ranking of the leaders, documents of least chance in the whole table."""
    rows = tokens.where("summary IS NULL").drop("summary")
    chosen = rows.where(F.col("chance") <= known.last_chance).orderBy("chance", "id").limit(known.n_leaders).collect()
    leaders = [np.frombuffer(r["ids"], f"<u{len(r['ids']) // r['doc_tokens']}") for r in chosen]

    @common.releasing
    def rankings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()  # the worker tokenises no more
        index = Shard(leaders, known.corpus) if leaders else None
        for batch in batches:
            ids = list(tokens_of(batch))
            keys = [row.tobytes() for at in _few_tokens([len(d) for d in ids]) for row in index.rankings(np.concatenate(ids[at]), np.array([len(d) for d in ids[at]]))]
            yield batch.append_column("ranking", pa.array(keys, pa.binary()))

    return rows.mapInArrow(rankings, f"id {dict(rows.dtypes)['id']}, ids binary, doc_tokens long, chance long, ranking binary")


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    ids are the piece's token ids as little-endian unsigned 32-bit integers.  A
    document's tokens are its text's ids and the end id, so null and empty texts
    have one token; every token is in exactly one piece.  Rows are packed as they
    are: repeated rows and repeated or null ids are documents of their own.  An
    empty table gives no rows; other columns are not carried.  An id column named
    like an added one is an error.
    """
    common.require_absent(docs.select(id_col), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    size = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_tasks = max(common.shuffle_partitions(spark), -(-size // TASK_BYTES))
    tokens = common.checkpoint(tokenized(docs.select(F.col(id_col).alias("id"), common.text_or_empty(text).alias("text")), tokenizer_path))
    known = statistics(tokens)
    # Written, as dealing by ranges reads it twice; the row number lets a range end inside a run of equal rows.
    placed = common.checkpoint(ranked(tokens, known).withColumn("row", F.monotonically_increasing_id()))
    order = ("ranking", "chance", "id", "row")
    dealt = placed.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order).select("id", "ids", "doc_tokens")

    @common.releasing
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def named() -> Iterator[tuple[object, np.ndarray]]:
            for batch in batches:
                kinds[:] = [batch.schema.field("id").type]
                yield from zip(batch["id"].to_pylist(), tokens_of(batch), strict=True)

        for out in pack_blocks(named(), known.corpus, TaskContext.get().partitionId() << 32, window):
            types = [kinds[0], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [id_col if k == "id" else k for k in out])

    return dealt.mapInArrow(packed, SCHEMA.format(id=f"`{id_col}`", type=id_type))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(common.table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
