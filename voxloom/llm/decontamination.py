"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to lower-case words; every run of ``window``
words (a shorter text as a whole) is a pattern of the automaton.  A document is
normalised to the same form, scanned once, and hits are mapped back to word
numbers and to character offsets of the original text.  Each row is judged on
its own, so there is no shuffle.

What is broadcast are the benchmark's words, of checked size; a worker makes the
automaton from them, once, and holds no more than one of ``MAX_PATTERNS``
patterns at a time (about 3 KB each).  A larger benchmark is cut by ranges of
its windows: the texts are still read once, and each batch of them is scanned
by the automata of the ranges, one after another.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WORD = re.compile(common.ALNUM_WORD_ANY_CASE)
#: Bytes that are no part of a word become spaces, A-Z become lower case; UTF-8 bytes over 0x7F stay.
BYTE_MAP = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Patterns of one automaton, and UTF-8 bytes of a benchmark.
MAX_PATTERNS = 50_000
MAX_BENCHMARK_BYTES = 256 << 20
RESULT = "n_words long, n_hit long, items array<string>, hit_words array<struct<first:long,end:long>>, hit_chars array<struct<start:long,end:long>>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(BYTE_MAP).split()


def blocks_of(items: list[tuple[str, bytes]], window: int, max_patterns: int) -> Iterator[dict[str, tuple[int, list[str]]]]:
    """Pattern -> its number of words and the items it comes from, at most ``max_patterns`` at once; a pattern may come again in another block."""
    found: dict[str, tuple[int, set[str]]] = {}
    closed = lambda: {k: (n, sorted(ids)) for k, (n, ids) in found.items()}
    for item, line in items:
        words = line.split()
        n = min(window, len(words))
        for i in range(len(words) - n + 1) if n else ():
            key = (b" " + b" ".join(words[i : i + n]) + b" ").decode("latin-1")
            if len(found) == max_patterns and key not in found:
                yield closed()
                found.clear()
            found.setdefault(key, (n, set()))[1].add(item)
    yield closed()


def automaton_of(patterns: dict[str, tuple[int, list[str]]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for key, (n, ids) in patterns.items():
        automaton.add_word(key, (len(key), n, ids))
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton: ahocorasick.Automaton, before: dict | None = None) -> dict:
    """What the automaton finds in a text, joined with what an earlier pass found."""
    words = words_of(text or "")
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    hits = list(automaton.iter(line)) if words and len(automaton) else []
    spans = [(x["first"], x["end"]) for x in before["hit_words"]] if before else []
    items = set(before["items"]) if before else set()
    if hits:
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])  # of the space before each word
        for first, (_, (_, n, ids)) in zip(np.searchsorted(starts, [end - size + 1 for end, (size, _, _) in hits]).tolist(), hits, strict=True):
            spans.append((first, first + n))
            items.update(ids)
    merged: list[list[int]] = []
    for first, end in sorted(set(spans)):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    chars = []
    if merged:
        at = [m.span() for m in WORD.finditer(text)]
        chars = [{"start": at[first][0], "end": at[end - 1][1]} for first, end in merged]
    return {"n_words": len(words), "n_hit": sum(e - b for b, e in merged), "items": sorted(items), "hit_words": [{"first": b, "end": e} for b, e in merged], "hit_chars": chars}


RESULT_TYPE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("hit_words", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("hit_chars", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_built: dict[str, ahocorasick.Automaton] = {}


def _scanner(shared, window: int, max_patterns: int):
    """One pass over the texts; shared: the broadcast words of the benchmark."""
    key = uuid.uuid4().hex

    def automata() -> Iterator[ahocorasick.Automaton]:
        if key in _built:
            yield _built[key]
            return
        _built.clear()
        for k, block in enumerate(blocks_of(shared.value, window, max_patterns)):
            if k:
                _built.clear()  # only an automaton that is the only one is kept
            automaton = automaton_of(block)
            if not k:
                _built[key] = automaton
            yield automaton

    @F.arrow_udf(RESULT)
    def scanned(texts: pa.Array) -> pa.Array:
        found: list[dict | None] = [None] * len(texts)
        for automaton in automata():
            found = [scan(t.as_py(), automaton, b) for t, b in zip(texts, found, strict=True)]
        return pa.array(found, RESULT_TYPE)

    return scanned


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """Add n_words, n_hit, items, hit_words and hit_chars to every document.

    A word is hit when it lies in any occurrence of a benchmark window.  Null
    and empty texts have no words and no hits; benchmark texts without words
    have no window, repeated benchmark rows count once for each item id (a null
    id reads ``None``).  An empty benchmark hits nothing.  hit_words and
    hit_chars are merged half-open ranges, in words from 0 and in code points
    of the original text.  An empty table gives no rows.  Columns named like the
    added ones are an error.

    The benchmark is the stated query set; one of over ``MAX_BENCHMARK_BYTES`` is an error.
    """
    common.require_absent(docs, "n_words", "n_hit", "items", "hit_words", "hit_chars")
    found = common.fresh_name(docs, "found")
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0)).alias("n")).first()["n"]
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"a benchmark of {size} bytes; at most {MAX_BENCHMARK_BYTES} are broadcast")
    items = [(str(r[0]), b" ".join(words_of(r[1] or ""))) for r in benchmark.select(item_id, item_text).distinct().toLocalIterator()]
    scanned = _scanner(docs.sparkSession.sparkContext.broadcast(items), window, max_patterns)
    return docs.withColumn(found, scanned(F.col(text))).select(*docs.columns, f"{found}.*")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
lens AS (SELECT DISTINCT n FROM bw),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM dg JOIN bw USING (n, g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hw.n_hit, 0) AS n_hit, coalesce(hi.n_items, 0) AS n_items,
       sha256(coalesce(hi.items, '')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
