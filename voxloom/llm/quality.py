"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  A line's features are counts over its bytes and
words and how often it occurs in its document, with the same features of the
lines before and after.  The field is fitted on a bounded sample of labelled
documents, whose lines all take the document's label; a document's score is the
mean of its lines' forward-backward marginals, weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Labelled documents that the field is fitted on, at most; the first by hash of their id.
MAX_TRAIN_DOCS = 4000
#: Lines of all these documents together, at most; a document with over a twentieth of them is not in the sample.
MAX_TRAIN_LINES = 200_000
THRESHOLD = 0.3
#: UTF-8 bytes of text handled at once in a worker.
CHUNK_BYTES = 2_000_000

_OTHER, _UPPER, _LOWER, _DIGIT, _STOP, _MARK, _PIPE, _BANG, _SPACE, _HIGH = range(10)
BYTE_CLASS = np.full(256, _OTHER, np.uint8)
for _codes, _kind in ((range(65, 91), _UPPER), (range(97, 123), _LOWER), (range(48, 58), _DIGIT), (b".,;:?'\"()-", _STOP), (b"#$%&*+<=>@[]\\^_`{}~/", _MARK), (b"|", _PIPE), (b"!", _BANG), (b" \t\r\x0b\x0c", _SPACE), (range(128, 256), _HIGH)):
    BYTE_CLASS[list(_codes)] = _kind
N_CLASSES = 10
N_LINE = N_CLASSES + 6
N_FEATURES = 3 * N_LINE + 3


class Lines(NamedTuple):
    features: np.ndarray  # a row for each line
    lengths: np.ndarray  # bytes and the line break
    counts: np.ndarray  # lines of each document


class Field(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of features and a bias, for "good"
    moves: np.ndarray  # 2 x 2, from label to label


def line_features(texts: list[bytes]) -> Lines:
    joined = b"\n".join(texts)
    lines = joined.split(b"\n")
    n, counts = len(lines), np.array([t.count(b"\n") + 1 for t in texts])
    length = np.fromiter(map(len, lines), np.int64, n)
    kind = BYTE_CLASS[np.frombuffer(joined + b"\n", np.uint8)]
    of_class = np.bincount(np.repeat(np.arange(n), length + 1) * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float64)
    of_class[:, _OTHER] -= 1  # its line break
    words = np.array([(len(w), len(set(w))) for w in map(bytes.split, lines)], np.float64).reshape(n, 2)
    doc = np.repeat(np.arange(len(texts)), counts)
    keys = np.fromiter(map(hash, lines), np.int64, n)
    _, same, often = np.unique(np.stack([doc, keys]), axis=1, return_inverse=True, return_counts=True)
    n_words = np.maximum(words[:, 0], 1)
    own = np.column_stack([of_class / np.maximum(length, 1)[:, None], np.log1p(length), np.log1p(words[:, 0]), length / n_words / 10, words[:, 1] / n_words, np.log1p(words[:, 0] - words[:, 1]), np.log(often[same.ravel()])])
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    ends = np.cumsum(counts)
    first[ends - counts], last[ends - 1] = True, True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    return Lines(np.column_stack([own, before, after, first, last, np.log(counts)[doc]]), length + 1, counts)


def _by_step(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents from most lines to fewest, where each starts, and how many have a line at each step."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    return order, starts, np.searchsorted(-counts[order], -np.arange(1, counts.max() + 1), side="right")


def forward_backward(scores: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of "good" against "bad" from the lines up to each one, and from those behind it."""
    forward, backward = scores.copy(), np.zeros_like(scores)
    _, starts, active = _by_step(counts)
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        a = forward[at - 1]
        forward[at] += np.logaddexp(a + moves[1, 1], moves[0, 1]) - np.logaddexp(a + moves[1, 0], moves[0, 0])
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        b = scores[at] + backward[at]
        backward[at - 1] = np.logaddexp(b + moves[1, 1], moves[1, 0]) - np.logaddexp(b + moves[0, 1], moves[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_field(lines: Lines, labels: np.ndarray, rounds: int = 250, rate: float = 0.05, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge, by Adam; every document weighs the same."""
    if not len(labels):
        return Field(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), np.zeros((2, 2)))
    mean, scale = lines.features.mean(0), np.maximum(lines.features.std(0), 1e-6)
    x = np.column_stack([np.clip((lines.features - mean) / scale, -8, 8), np.ones(len(lines.features))])
    y = np.repeat(labels.astype(float), lines.counts)
    weight = np.repeat(1 / lines.counts, lines.counts) / len(labels)
    inner = np.ones(len(y), bool)  # lines that another of their document follows
    inner[np.cumsum(lines.counts) - 1] = False
    at = np.flatnonzero(inner)
    theta = np.zeros(N_FEATURES + 1 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = theta[-4:].reshape(2, 2)
        scores = x @ theta[:-4]
        forward, backward = forward_backward(scores, moves, lines.counts)
        gradient = np.concatenate([x.T @ (weight * (y - _sigmoid(forward + backward))), np.zeros(4)])
        a, b = forward[at], scores[at + 1] + backward[at + 1]
        pair = np.stack([moves[0, 0] + 0 * a, moves[0, 1] + b, moves[1, 0] + a, moves[1, 1] + a + b])
        pair = np.exp(pair - pair.max(0))
        same = np.stack([1 - y[at], 0 * a, 0 * a, y[at]])
        gradient[-4:] = (weight[at] * (same - pair / pair.sum(0))).sum(1)
        gradient -= ridge * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def score_texts(texts: list[bytes], field: Field) -> np.ndarray:
    lines = line_features(texts)
    scores = np.clip((lines.features - field.mean) / field.scale, -8, 8) @ field.weights[:-1] + field.weights[-1]
    forward, backward = forward_backward(scores, field.moves, lines.counts)
    starts = np.cumsum(lines.counts) - lines.counts
    good = np.add.reduceat(_sigmoid(forward + backward) * lines.lengths, starts)
    return np.clip(good / np.add.reduceat(lines.lengths, starts), 0, 1)


def _chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts.cast(pa.binary()):
        chunk.append(text.as_py() or b"")
        size += len(chunk[-1])
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _line_features(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts:
        lines = line_features([(text.as_py() or "").encode("utf-8", "surrogatepass")])
        out.append({"features": lines.features.astype("<f4").tobytes(), "lengths": lines.lengths.astype("<i8").tobytes()})
    return pa.array(out, pa.struct([("features", pa.binary()), ("lengths", pa.binary())]))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train_field(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", max_docs: int = MAX_TRAIN_DOCS, max_lines: int = MAX_TRAIN_LINES) -> Field:
    """Fit on labelled rows that are not held out, a documented bounded sample.

    It takes whole documents, all rows of an id together, in the order of the
    hash of their ids: the first ``max_docs`` ids, of these all with at most
    ``max_lines`` / 20 lines, up to ``max_lines`` lines in total.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label).alias("label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(max_docs)
    sample = common.checkpoint(docs.select(F.col(id_col).alias("id"), common.text_or_empty(text).alias("text")).join(F.broadcast(chosen.select(F.col(id_col).alias("id"), "label")), "id"))
    lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = sample.groupBy("id").agg(F.sum(lines).alias("lines")).where(F.col("lines") * 20 <= max_lines)  # a row for each of at most max_docs ids
    up_to = F.sum("lines").over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("id"), "id"))
    kept = sizes.withColumn("up_to", up_to).where(F.col("up_to") <= max_lines).select("id")
    rows = sample.join(F.broadcast(kept), "id", "left_semi").select("id", "label", F.arrow_udf(_line_features, "features binary, lengths binary")("text").alias("x")).select("id", "label", "x.*").collect()
    rows = sorted(rows, key=lambda r: (r[0], r["features"]))
    if not rows:
        return fit_field(Lines(np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(0, int)), np.zeros(0))
    features = [np.frombuffer(r["features"], "<f4").reshape(-1, N_FEATURES) for r in rows]
    lines = Lines(np.concatenate(features).astype(float), np.concatenate([np.frombuffer(r["lengths"], "<i8") for r in rows]), np.array([len(f) for f in features]))
    return fit_field(lines, np.array([r["label"] for r in rows]))


def score_quality(docs: DataFrame, field: Field, text: str = "text", name: str = "score") -> DataFrame:
    """Add the document score, 0 (bad) to 1 (good).

    A null text counts as empty; an empty text is one empty line and has a score
    like others.  Repeated rows get equal scores.  The text is the only input.
    Without labelled rows the field knows nothing and every score is 0.5.
    """
    common.require_absent(docs, name)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [score_texts(chunk, field) for chunk in _chunks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.withColumn(name, scored(F.col(text)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train_field(docs, common.table(spark, sf_dir, "labels"))
    return score_quality(docs, field).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
