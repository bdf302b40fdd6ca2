"""Language of a text by a string kernel, Nyström landmarks and kernel ridge regression.

The kernel is the blended spectrum of presence: two texts are as similar as the
number of runs of one to four characters that both hold, over the geometric mean
of how many each holds.  Runs are hashed to ``DIMS`` places, so a text is a row
of zeros and ones, and kernels of a batch with all landmarks are one matrix
product.  Landmarks and the regression's rows are a bounded sample of labelled
documents, spread over the languages; each language is fitted against the rest.

Only the ids and languages are read to choose the sample, and of its texts no
more than their packed rows reach the driver.  Scoring is row by row: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Documents that the regression is fitted on, at most, in all and of one language, and how many of them are landmarks.
MAX_TRAIN_DOCS = 2000
MAX_LANG_DOCS = 800
LANDMARKS = 200
RIDGE = 1.0
#: Places of the hashed runs, as a power of two, and the longest run.
DIM_BITS = 15
DIMS = 1 << DIM_BITS
LONGEST = 4
#: Texts of one matrix product, and characters that are hashed at once.
BATCH_TEXTS = 128
CHUNK_CHARS = 1 << 18
UNKNOWN = "und"
SPACE = 32


class Model(NamedTuple):
    langs: list[str]
    landmarks: np.ndarray  # packed rows
    weights: np.ndarray  # landmark x language
    bias: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _runs(text: str, longest: int) -> Iterator[np.ndarray]:
    """Lower-case letters with single spaces for all else, in chunks that begin with the end of the one before."""
    before = np.full(1, SPACE, np.uint32)
    for at in range(0, len(text), CHUNK_CHARS):
        codes = np.frombuffer(text[at : at + CHUNK_CHARS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, np.uint32(SPACE))
        kept = codes[(codes != SPACE) | (np.concatenate([before[-1:], codes[:-1]]) != SPACE)]
        before = np.concatenate([before, kept])
        yield before
        before = before[-(longest - 1) :]


def _mark(row: np.ndarray, codes: np.ndarray, longest: int) -> None:
    """Set the places of all runs of up to ``longest`` codes."""
    h = np.zeros(len(codes), np.uint32)
    for n in range(longest):
        if n >= len(codes):
            return
        h = (h[: len(codes) - n] + codes[n:] + np.uint32(1)) * np.uint32(0x9E3779B1)
        row[(h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(32 - DIM_BITS)] = 1


def presence(texts: list[str | None], longest: int = LONGEST) -> np.ndarray:
    """A row of zeros and ones for each text, over the whole of it; of zeros only where it has no letter."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, text in zip(out, texts, strict=True):
        for codes in _runs(text or "", longest):
            if (codes != SPACE).any():
                _mark(row, codes, longest)
    return out


def _normalised(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


def fit(bits: np.ndarray, langs: list[str], n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Regression of 1 for a row's own language and 0 for others; ``bits`` are packed rows, the first of them the landmarks."""
    learned = sorted(set(langs))
    if not learned:
        return Model([], np.zeros((0, DIMS // 8), np.uint8), np.zeros((0, 0)), np.zeros(0))
    marks = _normalised(_unpacked(bits[:n_landmarks]))
    kernel = np.concatenate([_normalised(_unpacked(bits[at : at + BATCH_TEXTS])) @ marks.T for at in range(0, len(bits), BATCH_TEXTS)]).astype(float)
    values, vectors = np.linalg.eigh(kernel[:n_landmarks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # of the inverse
    features = kernel @ root
    wanted = (np.array(langs)[:, None] == np.array(learned)[None]).astype(float)
    balance = (wanted / wanted.sum(0)).sum(1, keepdims=True) * len(langs) / len(learned)  # every language weighs the same
    centre, bias = (features * balance).mean(0), (wanted * balance).mean(0)
    f, y = features - centre, wanted - bias
    beta = np.linalg.solve(f.T @ (f * balance) + ridge * np.eye(f.shape[1]), f.T @ (y * balance))
    return Model(learned, bits[:n_landmarks], root @ beta, bias - centre @ beta)


class Scorer:
    """A model with its landmarks as a matrix, for the batches of a task."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.marks = np.ascontiguousarray(_normalised(_unpacked(model.landmarks)).T)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.model.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        x = presence(texts)
        values = (_normalised(x) @ self.marks).astype(float) @ self.model.weights + self.model.bias
        best, known = values.argmax(1), x.any(1)
        score = np.where(known, np.clip(values[np.arange(len(texts)), best], 0, 1), 0.0)
        return [self.model.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score.tolist()


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS, of_lang: int = MAX_LANG_DOCS) -> DataFrame:
    """(lang, place, bits): labelled documents that aren't held out, taken in turn from every language by the hash of their ids.

    At most ``of_lang`` of a language and ``max_docs`` in all.  Each task ranks
    the ids that it has first, and no more than ``of_lang`` of a language leave it.

    Rows of null ids or languages are left out; of rows that repeat an id and
    language the least text counts.
    """
    keys = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), held_out(id_col).alias("held")).where("id IS NOT NULL AND lang IS NOT NULL AND NOT held")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = keys.select("lang", "id").distinct().withColumn("place", turn).where(F.col("place") <= of_lang).orderBy("place", "lang").limit(max_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")
    texts = rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "place").agg(F.min("text").alias("text"))  # a row for each of at most max_docs

    @F.arrow_udf("binary")
    def packed(values: pa.Array) -> pa.Array:
        return pa.array([np.packbits(presence([v.as_py()])[0].astype(bool)).tobytes() for v in values], pa.binary())

    return texts.select("lang", "place", packed("text").alias("bits"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS, of_lang: int = MAX_LANG_DOCS, landmarks: int = LANDMARKS) -> Model:
    """Fit on the sample; documents without a letter teach nothing."""
    found = sorted(tuple(r) for r in sample(docs, text, lang, id_col, max_docs, of_lang).collect())
    found = sorted((r for r in found if any(r[2])), key=lambda r: (r[1], r[0]))
    bits = np.frombuffer(b"".join(r[2] for r in found), np.uint8).reshape(len(found), DIMS // 8)
    return fit(bits, [r[0] for r in found], landmarks)


def identify(docs: DataFrame, model: Model, text: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """Add the predicted language and the regression's value for it, from 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if nothing was learned.  Texts count as a whole, however long.  Repeated
    texts get equal results, ties go to the first language in order.  Columns
    named like the added ones are an error.
    """
    common.require_absent(docs, lang_name, score_name)
    found = common.fresh_name(docs, "found")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x 4 KB

    @F.arrow_udf("lang string, score double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            langs, scores = [], []
            for at in range(0, len(batch), BATCH_TEXTS):
                some = scorer([t.as_py() for t in batch.slice(at, BATCH_TEXTS)])
                langs += some[0]
                scores += some[1]
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    rows = docs.withColumn(found, scored(F.col(text)))
    return rows.select(*docs.columns, F.col(f"{found}.lang").alias(lang_name), F.col(f"{found}.score").alias(score_name))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
