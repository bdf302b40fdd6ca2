"""Personal data by weak supervision (DataFrame functions only on the executors).

Fixed base patterns give spans that always stay.  A wider set of patterns gives
candidate spans; labelers (format checks, gazetteers, context words) vote on
each, and features of its own describe it.  The candidates of all documents are
counted by kind, votes and features, which is bounded by the values that these
can take however large the corpus is.  Expectation-maximisation on those counts
estimates, for each kind, how common personal data is among its candidates and
how reliable each labeler; a logistic span classifier over the features alone is
fitted to the resulting posteriors.  It sees a candidate's form and surroundings
and not its votes, so it also judges candidates on which no labeler has an
opinion.  Labelers and classifier are then added up: the votes' log odds and the
classifier's, with weights that a ridge holds near 0.7 and 0.3, as the posteriors
alone would give all weight to the votes that they come from.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed values.  The forms find the same spans as the plain ones in the tests; possessive
#: quantifiers and look-behinds keep them linear on long runs of one class.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Candidate kinds beyond the base.
WIDE = {
    "email_spelt": r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,4}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?(?![A-Za-z])",
    "phone_local": r"(?<![0-9+A-Za-z])\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: Text in which a wide candidate can occur at all.
WIDE_GATE = r"[\[(]at[\])]|[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}|(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z]|[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
CONTEXT = 40
#: Gazetteers; fixed values.
TOP_LEVEL = ["com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "us", "uk", "de", "fr", "es", "it", "nl", "eu", "ch", "at", "ca", "au", "jp"]
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}
GIVEN_NAMES = [
    "Adam", "Alice", "Amy", "Andrea", "Andrew", "Anna", "Anthony", "Antonio", "Barbara", "Brian", "Carlos", "Carmen", "Charles", "Christine", "Christopher", "Claire", "Daniel", "David", "Diana", "Donald",
    "Edward", "Elena", "Elizabeth", "Emily", "Emma", "Eric", "Frank", "George", "Grace", "Hans", "Helen", "Henry", "Jack", "James", "Jane", "Jean", "Jennifer", "Jessica", "John", "Jorge",
    "Jose", "Joseph", "Juan", "Julia", "Karen", "Kevin", "Klaus", "Laura", "Linda", "Lisa", "Louis", "Lucy", "Luis", "Maria", "Marie", "Mark", "Martin", "Mary", "Matthew", "Michael",
    "Nancy", "Nicolas", "Olivia", "Patricia", "Paul", "Peter", "Philip", "Pierre", "Rachel", "Richard", "Robert", "Rosa", "Ruth", "Samuel", "Sandra", "Sara", "Sarah", "Simon", "Sofia", "Sophie",
    "Stephen", "Steven", "Susan", "Thomas", "Ursula", "Victor", "Walter", "William",
]
FAMILY_NAMES = [
    "Adams", "Allen", "Anderson", "Baker", "Becker", "Bell", "Bernard", "Brown", "Campbell", "Carter", "Clark", "Cohen", "Collins", "Cook", "Cooper", "Davis", "Diaz", "Dubois", "Evans", "Fernandez",
    "Fischer", "Fisher", "Garcia", "Gonzalez", "Green", "Hall", "Harris", "Hernandez", "Hill", "Hoffmann", "Jackson", "Johnson", "Jones", "Kelly", "King", "Klein", "Koch", "Lee", "Lewis", "Lopez",
    "Martin", "Martinez", "Mayer", "Miller", "Mitchell", "Moore", "Morgan", "Morris", "Murphy", "Nelson", "Parker", "Perez", "Phillips", "Reed", "Richter", "Roberts", "Robinson", "Rodriguez", "Ross", "Sanchez",
    "Schmidt", "Schneider", "Scott", "Smith", "Stewart", "Taylor", "Thomas", "Thompson", "Torres", "Turner", "Wagner", "Walker", "Ward", "Watson", "Weber", "White", "Williams", "Wilson", "Wood", "Wright", "Young",
]
#: Exchange codes and area codes that no telephone has, and area numbers and groups that were published in examples or advertisements.
FICTIONAL_EXCHANGES, SERVICE_AREAS = ["555"], ["211", "311", "411", "511", "611", "711", "811", "911", "900", "976"]
EXAMPLE_NUMBERS = ["078051120", "219099999", "123456789", "111111111", "222222222", "333333333", "444444444", "555555555", "777777777", "888888888", "999999999"]
NEAR = {
    "email_spelt": "e-?mail|mail|contact|write|reach|courriel|correo",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "person": "name|by|from|dear|contact|patient|author|herr|frau|madame|monsieur|se[nñ]or",
    "phone_local": "phone|tel|call|mobile|cell|fax|t[eé]l[eé]phone|telefon|tel[eé]fono",
    "ssn": "ssn|social security|tax|taxpayer|insurance",
}
AGAINST = "isbn|issn|version|serial|order|invoice|part|model|page|chapter|item|score"
LABELERS = ["format", "gazetteer", "near", "against", "alone"]
SPAN = "struct<kind:string,start:int,end:int>"
#: What the classifier sees of a candidate, each a small whole number from 0 to 3.
FEATURES = ["length", "digit_share", "separators", "word_before", "word_after", "line_start", "digits_near", "many"]
LEVELS = 4
WIDE_SPAN = "array<struct<kind:string,start:int,end:int,votes:array<int>,features:array<int>>>"


def _span_of(kind: str, **more: Callable[[Column], list[Column]]) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), *(F.array(*of(x)).alias(name) for name, of in more.items()))


def base_spans(text: Column) -> Column:
    """array<struct<kind,start,end>> of the base kinds, by kind as listed, then start."""
    digits = lambda x: F.regexp_replace(x["found"], "[^0-9]", "")
    checks = {
        "email": (F.contains(text, F.lit("@")), lambda x: F.lit(True)),
        "ip": (F.contains(text, F.lit(".")) & text.rlike(r"[0-9]\.[0-9]"), lambda x: x["found"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        "card": (text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), lambda x: F.length(digits(x)).between(16, 19) & F.call_function("luhn_check", digits(x))),
        "phone": (text.rlike(r"\+[0-9]"), lambda x: F.length(digits(x)).between(8, 15)),
    }
    kinds = []
    for kind, (gate, good) in checks.items():
        spans = F.transform(F.filter(common.occurrences(text, F.lit(BASE[kind])), good), _span_of(kind))
        kinds.append(F.when(gate, spans).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.concat(*kinds)


def _around(text: Column, x: Column) -> tuple[Column, Column]:
    """Up to CONTEXT characters before and after a candidate."""
    return F.substring(text, F.greatest(F.lit(1), x["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), x["start"])), F.substring(text, x["end"] + 1, F.lit(CONTEXT))


def _votes(text: Column, kind: str, x: Column) -> list[Column]:
    """1 for personal data, -1 against, 0 for no opinion; in the order of LABELERS."""
    found, digits, plain = x["found"], F.regexp_replace(x["found"], "[^0-9]", ""), F.regexp_replace(x["found"], " ", "")
    around = F.lower(F.concat_ws(" ", *_around(text, x)))
    vote = lambda yes, no=None: F.when(yes, 1).when(no if no is not None else F.lit(False), -1).otherwise(0)
    bad_ssn = digits.rlike("^(?:000|666|9)|^[0-9]{3}00|0000$")
    form = {
        "email_spelt": vote(found.rlike(r"[A-Za-z]"), ~found.rlike(r"[A-Za-z]")),
        "iban": vote(F.length(plain).between(15, 34), F.length(plain) > 34),
        "person": vote(found.rlike(r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$")),
        "phone_local": vote(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[0-9]{3}[01]")),
        "ssn": vote(~bad_ssn, bad_ssn),
    }[kind]
    country = F.create_map(*(F.lit(v) for kv in IBAN_LENGTHS.items() for v in kv))
    names = F.split(F.regexp_replace(found, r"^[A-Za-z]+\.?\x20", ""), " ")
    last = F.lower(F.regexp_extract(found, r"([A-Za-z]+)$", 1))
    gazetteer = {
        "email_spelt": vote(last.isin(TOP_LEVEL), ~last.isin(TOP_LEVEL)),
        "iban": vote(F.try_element_at(country, F.substring(plain, 1, 2)) == F.length(plain), F.coalesce(F.try_element_at(country, F.substring(plain, 1, 2)), F.lit(0)) != F.length(plain)),
        "person": vote(F.arrays_overlap(names, F.array(*map(F.lit, [*GIVEN_NAMES, *FAMILY_NAMES])))),
        "phone_local": vote(F.lit(False), F.substring(digits, 4, 3).isin(FICTIONAL_EXCHANGES) | F.substring(digits, 1, 3).isin(SERVICE_AREAS)),
        "ssn": vote(F.lit(False), digits.isin(EXAMPLE_NUMBERS)),
    }[kind]
    outside = F.concat(F.substring(text, x["start"], F.when(x["start"] > 0, 1).otherwise(0)), F.lit("|"), F.substring(text, x["end"] + 1, F.lit(1)))
    return [v.cast("int") for v in (form, gazetteer, vote(around.rlike(rf"\b(?:{NEAR[kind]})\b")), F.when(around.rlike(rf"\b(?:{AGAINST})\b"), -1).otherwise(0), F.when(outside.rlike(r"[/#=_\\@]"), -1).otherwise(0))]


def _features(text: Column, x: Column) -> list[Column]:
    """In the order of FEATURES."""
    before, after = _around(text, x)
    size, found = x["end"] - x["start"], x["found"]
    level = lambda value, *limits: sum(((value >= limit).cast("int") for limit in limits), F.lit(0))
    marks = F.length(F.regexp_replace(found, "[A-Za-z0-9]", ""))
    return [
        level(size, 12, 16, 24),
        level(F.length(F.regexp_replace(found, "[^0-9]", "")) * 4, size, 2 * size, 3 * size),
        level(marks, 2, 3, 5),
        F.when(before.rlike(r"[A-Za-z]:\s*$"), 3).when(before.rlike(r"[a-z]\s*$"), 2).when(before.rlike(r"[A-Z]\s*$"), 1).otherwise(0),
        F.when(after.rlike(r"^\s*[.,;]"), 3).when(after.rlike(r"^\s*[a-z]"), 2).when(after.rlike(r"^\s*[A-Z]"), 1).otherwise(0),
        before.rlike(r"(?:^|\n)\s*$").cast("int"),
        level(F.length(F.regexp_replace(F.concat(before, after), "[^0-9]", "")), 1, 6, 20),
        before.rlike(r"[0-9]{3}[^0-9][0-9]{2}").cast("int"),
    ]


def wide_spans(text: Column) -> Column:
    """Candidates of the wide kinds with their votes and features."""
    kinds = [F.transform(common.occurrences(text, F.lit(regex)), _span_of(kind, votes=partial(_votes, text, kind), features=partial(_features, text))) for kind, regex in WIDE.items()]
    return F.when(text.rlike(WIDE_GATE), F.concat(*kinds)).otherwise(F.array().cast(WIDE_SPAN))


class SpanModel(NamedTuple):
    """By kind: how common personal data is among the candidates, how reliable each labeler; then the classifier."""

    prior: dict[str, float]
    accuracy: dict[str, list[float]]
    weights: dict[str, list[float]]  # of the features' levels, by kind; the first is a bias
    votes: float  # weights of the labelers' and of the classifier's log odds
    features: float


def _design(features: np.ndarray) -> np.ndarray:
    """A column of ones and, for each feature, a column for each level over 0."""
    return np.concatenate([np.ones((len(features), 1)), *((features == level).astype(float) for level in range(1, LEVELS))], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, start: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Newton steps, pulled to ``start`` by ``ridge``."""
    w = start.copy()
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (weight * (p - target)) + ridge * (w - start)
        w = w - np.linalg.solve(x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]) + ridge * np.eye(len(w)), gradient)
    return w


def fit_span_model(counts: list[tuple[str, list[int], list[int], int]], rounds: int = 100) -> SpanModel:
    """EM over counted vote patterns by kind, then a logistic fit of the features to the posteriors.

    counts: (kind, votes, features, how many candidates).  Reliabilities start at
    0.8 and have a weak prior there, which decides where few candidates exist.
    """
    priors, accuracies, weights, logits = {}, {}, {}, []
    for kind in sorted(WIDE):
        own = [c for c in counts if c[0] == kind]
        v = np.array([c[1] for c in own], float).reshape(-1, len(LABELERS))
        x = _design(np.array([c[2] for c in own], int).reshape(-1, len(FEATURES)))
        weight = np.array([c[3] for c in own], float)
        accuracy, prior = np.full(len(LABELERS), 0.8), 0.5
        odds = lambda: math.log(prior / (1 - prior)) + v @ np.log(accuracy / (1 - accuracy))  # noqa: E731, B023
        for _ in range(rounds):
            posterior = _sigmoid(odds())
            right = (weight[:, None] * np.where(v > 0, posterior[:, None], np.where(v < 0, 1 - posterior[:, None], 0))).sum(0)
            given = (weight[:, None] * (v != 0)).sum(0)
            accuracy = np.clip((right + 16) / (given + 20), 0.55, 0.99)
            prior = float(np.clip((weight @ posterior + 5) / (weight.sum() + 10), 0.05, 0.95))
        start = np.concatenate([[math.log(prior / (1 - prior))], np.zeros(x.shape[1] - 1)])
        fitted = _logistic(x, _sigmoid(odds()), weight, start, 1.0)
        priors[kind], accuracies[kind], weights[kind] = prior, [float(a) for a in accuracy], [float(w) for w in fitted]
        logits.append((np.column_stack([odds(), x @ fitted]), _sigmoid(odds()), weight))
    both, target, weight = (np.concatenate(c) for c in zip(*logits, strict=True))
    mix = np.clip(_logistic(both, target, weight, np.array([0.7, 0.3]), max(1.0, 0.25 * weight.sum())), 0.1, 1.0)
    return SpanModel(priors, accuracies, weights, float(mix[0]), float(mix[1]))


def _probability(model: SpanModel, span: Column) -> Column:
    logit = F.lit(0.0)
    for kind in sorted(WIDE):
        votes, features = F.lit(math.log(model.prior[kind] / (1 - model.prior[kind]))), F.lit(model.weights[kind][0])
        for i, a in enumerate(model.accuracy[kind]):
            votes = votes + F.lit(math.log(a / (1 - a))) * F.get(span["votes"], F.lit(i))
        for i in range(len(FEATURES)):
            levels = F.array(F.lit(0.0), *(F.lit(model.weights[kind][1 + level * len(FEATURES) + i]) for level in range(LEVELS - 1)))
            features = features + F.get(levels, F.get(span["features"], F.lit(i)))
        logit = F.when(span["kind"] == kind, F.lit(model.votes) * votes + F.lit(model.features) * features).otherwise(logit)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def find_pii(docs: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """Add base_spans and added_spans (with a probability) to every row.

    Null texts count as empty and have no spans.  Offsets are code points, end
    exclusive.  A wide candidate is added when its probability reaches
    ``threshold`` and it shares no character with a base span.  Columns named
    like the added ones are an error; an empty table gives no rows.
    """
    common.require_absent(docs, "base_spans", "added_spans")
    wide, content = common.fresh_name(docs, "wide"), common.text_or_empty(text)
    free = lambda base: lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    found = docs.withColumn("base_spans", base_spans(content)).withColumn(wide, wide_spans(content))
    found = found.withColumn(wide, F.filter(F.col(wide), free(F.col("base_spans"))))
    candidates = docs.where(content.rlike(WIDE_GATE)).select(base_spans(content).alias("b"), wide_spans(content).alias("w"))
    candidates = candidates.select(F.explode(F.filter("w", free(F.col("b")))).alias("s"))
    votes = candidates.groupBy("s.kind", "s.votes", "s.features").agg(F.count("*").alias("n"))
    model = fit_span_model([(r["kind"], list(r["votes"]), list(r["features"]), r["n"]) for r in votes.collect()])  # bounded by the values of votes and features
    scored = F.transform(F.col(wide), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _probability(model, s).alias("probability")))
    return found.withColumn("added_spans", F.array_sort(F.filter(scored, lambda s: s["probability"] >= threshold))).drop(wide)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    added = F.transform("added_spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", *(count(kind) for kind in BASE), F.sha2(_joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(F.col("base_spans"), added)).alias("spans"))
