"""Referential integrity between manifests, payload listings and work already done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import filter_confidence


def orphans(listing: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Payloads that no manifest row names."""
    return listing.join(manifest.select(*keys), keys, "left_anti")


def missing(listing: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Manifest rows without a payload."""
    return manifest.join(listing.select(*keys), keys, "left_anti")


def referenced(listing: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Payloads that are named, once each: what a selective copy takes."""
    return listing.join(manifest.select(*keys), keys, "left_semi")


def integrity_report(listing: DataFrame, manifest: DataFrame, key: str, by: str | None = None, examples: int = 10) -> DataFrame:
    """Counts of payloads, named, orphaned and missing keys, with the first examples in key order, for all or by ``by``.

    Both sides are reduced to distinct keys, so one shuffled full join decides;
    examples are the least keys, kept by rank and not by collecting a group.
    """
    keys = [key] if by is None else [by, key]
    have = listing.select(*keys).distinct().withColumn("in_listing", F.lit(True))
    named = manifest.select(*keys).distinct().withColumn("in_manifest", F.lit(True))
    both = have.join(named, keys, "full_outer").withColumn("state", F.when(F.col("in_manifest").isNull(), "orphaned").when(F.col("in_listing").isNull(), "missing").otherwise("matched"))
    group = [] if by is None else [by]
    counts = both.groupBy(*group).agg(
        F.count("in_listing").alias("n_files"), F.count("in_manifest").alias("n_referenced"), F.count_if(F.col("state") == "orphaned").alias("n_orphaned"), F.count_if(F.col("state") == "missing").alias("n_missing"), F.count_if(F.col("state") == "matched").alias("n_matched")
    )
    if by is not None:
        return counts
    first = {s: both.where(F.col("state") == s).select(key).orderBy(key).limit(examples) for s in ("orphaned", "missing")}
    for state, rows in first.items():
        counts = counts.withColumn(f"first_{state}", F.array_join(F.coalesce(rows.agg(F.array_sort(F.collect_list(F.col(key)))).scalar(), F.array()), ","))
    return counts


def accounting(listing: DataFrame, manifest: DataFrame, key: str, good: Column) -> DataFrame:
    """Every manifest row falls in one bucket: kept, rejected, or missing (no payload, or an empty one)."""
    have = listing.where("length > 0").select(key).distinct().withColumn("found", F.lit(True))
    state = F.when(F.col("found").isNull(), "missing").when(good, "kept").otherwise("rejected")
    return manifest.join(have, key, "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs not done yet, by a stable key: makes a resumed run idempotent."""
    return inputs.join(done.select(key), key, "left_anti")


def delete_list(listing: DataFrame, manifest: DataFrame, key: str, good: Column) -> DataFrame:
    """(key, reason) of payloads that may go, ``orphaned`` or ``rejected``; one that a good row names stays.  Nothing is deleted here."""
    named = manifest.groupBy(key).agg(F.coalesce(F.max(good), F.lit(False)).alias("good"))
    both = listing.select(key).distinct().join(named, key, "left")
    return both.where("good IS NULL OR NOT good").select(key, F.when(F.col("good").isNull(), "orphaned").otherwise("rejected").alias("reason"))


def clean_for_upload(manifest: DataFrame, listing: DataFrame, key: str, good: Column, minimum: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(rows to upload, one row on what became of all).

    Rows under the least confidence go, then those that are not ``good``, then
    those without a payload.  It is ``valid`` where rows are left and each left
    by the filters has a payload, once; orphaned payloads are counted only.
    """
    sure = filter_confidence(manifest, minimum)
    clean = sure.where(F.coalesce(good, F.lit(False)))
    kept = referenced(clean, listing, [key])
    states = integrity_report(listing, clean, key).select("n_orphaned", "n_missing")
    count = lambda rows: rows.agg(F.count("*").alias("n")).scalar()
    report = states.select(count(manifest).alias("total"), count(sure).alias("confident"), count(clean).alias("clean"), count(kept).alias("kept"), "n_orphaned", "n_missing", clean.agg(F.count(key) - F.count_distinct(key)).scalar().alias("n_repeated"))
    return kept, report.withColumn("valid", (F.col("clean") > 0) & (F.col("n_missing") == 0) & (F.col("n_repeated") == 0))


def source_kind(source: Column) -> Column:
    return F.when(source.rlike(r"^(?:https?://|www\.)"), "url").otherwise("local")


def validate(manifest: DataFrame, listing: DataFrame, key: str, required: list[str], sample: int | None = None) -> DataFrame:
    """(severity, code, n) of problems.

    With ``sample`` only the first rows in key order are looked at, as a quick
    check; else all are.
    """
    rows = manifest if sample is None else manifest.orderBy(key).limit(sample)
    problems = [F.when(F.col(c).isNull(), F.concat(F.lit("null_"), F.lit(c))) for c in required]
    found = rows.join(listing.select(key).distinct().withColumn("found", F.lit(True)), key, "left")
    codes = F.array_compact(F.array(*problems, F.when(F.col("found").isNull(), F.lit("payload_missing")), F.when(F.col("dup") > 1, F.lit("duplicate_key"))))
    counted = found.join(rows.groupBy(key).agg(F.count("*").alias("dup")), key, "left")
    long = counted.select(F.explode(codes).alias("code"))
    return long.groupBy("code").agg(F.count("*").alias("n")).select(F.when(F.startswith("code", F.lit("null_")), "error").otherwise("warning").alias("severity"), "code", "n")
