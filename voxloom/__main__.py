"""``python -m voxloom``: prepare a dataset, look at its confidences, check its files."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import integrity as I
from .operators import quality as Q
from .plans.lease import Held
from .plans.prepare import OPTIONAL, Config, Preparation
from .sources import manifest as M


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="voxloom", description="Curate speech datasets on Spark.")
    top.add_argument("--master", help="Spark master; by default that of spark-submit")
    commands = top.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare", help="from folders of audio to a dataset of segments")
    prepare.add_argument("inputs", nargs="*", help="folders that hold audio")
    prepare.add_argument("--output", "-o", help="folder of the dataset")
    prepare.add_argument("--config", help="saved settings; options given here win")
    prepare.add_argument("--save-config", help="also save the settings there")
    for name in OPTIONAL:
        prepare.add_argument(f"--skip-{name}", action="store_true", help=f"leave out the stage {name}")
    for option, kind in (("--min-snr-db", float), ("--min-duration", float), ("--max-duration", float), ("--target-rate", int), ("--min-silence-ms", int), ("--min-speech-ms", int), ("--seed", int)):
        prepare.add_argument(option, type=kind)
    again = prepare.add_mutually_exclusive_group()
    again.add_argument("--resume", action="store_true", help="go on where a run with the same settings ended")
    again.add_argument("--force-restart", action="store_true", help="run all stages again")

    confidence = commands.add_parser("filter-confidence", help="report on a manifest's confidences, and write what passes")
    confidence.add_argument("dataset")
    confidence.add_argument("--min-confidence", type=float, default=0.8)
    confidence.add_argument("--apply", metavar="FOLDER", help="write the manifest of the rows that pass there")

    check = commands.add_parser("check", help="files without rows and rows without files")
    check.add_argument("dataset")
    check.add_argument("--delete-list", metavar="FOLDER", help="write the names of files without rows there")
    return top


def config_of(spark: SparkSession, given: argparse.Namespace) -> Config:
    """Settings from the options over those of a saved file over the defaults."""
    names = {f.name for f in fields(Config)}
    changes = {k: v for k, v in vars(given).items() if k in names and v not in (None, [])}
    skipped = tuple(n for n in OPTIONAL if getattr(given, f"skip_{n}"))
    if skipped:
        changes["skip"] = skipped
    if given.config:
        return Config.load(spark, given.config, **changes)
    if "output" not in changes:
        raise ValueError("prepare needs --output or --config")
    return Config(**{"inputs": (), **changes})


def _shown(df: DataFrame) -> None:
    print("\t".join(df.columns))
    for row in df.collect():  # reports of a few rows
        print("\t".join(f"{v:.4f}" if isinstance(v, float) else str(v) for v in row))


def _prepare(spark: SparkSession, given: argparse.Namespace) -> int:
    config = config_of(spark, given)
    if given.save_config:
        config.save(spark, given.save_config)
    _shown(Preparation(spark, config).execute(given.resume, given.force_restart).orderBy("split"))
    return 0


def _filter(spark: SparkSession, given: argparse.Namespace) -> int:
    rows = M.read_manifest(spark, given.dataset)
    _shown(Q.confidence_report(rows, given.min_confidence))
    if given.apply:
        M.write_manifest(Q.filter_confidence(rows, given.min_confidence), given.apply)
    return 0


def _check(spark: SparkSession, given: argparse.Namespace) -> int:
    """1 where something is missing or left over."""
    files = M.list_payloads(spark, given.dataset).select("file_name")
    rows = M.read_manifest(spark, given.dataset, strict=False).select("file_name")
    orphans, missing = I.orphans(files, rows, ["file_name"]), I.missing(files, rows, ["file_name"])
    counts = [orphans.agg(F.lit("files without rows").alias("what"), F.count("*").alias("n")), missing.agg(F.lit("rows without files").alias("what"), F.count("*").alias("n"))]
    report = counts[0].unionByName(counts[1])
    if given.delete_list:
        orphans.select("file_name").write.mode("overwrite").text(given.delete_list)
    _shown(report)
    return int(report.agg(F.sum("n")).first()[0] > 0)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 1 if a check found something, 2 for wrong settings or a folder that another run holds."""
    given = parser().parse_args(argv)
    builder = SparkSession.builder.appName("voxloom")
    session = spark or (builder.master(given.master) if given.master else builder).getOrCreate()
    try:
        return {"prepare": _prepare, "filter-confidence": _filter, "check": _check}[given.command](session, given)
    except (ValueError, Held) as e:
        print(f"voxloom: {e}", file=sys.stderr)
        return 2
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    sys.exit(main())
