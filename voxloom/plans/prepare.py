"""From folders of audio to a dataset: one configuration, stages that resume, reports beside them."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plugins as P
from ..functions import signal as G
from ..operators import quality as Q
from ..operators import splits as S
from ..sources import audio as A
from ..sources.manifest import write_report
from .pipeline import Run

#: Stages that may be left out, in their order.
OPTIONAL = ("enhance", "segment", "transcribe", "clean")


@dataclass(frozen=True)
class Config:
    """What a run does; kept with its output, so that a resumed run is the same run."""

    inputs: tuple[str, ...]
    output: str
    skip: tuple[str, ...] = ()
    target_rate: int = 24_000
    min_snr_db: float = 15.0
    min_duration: float = 0.5
    max_duration: float = 10.0
    frame_ms: int = 30
    speech_level: float = 1e-4
    min_silence_ms: int = 300
    min_speech_ms: int = 700
    ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)
    seed: int = 42

    def __post_init__(self) -> None:
        for name in ("inputs", "skip", "ratios"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        wrong = [
            (not self.inputs, "no inputs"),
            (set(self.skip) - set(OPTIONAL), f"only {', '.join(OPTIONAL)} can be skipped"),
            (self.target_rate <= 0, "the rate must be positive"),
            (not 0 <= self.min_duration <= self.max_duration, "the durations must rise from 0"),
            (abs(sum(self.ratios) - 1) >= 1e-5 or min(self.ratios) < 0, "split ratios must add up to 1"),
        ]
        said = [text for bad, text in wrong if bad]
        if said:
            raise ValueError("; ".join(said))

    @property
    def thresholds(self) -> Q.Thresholds:
        return Q.Thresholds(min_duration=self.min_duration, max_duration=self.max_duration, min_snr_db=self.min_snr_db)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self), indent=None, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, **changes: object) -> Config:
        """As it was saved, with changes; an unknown name is an error."""
        found = json.loads("\n".join(r["value"] for r in spark.read.option("wholetext", "true").text(path).limit(1).collect()))
        unknown = set(found) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        return cls(**{**found, **changes})


def _segment(config: Config) -> Callable[[DataFrame], DataFrame]:
    frame = config.target_rate * config.frame_ms // 1000
    frames = lambda ms: -(-ms // config.frame_ms)

    def work(heard: DataFrame) -> DataFrame:
        spoken = P.voice_activity(heard.drop("start"), "samples", frame, config.speech_level, frames(config.min_silence_ms) - 1, frames(config.min_speech_ms))
        return spoken.select("path", "rate", "start", "text", "problem", F.slice("samples", F.col("start") + 1, F.col("end") - F.col("start")).alias("samples"))

    return work


def stages(spark: SparkSession, config: Config, decoders: dict[str, A.Decoder] | None = None, transcriber: tuple[Callable, Callable] | None = None) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
    """listen, enhance, segment, transcribe, clean, split.  ``transcriber``: how a model is loaded, and (model, samples) -> text; without one texts are empty."""
    x = F.col("samples")

    def listen(_: DataFrame) -> DataFrame:
        return A.read_audio(spark, list(config.inputs), config.target_rate, decoders=decoders)

    def enhance(heard: DataFrame) -> DataFrame:
        return heard.where("error IS NULL").select("path", "rate", G.peak_normalize(G.remove_dc(x)).alias("samples"))

    def transcribe(parts: DataFrame) -> DataFrame:
        if transcriber is None:
            return parts.withColumn("text", F.lit("")).withColumn("problem", F.lit(None).cast("string"))
        said = P.with_model(parts, "samples", *transcriber, "string", "said")
        return said.withColumn("text", F.coalesce("said.value", F.lit(""))).withColumn("problem", F.col("said.error")).drop("said")

    def clean(parts: DataFrame) -> DataFrame:
        m = parts.withColumn("duration", F.size("samples") / F.col("rate")).withColumn("low_freq", G.spectral_ratios(x, float(config.target_rate))["low_freq_ratio"])
        found = Q.issues(config.thresholds, F.col("duration"), G.peak(x), G.frame_snr_db(x, config.target_rate // 40), G.dc_offset(x), F.col("low_freq"))
        judged = m.withColumn("issues", F.concat(found, F.when(F.col("problem").isNotNull(), F.array(F.lit("transcription_failed"))).otherwise(F.array().cast("array<string>"))))
        return judged.withColumn("is_good", F.size("issues") == 0)

    def split(parts: DataFrame) -> DataFrame:
        kept = parts.where("is_good") if "is_good" in parts.columns else parts
        named = kept.withColumn("key", F.format_string("%s#%012d", "path", "start")).select("key", "rate", "samples", "text")
        return S.segment_names(S.assign_split(named, "key", config.seed, config.ratios), "rn")

    def whole(heard: DataFrame) -> DataFrame:
        """Rows as the next stages want them, whichever stages were left out."""
        rows = heard.where("error IS NULL") if "error" in heard.columns else heard
        for name, value in (("start", F.lit(0)), ("text", F.lit("")), ("problem", F.lit(None).cast("string"))):
            rows = rows if name in rows.columns else rows.withColumn(name, value)
        return rows

    ready = lambda work: lambda df: work(whole(df))
    return [("listen", listen), ("enhance", ready(enhance)), ("segment", ready(_segment(config))), ("transcribe", ready(transcribe)), ("clean", ready(clean)), ("split", ready(split))]


@dataclass
class Preparation:
    """A run of all stages into ``config.output``: the dataset, its reports and what is needed to resume."""

    spark: SparkSession
    config: Config
    decoders: dict[str, A.Decoder] | None = None
    transcriber: tuple[Callable, Callable] | None = None
    run: Run = field(init=False)

    def __post_init__(self) -> None:
        self.run = Run(self.spark, f"{self.config.output}/_run", stages(self.spark, self.config, self.decoders, self.transcriber), set(self.config.skip))

    def _saved(self) -> Config | None:
        try:
            return Config.load(self.spark, f"{self.config.output}/_run/_config")
        except AnalysisException:
            return None

    def execute(self, resume: bool = False, restart: bool = False) -> DataFrame:
        """(split, segments, seconds, hours, mean_seconds) of the dataset.

        A folder that has stages from before needs ``resume``, with the same
        configuration, or ``restart``.
        """
        done = sorted(self.run.committed())
        if done and not (resume or restart):
            raise ValueError(f"{self.config.output} has the stages {', '.join(done)}: resume or restart")
        if done and resume and not restart and self._saved() != self.config:
            raise ValueError(f"{self.config.output} was begun with other settings: restart, or resume with {self._saved()}")
        self.config.save(self.spark, f"{self.config.output}/_run/_config")
        rows = self.run.execute(self.spark.range(0), restart)
        written = A.write_dataset(rows.select(F.concat(F.col("split"), F.lit("_"), F.col("split_name")).alias("file_name"), "text", "split", F.lit(None).cast("double").alias("confidence"), "rate", "samples"), self.config.output)
        committed = self.run.committed()
        if "clean" in committed:
            judged = self.spark.read.parquet(committed["clean"])
            write_report(Q.reason_counts(judged), f"{self.config.output}/_reports/reasons")
            write_report(Q.quality_report(judged.withColumn("score", F.lit(1.0))), f"{self.config.output}/_reports/quality")
        failed = self.spark.read.parquet(committed["listen"]).where("error IS NOT NULL").select("path", "error")
        write_report(failed, f"{self.config.output}/_reports/unreadable")
        return S.split_stats(written.where("error IS NULL"))
