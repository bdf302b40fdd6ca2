"""Quality and confidence gates with reasons, and their reports."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def confidence_from_logprob(avg_logprob: Column) -> Column:
    """1 + mean log probability / 10, from 0 to 1; 1 where there is none."""
    return F.coalesce(clamp(1 + avg_logprob / 10), F.lit(1.0))


def mean_logprob(segments: Column) -> Column:
    """Mean over an array of segments, a missing log probability counting as 0; null for no segments."""
    total = F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + F.coalesce(s["avg_logprob"], F.lit(0.0)))
    return F.when(F.size(segments) > 0, total / F.size(segments))


def filter_confidence(df: DataFrame, minimum: float = 0.8, column: str = "confidence") -> DataFrame:
    """Rows at or above the minimum; a missing confidence counts as 1."""
    return df.where(F.coalesce(F.col(column), F.lit(1.0)) >= minimum)


def confidence_report(df: DataFrame, minimum: float = 0.8, column: str = "confidence") -> DataFrame:
    """One row: counts and mean, min and max before and after the filter, from one scan."""
    c = F.coalesce(F.col(column), F.lit(1.0))
    kept = F.when(c >= minimum, c)
    aggs = [F.count("*").alias("total"), F.count(kept).alias("kept"), F.count_if(c < minimum).alias("rejected")]
    for name, x in (("before", c), ("after", kept)):
        aggs += [F.coalesce(F.avg(x), F.lit(0.0)).alias(f"mean_{name}"), F.coalesce(F.min(x), F.lit(1.0)).alias(f"min_{name}"), F.coalesce(F.max(x), F.lit(0.0)).alias(f"max_{name}")]
    return df.agg(*aggs)


def confidence_whatif(df: DataFrame, thresholds: list[float], column: str = "confidence") -> DataFrame:
    """(threshold, below, total, pct) for each threshold, from one scan."""
    c = F.coalesce(F.col(column), F.lit(1.0))
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(c < t).alias(f"b{i}") for i, t in enumerate(thresholds)))
    rows = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"b{i}").alias("below")) for i, t in enumerate(thresholds)))
    out = counts.select("total", F.explode(rows).alias("r"))
    return out.select("r.threshold", "r.below", "total", F.coalesce(F.try_divide(F.col("below") * 100.0, F.col("total")), F.lit(0.0)).alias("pct"))


def confidence_distribution(df: DataFrame, group: str, column: str = "confidence") -> DataFrame:
    """Count, mean, min, max and counts below 0.8 and 0.9, for each group and for all (``ALL``)."""
    c = F.coalesce(F.col(column), F.lit(1.0))
    rolled = df.rollup(group).agg(
        F.grouping(group).alias("is_all"), F.count("*").alias("n"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"), F.count_if(c < 0.8).alias("below_08"), F.count_if(c < 0.9).alias("below_09")
    )
    return rolled.withColumn(group, F.when(F.col("is_all") == 1, F.lit("ALL")).otherwise(F.col(group))).drop("is_all")


@dataclass(frozen=True)
class Thresholds:
    """Bounds of the gate; both ends of the duration range are kept."""

    min_duration: float = 0.5
    max_duration: float = 10.0
    min_analysis: float = 0.05
    min_peak: float = 0.01
    max_peak: float = 0.99
    min_snr_db: float = 15.0
    max_dc_offset: float = 0.05
    max_low_freq: float = 0.1
    max_clipping: float = 0.01

    def aggressive(self) -> Thresholds:
        return replace(self, min_snr_db=self.min_snr_db + 5, max_clipping=self.max_clipping / 2, max_low_freq=self.max_low_freq / 2)


def issues(t: Thresholds, duration: Column, peak: Column | None = None, snr_db: Column | None = None, dc_offset: Column | None = None, low_freq: Column | None = None) -> Column:
    """Reason codes in order.  Under the analysis minimum no other metric is looked at; a null metric gives no reason."""
    too_short = F.when(duration < t.min_duration, F.lit("too_short"))
    too_long = F.when(duration > t.max_duration, F.lit("too_long"))
    stop = duration < t.min_analysis
    rest = []
    if peak is not None:
        rest.append(F.when(peak < t.min_peak, F.lit("too_quiet")).when(peak > t.max_peak, F.lit("clipping")))
    if snr_db is not None:
        rest.append(F.when(snr_db < t.min_snr_db, F.lit("low_snr")))
    if dc_offset is not None:
        rest.append(F.when(F.abs(dc_offset) > t.max_dc_offset, F.lit("dc_offset")))
    if low_freq is not None:
        rest.append(F.when(low_freq > t.max_low_freq, F.lit("low_frequency_noise")))
    full = F.array_compact(F.array(too_short, too_long, *rest))
    return F.when(stop, F.array_compact(F.array(too_short, F.lit("too_short_for_analysis")))).otherwise(full)


def overall_score(snr_db: Column | None = None, low_freq: Column | None = None, peak: Column | None = None) -> Column:
    """min(1, snr / 20) * (1 - low frequency share) * peak factor; absent or null factors are skipped, nothing is clamped at 0."""
    score = F.lit(1.0)
    if snr_db is not None:
        score = score * F.coalesce(F.least(F.lit(1.0), snr_db / 20), F.lit(1.0))
    if low_freq is not None:
        score = score * F.coalesce(1 - low_freq, F.lit(1.0))
    if peak is not None:
        score = score * F.coalesce(F.when(peak < 0.5, F.least(F.lit(1.0), peak / 0.5)).otherwise(1 - (peak - 0.5) / 0.5), F.lit(1.0))
    return score


def reason_text(duration: Column, snr_db: Column, code: Column) -> Column:
    """The code with the value that caused it."""
    return (
        F.when(code == "too_short", F.format_string("too_short_%.1fs", duration))
        .when(code == "too_long", F.format_string("too_long_%.1fs", duration))
        .when(code == "low_snr", F.format_string("low_snr_%.1fdB", snr_db))
        .otherwise(code)
    )


#: Canonical reasons and what a message of each contains, first match wins.
REASON_BUCKETS = [("Low SNR", "SNR"), ("Clipping", "clipping"), ("DC offset", "DC offset"), ("Low frequency noise", "low-frequency"), ("Too short", "too short"), ("Too long", "too long"), ("Too quiet", "too quiet")]


def messages(t: Thresholds, duration: Column, peak: Column, snr_db: Column, dc_offset: Column, low_freq: Column, clipping: Column) -> Column:
    """The seven checks of the stricter gate as messages, all with strict comparisons."""
    return F.array_compact(
        F.array(
            F.when(snr_db < t.min_snr_db, F.format_string("Low SNR: %.1f dB", snr_db)),
            F.when(clipping > t.max_clipping, F.format_string("High clipping: %.3f", clipping)),
            F.when(F.abs(dc_offset) > t.max_dc_offset, F.format_string("High DC offset: %.3f", dc_offset)),
            F.when(low_freq > t.max_low_freq, F.format_string("High low-frequency noise: %.3f", low_freq)),
            F.when(duration < t.min_duration, F.format_string("too short: %.2f s", duration)),
            F.when(duration > t.max_duration, F.format_string("too long: %.2f s", duration)),
            F.when(peak < t.min_peak, F.format_string("too quiet: %.3f", peak)),
        )
    )


def reason_bucket(message: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, part in reversed(REASON_BUCKETS):
        out = F.when(F.contains(message, F.lit(part)), F.lit(name)).otherwise(out)
    return out


def reason_counts(df: DataFrame, column: str = "issues") -> DataFrame:
    return df.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def quality_report(df: DataFrame, is_good: str = "is_good", score: str = "score") -> DataFrame:
    """One row: totals, mean score of kept rows (0 if none) and the rate of rejection (0 if empty)."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(is_good)).alias("kept"),
        F.count_if(~F.col(is_good)).alias("rejected"),
        F.coalesce(F.avg(F.when(F.col(is_good), F.col(score))), F.lit(0.0)).alias("mean_score"),
        F.coalesce(F.try_divide(F.count_if(~F.col(is_good)).cast("double"), F.count("*")), F.lit(0.0)).alias("rejection_rate"),
    )


def summary_stats(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, mean, std, min, max, median): population deviation; metrics without values are absent.

    The medians are exact and found when this is called, see ``quantiles``; the rest is one row over one scan.
    """
    median = exact_quantiles(df, metrics, [0.5])
    x = {m: F.col(m).cast("double") for m in metrics}
    stats = lambda m: F.struct(F.lit(m).alias("metric"), F.avg(x[m]).alias("mean"), F.stddev_pop(x[m]).alias("std"), F.min(x[m]).alias("min"), F.max(x[m]).alias("max"), F.lit(median.get(m, {}).get(0.5)).cast("double").alias("median"))
    return df.agg(F.array(*(stats(m) for m in metrics)).alias("r")).select(F.explode("r").alias("r")).select("r.*").where("mean IS NOT NULL")


def segment_filter(df: DataFrame, rms: str | None = None, peak: str | None = None) -> DataFrame:
    """ASR segments worth keeping: speech, likely, 1 to 10 s, with a word character, neither silent nor clipped."""
    duration = F.col("end") - F.col("start")
    keep = (F.coalesce("no_speech_prob", F.lit(0.0)) <= 0.4) & (F.coalesce("avg_logprob", F.lit(-10.0)) >= -1.0) & duration.between(1, 10) & F.col("text").rlike(r"\w")
    if rms:
        keep = keep & (F.col(rms) >= 1e-4)
    if peak:
        keep = keep & (F.col(peak) <= 0.99)
    return df.where(keep)


def valid_transcripts(df: DataFrame) -> DataFrame:
    return df.where((F.col("text") != "") & (F.coalesce("error", F.lit("")) == ""))


def training_rows(df: DataFrame) -> DataFrame:
    """Rows a trainer takes: 1 to 510 phonemes, at least 3 token ids, at most 30 s."""
    return df.where(F.col("n_phonemes").between(1, 510) & (F.col("n_tokens") >= 3) & (F.col("duration") <= 30))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from min to max, the last closed on the right: (bin, n); a single value goes to bin 0."""
    limits = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    low, high = (limits.select(c).scalar() for c in ("low", "high"))
    place = F.when(high == low, F.lit(0)).otherwise(F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1)))
    return df.where(F.col(column).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def size_category_mb(mb: Column) -> Column:
    return F.when(mb < 100, "small (<100MB)").when(mb < 1000, "medium (100MB-1GB)").when(mb < 10000, "large (1GB-10GB)").otherwise("very large (>10GB)")


def size_category_count(n: Column) -> Column:
    return F.when(n < 1e3, "n<1K").when(n < 1e4, "1K<n<10K").when(n < 1e5, "10K<n<100K").when(n < 1e6, "100K<n<1M").otherwise("n>1M")


def recommendations(duration: Column, rms: Column, snr: Column, rms_std: Column) -> Column:
    return F.array_compact(F.array(F.when(duration < 2, "short_samples"), F.when(rms < 0.01, "quiet"), F.when(snr < 20, "noisy"), F.when(rms_std > 0.02, "uneven_level")))


#: Seconds of work for a second of audio.
PROCESSING_FACTOR = {"fast": 0.5, "balanced": 1.0, "quality": 2.0}


def processing_seconds(total_duration: Column, n_files: Column, mode: Column) -> Column:
    factor = F.lit(1.0)
    for name, value in PROCESSING_FACTOR.items():
        factor = F.when(mode == name, F.lit(value)).otherwise(factor)
    return total_duration * factor + 5 * n_files
