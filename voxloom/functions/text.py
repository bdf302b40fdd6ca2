"""Text normalisation, tokens and labels as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: English number words.
ONES = ["", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
TENS = ["", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]
SCALES = ["", "thousand", "million", "billion", "trillion", "quadrillion", "quintillion", "sextillion", "septillion", "octillion", "nonillion", "decillion"]


def _pick(words: list[str], i: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), i)


def _below_1000(n: Column) -> Column:
    """Words of 1 to 999, with "and" behind the hundreds and a hyphen in the tens; empty for 0."""
    rest = n % 100
    tens = F.when(rest < 20, _pick(ONES, rest)).otherwise(F.concat(_pick(TENS, F.floor(rest / 10).cast("int")), F.when(rest % 10 > 0, F.concat(F.lit("-"), _pick(ONES, rest % 10))).otherwise("")))
    hundreds = F.concat(_pick(ONES, F.floor(n / 100).cast("int")), F.lit(" hundred"))
    return F.when(n < 100, tens).when(rest == 0, hundreds).otherwise(F.concat(hundreds, F.lit(" and "), tens))


def number_words(digits: Column) -> Column:
    """A run of ASCII digits in words: groups joined by commas, "and" before a last group under 100.

    Runs beyond the named scales are read digit by digit.
    """
    size = F.ceil(F.length(digits) / 3).cast("int")
    padded = F.lpad(digits, 36, "0")
    groups = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.substring(padded, i * 3 + 1, F.lit(3)).cast("int"))
    worded = F.transform(
        groups,
        lambda n, i: F.struct(n.alias("n"), F.when(n > 0, F.concat_ws(" ", _below_1000(n), F.when(i < 11, _pick(SCALES, F.lit(11) - i)))).alias("w")),
    )
    said = F.filter(worded, lambda g: g["n"] > 0)
    last = F.element_at(groups, -1)
    all_words = F.array_join(F.transform(said, lambda g: g["w"]), ", ")
    head = F.array_join(F.transform(F.slice(said, 1, F.greatest(F.size(said) - 1, F.lit(0))), lambda g: g["w"]), ", ")
    small_last = (F.size(said) > 1) & last.between(1, 99)
    by_digit = F.array_join(F.transform(F.split(digits, ""), lambda d: F.when(d == "0", "zero").otherwise(_pick(ONES, d.cast("int")))), " ")
    words = F.when(small_last, F.concat(head, F.lit(" and "), _below_1000(last))).otherwise(all_words)
    return F.when(size > 12, by_digit).when(F.size(said) == 0, F.lit("zero")).otherwise(words)


def spell_numbers(text: Column) -> Column:
    """Every run of ASCII digits in words; the text between runs is unchanged."""
    parts = F.zip_with(F.split(text, "[0-9]+", -1), F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), lambda t, d: F.concat(t, F.coalesce(F.when(d.isNotNull(), number_words(d)), F.lit(""))))
    return F.when(text.rlike("[0-9]"), F.array_join(parts, "")).otherwise(text)


def nfkc(text: Column) -> Column:
    """Compatibility normalisation; Spark has no built-in for it, so texts go through Python in Arrow batches."""

    @F.pandas_udf("string")
    def normalised(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return normalised(text)


def speakable(text: Column) -> Column:
    """Numbers in words, only letters, digits, .,?!' and the space kept, spaces collapsed and trimmed."""
    stripped = F.regexp_replace(spell_numbers(text), r"[^a-zA-Z0-9\.,\?!' ]", "")
    return F.trim(F.regexp_replace(stripped, " +", " "))


def normalize_text(text: Column) -> Column:
    """``speakable`` with the first letter in upper case and the rest unchanged."""
    t = speakable(text)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)))


def capitalise_text(text: Column) -> Column:
    """``speakable`` with the first letter in upper and the rest in lower case."""
    t = speakable(text)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, F.lit(2), F.length(t))))


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def token_histogram(df: DataFrame, text: str = "text") -> DataFrame:
    """(token, n, pct): the total is the sum of the counts, a scalar subquery over them, so no window without partitions."""
    counts = df.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / counts.agg(F.sum("n").alias("total")).scalar())


#: Sound classes; parameters of ``class_coverage``.
VOWELS = ["i", "ɪ", "e", "ɛ", "æ", "ɑ", "ɔ", "o", "ʊ", "u", "ʌ", "ə", "ɚ", "ɛɹ", "aɪ", "aʊ", "ɔɪ"]
CONSONANTS = ["p", "b", "t", "d", "k", "g", "f", "v", "θ", "ð", "s", "z", "ʃ", "ʒ", "h", "m", "n", "ŋ", "l", "ɹ", "w", "j"]


def class_coverage(histogram: DataFrame) -> DataFrame:
    """One row over a histogram: distinct tokens, and count and share of vowels, consonants and others."""
    n = F.col("n")
    vowel, consonant = F.col("token").isin(VOWELS), F.col("token").isin(CONSONANTS)
    part = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    share = lambda c: F.coalesce(F.try_divide(100.0 * part(c), F.sum(n)), F.lit(0.0))
    return histogram.agg(
        F.count("*").alias("distinct_tokens"),
        part(vowel).alias("vowels"),
        part(consonant).alias("consonants"),
        part(~vowel & ~consonant).alias("other"),
        share(vowel).alias("vowel_pct"),
        share(consonant).alias("consonant_pct"),
    )


def token_ids(text: Column, vocabulary: dict[str, int]) -> Column:
    """Characters by vocabulary between two zeros; unknown characters are dropped."""
    table = F.create_map(*(F.lit(x) for kv in sorted(vocabulary.items()) for x in kv))
    known = F.filter(F.transform(F.split(text, ""), lambda c: F.try_element_at(table, c)), lambda i: i.isNotNull())
    return F.concat(F.array(F.lit(0)), known, F.array(F.lit(0)))


def format_duration(seconds: Column) -> Column:
    h, m, s = F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int"), F.floor(seconds % 60).cast("int")
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, s)).when(m > 0, F.format_string("%dm %ds", m, s)).otherwise(F.format_string("%ds", s))


def reason_label(reason: Column) -> Column:
    return F.initcap(F.replace(reason, F.lit("_"), F.lit(" ")))


def preview(text: Column, n: int = 50) -> Column:
    return F.concat(F.left(text, F.lit(n)), F.lit("..."))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r".(\.[^.]*)$", 1)


def parse_log_line(line: Column) -> Column:
    """struct(type, epoch, epochs, batch, batches, loss, avg, train_loss, val_loss); nulls where a line has none.

    An ``epoch`` line is a summary with its training and validation loss; a
    ``batch`` line reports progress.  A summary on several lines is first joined
    to one, see ``joined_summaries``.  The loss of a batch is the first one
    behind a bar, so a text that holds "Loss:" doesn't disturb it.
    """
    found = lambda regex, kind: F.nullif(F.regexp_extract(line, regex, 1), F.lit("")).try_cast(kind)
    epoch = F.contains(line, F.lit("Epoch")) & F.contains(line, F.lit("Summary:"))
    batch = ~epoch & F.contains(line, F.lit("[Epoch")) & F.contains(line, F.lit("Batch"))
    number = lambda regex, kind: F.when(batch, found(regex, kind))
    loss = lambda name: F.when(epoch, found(rf"{name} Loss:\s*([-+0-9.eEnaif]+)", "double"))
    return F.struct(
        F.when(epoch, "epoch").when(batch, "batch").alias("type"),
        F.when(epoch, found(r"Epoch\s*(\d+)", "int")).otherwise(number(r"\[Epoch (\d+)/\d+\]", "int")).alias("epoch"),
        F.when(epoch, found(r"Epoch\s*\d+/(\d+)", "int")).otherwise(number(r"\[Epoch \d+/(\d+)\]", "int")).alias("epochs"),
        number(r"Batch (\d+)/\d+", "int").alias("batch"),
        number(r"Batch \d+/(\d+)", "int").alias("batches"),
        number(r"^[^|]*\| Loss: ([0-9.]+)", "double").alias("loss"),
        number(r"^[^|]*\| Loss: [0-9.]+ \| Avg: ([0-9.]+)", "double").alias("avg"),
        loss("Training").alias("train_loss"),
        loss("Validation").alias("val_loss"),
    )


def joined_summaries(log: Column) -> Column:
    """Array of the lines of a log; the indented lines behind an epoch summary are joined to it."""
    return F.split(F.regexp_replace(log, r"(?m)(?<=\S)[ \t]*\r?\n[ \t]+(?=(?:Training|Validation) Loss:)", " "), r"\r?\n")


#: Forms of a time.
STAMPS = {"compact": "yyyyMMdd_HHmmss", "day": "yyyy-MM-dd", "iso": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stamp(ts: Column, form: str) -> Column:
    return F.date_format(ts, STAMPS[form])


def merged(first: Column, second: Column) -> Column:
    """Both maps in one; of a key that both have the second's value counts."""
    return F.map_concat(F.map_filter(first, lambda k, v: ~F.map_contains_key(second, k)), second)
