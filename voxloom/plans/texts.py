"""Queries: text normalisation, tokens, chunks and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import signal as G
from ..functions import text as T
from . import bindings as B


def _docs(spark, sf):
    return B.table(spark, sf, "documents")


def normalize_text(spark, sf):
    return _docs(spark, sf).select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


def normalize_text_nfkc(spark, sf):
    return _docs(spark, sf).select("doc_id", T.normalize_text(T.nfkc(F.col("text"))).alias("normal"))


def capitalise_text(spark, sf):
    return _docs(spark, sf).select("doc_id", T.capitalise_text(F.col("text")).alias("normal"))


def number_words(spark, sf):
    runs = _docs(spark, sf).select(F.explode(F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))).alias("digits"))
    return runs.groupBy("digits").agg(F.count("*").alias("n")).select("digits", "n", T.number_words(F.col("digits")).alias("words"))


def token_histogram(spark, sf):
    return T.token_histogram(_docs(spark, sf)).select("token", "n", F.round("pct", 9).alias("pct"))


def token_top10(spark, sf):
    return T.token_histogram(_docs(spark, sf)).orderBy(F.desc("n"), "token").limit(10).select("token", "n")


def token_rare(spark, sf):
    return T.token_histogram(_docs(spark, sf)).where("pct < 0.5").agg(F.count("*").alias("rare_tokens"), F.sum("n").alias("occurrences"))


def class_coverage(spark, sf):
    c = T.class_coverage(T.token_histogram(_docs(spark, sf)))
    return c.select("distinct_tokens", "vowels", "consonants", "other", F.round("vowel_pct", 6).alias("vowel_pct"), F.round("consonant_pct", 6).alias("consonant_pct"))


def text_chunks(spark, sf):
    c = _docs(spark, sf).select("doc_id", "text", F.explode(G.chunk_bounds(F.length("text"), 1000, 100)).alias("c"))
    return c.select("doc_id", F.col("c.start").alias("start"), F.md5(F.substring("text", F.col("c.start") + 1, F.col("c.end") - F.col("c.start")).cast("binary")).alias("md5"))


def duration_labels(spark, sf):
    return _docs(spark, sf).select("doc_id", T.format_duration(F.col("n_chars") / 2.0).alias("label"))


def reason_labels(spark, sf):
    e = B.table(spark, sf, "events").select(F.concat(F.col("event_type"), F.lit("_event_count")).alias("r"))
    return e.groupBy(T.reason_label(F.col("r")).alias("label")).agg(F.count("*").alias("n"))


def text_previews(spark, sf):
    return _docs(spark, sf).select("doc_id", T.preview(F.col("text")).alias("preview"))


def url_parts(spark, sf):
    u = F.col("url")
    return B.table(spark, sf, "pages").select("page_id", T.file_name(u).alias("name"), T.stem(u).alias("stem"), T.suffix(u).alias("suffix"), F.substring_index("url", "/", 3).alias("site"))


def line_counts(spark, sf):
    lines = _docs(spark, sf).select(F.explode(F.split(F.trim("text"), "\n")).alias("line"))
    return lines.groupBy(F.when(F.startswith("line", F.lit("The")), "the").when(F.endswith("line", F.lit(".")), "stop").when(F.contains("line", F.lit(",")), "comma").otherwise("other").alias("kind")).agg(F.count("*").alias("n"))


def token_id_lengths(spark, sf):
    vocabulary = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz ,.", 1)}
    return _docs(spark, sf).select("doc_id", F.size(T.token_ids(F.col("text"), vocabulary)).alias("n_ids"))


def _log_lines(spark, sf):
    e = B.table(spark, sf, "events")
    line = F.format_string("[Epoch %d/50] Batch %d/200 | Loss: %.4f | Avg: %.4f | Text: Loss: none...", F.dayofmonth("ts"), F.col("event_id") % 200, F.floor("value") / 100.0, F.floor(F.col("value") / 2) / 100.0)
    summary = F.format_string("Epoch %d/50 Summary:\n  Training Loss:    %.4f\n  Validation Loss:  %.4f", F.dayofmonth("ts"), F.floor("value") / 100.0, F.floor(F.col("value") / 2) / 100.0)
    log = F.when(F.col("event_type") == "error", F.lit("Training Loss: pending")).when(F.col("event_type") == "signup", summary).otherwise(line)
    return e.select("event_id", F.explode(T.joined_summaries(log)).alias("line"))


def log_parse(spark, sf):
    return _log_lines(spark, sf).select("event_id", T.parse_log_line(F.col("line")).alias("p")).select("event_id", "p.*")


def json_props(spark, sf):
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1))
    return B.table(spark, sf, "events").groupBy((k % 10).alias("k10")).agg(F.count("*").alias("n"), F.sum(k).alias("total"))


_NORMAL = r"trim(regexp_replace(regexp_replace(t, '[^a-zA-Z0-9\.,\?!'' ]', '', 'g'), ' +', ' ', 'g'))"
_ONES = "['one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve','thirteen','fourteen','fifteen','sixteen','seventeen','eighteen','nineteen']"
_TENS = "['ten','twenty','thirty','forty','fifty','sixty','seventy','eighty','ninety']"
_SCALES = "['decillion','nonillion','octillion','septillion','sextillion','quintillion','quadrillion','trillion','billion','million','thousand']"
_B100 = f"CASE WHEN n % 100 = 0 THEN '' WHEN n % 100 < 20 THEN {_ONES}[n % 100] ELSE {_TENS}[n % 100 // 10] || CASE WHEN n % 10 > 0 THEN '-' || {_ONES}[n % 10] ELSE '' END END"
_B1000 = f"CASE WHEN n < 100 THEN {_B100} ELSE {_ONES}[n // 100] || ' hundred' || CASE WHEN n % 100 > 0 THEN ' and ' || {_B100} ELSE '' END END"
#: words of every distinct run of digits
_WORDS = f"""runs AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9]+')) AS digits FROM documents),
grp AS (SELECT digits, i, CAST(substr(lpad(digits, 36, '0'), i * 3 - 2, 3) AS INTEGER) AS n FROM runs, range(1, 13) r(i) WHERE length(digits) <= 36),
said AS (SELECT digits, i, n, {_B1000} || CASE WHEN i < 12 THEN ' ' || {_SCALES}[i] ELSE '' END AS w FROM grp WHERE n > 0),
words AS (SELECT digits, CASE WHEN count(said.n) = 0 THEN 'zero' WHEN count(said.n) > 1 AND max(CASE WHEN i = 12 THEN n ELSE 0 END) BETWEEN 1 AND 99
   THEN string_agg(w, ', ' ORDER BY i) FILTER (i < 12) || ' and ' || max(CASE WHEN i = 12 THEN w END) ELSE string_agg(w, ', ' ORDER BY i) END AS words FROM runs LEFT JOIN said USING (digits) GROUP BY digits)"""
_SPELT = f"""{_WORDS}, parts AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[0-9]+')) AS piece, unnest(list_concat(regexp_extract_all(text, '[0-9]+'), [''])) AS digits, generate_subscripts(regexp_split_to_array(text, '[0-9]+'), 1) AS i FROM documents),
spelt AS (SELECT doc_id, string_agg(piece || coalesce(words, ''), '' ORDER BY i) AS t FROM parts LEFT JOIN words USING (digits) GROUP BY doc_id)"""
_TOKENS = r"(SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS token FROM documents) GROUP BY token)"
_HIST = f"(SELECT token, n, 100.0::DOUBLE * n / (SELECT sum(n) FROM {_TOKENS}) AS pct FROM {_TOKENS})"
_VOWELS = "'i', 'ɪ', 'e', 'ɛ', 'æ', 'ɑ', 'ɔ', 'o', 'ʊ', 'u', 'ʌ', 'ə', 'ɚ', 'ɛɹ', 'aɪ', 'aʊ', 'ɔɪ'"
_CONSONANTS = "'p', 'b', 't', 'd', 'k', 'g', 'f', 'v', 'θ', 'ð', 's', 'z', 'ʃ', 'ʒ', 'h', 'm', 'n', 'ŋ', 'l', 'ɹ', 'w', 'j'"
_LINES = "(SELECT event_id, CASE WHEN event_type = 'error' THEN 'Training Loss: pending' ELSE printf('[Epoch %d/50] Batch %d/200 | Loss: %.4f | Avg: %.4f | Text: Loss: none...', dayofmonth(ts), event_id % 200, floor(value) / 100.0, floor(value / 2) / 100.0) END AS line FROM events)"

SQL = {
    "normalize_text": f"WITH {_SPELT} SELECT doc_id, upper(substr(x, 1, 1)) || substr(x, 2) AS normal FROM (SELECT doc_id, {_NORMAL} AS x FROM spelt)",
    "capitalise_text": f"WITH {_SPELT} SELECT doc_id, upper(substr(x, 1, 1)) || lower(substr(x, 2)) AS normal FROM (SELECT doc_id, {_NORMAL} AS x FROM spelt)",
    "number_words": f"WITH {_WORDS} SELECT digits, n, words FROM words JOIN (SELECT digits, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[0-9]+')) AS digits FROM documents) GROUP BY digits) USING (digits)",
    "token_histogram": f"SELECT token, n, round(pct, 9) AS pct FROM {_HIST}",
    "token_top10": f"SELECT token, n FROM {_TOKENS} ORDER BY n DESC, token LIMIT 10",
    "token_rare": f"SELECT count(*) AS rare_tokens, CAST(sum(n) AS BIGINT) AS occurrences FROM {_HIST} WHERE pct < 0.5",
    "class_coverage": f"SELECT count(*) AS distinct_tokens, CAST(coalesce(sum(n) FILTER (token IN ({_VOWELS})), 0) AS BIGINT) AS vowels, CAST(coalesce(sum(n) FILTER (token IN ({_CONSONANTS})), 0) AS BIGINT) AS consonants, CAST(coalesce(sum(n) FILTER (token NOT IN ({_VOWELS}) AND token NOT IN ({_CONSONANTS})), 0) AS BIGINT) AS other, round(100.0::DOUBLE * coalesce(sum(n) FILTER (token IN ({_VOWELS})), 0) / sum(n), 6) AS vowel_pct, round(100.0::DOUBLE * coalesce(sum(n) FILTER (token IN ({_CONSONANTS})), 0) / sum(n), 6) AS consonant_pct FROM {_TOKENS}",
    "text_chunks": "SELECT doc_id, CAST(i * 900 AS INTEGER) AS start, md5(substr(text, i * 900 + 1, 1000)) AS md5 FROM (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 1000 THEN 1 ELSE CAST(ceil((length(text) - 1000) / 900) AS BIGINT) + 1 END)) AS i FROM documents)",
    "duration_labels": "SELECT doc_id, CASE WHEN s >= 3600 THEN printf('%dh %dm %ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm %ds', s // 60, s % 60) ELSE printf('%ds', s) END AS label FROM (SELECT doc_id, CAST(floor(n_chars / 2.0) AS INTEGER) AS s FROM documents)",
    "reason_labels": "SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ' Event Count' AS label, count(*) AS n FROM events GROUP BY 1",
    "text_previews": "SELECT doc_id, left(text, 50) || '...' AS preview FROM documents",
    "url_parts": r"SELECT page_id, name, regexp_replace(name, '(.)\.[^.]*$', '\1') AS stem, regexp_extract(name, '.(\.[^.]*)$', 1) AS suffix, array_to_string(string_split(url, '/')[1:3], '/') AS site FROM (SELECT page_id, url, string_split(url, '/')[-1] AS name FROM pages)",
    "line_counts": "SELECT CASE WHEN starts_with(line, 'The') THEN 'the' WHEN ends_with(line, '.') THEN 'stop' WHEN contains(line, ',') THEN 'comma' ELSE 'other' END AS kind, count(*) AS n FROM (SELECT unnest(string_split(trim(text), chr(10))) AS line FROM documents) GROUP BY 1",
    "token_id_lengths": "SELECT doc_id, CAST(length(regexp_replace(text, '[^a-z ,.]', '', 'g')) + 2 AS INTEGER) AS n_ids FROM documents",
    "log_parse": """WITH e AS (SELECT event_id, event_type, CAST(dayofmonth(ts) AS INTEGER) AS epoch, CAST(event_id % 200 AS INTEGER) AS batch, floor(value) / 100.0 AS a, floor(value / 2) / 100.0 AS b FROM events)
        SELECT event_id, CASE WHEN event_type = 'signup' THEN 'epoch' WHEN event_type <> 'error' THEN 'batch' END AS type, CASE WHEN event_type <> 'error' THEN epoch END AS epoch, CASE WHEN event_type <> 'error' THEN 50 END AS epochs,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN batch END AS batch, CASE WHEN event_type NOT IN ('error', 'signup') THEN 200 END AS batches, CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(printf('%.4f', a) AS DOUBLE) END AS loss,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(printf('%.4f', b) AS DOUBLE) END AS avg, CASE WHEN event_type = 'signup' THEN CAST(printf('%.4f', a) AS DOUBLE) END AS train_loss, CASE WHEN event_type = 'signup' THEN CAST(printf('%.4f', b) AS DOUBLE) END AS val_loss FROM e""",
    "json_props": "SELECT k % 10 AS k10, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (SELECT coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k FROM events) GROUP BY 1",
}
SQL["normalize_text_nfkc"] = SQL["normalize_text"]  # no text here changes under compatibility normalisation
QUERIES = {name: globals()[name] for name in SQL}
