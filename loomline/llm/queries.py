"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import spread
from . import decontamination, language_id, near_dedup, packing, pii, quality_rules, substring_dedup, token_counts, url_filters, warc
from ._common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


HOST_RULES = (
    url_filters.HostRule("block", "com", "/en/"),
    url_filters.HostRule("allow", "example.com", "/en/7"),
    url_filters.HostRule("allow", "net", "/de/"),
    url_filters.HostRule("block", "example.net", "/de/8"),
    url_filters.HostRule("block", "org", "/es/"),
)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    files = warc.write_archives(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"), "page_id", "url", payload)
    records = warc.read_archives(files, payloads=False).filter("kind = 'record'")
    return records.select(warc.id_of("warc-record-id").alias("page_id"), "payload_bytes", "payload_digest", F.col("headers")["warc-type"].alias("record_type"), warc.id_of("warc-refers-to").alias("refers_to"))


OP2_SQL = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS h, min(page_id) OVER (PARTITION BY sha1(b)) AS least FROM p)
SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> least THEN least END AS refers_to
FROM h
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = pii.detect(docs)
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), added)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_rules.judge(docs, sample=quality_rules.planning_sample(docs))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *figures)


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, greatest(len(words) - 1, 1))) AS i, words FROM w WHERE len(words) >= 3),
n AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS c FROM g),
x AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM n WHERE c > 1) GROUP BY r),
f AS (SELECT doc_id, t, words, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN x USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT (base_failed
        OR NOT (word_chars / greatest(n_words, 1) BETWEEN 2 AND 15)
        OR n_symbols > 0.25 * n_words
        OR n_dup_lines > 0.5 * len(lines)
        OR (length(t) - length(regexp_replace(t, '\p{L}', '', 'g'))) / greatest(length(t), 1) < 0.5
        OR (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g'))) / greatest(length(t), 1) > 0.5
        OR len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) / greatest(len(words), 1) < 0.6
        OR len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) / greatest(len(lines), 1) > 0.5
        OR len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•*‣-][\x20\x09]'))) / greatest(len(lines), 1) > 0.9) AS kept
FROM b
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT r, unnest(range(1, greatest(len(words) - 33, 1))) AS i, words FROM d WHERE len(words) >= 35),
k AS (SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM w),
s AS (SELECT r, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
g AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM s) GROUP BY r),
o AS (SELECT d.r, doc_id, words, coalesce(gone, []) AS gone FROM d LEFT JOIN g ON d.r = g.r)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM o
"""


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    return url_filters.judge_urls(pages, [*HOST_RULES, *url_filters.PATTERNS]).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM u),
r AS (SELECT *, CASE
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule FROM h)
SELECT CAST(page_id AS BIGINT) AS page_id, host, path, rule, CASE
    WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(lower(coalesce(url, '')), '/wp-login\.php([?#]|$)|[?&]phpsessionid=|[?&]jsessionid=|/cgi-bin/|/checkout/cart([/?#]|$)|\.exe([?#]|$)|[./]doubleclick\.net/|/(ad|ads)/(click|track)') THEN 'block'
    WHEN regexp_matches(lower(coalesce(url, '')), '/wp-admin/|/xmlrpc\.php([?#]|$)|[?&](sessionid|phpsessid|replytocom)=|/(signin|signup|login|logout|register)([/?#]|$)|/cart/(add|remove)([/?#]|$)|\.(zip|rar|iso|apk|dmg|msi)([?#]|$)|[./](googlesyndication|adnxs|scorecardresearch)\.com/|/(print|email)-this-page([/?#]|$)') THEN 'block'
    ELSE 'allow' END AS verdict FROM r
"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    manifest = token_counts.write_token_files(table(spark, sf_dir, "documents"), folder)
    counts = token_counts.count_documents(token_counts.file_sizes(spark, manifest))
    return manifest.join(counts, ["path", "ordinal"]).select("doc_id", "n_tokens", "part", "ordinal", "start", "closed")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out()))
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_warc": op2_warc,
    "op3_pii": op3_pii,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
}
SQL = {"op2_warc": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op5_url_filters": OP5_SQL, "op9_quality_rules": OP9_SQL}
