"""One query per operator over its whole table, beside the SQL it must equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeload.llm import chat, decontaminate, exact_substrings, packing, quality, simhash, substrings, token_files, url_filter, warc
from homeload.llm import more_queries  # noqa: F401
from homeload.llm.registry import ORACLES, QUERIES, query
from homeload.llm.stages import SEQUENCE, TOKENIZER
from homeload.queries.tables import table
from homeload.session import shared_folder

__all__ = ["ORACLES", "QUERIES"]



@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to token files and back; the rows are read from the files."""
    folder = shared_folder(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_files.read_digests(spark, folder)


@query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, one row per piece."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0, size=SEQUENCE)
    return packing.pack(cut, SEQUENCE)


@query()
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query(
    f"""
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS answer
      FROM pages
    )
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {warc.base32_sql("h")} AS payload_digest,
           CASE WHEN page_id = answer THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> answer THEN answer END AS refers_to
    FROM p"""
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in Zstandard archives, read back and validated."""
    back = warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SAID = "\\### Assistant: </turn> ok"
OUT_OF_TABLE = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]
OUT_OF_TABLE_SQL = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in OUT_OF_TABLE)


@query(
    f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES {OUT_OF_TABLE_SQL}) AS v(conv_id, turn, role, text)
    ), w AS (
      SELECT *, replace(replace(replace(replace(text, '\\', '\\0'), '###', '\\1'), '</turn>', '\\2'), ':', '\\3') AS escaped,
             '### ' || role || ': ' || ' </turn>' || chr(10) AS marks
      FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
           CAST(sum(length(escaped) + length(marks)) AS BIGINT) AS formatted_chars
    FROM w GROUP BY conv_id"""
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, formatted; every figure is read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(OUT_OF_TABLE, "conv_id long, turn long, role string, text string")
    made = chat.format_chats(rows.unionByName(more))
    back = made.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("learned"),
    )
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
    WITH p AS (
      SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest,
             list_distinct(list_filter(string_split_regex({ASCII_LOWER.format("coalesce(url, '')")}, '[^a-z0-9]+'), lambda t: t <> '')) AS tokens
      FROM pages
    ), h AS (
      SELECT page_id, url, tokens, {ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM p
    ), l AS (
      SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id
    ), b AS (
      SELECT h.tokens, l.bad FROM h JOIN l ON h.page_id = l.doc_id
    ), least AS (
      SELECT greatest({url_filter.MIN_COUNT}, ceil({url_filter.MIN_SHARE} * count(*))) AS n FROM b
    ), s AS (
      SELECT list_filter(list_sort(b.tokens), lambda t, i: (r.m >> (i - 1)) % 2 = 1) AS tokens, bad
      FROM b, unnest(range(1, CAST(pow(2, len(b.tokens)) AS BIGINT))) AS r(m)
    ), r AS (
      SELECT tokens FROM s GROUP BY tokens
      HAVING count_if(bad) >= (SELECT n FROM least) AND count_if(bad) >= {url_filter.MIN_CONFIDENCE} * count(*)
    ), m AS (
      SELECT DISTINCT h.url FROM h, r WHERE list_has_all(h.tokens, r.tokens)
    ), g AS (
      SELECT *, rh || rp AS rule, row_number() OVER (PARTITION BY page_id, url ORDER BY length(rh || rp) DESC) AS k
      FROM (SELECT page_id, url, host, path FROM h) x, (VALUES {rules}) AS v(verdict, rh, rp)
      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    )
    SELECT h.page_id, h.host, h.path, g.rule, coalesce(g.verdict, CASE WHEN m.url IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM h LEFT JOIN g ON g.page_id = h.page_id AND g.url = h.url AND g.k = 1 LEFT JOIN m ON m.url = h.url"""


@query(_url_sql())
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by stated rules, else by rules mined from the labels of the documents of the same number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.bool_or(bad).alias("bad"))
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    return url_filter.judge(pages, labelled, URL_RULES)


WORD_SQL = r"[^\x20\x09-\x0D]+"

_QUALITY_SQL = f"""
    WITH d AS (
      SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS words, string_split(coalesce(text, ''), chr(10)) AS lines
      FROM documents
    ), t AS (
      SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM d, unnest(range(1, len(words) - 1)) AS r(i)
    ), x AS (
      SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS n FROM t) WHERE n > 1
    ), n AS (
      SELECT k, CAST(count(DISTINCT i + j) AS BIGINT) AS n_repeat_words FROM x, unnest([0, 1, 2]) AS o(j) GROUP BY k
    ), q AS (
      SELECT doc_id, text, lines, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             list_filter(lines, lambda s: regexp_matches(s, '{WORD_SQL}')) AS full_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(text) - length(replace(text, '!', '')) AS bangs,
             length(text) - length(regexp_replace(text, '[!-@\\[-`{{-~]', '', 'g')) AS signs
      FROM d LEFT JOIN n USING (k)
    ), f AS (
      SELECT *, CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
      FROM q
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR 10 * bangs > 3 * n_words OR (n_dup_lines > 3 AND 10 * n_dup_lines > 3 * (len(lines) - 1))
                OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * signs > word_chars) AS kept
    FROM f"""


@query(_QUALITY_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every whole text."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "q.*", "base_failed", "kept")


BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = f"regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{BENCH_WORD}')"

_DECONTAMINATE_SQL = f"""
    WITH d AS (
      SELECT doc_id, row_number() OVER () AS k, {_WORDS} AS w FROM documents
    ), b AS (
      SELECT item_id, {_WORDS} AS w FROM benchmark
    ), bw AS (
      SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
      FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(i) WHERE len(w) > 0
    ), dw AS (
      SELECT k, i, size, array_to_string(w[i : i + size - 1], ' ') AS s
      FROM d, (SELECT DISTINCT size FROM bw) z, unnest(range(1, len(w) - size + 2)) AS r(i)
    ), m AS (
      SELECT k, i, dw.size, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.size = bw.size
    ), h AS (
      SELECT k, count(DISTINCT i + j) AS n_hit FROM m, unnest(range(0, m.size)) AS o(j) GROUP BY k
    ), t AS (
      SELECT k, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT k, item_id FROM m) GROUP BY k
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)"""


@query(_DECONTAMINATE_SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every whole document."""
    judged = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the passages that documents with smaller ids hold."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"), "text")


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the bytes of 50-byte strings that documents with smaller ids hold."""
    kept = exact_substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
