"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import html_text, licences, media, mixing, ngram_join, pieces, quality, sharding, tokens, url_filter
from .common import documents, stored


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).selectExpr("doc_id", "n_licence_lines", "array_join(families, ',') as families")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf_dir))
    return plan.selectExpr("doc_id", "size", "source_size", "target", "size * copies as taken", "source", "copies")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is written once; two versions of the policy and the ablations read it."""
    rows = stored(quality.ledger(documents(spark, sf_dir)), "ledger")
    rows = quality.apply_policy(quality.apply_policy(rows, quality.BASE, "base_kept"), quality.PRODUCTION)
    rows = quality.with_only_rule(rows, quality.PRODUCTION)
    return rows.selectExpr("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "not base_kept as base_failed", "kept", "fail_bits", "only_rule", "n_only")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


#: The dated filter-list entries that op8 applies (list_name, kind, pattern, action, since).
URL_ENTRIES = (
    ("adult", "domain", "adult-x.example.com", "block", "2023-06-01"),
    ("ads", "domain", "ads-track.example.com", "block", "2024-02-10"),
    ("ads", "domain", "ads-track.example.com", "remove", "2024-09-15"),
    ("gambling", "domain", "casino-win.example.net", "block", "2024-03-01"),
    ("gambling", "domain", "casino-win.example.net", "remove", "2024-05-01"),
    ("gambling", "domain", "casino-win.example.net", "block", "2024-07-20"),
    ("gambling", "domain", "free-bets.example.net", "block", "2024-01-15"),
    ("spam", "domain", "spam-farm.example.org", "block", "2023-01-01"),
    ("spam", "domain", "cheap-pills.example.com", "block", "2024-04-01"),
    ("spam", "domain", "cheap-pills.example.net", "block", "2024-04-01"),
    ("spam", "domain", "example.org", "block", "2024-11-01"),
    ("partners", "domain", "tionsh.example.net", "allow", "2024-01-01"),
    ("review", "prefix", "tionsh.example.net/de", "block", "2024-06-01"),
    ("review", "prefix", "tionsh.example.net/de", "remove", "2024-08-01"),
    ("review", "prefix", "blog.tionsh.example.net/fr/", "block", "2024-02-01"),
    ("partners", "domain", "blog.ththre.example.org", "allow", "2024-10-01"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages have no fetch time: a page's day is 2024-01-01 and page_id mod 366 days."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id", "url", "date_add(date'2024-01-01', cast(page_id % 366 as int)) as day")
    entries = spark.createDataFrame(list(URL_ENTRIES), "list_name string, kind string, pattern string, action string, since string")
    return url_filter.verdicts(pages, entries)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_licence_scan, op2_pieces, op3_main_text, op4_mixing, op5_sharding, op6_quality, op7_token_ids, op8_url_filter, op9_media, op10_ngram_join)}

def _op8_sql() -> str:
    values = ", ".join("(" + ", ".join(f"'{x}'" for x in e) + ")" for e in URL_ENTRIES)
    return f"""
WITH log AS (
  SELECT list_name, CASE WHEN kind = 'domain' THEN lower(pattern) ELSE regexp_replace(pattern, '/+$', '') END AS key, CAST(since AS DATE) AS valid_from, max(action) AS action
  FROM (VALUES {values}) v(list_name, kind, pattern, action, since) GROUP BY 1, 2, 3),
spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY list_name, key ORDER BY valid_from) AS valid_to FROM log),
captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS day, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '') AS path FROM pages),
hits AS (
  SELECT c.page_id, s.action AS verdict, s.list_name, s.key AS entry, s.valid_from,
    row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.key) DESC, s.action = 'allow', s.list_name, s.key) AS rank
  FROM captures c JOIN spans s ON c.host <> '' AND (c.host = s.key OR ends_with(c.host, '.' || s.key) OR starts_with(c.host || c.path || '/', s.key || '/'))
    AND c.day >= s.valid_from AND (s.valid_to IS NULL OR c.day < s.valid_to)
  WHERE s.action <> 'remove')
SELECT c.page_id, c.url, CAST(c.day AS DATE) AS day, coalesce(h.verdict, 'none') AS verdict, h.list_name, h.entry, h.valid_from
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.rank = 1
"""


OP6_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM words),
windows AS (
  SELECT doc_id, i, t || ' ' || lead(t, 1) OVER z || ' ' || lead(t, 2) OVER z || ' ' || lead(t, 3) OVER z || ' ' || lead(t, 4) OVER z || ' ' || lead(t, 5) OVER z
    || ' ' || lead(t, 6) OVER z || ' ' || lead(t, 7) OVER z AS g FROM tokens WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows WHERE g IS NOT NULL),
marked AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM twice WHERE n > 1) GROUP BY doc_id),
filled AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(lines) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(f.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_repeat_words, coalesce(f.n_lines, 0) AS n_lines,
    length(regexp_replace(w.text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(w.text, '[^A-Z]', '', 'g')) AS n_upper
  FROM words w LEFT JOIN filled f ON f.doc_id = w.doc_id LEFT JOIN marked k ON k.doc_id = w.doc_id),
bits AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)::INT
    + 16 * (n_words >= 20 AND 100 * n_upper > 80 * n_letters)::INT + 32 * (n_words > 0 AND word_chars > 40 * n_words)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits,
  CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'repeated_lines' WHEN 16 THEN 'shouting' WHEN 32 THEN 'long_words' END AS only_rule,
  CASE WHEN bit_count(fail_bits) = 1 THEN count(*) OVER (PARTITION BY fail_bits) END AS n_only FROM bits
"""

OP10_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 75 * (s.n + t.n - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS a, x AS b FROM edges UNION SELECT r.a, e.y FROM reach r JOIN edges e ON e.x = r.b),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.m, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN least l ON l.a = w.doc_id
"""

ORACLE: dict[str, str] = {"op6_quality": OP6_SQL, "op8_url_filter": _op8_sql(), "op10_ngram_join": OP10_SQL}
