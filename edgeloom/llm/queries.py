"""Registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import (
    collocations,
    conversation_repair,
    embedding_neardup,
    exact_dedup,
    language_id,
    packing,
    pii_semicrf,
    quality_pu,
    secret_scan,
    sentencepiece_sampling,
    simhash_neardup,
    url_filters,
    warc_zip,
)
from edgeloom.llm.storage import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed vocabularies keep ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_table(spark, sf_dir, "documents")).drop("n")


def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_sampling.encode_rows(docs, tokenizer_file("piece_bpe_32k.model"))


def op5_warc_zip_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(spark, _table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op10_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_semicrf.scan(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(_table(spark, sf_dir, "conversations"))
    return conversation_repair.report(damaged, copies_col="copies")


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(_table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_simhash_near_dedup,
        op3_exact_dedup,
        op4_sentencepiece_sampling,
        op5_warc_zip_round_trip,
        op6_packing,
        op7_language_id,
        op8_quality_pu,
        op9_secret_scan,
        op10_pii_semicrf,
        op11_conversation_repair,
        op12_url_filters,
        op13_collocations,
    )
}

SQL: dict[str, str] = {}

SQL["op3_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER stays AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER stays = 1 AS kept, text_sha256
FROM texts WINDOW stays AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)"""

SQL["op5_warc_zip_round_trip"] = r"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (SELECT page_id, payload, octet_length(payload) AS payload_bytes, unhex(sha1(payload)) AS raw FROM payloads),
bits AS (SELECT page_id, payload, payload_bytes, [('0x' || substr(hex(raw), 5 * i + 1, 5))::BIGINT FOR i IN range(8)] AS words FROM digests),
named AS (SELECT page_id, payload, payload_bytes, array_to_string(flatten([[
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((w >> (15 - 5 * k)) & 31)::INT, 1) FOR k IN range(4)] FOR w IN words]), '') AS payload_digest FROM bits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER same THEN NULL ELSE min(page_id) OVER same END AS refers_to
FROM named WINDOW same AS (PARTITION BY payload)"""

_ASSIGN = """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRET_KINDS = [
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]{16,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("prefixed", r"(?:ghp|gho|ghs|xoxb|xoxp|sk_live|rk_live)_?-?[A-Za-z0-9-]{16,}", 0, 0),
]
_SECRET_ROWS = "\nUNION ALL\n".join(
    f"SELECT doc_id, source, lang, {rank} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{pattern}') AS gaps, "
    f"regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_extract_all(t, '{pattern}', {group}) AS vals FROM texts"
    for rank, (kind, pattern, group, least) in enumerate(_SECRET_KINDS)
)
_LISTED = "coalesce(string_agg(kind || ':' || p || ':' || till, ',' ORDER BY p, rank) FILTER (WHERE {}), '')"
SQL["op9_secret_scan"] = f"""
WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
matched AS ({_SECRET_ROWS}),
placed AS (
  SELECT doc_id, source, lang, rank, kind, hits[i] AS hit, vals[i] AS val, least,
         list_sum([length(x) FOR x IN gaps[:i]]) + coalesce(list_sum([length(x) FOR x IN hits[:i - 1]]), 0) AS p
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM matched)),
candidates AS (SELECT *, p + length(hit) AS till, sha256(val) AS h FROM placed WHERE length(val) >= least),
owned AS (
  SELECT h, count(DISTINCT coalesce(source, '~')) <= 2 AND count(DISTINCT (coalesce(source, ''), coalesce(lang, ''))) <= 4 AS live
  FROM candidates GROUP BY h),
judged AS (SELECT c.*, live FROM candidates c JOIN owned USING (h)),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex, {_LISTED.format('rank < 3')} AS base, {_LISTED.format('rank < 3 OR live')} AS spans,
         count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM texts LEFT JOIN found USING (doc_id)"""


SQL["op12_url_filters"] = r"""
WITH rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS number, page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM rests),
rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(h, p, verdict)),
ruled AS (
  SELECT number, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY number),
globs AS (
  SELECT * FROM (VALUES ('**cheap-pills**', '[\s\S]*cheap-pills[\s\S]*'), ('**casino**', '[\s\S]*casino[\s\S]*'), ('*.xxx/**', '[^/]*\.xxx/[\s\S]*'),
                        ('**/wp-login.php', '[\s\S]*/wp-login\.php'), ('**/cgi-bin/**', '[\s\S]*/cgi-bin/[\s\S]*'),
                        ('*/search/??/**', '[^/]*/search/[^/]{2}/[\s\S]*')) AS t(pattern, regex)),
globbed AS (SELECT number, arg_min(pattern, (-length(pattern), pattern)) AS pattern FROM parts JOIN globs ON regexp_full_match(host || path, regex) GROUP BY number)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN pattern END AS pattern,
       coalesce(verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts LEFT JOIN ruled USING (number) LEFT JOIN globbed USING (number)"""


SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
        FROM words, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE len(w) >= k)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 100),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(w[:cut], ' ') AS lead, array_to_string(w[cut + 1:], ' ') AS rest
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
rated AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = lead JOIN grams y ON y.lang = c.lang AND y.phrase = rest JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, a, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, k - size + 2)]) AS phrase
  FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates)),
longer AS (SELECT lang, phrase, max(a) AS longest FROM parts GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000"""
