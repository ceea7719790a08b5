"""Registered queries of this package, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    bpe,
    decontaminate,
    filter_audit,
    fingerprint,
    language_id,
    near_dup,
    periodic_runs,
    pii,
    quality,
    sharding,
    suffix_dedup,
    token_files,
    warc,
)
from basketry.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_bpe")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, folder, "documents"), vocabulary_path(), stored=True)


@query("op5_near_dup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, folder, "documents"))


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op9_decontaminate",
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, pattern)),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op10_pii")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(read_table(spark, folder, "documents"))


@query("op6_token_files")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.written_and_read(read_table(spark, folder, "documents"), vocabulary_path(), stored=True)


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(read_table(spark, folder, "documents"))


@query("op1_fingerprint")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_likeness(read_table(spark, folder, "documents"))


@query("op3_sharding")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.repeated_passages(read_table(spark, folder, "documents"), stored=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# Lyndon roots and their extension have no SQL form of bearable cost; tests use brute force.
@query("op13_runs")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.runs_report(read_table(spark, folder, "documents"))


@query(
    "op12_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, max(page_id) AS stored, strlen(body) >= 1000 AS shared FROM p GROUP BY body)
SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN shared AND page_id IS DISTINCT FROM stored AND stored IS NOT NULL THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN shared AND page_id IS DISTINCT FROM stored THEN stored END AS refers_to
FROM p JOIN g USING (body)""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return warc.written_and_read(read_table(spark, folder, "pages"))


_PARTS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op11_filter_audit",
    rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_PARTS} AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS least_id FROM d GROUP BY t),
l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad
  FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
       + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
       + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
       + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
       + CASE WHEN doc_id > least_id THEN 16 ELSE 0 END AS mask
  FROM d JOIN firsts USING (t) LEFT JOIN l USING (doc_id)),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
  FROM m GROUP BY part, mask),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
  SELECT filter_order, cast(step AS INTEGER) AS step, bits[step] AS bit,
         cast(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS prior
  FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (WHERE mask & bit = 0 AND mask & prior = 0) AS kept,
         sum(n) FILTER (WHERE mask & bit > 0 AND mask & prior = 0) AS removed,
         sum(n) FILTER (WHERE mask & bit > 0 AND mask & prior > 0) AS redundant,
         sum(n) FILTER (WHERE mask = bit) AS unique_fails,
         sum(good) FILTER (WHERE mask & bit > 0 AND mask & prior = 0) AS good_lost,
         sum(bad) FILTER (WHERE mask & bit > 0 AND mask & prior = 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, cast(coalesce(kept, 0) AS BIGINT) AS kept,
       cast(coalesce(removed, 0) AS BIGINT) AS removed, cast(coalesce(redundant, 0) AS BIGINT) AS redundant,
       cast(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, cast(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       cast(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       cast(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM r""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(spark, f"{folder}/documents.parquet", read_table(spark, folder, "labels"))
