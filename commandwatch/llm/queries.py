"""One query for each operator, over the whole of its table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import fill_in_middle, filter_audit, fingerprints, near_dedup, ngram_join, packing, personal_data, quality_classifier, quality_rules, secrets, substring_dedup, tokenizing, toxicity
from .labelled import held_out
from .spark_io import prepare

TOKENIZER = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_findings(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, labels, held_out(4, 2))


@query
def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizing.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Likeness(words=3, percent=85, bands=25, rows=5))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.quality_scores(docs, labels, held_out(5, 0))


@query
def op9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_unrepeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digests(table(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.span_digests(table(spark, sf_dir, "documents"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.arrangement_digests(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def linked_sql(words: int, percent: int, more: str = "") -> str:
    """Components of documents by the Jaccard similarity of their word n-grams."""
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[place:place + {words - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - {words - 1}) + 1)) AS place FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT id, b FROM reach JOIN links ON other = a
), least AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM documents JOIN least ON id = doc_id LEFT JOIN sizes USING (doc_id)
"""


ORACLES["op5_near_duplicates"] = linked_sql(3, 85, ", doc_id = component_id AS kept")
ORACLES["op13_ngram_join"] = linked_sql(5, 80)
ORACLES["op11_fill_in_middle"] = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS draws FROM tokens
), cuts AS (
  SELECT *, least(draws[1] % (n + 1), draws[2] % (n + 1)) AS low, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR draws[3] % 100 >= 50 THEN 'plain'
      WHEN draws[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix, coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
    coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""
ORACLES["op12_filter_audit"] = r"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM base GROUP BY text
), said AS (
  SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), counted AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM base
), failed AS (
  SELECT part, doc_id, CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
    + 4 * CAST(100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(first < doc_id AS INT) AS mask
  FROM counted JOIN firsts USING (text)
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad
  FROM failed LEFT JOIN said USING (doc_id) GROUP BY part, mask
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), summed AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM cells, (SELECT filter_order, step, bit, CAST(earlier AS INT) AS earlier FROM steps) GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM summed
"""
ORACLES["op7_unrepeated"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, place, list_slice(words, place, place + 12) AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM texts)
), firsts AS (
  SELECT run, min(struct_pack(doc := doc_id, place := place)) AS source FROM windows GROUP BY run
), copied AS (
  SELECT doc_id, place, source FROM windows JOIN firsts USING (run) WHERE source.doc < doc_id
), gone AS (
  SELECT DISTINCT doc_id, place + k AS place FROM copied, (SELECT unnest(range(0, 13)) AS k)
), factors AS (
  SELECT doc_id, count(*) AS n_factors FROM (
    SELECT doc_id, place, source, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before,
      lag(source) OVER (PARTITION BY doc_id ORDER BY place) AS earlier FROM copied)
  WHERE before IS NULL OR before <> place - 1 OR earlier.doc <> source.doc OR earlier.place <> source.place - 1 GROUP BY doc_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT texts.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256, coalesce(n_factors, 0) AS n_factors
FROM texts LEFT JOIN kept ON kept.doc_id = texts.doc_id
LEFT JOIN factors ON factors.doc_id = texts.doc_id
"""
