"""The registered queries of the corpus operators, one for each, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, dedup, html_text, maxent, ngram_join, packing, quality, rules, secrets, warc
from .common import read_table

_WORD = r"'[^\x20\x09-\x0D]+'"


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.find_secrets(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(read_table(spark, sf_dir, "documents"))


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())


SQL_OP5 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_STOP = ", ".join(f"'{x}'" for x in sorted({v for w in rules.STOP_WORDS for v in (w, w.capitalize(), w.upper())}))
SQL_OP9 = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, {_WORD})) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS x
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_bang
  FROM w LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 1.2 AND 60.0 AND n_symbols / n_words <= 0.25
       AND n_bang / n_words <= 0.5 AND n_dup_lines / n_lines <= 0.6
       AND n_stop / n_words >= 0.005 AS kept
FROM b
"""

QUERIES = {
    f.__name__: f
    for f in (op1_html_text, op2_ngram_join, op3_secrets, op4_warc, op5_exact_dedup, op6_maxent, op7_quality_gam, op8_best_fit_packing, op9_quality_rules, op10_byte_bpe)
}
ORACLE = {"op5_exact_dedup": SQL_OP5, "op9_quality_rules": SQL_OP9}
