"""A training-corpus pipeline over documents: rules, exact copies, near copies, secrets, packing.

Each stage takes what the one before has kept, written as Parquet and read again. All but the last return the columns
of documents; the last returns the pieces of the packed sequences.

Defined results: null and empty texts fail the rules and go; rows repeated with id and text stay once; of equal texts a row
with an id stays before one without, and a near copy without an id is not dropped; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namavali.llm import dedup, ngram_join, packing, queries, rules, secrets
from namavali.llm.common import materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return rules.filter_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8, the row with the smallest id."""
    return ngram_join.drop_near_duplicates(docs, k=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text."""
    out = secrets.mask_secrets(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern())
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.best_fit_pack(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizing cannot be written in SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
