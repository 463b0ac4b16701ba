"""Groups of names with one comparison key, their statistics, and the files they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import normalize_key


def groups(df: DataFrame, order: str = "seq", name: str = "name") -> DataFrame:
    """Per key: normalized, cnt, first_seq."""
    return df.groupBy(normalize_key(name).alias("normalized")).agg(F.count("*").alias("cnt"), F.min(order).alias("first_seq"))


def occurrences(df: DataFrame, of: DataFrame, order: str = "seq", name: str = "name") -> DataFrame:
    """A row for each occurrence of the groups `of`: their columns, seq, name. A frequent key stays many rows, so the join
    can be split where it is skewed."""
    rows = df.select(normalize_key(name).alias("normalized"), F.col(order).alias("seq"), F.col(name).alias("name"))
    return of.join(rows, "normalized")


def duplicate_groups(df: DataFrame, order: str = "seq", name: str = "name") -> DataFrame:
    """Keys that occur more than once; most frequent first, then by first occurrence."""
    return groups(df, order, name).where("cnt > 1")


def statistics(df: DataFrame, name: str = "name") -> DataFrame:
    """One row: total, unique_names, duplicate_groups, total_duplicates, duplicate_rate."""
    c = df.groupBy(normalize_key(name).alias("k")).count()
    s = c.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.count("*").alias("unique_names"),
        F.count_if(F.col("count") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("total_duplicates"),
    )
    rate = F.when(F.col("total") > 0, F.col("total_duplicates") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    return s.withColumn("duplicate_rate", F.round(rate, 2))


def sources(df: DataFrame, name: str = "name", file: str = "pdf_file") -> DataFrame:
    """Per key the files it occurs in, sorted; every occurrence counts, kept or not."""
    g = df.groupBy(normalize_key(name).alias("normalized")).agg(F.array_sort(F.collect_set(file)).alias("pdfs"))
    return g.withColumn("n_pdfs", F.size("pdfs"))


def cross_file(df: DataFrame, name: str = "name", file: str = "pdf_file") -> DataFrame:
    """Keys that occur in several files."""
    return sources(df, name, file).where("n_pdfs > 1")
