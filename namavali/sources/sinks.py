"""Writers: names by file, valid names, and reports as text; rejects and errors as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_full_names(names: DataFrame, path: str, order: list[str]) -> None:
    """One folder a file, in order: path/pdf_file=stem/part-*.txt. A file's names are of one task, sorted."""
    dealt = names.repartition("pdf_file").sortWithinPartitions("pdf_file", *order)
    dealt.select("pdf_file", F.col("name").alias("value")).write.mode("overwrite").partitionBy("pdf_file").text(path)


def write_lines(rows: DataFrame, path: str, order: list[str], column: str = "line") -> None:
    """Ordered text in parts whose names sort in the same order; a range of the order is a part."""
    rows.orderBy(*order).select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(by or [])).parquet(path)
