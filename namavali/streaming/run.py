"""The whole run over a stream of pages: extraction once, then windows and sources as states, then the end-of-stream stage.

Pages are extracted as they come into the table `found`. Three queries follow that table: full names by the window of each
file, first names by one window of all files with their running number, and the files that each key occurs in. All go on
from their checkpoints, so a lost executor or a stopped driver repeats no name and loses none. `finish` then validates the
streamed tables and gives what the batch run gives; with pages arriving in the batch order, the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalize_key
from ..operators import duplicates, extract, validate
from ..plans.pipeline import ORDER, Run
from .dedup import keep_recent_stream, read_stream, run_available, start_available

PAGES = "pdf_file string, page_num int, text string"
FIRST = [*ORDER, "word_no"]


def sources_stream(messages: DataFrame) -> DataFrame:
    """The first row of each key and file: norm, pdf_file, name. The state is dealt out by both."""
    return messages.select(normalize_key("name").alias("norm"), "pdf_file", "name").dropDuplicates(["norm", "pdf_file"])


def run_stream(spark: SparkSession, pages: str, out: str, checkpoint: str, dedup_window: int = 1000, files_at_once: int = 100) -> None:
    """Takes in the Parquet files of the folder `pages` that are new since the last call."""
    found = extract.extraction(extract.repair(read_stream(spark, pages, PAGES, files_at_once)))
    run_available(found, f"{out}/found", f"{checkpoint}/found")
    schema = spark.read.parquet(f"{out}/found").schema
    of = lambda: extract.accepted(read_stream(spark, f"{out}/found", schema, files_at_once))
    first = extract.first_name_rows(of())
    queries = {
        "full": keep_recent_stream(of().withColumnRenamed("full_name", "name"), "pdf_file", ORDER, dedup_window),
        "first": keep_recent_stream(first, None, FIRST, dedup_window),
        "sources": sources_stream(first),
    }
    for q in [start_available(df, f"{out}/{k}", f"{checkpoint}/{k}") for k, df in queries.items()]:
        q.awaitTermination()


def finish(spark: SparkSession, pages: str, out: str, mode: str | None = None) -> Run:
    """The end-of-stream stage over the streamed tables; `plans.pipeline.write` writes its lists and reports."""
    read = lambda k: spark.read.parquet(f"{out}/{k}")
    found, first = read("found"), read("first").withColumnRenamed("place", "seq").drop("group")
    empty = extract.page_errors(spark.read.schema(PAGES).parquet(pages)).withColumn("block_no", F.lit(0)).withColumn("raw_text", F.lit(""))
    errors = extract.block_errors(found).unionByName(empty)
    return Run(read("full").drop("group", "place"), first, validate.validate(first, mode), errors, extract.rejected(found), duplicates.sources(read("sources")))
