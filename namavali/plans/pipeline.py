"""The whole run: pages to accepted names, deduplication, validation, tables and reports."""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, duplicates, extract, reports, validate
from ..sources import sinks
from ..sources.tables import materialize, with_sequence

ORDER = ["pdf_file", "page_num", "block_no", "line_no", "part_no"]


@dataclass
class Run:
    full: DataFrame  # accepted full names after the window of each file
    first: DataFrame  # first names after the window of all files, with seq
    validated: validate.Validated
    errors: DataFrame
    rejected: DataFrame
    sources: DataFrame


def run(pages: DataFrame, dedup_window: int = 1000, mode: str | None = None) -> Run:
    """pages: pdf_file, page_num, text. Names are in order of file, page and place."""
    found = materialize(extract.extraction(extract.repair(pages)), "extraction")
    full = extract.accepted(found)
    messages = extract.first_name_rows(full)
    errors = extract.block_errors(found).unionByName(extract.page_errors(pages).withColumn("block_no", F.lit(0)).withColumn("raw_text", F.lit("")))
    kept = dedup.deduplicate(full.withColumnRenamed("full_name", "name"), ["pdf_file"], ORDER, dedup_window)
    first = with_sequence(dedup.deduplicate(messages, [], [*ORDER, "word_no"], dedup_window), [*ORDER, "word_no"])
    first = materialize(first, "first")
    return Run(kept, first, validate.validate(first, mode), errors, extract.rejected(found), duplicates.sources(messages))


def write(r: Run, path: str) -> None:
    sinks.write_full_names(r.full, f"{path}/extracted_names", ORDER)
    sinks.write_lines(r.validated.valid, f"{path}/only_names", ["seq"], "name")
    at = ["section", "item", "line_no"]
    sinks.write_lines(reports.review_report(r.validated), f"{path}/only_names_errors", at)
    sinks.write_lines(reports.duplicates_report(r.first, duplicates.duplicate_groups(r.first), duplicates.statistics(r.first)), f"{path}/only_names_duplicates_report", at)
    sinks.write_lines(reports.cross_file_report(r.sources.where("n_pdfs > 1")), f"{path}/only_names_cross_file_report", at)
    sinks.write_lines(reports.error_report(r.errors, r.rejected), f"{path}/errors_report", at)
    sinks.write_lines(reports.summary_report(r.full, r.first, r.sources), f"{path}/summary", at)
    sinks.write_table(r.errors, f"{path}/errors")
    sinks.write_table(r.rejected, f"{path}/rejected")


def arguments(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="namavali", description="Names from a folder of roll pages.")
    p.add_argument("-f", "--folder", required=True, help="folder of *.pdf files")
    p.add_argument("-o", "--output", default="./output", help="folder of results")
    p.add_argument("-p", "--pages", default="3-32", help="first and last page, START-END")
    p.add_argument("-w", "--workers", type=int, default=0, help="threads where Spark runs in one process; 0: all but one")
    p.add_argument("--dedup-window", type=int, default=0, help="recent keys that are remembered; 0: 1000")
    p.add_argument("-a", "--add-correction", choices=("phonetic_dict", "pattern", "both"), help="corrections applied to first names")
    a = p.parse_args(argv)
    start, dash, end = a.pages.partition("-")
    if not (dash and start.strip().isdigit() and end.strip().isdigit()) or not 1 <= int(start) <= int(end):
        p.exit(1, f"pages must be START-END with 1 <= START <= END, not {a.pages}\n")
    if a.workers < 0 or a.dedup_window < 0:
        p.exit(1, "workers and dedup-window must not be negative\n")
    a.start, a.end, a.dedup_window = int(start), int(end), a.dedup_window or 1000
    return a


def folder_problem(spark: SparkSession, folder: str) -> str | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return f"Folder does not exist: {folder}"
    return None if system.getFileStatus(path).isDirectory() else f"Path is not a directory: {folder}"


def main(argv: list[str] | None = None) -> int:
    import os

    from ..sources.pages import PdfplumberReader, read_pages, tesseract

    a = arguments(sys.argv[1:] if argv is None else argv)
    builder = SparkSession.builder.appName("namavali")
    if "SPARK_MASTER" not in os.environ and not SparkSession.getActiveSession():
        builder = builder.master(f"local[{a.workers or max(1, (os.cpu_count() or 2) - 1)}]")
    spark = builder.getOrCreate()
    if problem := folder_problem(spark, a.folder):
        print(problem)
        return 1
    pages, status = read_pages(spark, a.folder, PdfplumberReader(), a.start, a.end, tesseract)
    pages, status = materialize(pages, "pages"), materialize(status, "status")
    if status.isEmpty():
        print(f"No PDF files in {a.folder}")
        return 0
    write(run(pages, a.dedup_window, a.add_correction), a.output)
    sinks.write_table(status, f"{a.output}/file_status")
    for r in spark.read.text(f"{a.output}/summary").where("value NOT LIKE '  Full names:%' AND value NOT LIKE '%:'").collect():  # the totals and top five
        print(r.value)
    return 0


if __name__ == "__main__":
    sys.exit(main())
