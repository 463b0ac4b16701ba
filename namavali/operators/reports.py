"""Reports as ordered lines: (section, item, line_no, line). Headings hold counts, never the time of day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize, with_sequence
from .clusters import adjacent_distances
from .duplicates import occurrences
from .validate import Validated

_S = "section int, item long, line_no int, line string"


def _rows(df: DataFrame, section: int, lines: Column) -> DataFrame:
    """lines: an array for each row of df, which has `item`."""
    return df.select(F.lit(section).alias("section"), F.col("item").cast("long").alias("item"), F.posexplode(lines).alias("line_no", "line"))


def _item(df: DataFrame, *order) -> DataFrame:
    """Consecutive numbers in a report's order; items grow with the input, so they are numbered by ranges."""
    return with_sequence(df, list(order), "item")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def duplicates_report(names: DataFrame, groups: DataFrame, statistics: DataFrame) -> DataFrame:
    """names: seq, name. groups: their duplicate_groups. Nothing is reported if there are none.

    An occurrence's line is its place among all occurrences less the place of its group's first one, so no group is ever
    brought together.
    """
    c = F.col
    head = statistics.where("duplicate_groups > 0").withColumn("item", F.lit(0))
    head = _rows(
        head,
        1,
        F.array(
            F.lit("DUPLICATE NAMES REPORT"),
            F.lit("SUMMARY STATISTICS"),
            _text("Total names processed: ", c("total")),
            _text("Unique names (after deduplication): ", c("unique_names")),
            _text("Duplicate groups found: ", c("duplicate_groups")),
            _text("Total duplicates removed: ", c("total_duplicates")),
            F.format_string("Duplicate rate: %.2f%%", c("total_duplicates") * 100.0 / c("total")),
        ),
    )
    g = materialize(_item(groups, F.desc("cnt"), "first_seq"), "groups")
    body = _rows(g, 2, F.array(_text("--- Group #", c("item"), " ---"), _text("Normalized form: ", c("normalized")), _text("Total occurrences: ", c("cnt")), F.lit("Variations found:")))
    placed = with_sequence(occurrences(names, g), ["item", "seq"], "place")
    first = placed.groupBy("item").agg(F.min("place").alias("first"))
    told = placed.join(first, "item").select(
        F.lit(2).alias("section"), "item", (c("place") - c("first") + 4).cast("int").alias("line_no"), _text("  Line ", c("seq"), ": ", c("name")).alias("line")
    )
    return head.unionByName(body).unionByName(told)


def cross_file_report(names: DataFrame) -> DataFrame:
    """names: cross_file. Most files first, then by key; nothing if no name is in several files."""
    head = names.agg(F.count("*").alias("n")).where("n > 0").withColumn("item", F.lit(0))
    head = _rows(head, 1, F.array(F.lit("CROSS-FILE FIRST NAMES REPORT"), _text("Names appearing in multiple PDF files: ", F.col("n"))))
    g = _item(names, F.desc("n_pdfs"), "normalized")
    files = F.transform("pdfs", lambda p: F.concat(F.lit("    - "), p))
    return head.unionByName(_rows(g, 2, F.concat(F.array(F.col("normalized"), _text("  Found in ", F.col("n_pdfs"), " PDF(s):")), files)))


def summary_report(full: DataFrame, first: DataFrame, sources: DataFrame, top: int = 5) -> DataFrame:
    """What a run has written: names of each file, first names, names of several files with the most frequent, total."""
    c = F.col
    files = materialize(full.groupBy("pdf_file").agg(F.count("*").alias("n")), "files")
    cross = sources.where("n_pdfs > 1")
    both = first.agg(F.count("*").alias("n")).crossJoin(cross.agg(F.count("*").alias("m"))).withColumn("item", F.lit(0))  # one row each
    said = F.array(F.lit("Global First Names"), _text("  Total unique first names collected: ", c("n")), _text("  Names appearing in multiple PDFs: ", c("m")))
    most = _item(cross.select("normalized", "n_pdfs").orderBy(F.desc("n_pdfs"), "normalized").limit(top), F.desc("n_pdfs"), "normalized")
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).withColumn("item", F.lit(0))
    out = _rows(_item(files, "pdf_file"), 1, F.array(_text(c("pdf_file"), ":"), _text("  Full names: ", c("n"))))
    out = out.unionByName(_rows(both, 2, said)).unionByName(_rows(most, 3, F.array(_text("    ", c("normalized"), ": ", c("n_pdfs"), " PDFs"))))
    return out.unionByName(_rows(total, 4, F.array(_text("Total full names written: ", c("n")))))


def review_report(v: Validated) -> DataFrame:
    """Counts, clusters with their distances, ill-formed names, and names with known patterns."""
    c = F.col
    head = _rows(
        v.summary().withColumn("item", F.lit(0)),
        0,
        F.array(
            F.lit("CONSOLIDATED NAMES NEEDING MANUAL REVIEW"),
            _text("Total items flagged: ", c("flagged")),
            _text("  - Phonetic variant clusters: ", c("clusters")),
            _text("  - Morphologically invalid: ", c("morphology")),
            _text("  - Pattern-based corrections: ", c("patterns")),
        ),
    )
    member = F.struct("pos", F.concat(F.lit("  • "), c("name"), F.lit(" → ["), c("latin"), F.lit("] (appears "), c("cnt").cast("string"), F.lit(" times)")).alias("t"))
    step = F.struct("pos", F.concat(F.lit("    "), c("latin"), F.lit(" ↔ "), c("next_latin"), F.lit(" = "), c("distance").cast("string")).alias("t"))
    groups = v.clusters.groupBy("cluster_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(member)).alias("m"))
    steps = adjacent_distances(v.clusters).groupBy("cluster_id").agg(F.array_sort(F.collect_list(step)).alias("d"))
    both = groups.join(steps, "cluster_id").withColumn("item", c("cluster_id"))
    first = _rows(both, 1, F.concat(F.array(_text("--- Cluster #", c("cluster_id"), " (", c("n"), " variants) ---")), c("m.t"), F.array(F.lit("  Edit distances:")), c("d.t")))
    m = _item(v.morphology, "seq")
    second = _rows(m, 2, F.concat(F.array(_text("--- Item #", c("item"), " ---"), _text("  Name: ", c("name")), F.lit("  Issues:")), F.transform("reasons", lambda r: F.concat(F.lit("    - "), r))))
    p = _item(v.patterns, "seq")
    third = _rows(p, 3, F.array(_text("--- Item #", c("item"), " ---"), _text("  Original: ", c("name")), _text("  Suggested: ", c("suggested")), _text("  Patterns: ", F.array_join("flags", ", "))))
    none = lambda df, k, said: _rows(df.limit(1).agg(F.count("*").alias("n")).where("n = 0").withColumn("item", F.lit(0)), k, F.array(F.lit(f"  (No {said} found)")))
    parts = (first, second, third, none(v.clusters, 1, "phonetic variants"), none(v.morphology, 2, "morphologically invalid names"), none(v.patterns, 3, "pattern-based errors"))
    out = head
    for part in parts:
        out = out.unionByName(part)
    return out


def error_report(errors: DataFrame, rejects: DataFrame, review: DataFrame | None = None) -> DataFrame:
    """errors: pdf_file, page_num, block_no, raw_text, reason. rejects: ..., name, reason. review: pdf_file, page_num,
    original_name, corrected_name, reason."""
    c = F.col
    where = (_text("File: ", c("pdf_file")), _text("Page: ", c("page_num")))
    e = _item(errors, "pdf_file", "page_num", "block_no")
    r = _item(rejects, "pdf_file", "page_num", "block_no", "name", "reason")
    out = _rows(e, 1, F.array(_text("--- Error #", c("item"), " ---"), *where, _text("Reason: ", c("reason")), F.lit("Raw Text:"), c("raw_text")))
    out = out.unionByName(_rows(r, 2, F.array(_text("--- Rejected #", c("item"), " ---"), *where, _text("Name: ", c("name")), _text("Reason: ", c("reason")))))
    if review is not None:
        v = _item(review, "pdf_file", "page_num", "original_name")
        out = out.unionByName(_rows(v, 3, F.array(_text("--- Review Item #", c("item"), " ---"), *where, _text("Original: ", c("original_name")), _text("Corrected: ", c("corrected_name")), _text("Reason: ", c("reason")))))
    return out
