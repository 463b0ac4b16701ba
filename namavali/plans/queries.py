"""The registered queries: each applies an operator to the synthetic roll or to a driver table, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import names as N
from ..functions.phonetic import phonetic_similarity, transliterate
from ..functions.text import file_stem, strip, word_list
from ..operators import clusters, dedup, duplicates, extract, reports, validate
from ..sources.pages import FormFeedReader, open_files, read_names
from ..sources.tables import shared_dir, with_sequence
from . import synth
from .pipeline import ORDER

WINDOW = 20  # recent keys in the bounded queries: small enough that keys are evicted
FIRST = [*ORDER, "word_no"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _pages(s: SparkSession, d: str) -> DataFrame:
    return synth.pages(s, d)


def _repaired(s: SparkSession, d: str) -> DataFrame:
    return extract.repair(_pages(s, d).where("text IS NOT NULL"))


def _found(s: SparkSession, d: str) -> DataFrame:
    return extract.extraction(_repaired(s, d))


def _accepted(s: SparkSession, d: str) -> DataFrame:
    return extract.accepted(_found(s, d))


def _firsts(s: SparkSession, d: str) -> DataFrame:
    return extract.first_name_rows(_accepted(s, d))


def _numbered(s: SparkSession, d: str) -> DataFrame:
    return with_sequence(_firsts(s, d), FIRST)


def _listed(s: SparkSession, d: str) -> DataFrame:
    """First names that the default window keeps: seq, name."""
    return with_sequence(dedup.deduplicate(_firsts(s, d), [], FIRST), FIRST).select("seq", "name")


def _given(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).groupBy(F.col("given").alias("name")).agg(F.min("id").alias("id"))


def _spelled(s: SparkSession, d: str) -> DataFrame:
    return clusters.spelled(_given(s, d), "id")


# ---- pages, lines, blocks --------------------------------------------------------------------------------------------


@query
def line_explode(s: SparkSession, d: str) -> DataFrame:
    docs = s.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query
def block_segmentation(s: SparkSession, d: str) -> DataFrame:
    return extract.segment(extract.lines(_repaired(s, d)))


@query
def block_filter(s: SparkSession, d: str) -> DataFrame:
    return extract.blocks(_repaired(s, d)).where(extract.has_label(F.col("block_text")))


@query
def page_range_filter(s: SparkSession, d: str) -> DataFrame:
    return extract.page_range(_pages(s, d), 4, 6).select("pdf_file", "page_num", F.length("text").cast("long").alias("n_chars"))


@query
def ocr_fallback_flag(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d).select("pdf_file", "page_num", extract.needs_ocr("text").alias("needs_ocr"))


@query
def skip_line_filter(s: SparkSession, d: str) -> DataFrame:
    return extract.lines(_repaired(s, d)).where(~extract.is_skipped(F.col("line")))


@query
def id_line_filter(s: SparkSession, d: str) -> DataFrame:
    return extract.lines(_repaired(s, d)).where(extract.is_id_line(strip(F.col("line"))))


@query
def name_lines(s: SparkSession, d: str) -> DataFrame:
    b = block_filter(s, d).select(*extract.KEYS, "block_no", F.posexplode(F.split("block_text", "\n")).alias("line_no", "line"))
    return b.withColumn("line", strip(F.col("line"))).where(extract.is_name_line(F.col("line")))


@query
def label_split(s: SparkSession, d: str) -> DataFrame:
    b = block_filter(s, d).select(*extract.KEYS, "block_no", F.explode(extract.parts_of(F.col("block_text"))).alias("p"))
    return b.select(*extract.KEYS, "block_no", "p.line_no", "p.part_no", "p.part")


@query
def extract_name(s: SparkSession, d: str) -> DataFrame:
    return label_split(s, d).select(*extract.KEYS, "block_no", "line_no", "part_no", extract.extract_name(F.col("part")).alias("name")).where("name <> ''")


@query
def accepted_names(s: SparkSession, d: str) -> DataFrame:
    return _accepted(s, d)


@query
def rejected_names(s: SparkSession, d: str) -> DataFrame:
    return extract.rejected(_found(s, d))


@query
def reject_reasons(s: SparkSession, d: str) -> DataFrame:
    return rejected_names(s, d).groupBy("reason").agg(F.count("*").alias("n"))


@query
def block_errors(s: SparkSession, d: str) -> DataFrame:
    return extract.block_errors(_found(s, d))


@query
def page_errors(s: SparkSession, d: str) -> DataFrame:
    return extract.page_errors(_pages(s, d))


@query
def first_names(s: SparkSession, d: str) -> DataFrame:
    return _firsts(s, d)


@query
def name_messages(s: SparkSession, d: str) -> DataFrame:
    return extract.name_messages(_accepted(s, d))


# ---- functions of text -----------------------------------------------------------------------------------------------


@query
def word_count(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).select("id", F.size(word_list(F.col("full_name"))).alias("n_words"))


@query
def file_stem_query(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", file_stem(F.concat(F.lit("/rolls/"), F.col("page_id").cast("string"), F.lit(".part.pdf"))).alias("stem"))


QUERIES["file_stem"] = QUERIES.pop("file_stem_query")


@query
def names_file_scan(s: SparkSession, d: str) -> DataFrame:
    """Lists with a blank line after each name, written and read back."""
    path = f"{shared_dir(s)}/namavali/lists-{uuid.uuid4().hex}"
    names = F.array_sort(F.collect_list(F.struct("id", "full_name")))
    made = synth.people(s, d).groupBy("pdf_file").agg(F.array_join(names["full_name"], "\n\n").alias("value"))
    made.write.partitionBy("pdf_file").text(path)
    return read_names(s, path, keep=("pdf_file",))


@query
def ocr_corrections(s: SparkSession, d: str) -> DataFrame:
    cards = synth._sql(s, synth.cards_sql(True), people=synth.people(s, d))
    return cards.select("id", N.ocr_corrections("card").alias("card"))


@query
def normalize_key(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).select("id", N.normalize_key("full_name").alias("norm"))


def _cards(s: SparkSession, d: str) -> DataFrame:
    people = synth.people(s, d)
    return synth._sql(s, synth.cards_sql(True), people=people).join(people.select("id", "full_name"), "id")


@query
def is_label_only(s: SparkSession, d: str) -> DataFrame:
    return _cards(s, d).select("id", N.is_label_only("full_name").alias("label_only"), N.is_label_only("card").alias("card_label"))


@query
def clean_name(s: SparkSession, d: str) -> DataFrame:
    labelled = F.concat(F.lit("नाव, "), F.col("full_name"), F.lit(" वडिलांचे"))
    return synth.people(s, d).select("id", N.clean_name("full_name").alias("cleaned"), N.clean_name(labelled).alias("labelled"))


@query
def transliterate_query(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).select("id", transliterate("full_name").alias("spelling"))


QUERIES["transliterate"] = QUERIES.pop("transliterate_query")


@query
def edit_distance(s: SparkSession, d: str) -> DataFrame:
    """Distances between all distinct given names of one Latin length; their number is the list's, not the table's."""
    n = _spelled(s, d)
    a, b = n.select(F.col("name").alias("a"), F.col("latin").alias("la"), "latin_len"), n.select(F.col("name").alias("b"), F.col("latin").alias("lb"), "latin_len")
    return a.join(b, "latin_len").where("a < b").select("a", "b", F.levenshtein("la", "lb").cast("long").alias("distance"))


@query
def phonetic_similarity_query(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).select("id", F.round(phonetic_similarity("given", "middle"), 6).alias("similarity"))


QUERIES["phonetic_similarity"] = QUERIES.pop("phonetic_similarity_query")


@query
def ocr_patterns(s: SparkSession, d: str) -> DataFrame:
    p = _given(s, d).select("name", N.ocr_patterns("name").alias("p"))
    return p.select("name", F.array_join("p.flags", "|").alias("flags"), "p.suggested")


@query
def pattern_report(s: SparkSession, d: str) -> DataFrame:
    p = _given(s, d).select("name", N.ocr_patterns("name").alias("p")).where(F.size("p.flags") > 0)
    return p.select(F.col("name").alias("original"), "p.suggested", F.array_join("p.flags", ", ").alias("patterns"))


@query
def ocr_corruption(s: SparkSession, d: str) -> DataFrame:
    return _cards(s, d).select("id", N.has_corruption("full_name").alias("corrupt"), N.has_corruption("card").alias("card_corrupt"))


@query
def name_validation(s: SparkSession, d: str) -> DataFrame:
    return synth.people(s, d).select("id", N.validation_reason("full_name").alias("reason"))


@query
def morphology(s: SparkSession, d: str) -> DataFrame:
    m = _given(s, d).select("name", N.morphology_reasons("name").alias("r"))
    return m.select("name", F.array_join("r", "|").alias("reasons"), (F.size("r") == 0).alias("is_valid"))


def _corrected(mode: str) -> Query:
    return lambda s, d: _given(s, d).select("name", N.corrected("name", mode).alias("corrected"))


for _mode in ("both", "pattern", "phonetic_dict"):
    QUERIES[f"corrected_names_{_mode}"] = _corrected(_mode)


@query
def phonetic_dict_lookup(s: SparkSession, d: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for pair in C.NAME_CORRECTIONS for x in pair])
    return synth.people(s, d).select("id", "given", F.try_element_at(known, F.col("given")).alias("known"))


# ---- counts, deduplication, duplicates -------------------------------------------------------------------------------


@query
def name_counts(s: SparkSession, d: str) -> DataFrame:
    return clusters.name_counts(_numbered(s, d))


@query
def name_line_numbers(s: SparkSession, d: str) -> DataFrame:
    return _accepted(s, d).withColumn("name_no", dedup.numbered(None, ["pdf_file"], ORDER[1:])).select("pdf_file", "full_name", "name_no")


def _full(s: SparkSession, d: str) -> DataFrame:
    return _accepted(s, d).withColumnRenamed("full_name", "name")


@query
def dedup_exact_full(s: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(_full(s, d), ["pdf_file"], ORDER).drop("norm")


@query
def dedup_exact_first(s: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(_numbered(s, d), [], ["seq"]).select("seq", "name", "norm")


@query
def dedup_window_full(s: SparkSession, d: str) -> DataFrame:
    n = _full(s, d).withColumn("name_no", dedup.numbered(None, ["pdf_file"], ORDER[1:]))
    return dedup.keep_recent(n, ["pdf_file"], ["name_no"], WINDOW).select("pdf_file", "name_no", "name")


@query
def dedup_window_first(s: SparkSession, d: str) -> DataFrame:
    return dedup.keep_recent(_numbered(s, d), [], ["seq"], WINDOW).select("seq", "name")


def _passed(s: SparkSession, d: str) -> DataFrame:
    """First names that pass the window, numbered anew: what the duplicate report of a run is made from."""
    return with_sequence(dedup_window_first(s, d).select(F.col("seq").alias("was"), "name"), ["was"]).select("seq", "name")


@query
def duplicate_groups_raw(s: SparkSession, d: str) -> DataFrame:
    n = _numbered(s, d)
    return duplicates.occurrences(n, duplicates.groups(n))


@query
def duplicate_groups(s: SparkSession, d: str) -> DataFrame:
    n = _numbered(s, d)
    return duplicates.occurrences(n, duplicates.duplicate_groups(n))


@query
def duplicate_groups_windowed(s: SparkSession, d: str) -> DataFrame:
    return duplicates.duplicate_groups(_passed(s, d))


@query
def duplicate_stats_windowed(s: SparkSession, d: str) -> DataFrame:
    return duplicates.statistics(_passed(s, d))


@query
def duplicate_stats(s: SparkSession, d: str) -> DataFrame:
    return duplicates.statistics(_firsts(s, d))


@query
def top_duplicate_groups(s: SparkSession, d: str) -> DataFrame:
    return duplicates.duplicate_groups(_numbered(s, d)).orderBy(F.desc("cnt"), "first_seq").limit(15).select("normalized", "cnt", "first_seq")


def _joined(g: DataFrame) -> DataFrame:
    return g.withColumn("pdfs", F.array_join("pdfs", ","))


@query
def name_sources(s: SparkSession, d: str) -> DataFrame:
    return _joined(duplicates.sources(_firsts(s, d)))


@query
def cross_file_names(s: SparkSession, d: str) -> DataFrame:
    return _joined(duplicates.cross_file(_firsts(s, d)))


@query
def top_cross_file(s: SparkSession, d: str) -> DataFrame:
    return duplicates.cross_file(_firsts(s, d)).orderBy(F.desc("n_pdfs"), "normalized").limit(5).select("normalized", "n_pdfs")


@query
def per_pdf_counts(s: SparkSession, d: str) -> DataFrame:
    return dedup_exact_full(s, d).groupBy("pdf_file").agg(F.count("*").alias("written"))


@query
def per_page_counts(s: SparkSession, d: str) -> DataFrame:
    n = _accepted(s, d).groupBy(*extract.KEYS).agg(F.count("*").alias("n"))
    return _pages(s, d).select(*extract.KEYS).join(n, extract.KEYS, "left").select(*extract.KEYS, F.coalesce("n", F.lit(0)).cast("long").alias("n_names"))


@query
def file_status(s: SparkSession, d: str) -> DataFrame:
    """Files of the roll opened by a reader; those of nations with an I are broken, and fail on their own."""
    pages = _pages(s, d).groupBy("pdf_file").agg(F.map_from_entries(F.collect_list(F.struct("page_num", "text"))).alias("of"), F.max("page_num").alias("last"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), "last"), lambda k: F.coalesce(F.try_element_at("of", k), F.lit(""))), "\f")
    broken = F.when(F.col("pdf_file").startswith("roll_I"), F.unhex(F.lit("FF"))).otherwise(F.lit(b""))
    files = pages.select(F.concat(F.lit("/rolls/"), "pdf_file").alias("path"), "pdf_file", F.concat(broken, text.cast("binary")).alias("content"))
    read, status = open_files(files, FormFeedReader())
    names = extract.accepted(extract.extraction(extract.repair(read.select(*extract.KEYS, "text")))).groupBy("pdf_file").agg(F.count("*").alias("n"))
    told = status.join(names, "pdf_file", "left").withColumn("reason", F.regexp_extract("error", "^[A-Za-z]+", 0))
    return told.select("pdf_file", "status", F.coalesce("n", F.lit(0)).cast("long").alias("names_count"), "n_pages", "reason")


# ---- validation ------------------------------------------------------------------------------------------------------


@query
def correction_stats(s: SparkSession, d: str) -> DataFrame:
    changed = lambda m: F.count_if(N.corrected("name", m) != F.col("name"))
    return _listed(s, d).agg(F.count("*").alias("total"), changed("both").alias("by_both"), changed("pattern").alias("by_pattern"), changed("phonetic_dict").alias("by_dict"))


@query
def latin_length_groups(s: SparkSession, d: str) -> DataFrame:
    return _spelled(s, d).groupBy("latin_len").agg(F.count("*").alias("n"), F.min("first_seq").alias("first_seq"))


@query
def phonetic_pairs(s: SparkSession, d: str) -> DataFrame:
    return clusters.phonetic_pairs(_spelled(s, d)).select("name_a", "name_b", "latin_a", "latin_b")


@query
def cluster_members(s: SparkSession, d: str) -> DataFrame:
    return clusters.phonetic_clusters(clusters.spelled(_listed(s, d)))


@query
def phonetic_clusters(s: SparkSession, d: str) -> DataFrame:
    one = F.struct("pos", F.concat_ws("=", "name", "latin", F.col("cnt").cast("string")).alias("t"))
    g = cluster_members(s, d).groupBy("cluster_id").agg(F.array_sort(F.collect_list(one)).alias("m"))
    return g.select("cluster_id", F.array_join("m.t", "|").alias("members"))


@query
def cluster_adjacent_distance(s: SparkSession, d: str) -> DataFrame:
    return clusters.adjacent_distances(cluster_members(s, d)).withColumn("distance", F.col("distance").cast("long"))


@query
def invalid_names(s: SparkSession, d: str) -> DataFrame:
    return validate.validate(_listed(s, d)).invalid


@query
def valid_first_names(s: SparkSession, d: str) -> DataFrame:
    return validate.validate(_listed(s, d)).valid


def _validated(mode: str | None, what: str) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        v = validate.validate(_listed(s, d), mode)
        return v.summary() if what == "summary" else getattr(v, what)

    return run


for _mode in ("none", "both", "pattern", "phonetic_dict"):
    for _what in ("valid", "invalid", "summary"):
        QUERIES[f"validation_{_what}_{_mode}"] = _validated(None if _mode == "none" else _mode, _what)


# ---- geometry and reports --------------------------------------------------------------------------------------------


@query
def card_boxes(s: SparkSession, d: str) -> DataFrame:
    """Boxes on seven made pages: four have rectangles, the rest only rules."""
    p = s.read.parquet(f"{d}/pages.parquet").select("page_id")
    at = lambda a, m: F.expr(f"CAST(page_id * {a} % {m} AS DOUBLE)")
    r = p.select((F.col("page_id") % 7).alias("page_id"), at(37, 400).alias("x0"), at(53, 700).alias("y0"), (at(29, 400) + 100).alias("w"), (at(31, 350) + 40).alias("h"))
    rects = r.where("page_id < 4").select("page_id", "x0", "y0", (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("h")).alias("y1"))
    flat = r.select("page_id", F.lit(0.0).alias("x0"), F.col("y0").alias("top"), F.lit(500.0).alias("width"), F.lit(0.5).alias("height")).distinct()
    upright = r.select("page_id", (F.col("x0") * 3).alias("x0"), F.lit(0.0).alias("top"), F.lit(0.5).alias("width"), F.lit(800.0).alias("height")).distinct()
    return extract.card_boxes(rects, flat.unionByName(upright))


@query
def report_duplicates(s: SparkSession, d: str) -> DataFrame:
    n = _numbered(s, d)
    return reports.duplicates_report(n, duplicates.duplicate_groups(n), duplicates.statistics(n))


@query
def report_review(s: SparkSession, d: str) -> DataFrame:
    return reports.review_report(validate.validate(_listed(s, d)))


@query
def report_cross_file(s: SparkSession, d: str) -> DataFrame:
    return reports.cross_file_report(duplicates.cross_file(_firsts(s, d)))


@query
def report_summary(s: SparkSession, d: str) -> DataFrame:
    full = dedup.deduplicate(_full(s, d), ["pdf_file"], ORDER)
    return reports.summary_report(full, _listed(s, d), duplicates.sources(_firsts(s, d)))


@query
def report_rejects(s: SparkSession, d: str) -> DataFrame:
    """Errors of blocks, then rejected names."""
    return reports.error_report(block_errors(s, d), rejected_names(s, d))


@query
def report_errors(s: SparkSession, d: str) -> DataFrame:
    """The whole log: errors of blocks and pages, then rejected names."""
    pages = page_errors(s, d).withColumn("block_no", F.lit(0)).withColumn("raw_text", F.lit(""))
    return reports.error_report(block_errors(s, d).unionByName(pages), rejected_names(s, d))


