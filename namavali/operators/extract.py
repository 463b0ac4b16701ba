"""From page text to names: lines, blocks, labelled parts, extraction, acceptance and rejection.

Everything is a projection of a page's own row: blocks and parts are cut by regular expressions and kept as arrays, so
even the second attempt at a block without names needs no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.names import clean_name, has_corruption, is_label_only, ocr_corrections, validation_reason
from ..functions.text import DIGIT, WS, collapse, let, strip

#: White space without the line feed, which ends a line.
_INLINE = WS.replace(r"\x{9}-\x{d}", r"\x{9}\x{b}-\x{d}")
#: Before a line that is a number: a new card begins.
BLOCK_START = rf"\n(?={_INLINE}*{DIGIT}+{_INLINE}*(?:\n|\z))"
#: Before each labelled name of a line.
PART_START = rf"(?=(?:पतीचे{WS}*)?(?:वडिलांचे{WS}*)?(?:पत्नीचे{WS}*)?(?:आईचे{WS}*)?(?:नाव|नाब){WS}*[:;])"
NO_NAMES = "Could not extract any names from text block"
KEYS = ["pdf_file", "page_num"]


def page_range(pages: DataFrame, start: int, end: int) -> DataFrame:
    """Pages start to end, both included; a plain filter, so readers can leave the others unread."""
    return pages.where(F.col("page_num").between(start, end))


def needs_ocr(text: Column | str) -> Column:
    """No text layer, or one of fewer than 100 characters."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.length(strip(t)) < 100, F.lit(True))


def repair(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", ocr_corrections("text"))


def lines(pages: DataFrame) -> DataFrame:
    """A row for each line, empty ones too."""
    return pages.select(*KEYS, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def is_serial(line: Column | str) -> Column:
    return strip(F.col(line) if isinstance(line, str) else line).rlike(f"^{DIGIT}+$")


def segment(rows: DataFrame) -> DataFrame:
    """Lines with the number of their block, from 1: a running count of serial lines after the first."""
    w = Window.partitionBy(*KEYS).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = (F.col("line_no") > 0) & is_serial("line")
    return rows.withColumn("block_no", (F.sum(start.cast("int")).over(w) + 1).cast("int"))


def blocks(pages: DataFrame) -> DataFrame:
    """A row for each block of a page, cut where `segment` counts."""
    cut = F.posexplode(F.split("text", BLOCK_START)).alias("block", "block_text")
    return pages.select(*KEYS, cut).select(*KEYS, (F.col("block") + 1).alias("block_no"), "block_text")


def has_label(text: Column) -> Column:
    return text.contains("नाव")


def is_skipped(line: Column) -> Column:
    """A line with a phrase that no name line has."""
    return reduce(lambda a, b: a | b, [line.contains(p) for p in C.SKIP_PHRASES])


def is_id_line(line: Column) -> Column:
    """A short line of digits, capitals, hyphens and white space."""
    return line.rlike(f"^(?:[{DIGIT}A-Z\\-]|{WS})+$") & (F.length(line) < 20)


def is_name_line(line: Column) -> Column:
    named = line.contains("नाव") | line.contains("नाब")
    return named & (line.contains(":") | line.contains(";")) & ~is_skipped(line) & ~is_id_line(line)


def split_parts(line: Column) -> Column:
    """The labelled parts of a line, in order."""
    return F.filter(F.split(line, PART_START), lambda p: p.contains("नाव") | p.contains("नाब"))


def extract_after(part: Column, label: str) -> Column:
    """What follows the label, by the first form that occurs; empty if that is a label or damaged."""
    colon, space = f"{label}{WS}*[:：]{WS}*([^\n]+)", f"{label}{WS}+([^\n]+)"
    raw = F.when(part.rlike(colon), F.regexp_extract(part, colon, 1)).when(part.rlike(space), F.regexp_extract(part, space, 1)).otherwise(F.lit(""))
    name = F.regexp_replace(collapse(raw), f"^(?:[-:：]|{WS})+", "")
    name = F.regexp_replace(name, "(?s)[;|].*$", "")
    return let(name, lambda n: F.when(is_label_only(n) | has_corruption(n), F.lit("")).otherwise(strip(n)))


def extract_name(part: Column) -> Column:
    """The name in a part: labels in order, the first with a result; then remains of labels and marks are removed."""
    after = lambda repaired: F.coalesce(*[F.nullif(F.when(part.contains(x), extract_after(repaired, x)), F.lit("")) for x in C.LABELS], F.lit(""))
    name = let(ocr_corrections(part), after)
    name = F.regexp_replace(name, f"^{WS}*(?:नाव|नाब|पतीचे|वडिलांचे|पत्नीचे|आईचे){WS}*[:;]{WS}*", "")
    name = collapse(F.regexp_replace(collapse(name), f"{WS}*(?:att|Fart|Fert){WS}*", " "))
    return strip(F.regexp_replace(name, f"^(?:[:;]|{WS})+", ""))


def parts_of(text: Column) -> Column:
    """The labelled parts of a block: array of (line_no, part_no, part)."""
    found = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line_no"), strip(x).alias("line")))
    named = F.filter(found, lambda x: is_name_line(x["line"]))
    return F.flatten(F.transform(named, lambda x: F.transform(split_parts(x["line"]), lambda p, j: F.struct(x["line_no"].alias("line_no"), j.alias("part_no"), p.alias("part")))))


def names_of(text: Column) -> Column:
    """The names of a block: array of (line_no, part_no, name, reason, cleaned)."""
    got = F.transform(parts_of(text), lambda p: F.struct(p["line_no"].alias("line_no"), p["part_no"].alias("part_no"), extract_name(p["part"]).alias("name")))
    some = F.filter(got, lambda p: p["name"] != "")
    return F.transform(some, lambda p: F.struct(p["line_no"].alias("line_no"), p["part_no"].alias("part_no"), p["name"].alias("name"), validation_reason(p["name"]).alias("reason"), clean_name(p["name"]).alias("cleaned")))


def _good(names: Column) -> Column:
    return F.filter(names, lambda p: p["reason"].isNull() & (p["cleaned"] != ""))


def extraction(pages: DataFrame) -> DataFrame:
    """A row for each block with a label: its names, those of the second attempt if there was one, and whether it failed.

    A block that yields nothing is tried again if another repair changes its text; only if it does not, it is an error.
    """
    b = blocks(pages).where(has_label(F.col("block_text"))).withColumn("names", names_of(F.col("block_text")))
    b = b.withColumn("repaired", ocr_corrections("block_text"))
    empty = F.size(_good(F.col("names"))) == 0
    again = empty & (F.col("repaired") != F.col("block_text"))
    return b.withColumn("again", F.when(again, names_of(F.col("repaired")))).withColumn("failed", empty & (F.col("repaired") == F.col("block_text")))


def accepted(found: DataFrame) -> DataFrame:
    """Accepted names in page order: pdf_file, page_num, block_no, line_no, part_no, full_name."""
    rows = found.select(*KEYS, "block_no", F.explode(F.concat(_good(F.col("names")), _good(F.coalesce("again", F.slice("names", 1, 0))))).alias("p"))
    return rows.select(*KEYS, "block_no", F.col("p.line_no").alias("line_no"), F.col("p.part_no").alias("part_no"), F.col("p.cleaned").alias("full_name"))


def rejected(found: DataFrame) -> DataFrame:
    """Rejected names of three characters and more, of both attempts."""
    bad = lambda c: F.filter(c, lambda p: p["reason"].isNotNull() & (F.length(p["name"]) >= 3))
    rows = found.select(*KEYS, "block_no", F.explode(F.concat(bad(F.col("names")), bad(F.coalesce("again", F.slice("names", 1, 0))))).alias("p"))
    return rows.select(*KEYS, "block_no", F.col("p.name").alias("name"), F.col("p.reason").alias("reason"))


def block_errors(found: DataFrame) -> DataFrame:
    return found.where("failed").select(*KEYS, "block_no", F.substring("block_text", 1, 200).alias("raw_text"), F.lit(NO_NAMES).alias("reason"))


def page_errors(pages: DataFrame) -> DataFrame:
    """Pages that gave no text at all."""
    return pages.where(F.coalesce(strip(F.col("text")) == "", F.lit(True))).select(*KEYS, F.lit("No text could be read from the page").alias("reason"))


def first_name_rows(full: DataFrame) -> DataFrame:
    """The first names of accepted names, with word_no."""
    from ..functions.names import first_names

    return full.select(*KEYS, "block_no", "line_no", "part_no", F.posexplode(first_names("full_name")).alias("word_no", "name"))


def name_messages(full: DataFrame) -> DataFrame:
    """Each name once as `full`, and its first names as `first`."""
    from ..functions.names import first_names

    one = F.struct(F.lit(-1).alias("word_no"), F.lit("full").alias("type"), F.col("full_name").alias("name"))
    others = F.transform(first_names("full_name"), lambda w, i: F.struct(i.alias("word_no"), F.lit("first").alias("type"), w.alias("name")))
    rows = full.select(*KEYS, "block_no", "line_no", "part_no", F.explode(F.concat(F.array(one), others)).alias("m"))
    return rows.select(*KEYS, "block_no", "line_no", "part_no", "m.word_no", "m.type", "m.name")


def card_boxes(rects: DataFrame, ruled: DataFrame, key: str = "page_id") -> DataFrame:
    """Boxes of cards: rectangles of a card's size, or else cells between neighbouring rules.

    rects: key, x0, y0, x1, y1. ruled: key, x0, top, width, height. Rules meet within a page only.
    """
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    direct = rects.where((w > 150) & (w < 400) & (h > 80) & (h < 300)).select(key, "x0", "y0", "x1", "y1")
    by = lambda c: Window.partitionBy(key).orderBy(c)
    flat = ruled.where(F.abs("height") < 2).select(key, F.col("top").alias("y0"), F.lead("top").over(by("top")).alias("y1")).where("y1 IS NOT NULL")
    upright = ruled.where(F.abs("width") < 2).select(key, F.col("x0"), F.lead("x0").over(by("x0")).alias("x1")).where("x1 IS NOT NULL")
    cells = flat.join(upright, key).where((w > 150) & (h > 80)).join(direct.select(key).distinct(), key, "left_anti")
    return direct.unionByName(cells.select(key, "x0", "y0", "x1", "y1"))
