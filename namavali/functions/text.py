"""White space, digits and words with Unicode semantics, which Java's and RE2's short classes lack."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All code points that count as white space; the spelling is understood by Java and RE2.
WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WS = "[^" + WS[1:]
DIGIT = r"\p{Nd}"
#: `$` matches before a last line feed only.
UNIX = "(?d)"


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it; keeps expression trees small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; ends are stripped."""
    return F.btrim(F.regexp_replace(c, f"{WS}+", " "), F.lit(" "))


def word_list(c: Column) -> Column:
    """Words between white space, none of them empty."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def without_last(c: Column, n: int = 1) -> Column:
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - n, F.lit(0)))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\z", 1)


def file_stem(path: Column) -> Column:
    """The file's name without its last suffix; a leading dot does not begin a suffix."""
    name = file_name(path)
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")
