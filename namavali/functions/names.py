"""Repair, cleaning, keys, patterns and validation of names, as expressions that Catalyst compiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .text import DIGIT, NOT_WS, UNIX, WS, collapse, let, strip, without_last, word_list


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def normalize_key(name: Column | str) -> Column:
    """The comparison key: one translation, equal to decomposing, mapping and composing on name characters."""
    return F.translate(_text(name), C.KEY_FROM, C.KEY_TO)


def ocr_corrections(text: Column | str) -> Column:
    """The literal replacements in their order; not idempotent, since the last one matches its own result."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), C.OCR_CORRECTIONS, _text(text))


def is_label_only(text: Column | str) -> Column:
    return strip(_text(text)).rlike(f"{UNIX}^(?:({C.LABEL_WORDS}){WS}*[:：]?{WS}*$|({C.HEADING_WORDS}))")


def clean_name(name: Column | str) -> Column:
    c = F.regexp_replace(_text(name), f"^नावः{WS}*", "")
    c = F.regexp_replace(c, f"^नाव[',]?{WS}*", "")
    for ending in C.LABEL_ENDINGS:
        c = F.regexp_replace(c, f"{UNIX}{WS}+{ending}$", "")
    c = F.substring_index(c, " उर्फ ", 1)
    c = F.regexp_replace(c, f"^उर्फ{WS}+", "")
    c = F.regexp_replace(c, f"{NOT_WS}+च्या{WS}+", "")
    return collapse(F.regexp_replace(c, "[ः',]", ""))


def first_names(full_name: Column | str) -> Column:
    """The words that stand for a person's own name: two of three, else the first."""
    w = word_list(_text(full_name))
    return let(w, lambda x: F.slice(x, F.lit(1), F.when(F.size(x) == 3, F.lit(2)).otherwise(F.least(F.size(x), F.lit(1)))))


def has_corruption(text: Column | str) -> Column:
    """Text that recognition has damaged beyond repair."""
    patterns = (
        "^[a-zA-Z]{1,3}:",
        f"[a-zA-Z]{{4,}}{WS}+[a-zA-Z]{{4,}}",
        C.ARTIFACTS,
        f"^{DIGIT}+{WS}+(Fert|fem|feat|लिंग){WS}*:",
        f"^{DIGIT}{{2,3}}{WS}+(Fart|Fert)",
    )
    return _text(text).rlike("|".join(f"(?:{p})" for p in patterns))


def validation_reason(name: Column | str) -> Column:
    """Why a name is not valid, by the first check that fails; null if it is valid. The name is cleaned first."""
    return let(clean_name(name), _first_failure)


def _first_failure(n: Column) -> Column:
    marks = F.regexp_count(n, F.lit(r"[\-;:|]"))
    solid = F.length(F.replace(n, F.lit(" "), F.lit("")))
    return (
        F.when(F.length(n) < 3, "Too short after cleaning (less than 3 characters)")
        .when(is_label_only(n), "Label only (not a name)")
        .when(n.rlike("[a-zA-Z]"), "Contains English characters")
        .when(n.rlike(DIGIT), "Contains numbers")
        .when(~n.rlike(f"{UNIX}^(?:[\\x{{900}}-\\x{{97f}}\\-]|{WS})+$"), "Contains invalid special characters")
        .when(F.regexp_count(n, F.lit(r"[\x{900}-\x{97f}]")) < 3, "Insufficient Devanagari characters")
        .when((solid > 0) & (marks / solid > 0.3), "Excessive punctuation")
    )


def _suffix(c: Column, *endings: str) -> Column:
    return reduce(lambda a, b: a | b, [c.endswith(e) for e in endings])


def ocr_patterns(name: Column | str, fix_suffix_bug: bool = False) -> Column:
    """struct(flags, suggested). Conditions look at the name, edits at the running suggestion.

    By default the ending त्त loses two of its three code points, as existing outputs have it; fix_suffix_bug drops all.
    """
    n = _text(name)
    known = F.create_map(*[F.lit(x) for pair in C.NAME_CORRECTIONS for x in pair])
    late = n.contains("णप्पा") & ~n.startswith("ण")
    nasal, dot = n.contains("ाण्"), n.endswith("ं")
    final = (F.length(n) > 2) & _suffix(n, "राच", "शीच", "ाच", "ीच")
    put = lambda c, old, new="प्पा": F.replace(c, F.lit(old), F.lit(new))
    steps = (
        lambda s: F.when(n.contains("ण्या"), put(s, "ण्या")).when(n.contains("ण्पा"), put(s, "ण्पा")).when(late, put(s, "णप्पा")).otherwise(s),
        lambda s: F.when(nasal, put(put(s, "ाण्या", "ाप्पा"), "ाण्पा", "ाप्पा")).otherwise(s),
        lambda s: F.when(final, F.concat(without_last(s), F.lit("व"))).otherwise(s),
        lambda s: F.when(dot, without_last(s)).otherwise(s),
        lambda s: F.coalesce(F.try_element_at(known, n), s),
        lambda s: F.when(n.endswith("त्त"), F.concat(without_last(s, 3 if fix_suffix_bug else 2), F.lit("त")))
        .when(n.endswith("राध"), F.concat(without_last(s), F.lit("म")))
        .when(n.endswith("नाध"), F.concat(without_last(s), F.lit("थ")))
        .otherwise(s),
    )
    found = (
        F.when(n.contains("ण्या"), "ण्या→प्पा").when(n.contains("ण्पा"), "ण्पा→प्पा").when(late, "णप्पा→प्पा"),
        F.when(nasal, "ाण्→ाप्"),
        F.when(final, "च→व"),
        F.when(dot, "trailing_ं"),
        F.when(F.map_contains_key(known, n), "phonetic_dict"),
        F.when(n.endswith("त्त"), "त्त→त").when(n.endswith("राध"), "राध→राम").when(n.endswith("नाध"), "नाध→नाथ"),
    )
    return F.struct(F.array_compact(F.array(*found)).alias("flags"), reduce(let, steps, n).alias("suggested"))


def corrected(name: Column | str, mode: str | None) -> Column:
    """The name, or its suggestion if the mode takes one of its flags: phonetic_dict, pattern, both or None."""
    n = F.col(name) if isinstance(name, str) else name
    if mode is None:
        return n
    take = {
        "phonetic_dict": lambda flags: F.array_contains(flags, "phonetic_dict"),
        "pattern": lambda flags: F.exists(flags, lambda f: f != "phonetic_dict"),
        "both": lambda flags: F.size(flags) > 0,
    }[mode]
    return let(ocr_patterns(n), lambda p: F.when(take(p["flags"]), p["suggested"]).otherwise(n))


def morphology_reasons(name: Column | str) -> Column:
    """Every check that a name's spelling fails, in order; an empty array for a well-formed name."""
    return let(strip(_text(name)), _failures)


def _failures(n: Column) -> Column:
    first, size = F.substring(n, 1, 1), F.length(n)
    bare = F.translate(n, C.DEPENDENT_SIGNS, "")
    halants = F.length(n) - F.length(F.replace(n, F.lit("्"), F.lit("")))
    found = F.array_compact(
        F.array(
            F.when(F.lit(C.DEPENDENT_SIGNS).contains(first), F.format_string("Starts with dependent vowel mark: '%s'", first)),
            F.when(size <= 2, F.format_string("Very short (%d chars), likely fragment", size)),
            F.when(n.endswith("्"), "Ends with halant (्), incomplete word"),
            F.when((size <= 4) & (halants > 0) & (halants * 2 >= size), "Appears to be orphaned consonant cluster"),
            F.when(n.startswith("़") | n.contains(" ़"), "Nukta (़) in invalid position"),
            F.when(n.contains("  ") | n.rlike("[॰।॥]"), "Contains unusual spacing or punctuation"),
            F.when(strip(bare) == "", "Contains only vowel marks, no base characters"),
        )
    )
    return F.when(size == 0, F.array(F.lit("Empty name"))).otherwise(found)
