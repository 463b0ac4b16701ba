"""Latin spelling of Devanagari names and their phonetic distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

#: Stands for a consonant's own vowel until the signs after it are known; a private code point.
_INHERENT = "\ue000"
_SIGNS = "".join(k for k, _ in C.ITRANS_OTHERS if "ा" <= k <= "्")


def transliterate(name: Column | str) -> Column:
    """ITRANS; characters without a spelling stay."""
    n = F.col(name) if isinstance(name, str) else name
    consonants = "".join(k for k, _ in C.ITRANS_CONSONANTS)
    marked = F.regexp_replace(n, f"([{consonants}])(?![{_SIGNS}])", "$1" + _INHERENT)
    spelling = F.create_map(*[F.lit(x) for pair in (*C.ITRANS_CONSONANTS, *C.ITRANS_OTHERS, (_INHERENT, "a")) for x in pair])
    return F.array_join(F.transform(F.split(marked, ""), lambda c: F.coalesce(F.try_element_at(spelling, c), c)), "")


def latin(name: Column | str) -> Column:
    return F.lower(transliterate(name))


def phonetic_similarity(a: Column | str, b: Column | str) -> Column:
    """1 - distance / longer length of the Latin spellings; 1 if both are empty."""
    x, y = latin(a), latin(b)
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longest)
