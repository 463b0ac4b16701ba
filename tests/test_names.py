"""Golden vectors of the column functions."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namavali.functions import names as N
from namavali.functions.phonetic import phonetic_similarity, transliterate
from namavali.functions.text import file_stem, strip, word_list


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(f("v")).collect()]


def test_key(spark):
    pairs = [("हनुमंत", "हनूमत"), ("शितल", "शीतल"), ("शीतल", "शीतल"), ("किंरण", "कीरण"), ("पोर्णिमा", "पौर्णीमा"), ("ख़ान", "खान"), ("ख़ान", "खान"), ("चाँद", "चाद"), ("", ""), (None, "")]
    assert column(spark, [a for a, _ in pairs], N.normalize_key) == [b for _, b in pairs]


def reference_key(s):
    s = unicodedata.normalize("NFD", s)
    for c in "ंँ़":
        s = s.replace(c, "")
    for a, b in ("िी", "ुू", "ेै", "ोौ"):
        s = s.replace(a, b)
    return unicodedata.normalize("NFC", s)


def test_key_equals_decomposition(spark):
    import random

    r = random.Random(3)
    letters = [chr(c) for c in range(0x900, 0x980) if not 0x951 <= c <= 0x954]
    values = ["".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(2000)]
    assert column(spark, values, N.normalize_key) == [reference_key(v) for v in values]


def test_ocr_corrections_repeat(spark):
    assert column(spark, ["नाच : राम", "वडिलांचे नाव: राम", "ara: att"], N.ocr_corrections) == ["नाव : राम", "वडिलांवडिलांचे नाव: राम", "नाव : "]


def test_clean_name(spark):
    pairs = [("नावः रमेश", "रमेश"), ("नाव, रमेश", "रमेश"), ("नावेद शेख", "ेद शेख"), ("राम पाटील वडिलांचे", "राम पाटील"), ("राम पत्नी", "राम पत्नी"), ("सुरेखा उर्फ ताई", "सुरेखा"), ("उर्फ ताई", "ताई"), ("आण्णाच्या पाटील", "पाटील"), ("रामः, पाटील", "राम पाटील"), (None, "")]
    assert column(spark, [a for a, _ in pairs], N.clean_name) == [b for _, b in pairs]


def test_validation(spark):
    short = "Too short after cleaning (less than 3 characters)"
    pairs = [("प्रकाश", None), ("अब", short), ("नाव", short), ("महाराष्ट्र राज्य", "Label only (not a name)"), ("राम Patil", "Contains English characters"), ("राम५", "Contains numbers"), ("राम@पाटील", "Contains invalid special characters"), ("---राम", "Excessive punctuation"), ("रा--म", "Excessive punctuation"), (None, short)]
    assert column(spark, [a for a, _ in pairs], N.validation_reason) == [b for _, b in pairs]


def test_first_names(spark):
    pairs = [("", []), ("राम", ["राम"]), ("राम पाटील", ["राम"]), ("राम शंकर पाटील", ["राम", "शंकर"]), ("राम शंकर बाबू पाटील", ["राम"]), (" राम शंकर\u001cपाटील ", ["राम", "शंकर"])]
    assert column(spark, [a for a, _ in pairs], N.first_names) == [b for _, b in pairs]


@pytest.mark.parametrize(
    ("name", "flags", "suggested", "dictionary", "pattern", "both"),
    [
        ("राम", [], "राम", "राम", "राम", "राम"),
        ("बाळाण्या", ["ण्या→प्पा", "ाण्→ाप्"], "बाळाप्पा", "बाळाण्या", "बाळाप्पा", "बाळाप्पा"),
        ("आण्पा", ["ण्पा→प्पा"], "आप्पा", "आण्पा", "आप्पा", "आप्पा"),
        ("बाणप्पा", ["णप्पा→प्पा"], "बाप्पा", "बाणप्पा", "बाप्पा", "बाप्पा"),
        ("णप्पा", [], "णप्पा", "णप्पा", "णप्पा", "णप्पा"),
        ("माण्णा", ["ाण्→ाप्"], "माण्णा", "माण्णा", "माण्णा", "माण्णा"),
        ("संजीच", ["च→व"], "संजीव", "संजीच", "संजीव", "संजीव"),
        ("रामं", ["trailing_ं"], "राम", "रामं", "राम", "राम"),
        ("हणमंत", ["phonetic_dict"], "हनुमंत", "हनुमंत", "हणमंत", "हनुमंत"),
        ("शौकत्त", ["phonetic_dict", "त्त→त"], "शौत", "शौत", "शौत", "शौत"),
        ("यशवंत्त", ["phonetic_dict", "त्त→त"], "यशवत", "यशवत", "यशवत", "यशवत"),
        ("हणमंत्त", ["phonetic_dict", "त्त→त"], "हनुमत", "हनुमत", "हनुमत", "हनुमत"),
        ("अनित्त", ["त्त→त"], "अनितत", "अनित्त", "अनितत", "अनितत"),
        ("सखाराध", ["राध→राम"], "सखाराम", "सखाराध", "सखाराम", "सखाराम"),
        ("जगन्नाध", ["नाध→नाथ"], "जगन्नाथ", "जगन्नाध", "जगन्नाथ", "जगन्नाथ"),
    ],
)
def test_patterns(spark, name, flags, suggested, dictionary, pattern, both):
    row = spark.createDataFrame([(name,)], "v string").select(N.ocr_patterns("v").alias("p"), *[N.corrected("v", m).alias(m) for m in ("phonetic_dict", "pattern", "both")]).first()
    assert (row.p.flags, row.p.suggested) == (flags, suggested)
    assert (row.phonetic_dict, row.pattern, row.both) == (dictionary, pattern, both)


def test_patterns_fixed(spark):
    assert column(spark, ["अनित्त"], lambda c: N.ocr_patterns(c, fix_suffix_bug=True)["suggested"]) == ["अनित"]


def test_morphology(spark):
    kinds = ["Empty", "Starts", "Very short", "Ends", "orphaned", "Nukta", "unusual", "only vowel"]
    cases = {"राम": [], "": [0], "रा": [2], "ीराम": [1], "रामक्": [3], "क्प्": [3, 4], "क्": [2, 3, 4], "िी": [1, 2, 7], "राम।": [6], "़राम": [5], "ाराम": [], "प्पा": []}
    found = column(spark, list(cases), N.morphology_reasons)
    assert [[next(k for k, w in enumerate(kinds) if w in r) for r in f] for f in found] == list(cases.values())


def test_text(spark):
    assert column(spark, ["　 a\u001c", "x"], lambda c: strip(F.col(c))) == ["a", "x"]
    assert column(spark, ["a b  c"], lambda c: word_list(F.col(c))) == [["a", "b", "c"]]
    assert column(spark, ["/x/a.b.pdf", "/x/.pdf", "/x/a"], lambda c: file_stem(F.col(c))) == ["a.b", ".pdf", "a"]


def test_transliteration(spark):
    assert column(spark, ["राम", "किरण", "शीतल", "क्ष", "x"], transliterate) == ["rAma", "kiraNa", "shItala", "kSha", "x"]
    row = spark.createDataFrame([("राम", "राम"), ("", "")], "a string, b string").select(phonetic_similarity("a", "b")).collect()
    assert [r[0] for r in row] == [1.0, 1.0]


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="रामकि ींश,':", max_size=12))
def test_clean_name_is_stripped(spark, name):
    (got,) = column(spark, [name], N.clean_name)
    assert got == got.strip() and "  " not in got and "," not in got
