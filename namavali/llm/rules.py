"""Quality rules: one Spark projection of ratios, judged by a table of thresholds, with no user function.

Defined results: a null text counts as empty and has no words; it fails (fewer than `min_words`). Repeated rows are
judged each by itself, an empty table gives an empty table, and only the id and text columns are read, so that other
columns cannot clash. Long texts cost a sort of their own windows and nothing quadratic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Very frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on not this are from at or an have has "
    "le la les de des du un une et en que qui dans pour par sur est au aux ce avec pas ou il se "
    "der die das und ist den dem von zu mit sich auf für im nicht ein eine als auch es an er "
    "el los las y del que se con por su para al lo como más o una no"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """The document fails if measure is below least or above most."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Ratios are a word's, a line's or a character's, as their names say.
THRESHOLDS = (
    Rule("word_length", "chars_per_word", 1.2, 60.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("exclamations", "exclamations_per_word", None, 0.5),
    Rule("repeated_lines", "dup_lines_per_line", None, 0.6),
    Rule("stop_words", "stop_words_per_word", 0.005, None),
)


def _without(text: Column, chars: str, put: str = "") -> Column:
    """Text with each of these characters replaced; literal searches, far cheaper than a regular expression."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(put))
    return text


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, kept columns and every measure. Words are maximal runs of other than space and U+0009 to U+000D."""
    others = [F.col(c).alias(f"__in_{k}") for k, c in enumerate(keep or [])]
    rest = [f"__in_{k}" for k in range(len(others))]
    t = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"), *others)
    t = t.withColumn("__w", F.array_remove(F.split(_without(F.col("__t"), "\t\n\x0b\x0c\r", " "), " "), ""))
    t = t.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    t = t.withColumn("__v", F.transform("__w", lambda w: F.xxhash64(w)))
    t = t.withColumn(
        "__h",
        F.when(F.size("__v") >= 3, F.expr("transform(sequence(0, size(__v) - 3), i -> xxhash64(get(__v, i), get(__v, i + 1), get(__v, i + 2)))")).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    # Windows in the order of their hashes: one is repeated if a neighbour has its hash.
    t = t.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.expr("sort_array(transform(__h, (h, i) -> struct(h, i)))")))
    t = t.withColumn("__p", F.expr("sort_array(transform(filter(__s, (x, j) -> x.h = get(__s, j - 1).h OR x.h = get(__s, j + 1).h), x -> x.i))"))
    covered = F.expr("aggregate(__p, struct(0 AS n, -3 AS at), (a, p) -> struct(a.n + least(3, p - a.at) AS n, p AS at), a -> a.n)")
    stop = [h for w in STOP_WORDS for h in (w, w.capitalize(), w.upper())]
    removed = lambda chars: (F.octet_length("__t") - F.octet_length(_without(F.col("__t"), chars))).cast("long")
    t = t.select(
        "__id",
        *rest,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "__w")).cast("long").alias("word_chars"),
        removed(SYMBOLS).alias("n_symbols"),
        F.size("__l").alias("__lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("__v", lambda v: v.isin([F.xxhash64(F.lit(w)) for w in sorted(set(stop))]))).alias("__stop"),
        removed("!").alias("__bang"),
    )
    per = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    return t.withColumns(
        {
            "chars_per_word": per(F.col("word_chars"), F.col("n_words")),
            "symbols_per_word": per(F.col("n_symbols"), F.col("n_words")),
            "exclamations_per_word": per(F.col("__bang"), F.col("n_words")),
            "dup_lines_per_line": per(F.col("n_dup_lines"), F.col("__lines")),
            "stop_words_per_word": per(F.col("__stop"), F.col("n_words")),
        }
    )


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    """Too few words, or more than max_repeat per cent of them in repeated windows."""
    return (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat)


def verdict(rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """The table compiled into one condition: true if no rule fails."""
    ok = F.lit(True)
    for r in rules:
        if r.least is not None:
            ok = ok & (F.col(r.measure) >= r.least)
        if r.most is not None:
            ok = ok & (F.col(r.measure) <= r.most)
    return ok


def failed_rules(rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """Names of the rules that fail, for reports."""
    out = []
    for r in rules:
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (F.col(r.measure) < r.least)
        if r.most is not None:
            bad = bad | (F.col(r.measure) > r.most)
        out.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*out))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """Per row: id, the measures, base_failed, failed_rules and kept."""
    m = measures(df, id_col, text_col)
    return m.select(
        F.col("__id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
        failed_rules(rules).alias("failed_rules"),
        *[r.measure for r in rules],
    )


def filter_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """The rows that pass, with their columns as they were.

    Verdicts are written as a small table first: a filter on the measures would be pushed into their projection and make
    every measure again and again. Rows are found again by id and a hash of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    m = measures(df.select(F.col(id_col), F.col(text_col), F.xxhash64(text).alias("__hash")), id_col, text_col, keep=["__hash"])
    told = materialize(m.select(F.col("__id").alias("__kid"), F.col("__in_0").alias("__khash"), (~base_failed() & verdict(rules)).alias("__kept")), "verdicts")
    kept = told.where("__kept").select("__kid", "__khash").distinct()
    return df.join(kept, df[id_col].eqNullSafe(kept["__kid"]) & (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == kept["__khash"]), "left_semi")
