"""Exact deduplication by content-defined chunk recipes, in DataFrame operations only.

A text is cut where its own characters say so (`CUT`; a run of thousands of characters without a cut is cut at MOST), so
equal texts have equal chunks. Chunks are deduplicated once, by text, to verified identifiers: a chunk's 64-bit hash where
no other chunk has it, and else the hash with the chunk's own text, so that equal identifiers prove equal chunks. A
text's recipe is its ordered list of identifiers; only recipes meet in the grouping, and the long texts move once, as
distinct chunks.

Defined results: a null text counts as empty and has an empty recipe; of equal texts the largest id stays, and of
repeated rows with that id one; a null id is less than any other and stays only if all of its text are null. An empty table gives an empty table. Only the id and the text are
read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: A chunk has this many characters at least and at most; it ends early at a line break or sentence end, or at a word
#: that begins with one of a quarter of the Latin letters.
LEAST, MOST = 512, 4096
CUT = r"[\n。！？]|[\s\p{P}](?=[cgjlmqwzCGJLMQWZ])"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text's chunks in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most}}}?(?:{CUT})|.{{1,{most}}}"), F.lit(0))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def clashes(rows: DataFrame) -> DataFrame:
    """Hashes that different chunks share: (h).

    The one movement of texts: distinct chunks by hash, combined on the map side first, so a chunk that occurs in a
    third of all rows is sent once by each task.
    """
    c = rows.select(F.explode(chunks_of(F.col("text"))).alias("chunk")).select(F.xxhash64("chunk").alias("h"), "chunk")
    store = c.groupBy("h").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("a <> b").select("h")
    return store


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, recipe (array of identifiers), text_sha256."""
    rows = _rows(df, id_col, text_col)
    clashing = materialize(clashes(rows), "clashes")
    hashes = F.transform(chunks_of(F.col("text")), lambda x: F.xxhash64(x))
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    if clashing.isEmpty():  # verified: each hash stands for one chunk
        return rows.select("id", hashes.alias("recipe"), sha)
    # Chunks of clashing hashes get as identifier the hash and the chunk itself; both are compared by value.
    one = rows.withColumn("row", F.monotonically_increasing_id()).select("id", "row", sha, F.posexplode_outer(chunks_of(F.col("text"))).alias("pos", "chunk"))
    one = one.withColumn("h", F.xxhash64("chunk"))
    told = one.join(clashing.withColumn("clash", F.lit(True)), "h", "left").withColumn("item", F.struct("pos", F.when(F.col("clash"), F.col("chunk")).otherwise(F.lit("")).alias("chunk"), "h"))
    return told.groupBy("row", "id", "text_sha256").agg(F.array_sort(F.collect_list(F.when(F.col("h").isNotNull() & F.col("pos").isNotNull(), F.col("item")))).alias("recipe")).drop("row")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, dropped ones too: id, keep_id, group_size, kept, text_sha256."""
    r = materialize(recipes(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "recipes")
    groups = r.groupBy("recipe").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
    # The key is made anew after the grouping, so both sides of the join are dealt out for it and a hot group is split.
    key = F.sha2(F.to_json(F.struct("recipe")), 256)
    groups = groups.select(key.alias("k"), F.col("recipe").alias("same"), "best", "group_size")
    joined = r.withColumn("k", key).join(groups, "k").where(F.col("recipe") == F.col("same"))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns as they were."""
    told = materialize(exact_dedup(df, id_col, text_col), "copies")
    gone = told.where("NOT kept").select(F.col(id_col).alias("__gone")).distinct()
    out = df.join(gone, F.col(id_col).eqNullSafe(F.col("__gone")), "left_anti")
    again = told.groupBy(id_col).count().where("count > 1")
    if not again.isEmpty():  # ids are not unique here: settle them by row
        rows = df.withColumn("__sha", F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
        stay = told.where("kept").select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__of"))
        out = rows.join(stay, rows[id_col].eqNullSafe(stay["__id"]) & (F.col("__sha") == F.col("__of")), "left_semi").dropDuplicates([id_col, "__sha"]).drop("__sha")
    return out
