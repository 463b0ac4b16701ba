"""Validation of a list of first names: correction, clusters, morphology, patterns, and the split into valid and invalid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import corrected, morphology_reasons, ocr_patterns
from ..sources.tables import materialize
from .clusters import phonetic_clusters, spelled


@dataclass
class Validated:
    """names: seq, name, corrected. clusters: members. morphology: seq, name, reasons. patterns: seq, name, flags,
    suggested. invalid: distinct names. valid: seq, name."""

    names: DataFrame
    clusters: DataFrame
    morphology: DataFrame
    patterns: DataFrame
    invalid: DataFrame
    valid: DataFrame

    def summary(self) -> DataFrame:
        """One row of counts; each is a single aggregate, so the cross joins are of one row."""
        n = self.names.agg(F.count("*").alias("total"), F.count_if(F.col("name") != F.col("corrected")).alias("corrections"))
        v = self.valid.agg(F.count("*").alias("valid"))
        c = self.clusters.agg(F.count_distinct("cluster_id").alias("clusters"))
        m = self.morphology.agg(F.count("*").alias("morphology"))
        p = self.patterns.agg(F.count("*").alias("patterns"))
        out = n.crossJoin(v).crossJoin(c).crossJoin(m).crossJoin(p)
        return out.select("total", "corrections", "valid", (F.col("total") - F.col("valid")).alias("invalid"), "clusters", "morphology", "patterns", (F.col("clusters") + F.col("morphology") + F.col("patterns")).alias("flagged"))


def validate(df: DataFrame, mode: str | None = None) -> Validated:
    """df: seq, name, in the order of seq. Names are not deduplicated again after correction.

    Patterns are looked for in the names as they came, the rest in the corrected ones, and a corrected name is dropped if
    that string itself is among the invalid.
    """
    names = materialize(df.select("seq", "name").withColumn("corrected", corrected("name", mode)), "corrected")
    now = names.select("seq", F.col("corrected").alias("name"))
    clusters = materialize(phonetic_clusters(spelled(now)), "clusters")
    morphology = now.withColumn("reasons", morphology_reasons("name")).where(F.size("reasons") > 0)
    patterns = names.select("seq", "name", ocr_patterns("name").alias("p")).where(F.size("p.flags") > 0).select("seq", "name", F.col("p.flags").alias("flags"), F.col("p.suggested").alias("suggested"))
    invalid = clusters.select("name").union(morphology.select("name")).union(patterns.select("name")).distinct()
    valid = now.join(invalid, "name", "left_anti").select("seq", "name")
    return Validated(names, clusters, morphology, patterns, invalid, valid)
