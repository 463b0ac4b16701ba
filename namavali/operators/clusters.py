"""Phonetic clusters: names whose Latin spellings of one length differ in one character, grouped greedily.

Pairs come from an equi-join: a spelling with its i-th character left out, i and the length agree exactly if at most the
i-th character differs. The greedy grouping only depends on the connected component, so it runs in components, which are
small, and not in all names of a length.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.phonetic import latin
from ..sources.tables import materialize, with_sequence


def name_counts(df: DataFrame, order: str = "seq", name: str = "name") -> DataFrame:
    """Distinct names with their number and first place."""
    return df.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("cnt"), F.min(order).alias("first_seq"))


def spelled(df: DataFrame, order: str = "seq", name: str = "name") -> DataFrame:
    """name_counts with the Latin spelling, made once for each distinct name."""
    return name_counts(df, order, name).withColumn("latin", latin("name")).withColumn("latin_len", F.length("latin"))


def phonetic_pairs(names: DataFrame) -> DataFrame:
    """Pairs of names at distance one: name_a and latin_a come first."""
    places = F.sequence(F.lit(1), F.col("latin_len"))
    mask = F.transform(places, lambda i: F.struct(i.alias("i"), F.concat(F.substring("latin", F.lit(1), i - 1), F.substring("latin", i + 1, F.col("latin_len"))).alias("rest")))
    m = names.where("latin_len > 0").select("name", "latin", "first_seq", "latin_len", F.explode(mask).alias("m")).select("name", "latin", "first_seq", "latin_len", "m.i", "m.rest")
    a = m.select(*[F.col(c).alias(c + "_a") for c in ("name", "latin", "first_seq")], "latin_len", "i", "rest")
    b = m.select(*[F.col(c).alias(c + "_b") for c in ("name", "latin", "first_seq")], "latin_len", "i", "rest")
    both = a.join(b, ["latin_len", "i", "rest"]).where("first_seq_a < first_seq_b AND latin_a <> latin_b")
    return both.select("name_a", "latin_a", "first_seq_a", "name_b", "latin_b", "first_seq_b", "latin_len").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(name, component): the least name that is reachable. Labels spread along pairs and are then looked up themselves,
    so the rounds grow with the logarithm of a component's diameter; each round is written and read again."""
    edges = pairs.select(F.col("name_a").alias("u"), F.col("name_b").alias("v"))
    edges = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
    while True:
        labels = materialize(labels, "labels")
        of = labels.select(F.col("u").alias("v"), F.col("label").alias("near"))
        seen = edges.join(of, "v").groupBy("u").agg(F.min("near").alias("near"))
        step = labels.join(seen, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("u").alias("label"), F.col("label").alias("far"))
        step = materialize(step.join(jump, "label", "left").select("u", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        if step.where("old <> label").isEmpty():
            return labels.select(F.col("u").alias("name"), F.col("label").alias("component"))
        labels = step.select("u", "label")


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0], corner = i, i, i - 1
        for j, y in enumerate(b, 1):
            left = min(row[j] + 1, left + 1, corner + (x != y))
            corner, row[j] = row[j], left
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def greedy(latins: list[str], most: int = 1) -> list[list[int]]:
    """Clusters of places: each free name in order takes the later free ones of its length that are close to all it has, equal to none."""
    free, out = [True] * len(latins), []
    for i in range(len(latins)):
        if free[i]:
            free[i], group = False, [i]
            for j in range(i + 1, len(latins)):
                if free[j] and all(len(latins[g]) == len(latins[j]) and 0 < distance(latins[g], latins[j], most) <= most for g in group):
                    free[j] = False
                    group.append(j)
            out.append(group)
    return [g for g in out if len(g) > 1]


def phonetic_clusters(names: DataFrame) -> DataFrame:
    """Members of clusters: cluster_id, pos, name, latin, cnt.

    names: from `spelled`. Ids count from 1 by the first occurrence of the length, then of the seed; members are by
    number, then first occurrence.
    """
    names = materialize(names, "names")
    found = components(phonetic_pairs(names))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first_seq").reset_index(drop=True)
        rows = []
        for group in greedy(pdf["latin"].tolist()):
            seed = pdf["first_seq"][group[0]]
            for i in group:
                rows.append((seed, pdf["name"][i], pdf["latin"][i], pdf["cnt"][i], pdf["first_seq"][i], pdf["latin_len"][i]))
        return pd.DataFrame(rows, columns=["seed", "name", "latin", "cnt", "first_seq", "latin_len"])

    schema = "seed long, name string, latin string, cnt long, first_seq long, latin_len int"
    with_len = names.join(found, "name").withColumn("first_seq", F.col("first_seq").cast("long"))
    members = with_len.select("component", "name", "latin", "cnt", "first_seq", "latin_len").groupBy("component").applyInPandas(run, schema)
    order = names.groupBy("latin_len").agg(F.min("first_seq").alias("len_first"))
    members = materialize(members.join(order, "latin_len"), "members")
    seeds = with_sequence(members.select("len_first", "seed").distinct(), ["len_first", "seed"], "cluster_id").withColumn("cluster_id", F.col("cluster_id").cast("int"))
    members = members.join(seeds, ["len_first", "seed"])
    pos = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("cnt"), "first_seq"))
    return members.select("cluster_id", pos.alias("pos"), "name", "latin", "cnt")


def adjacent_distances(clusters: DataFrame) -> DataFrame:
    """Distance of each member of a cluster to the next: cluster_id, pos, latin, next_latin, distance."""
    w = Window.partitionBy("cluster_id").orderBy("pos")
    rows = clusters.select("cluster_id", "pos", "latin", F.lead("latin").over(w).alias("next_latin")).where("next_latin IS NOT NULL")
    return rows.withColumn("distance", F.levenshtein("latin", "next_latin"))
