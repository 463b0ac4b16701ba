"""Keep-first deduplication by comparison key, exact or within a window of recent keys."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import normalize_key
from ..sources.tables import materialize


def keep_first(df: DataFrame, by: list[str], order: list[str], name: str = "name") -> DataFrame:
    """The first row of each key within `by`. Spark plans the rank as a group limit, before the shuffle too."""
    keyed = df.withColumn("norm", normalize_key(name))
    w = Window.partitionBy(*by, "norm").orderBy(*order)
    return keyed.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def accept(keys: Iterator[str], size: int) -> Iterator[bool]:
    """Whether each key is outside the last `size` accepted ones; a hit does not renew its key."""
    recent, known = deque(), set()
    for k in keys:
        if new := k not in known:
            recent.append(k)
            known.add(k)
            if len(recent) > size:
                known.discard(recent.popleft())
        yield new


def keep_recent(df: DataFrame, by: list[str], order: list[str], size: int = 1000, name: str = "name") -> DataFrame:
    """Rows whose key is not among the last `size` accepted of their group, in `order`.

    The window's state makes a group sequential; its rows are streamed in order, so memory is bounded by `size`, not by
    the group. Without `by` all rows are one group: use `deduplicate`, which avoids that where it can.
    """
    keyed = df.withColumn("norm", normalize_key(name))
    dealt = keyed.repartition(*[F.col(c) for c in by]) if by else keyed.repartition(1)
    ordered = dealt.sortWithinPartitions(*by, *order)
    at = [keyed.columns.index(c) for c in by]
    norm = keyed.columns.index("norm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, recent, known = None, deque(), set()
        for b in batches:
            mask = []
            for g, k in zip(zip(*(b.column(i).to_pylist() for i in at)) if at else [()] * len(b), b.column(norm).to_pylist()):
                if g != group:
                    group, recent, known = g, deque(), set()
                if new := k not in known:
                    recent.append(k)
                    known.add(k)
                    if len(recent) > size:
                        known.discard(recent.popleft())
                mask.append(new)
            yield b.filter(pa.array(mask, pa.bool_()))

    return ordered.mapInArrow(run, keyed.schema)


def deduplicate(df: DataFrame, by: list[str], order: list[str], size: int = 1000, name: str = "name") -> DataFrame:
    """The same rows as keep_recent, by keep_first if no group has more than `size` keys, since none is then evicted."""
    df = materialize(df, "keyed")  # counted and read again: what made it runs once
    keys = df.groupBy(*by).agg(F.count_distinct(normalize_key(name)).alias("n")).agg(F.max("n")).first()[0] or 0
    return keep_first(df, by, order, name) if keys <= size else keep_recent(df, by, order, size, name)


def numbered(df: DataFrame, by: list[str], order: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))
