"""The recent-keys window over a stream: one state a group, kept between batches."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.names import normalize_key


def read_stream(spark: SparkSession, path: str, schema, files_at_once: int = 100) -> DataFrame:
    """Parquet files as they come; files_at_once bounds what a batch takes in."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def keep_recent_stream(df: DataFrame, group: str | None = "pdf_file", order: Sequence[str] = ("seq",), size: int = 1000, name: str = "name") -> DataFrame:
    """Rows (group, the order's columns, name, norm, place) whose key is not among the last `size` accepted of their group,
    appended; `place` counts them. Without `group` all rows are one, as names of all files are.

    Within a batch rows are taken in `order`, for which a group's narrow rows of one batch are held at once; batches in the
    order they come. The state is the list of accepted keys and their number, so its size is bounded by `size`.
    """
    order = list(order)
    by = F.col(group) if group else F.lit("all")
    keyed = df.select(by.alias("group"), *order, F.col(name).alias("name"), normalize_key(name).alias("norm"))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, n = state.get if state.exists else ("[]", 0)
        recent = deque(json.loads(held))
        known = set(recent)
        rows = pd.concat(list(parts)).sort_values(order, kind="stable")
        kept = []
        for i, k in enumerate(rows["norm"]):
            if k not in known:
                kept.append(i)
                recent.append(k)
                known.add(k)
                if len(recent) > size:
                    known.discard(recent.popleft())
        state.update((json.dumps(list(recent)), n + len(kept)))
        yield rows.iloc[kept].assign(place=range(n + 1, n + len(kept) + 1))[schema.names]

    schema = T.StructType([*keyed.schema.fields, T.StructField("place", T.LongType())])
    return keyed.groupBy("group").applyInPandasWithState(step, schema, "recent string, n long", "append", GroupStateTimeout.NoTimeout)


def start_available(df: DataFrame, path: str, checkpoint: str):
    """A query that processes what there is, then ends; a rerun goes on from the checkpoint."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(df: DataFrame, path: str, checkpoint: str) -> None:
    start_available(df, path, checkpoint).awaitTermination()
