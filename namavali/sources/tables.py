"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder only where it is unset and Spark is one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="namavali-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended: whoever owns the shared folder clears it
        pass


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again; it survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/namavali/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, df.sparkSession, path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_sequence(df: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """df with consecutive numbers from 1 in `order`, without bringing all rows to one task.

    Rows are dealt out by ranges of the order, numbered in each range, and offset by the counts of the ranges before;
    only those counts, one for each range, are brought together.
    """
    from pyspark.sql import Window

    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = materialize(df, "unranged")  # ranges are chosen by a sample, which would run the lineage once more
    dealt = materialize(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("__part").count()
    before = F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    numbered = dealt.withColumn("__in", inside).join(F.broadcast(counts), "__part")  # one short row a range
    return numbered.withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__part", "__in", "__before")
