"""What several corpus operators share: the cluster's shared folder, materialised tables and vectorised word hashing."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of the delimiters of a word: space and U+0009 to U+000D.
DELIMITERS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same as a character class for Java regular expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Most bytes of text that are expanded to 64-bit arrays at once; one longer text is taken alone.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir that the driver and all executors share.

    Only where the session has none and runs in one process (tests) is a temporary folder taken.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not made:
        made = "file://" + tempfile.mkdtemp(prefix="namavali-")
        spark.sparkContext.setCheckpointDir(made)
    return made.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended: whoever owns the shared folder clears it
        pass


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/namavali/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """df as a table written in the shared folder: later stages read it again instead of its lineage."""
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)).cast("int")


def tasks_for(df: DataFrame, at_least: int = 1) -> int:
    return max(at_least, df.rdd.getNumPartitions())


# ---- what a worker holds between tasks -------------------------------------------------------------------------------

#: How to empty the caches that operators keep in a Python process from task to task, by operator.
_CACHES: dict[str, Callable[[], None]] = {}


def keeps(operator: str, clear: Callable[[], None]) -> None:
    _CACHES[operator] = clear


def empty_others(operator: str) -> None:
    """Caches of other operators go."""
    for name, clear in _CACHES.items():
        if name != operator:
            clear()


@lru_cache(maxsize=1)
def _malloc_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library than glibc
        return None


def give_back() -> None:
    """Freed memory goes back to the system, which the allocators would keep for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    if trim := _malloc_trim():
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], operator: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow; its tasks leave no more behind in a worker than the operator's own cache.

    Workers wait beside the executor's heap while other stages run, so what they hold counts there too.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_others(operator)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


# ---- vectorised words ------------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[list(DELIMITERS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POW = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        grown = np.full(max(n, 2 * len(_POW)), _BASE, np.uint64)
        grown[0] = 1
        with np.errstate(over="ignore"):
            _POW = np.multiply.accumulate(grown)
    return _POW


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of a hash may be used alone."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have up to `most` bytes together, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) bytes of rows i to j, starts and ends of their words there, and each word's row (from i)."""
    part = _LOWER[data[offsets[i] : offsets[j]]]
    bounds = offsets[i : j + 1] - offsets[i]
    solid = ~_SPACE[part]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(part))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return part, starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words part[start:end]; the same in every batch, task and run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    at = np.zeros(len(starts), np.int64)
    np.cumsum(sizes[:-1], out=at[1:])
    inside = np.arange(int(at[-1] + sizes[-1]), dtype=np.int64) - np.repeat(at, sizes)
    where = inside + np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        summed = np.add.reduceat(_BYTE[part[where]] * _powers(int(sizes.max()))[inside], at)
        return mix(summed + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_words(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows i to j, and each row's word bounds (j - i + 1 of them)."""
    part, starts, ends, row = words(data, offsets, i, j)
    return word_hashes(part, starts, ends), np.searchsorted(row, np.arange(j - i + 1))
