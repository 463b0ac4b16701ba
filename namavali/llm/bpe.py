"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Each block of texts lists its distinct pre-tokens, and keeps for every text the positions' places in that list. The
lists, dealt out by word, meet so that each distinct word is encoded once however many blocks hold it; its ids go back
to the blocks, where every text is put together by position. Decoding joins the ids with the token-byte table, whose
size is the vocabulary's. What is shuffled is columnar: one row holds a block's words of one share, not one word.

Defined results: a null text counts as empty and has no ids; repeated rows repeat; an empty table gives an empty table;
only the id and the text are read. A block ends after `BLOCK` characters, or one text if that is longer.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text in a block: what one task holds at once.
BLOCK = 32_000_000


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[bytes, int]:
    """The vocabulary: ranks by token."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def token_table(path: str) -> list[bytes]:
    """The token-byte table: tokens by id."""
    ranks = token_bytes(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=token_bytes(path), special_tokens={})


def _pack(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b)


def _unpack(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b, max_output_size=1 << 31)


def _planes(x: np.ndarray) -> bytes:
    """Small numbers packed by byte planes: high bytes, mostly zero, cost next to nothing."""
    return _pack(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpack(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _pieces(found: list[str]) -> tuple[bytes, bytes]:
    """Words as (lengths, bytes), packed."""
    raw = [w.encode() for w in found]
    return _planes(np.array([len(w) for w in raw], np.uint32)), _pack(b"".join(raw))


def _words(sizes: bytes, data: bytes) -> list[bytes]:
    raw, ends = _unpack(data), np.cumsum(_numbers(sizes)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _share(word: str, shares: int) -> int:
    return xxhash.xxh64_intdigest(word) % shares


def list_words(df: DataFrame, pattern: str, id_col: str, text_col: str, shares: int, block: int = BLOCK, only: str | None = None) -> DataFrame:
    """Rows of two kinds for each block: share -1 has ids of texts, their sizes and positions; others the words of a share.

    only: "texts" or "words", for one kind. Blocks are named by partition, number and ids, so both kinds can be made in
    passes of their own without storing the positions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall

        def out(key: int, seen: dict[str, int], ids: list, counts: list, places: list) -> pa.RecordBatch:
            names = list(seen)
            by = [[] for _ in range(shares)]
            for w in names:
                by[_share(w, shares)].append(w)
            order = {w: i for i, w in enumerate(w for part in by for w in part)}
            to = np.fromiter((order[w] for w in names), np.uint32, len(names))
            at = np.concatenate(places) if places else np.zeros(0, np.uint32)
            # Positions hold ranks by frequency, which pack well; behind the counts, each rank's place among the words.
            by_rank = np.argsort(-np.bincount(at, minlength=len(names)), kind="stable")
            rank = np.empty(len(names), np.uint32)
            rank[by_rank] = np.arange(len(names))
            key = f"{TaskContext.get().partitionId()}-{key}-{xxhash.xxh64_hexdigest(repr(ids))}"
            rows = []
            if only != "words":
                rows.append((key, -1, pa.array(ids, pa.int64()), _planes(np.concatenate([np.array(counts, np.uint32), to[by_rank]])), _planes(rank[at])))
            if only != "texts":
                rows += [(key, k, None, *_pieces(part)) for k, part in enumerate(by) if part]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([None if r[2] is None else r[2].to_pylist() for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.binary()),
                    pa.array([r[4] for r in rows], pa.binary()),
                ],
                ["block", "share", "ids", "sizes", "data"],
            )

        fresh = lambda: ({}, [], [], [])
        seen, ids, counts, places = fresh()
        key, size = 0, 0
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = split(text or "")
                places.append(np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.uint32, len(found)))
                ids.append(i)
                counts.append(len(found))
                size += len(text or "")
                if size >= block:
                    yield out(key, seen, ids, counts, places)
                    seen, ids, counts, places = fresh()
                    key, size = key + 1, 0
        if ids:
            yield out(key, seen, ids, counts, places)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "block string, share int, ids array<long>, sizes binary, data binary")


def encode_words(lists: DataFrame, path: str, pattern: str) -> DataFrame:
    """The words of each (block, share) as ids: (block, share, sizes, data). Each distinct word of a share is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _encoding(path, pattern)._encode_single_piece  # a pre-token is encoded as it is, not split again
        done: dict[bytes, bytes] = {}
        at = None
        for b in batches:
            out: list[tuple[str, int, bytes, bytes]] = []
            for block, share, sizes, data in zip(*(b.column(k).to_pylist() for k in range(4))):
                if share != at:
                    done, at = {}, share
                got = []
                for w in _words(sizes, data):
                    ids = done.get(w)
                    if ids is None:
                        ids = done[w] = np.array(whole(w), np.uint32).tobytes()
                    got.append(ids)
                out.append((block, share, _planes(np.array([len(g) // 4 for g in got], np.uint32)), _planes(np.frombuffer(b"".join(got), np.uint32))))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary(), pa.binary()))] if out else [pa.array([], t) for t in (pa.string(), pa.int32(), pa.binary(), pa.binary())], ["block", "share", "sizes", "data"])

    words = lists.where("share >= 0").select("block", "share", "sizes", "data")
    return words.repartition("share").sortWithinPartitions("share").mapInArrow(run, "block string, share int, sizes binary, data binary")


def gather(lists: DataFrame, encoded: DataFrame, tasks: int) -> DataFrame:
    """Each block's encoded words, then its texts, in one task. Blocks go by the number of the partition that made them, in
    turn, so a task has as many as the input's partitions call for, and no two meet by chance of their hashes."""
    texts = lists.where("share = -1").select("block", "share", "ids", "sizes", "data")
    both = texts.unionByName(encoded.withColumn("ids", F.lit(None).cast("array<bigint>")))
    part = F.split_part("block", F.lit("-"), F.lit(1)).cast("int")
    return both.repartitionById(tasks, F.pmod(part, F.lit(tasks))).sortWithinPartitions(F.col("block"), F.col("share").desc())


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each block: ids of texts, their numbers of words, the words' ranks, and the token ids of each rank."""
    parts: list[tuple[int, bytes, bytes]] = []
    for b in batches:
        for _, share, ids, sizes, data in zip(*(b.column(k).to_pylist() for k in range(5))):
            if share >= 0:
                parts.append((share, sizes, data))
                continue
            parts.sort(key=lambda p: p[0])
            n = np.concatenate([_numbers(s) for _, s, _ in parts]) if parts else np.zeros(0, np.uint32)
            flat = np.concatenate([_numbers(d) for _, _, d in parts]) if parts else np.zeros(0, np.uint32)
            told = _numbers(sizes)
            counts, by_rank = told[: len(ids)], told[len(ids) :]
            if len(by_rank) != len(n):
                raise ValueError(f"a block has {len(by_rank)} words, and {len(n)} came back")
            ends = np.cumsum(n, dtype=np.int64)
            yield ids, counts, _numbers(data), [flat[a:z] for a, z in zip((ends - n)[by_rank].tolist(), ends[by_rank].tolist())]
            parts = []


def encode_and_decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = True) -> DataFrame:
    """Per row: id, n_tokens, and either digests of the ids and of the decoded bytes, or token_ids and decoded."""
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = lambda only: list_words(df, pattern, id_col, text_col, shares, only=only)
    ordered = gather(kind("texts"), encode_words(kind("words"), path, pattern), shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)
        for ids, counts, places, coded in _by_block(batches):
            sizes = np.array([len(c) for c in coded], np.int64)
            decoded = [b"".join(map(table.__getitem__, c.tolist())) for c in coded]
            said = [b"".join(b"%d " % x for x in c.tolist()) for c in coded] if digests else []
            ends = np.cumsum(counts).tolist()
            cols: list[list] = [[], [], []]
            for a, z in zip([0, *ends], ends):
                at = places[a:z].tolist()
                cols[0].append(int(sizes[places[a:z]].sum()))
                if digests:
                    cols[1].append(hashlib.sha256(b"".join(map(said.__getitem__, at))[:-1]).hexdigest())
                    cols[2].append(hashlib.sha256(b"".join(map(decoded.__getitem__, at))).hexdigest())
                else:
                    cols[1].append([x for k in at for x in coded[k].tolist()])
                    cols[2].append(b"".join(map(decoded.__getitem__, at)))
            kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.int64(), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))], [id_col, "n_tokens", "a", "b"])

    schema = f"`{id_col}` long, n_tokens long, " + ("a string, b string" if digests else "a array<int>, b binary")
    names = ("ids_sha256", "decoded_sha256") if digests else ("token_ids", "decoded")
    return ordered.mapInArrow(run, schema).withColumnsRenamed(dict(zip(("a", "b"), names)))
