"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A text's set is its distinct shingles of `k` words (64-bit hashes). Texts with one set are a class, named by 128 bits; a
class stands for its copies from the start. Two sets that reach the threshold share a shingle among the first few of each in any common
order; the order is rare-first, by the number of texts. Those numbers come from all shingles: blocks of texts send their
shingles, as packed columns, to the task of a shingle range, which sends back only those that occur again. What occurs
once comes first in the order and can join nothing, so few texts have any entry in a prefix list.

Prefix shingles are joined in two steps, so that a large group of near copies is not expanded into its pairs:

1. Each prefix list links its members to one leader, that with the least of its set before the list's shingle: as many
   pairs as entries. What comes before is rarer, most of it edits of this member alone, so the leader of a group of near
   copies is the least edited one, with which the others are linked if with any.
   Pairs that pass the positional and suffix filters are verified, once each, and give components.
2. Members of one list that are still in different components, and have not been compared, are paired under the same
   filters and verified. What is skipped are only pairs that are connected already, so components are exact.

The positional filter takes a shingle as the first that two sets have in common: then all they share lies from it on in
both. Linked sets pass at the first shingle they share, so none is lost, and no other of their shingles need pass. It
holds the length filter, as no more can lie there than a set has.

A shingle that is frequent in a block is sent once with its count, and lists of very frequent shingles are dealt out in
shares, whose leaders meet again.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; a text of fewer than k
words has its whole sequence as one shingle; repeated rows are copies; null ids get a component if a text of theirs is
linked, as the smallest id of it. An empty table gives an empty table. Only the id and the text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, hash_words, materialize, mix, text_buffer, tidy

WORDS, PERCENT = 5, 80
#: Buckets of a set's signature; a list's entries in a share; shingles of a block and of a range, at a mean; texts of a
#: block with a shingle from which it counts as frequent there.
SIGNATURE, SHARE, HELD, RANGE, FREQUENT = 32, 4096, 1 << 21, 1 << 22, 32
#: Bits for each key of the filter that chooses texts to be read again, and its most bits (32 MB): with more keys it lets
#: more texts pass that a join then drops.
KEY_BITS, FILTER = 16, 1 << 28
#: Bits of a shingle's name in lists: a clash makes a candidate more, which verification drops.
NAME = 40
_PAD = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0xE7037ED1A0B428DB)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b, max_output_size=1 << 31), kind)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, i: int, j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of rows i to j one after the other, each ascending, and their bounds."""
    h, at = hash_words(data, offsets, i, j)
    n = np.diff(at)
    count = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    row = np.repeat(np.arange(j - i), count)
    first = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][row]
    last = at[1:][row]
    s = np.zeros(len(row), np.uint64)
    with np.errstate(over="ignore"):
        for w in range(k):
            place = first + w
            word = np.where(place < last, h[np.minimum(place, max(len(h) - 1, 0))], _PAD) if len(h) else s
            s = mix(s * _STEP + word)
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    s, row = s[new], row[new]
    return s, np.searchsorted(row, np.arange(j - i + 1))


def set_key(s: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    return xxhash.xxh3_128_digest(np.ascontiguousarray(s).tobytes())


def _planes(x: np.ndarray, bytes_each: int) -> bytes:
    """Numbers packed by byte planes, so that high bytes, which are mostly zero, cost nothing."""
    return _pack(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :bytes_each].T))


def _numbers(raw: bytes, bytes_each: int) -> np.ndarray:
    planes = _unpack(raw, np.uint8).reshape(bytes_each, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :bytes_each] = planes.T
    return out.view("<u8").ravel()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sets_table(rows: DataFrame, k: int) -> DataFrame:
    """Per row: id, n, key (null for an empty set), and the set's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            for i, j in chunks(offsets):
                s, at = shingle_sets(data, offsets, i, j, k)
                n = np.diff(at)
                row = np.repeat(np.arange(j - i), n)
                sig = np.bincount(row * SIGNATURE + (s & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=(j - i) * SIGNATURE).astype(np.int32)
                keys = [set_key(s[a:z]) if z > a else None for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
                sigs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sig) + 1, SIGNATURE), pa.int32()), pa.array(sig))
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), sigs], ["id", "n", "key", "signature"])

    return rows.mapInArrow(tidy(run), f"id {rows.schema['id'].dataType.simpleString()}, n long, key binary, signature array<int>")


def shingle_blocks(rows: DataFrame, k: int, shares: int) -> DataFrame:
    """Per (block, share): the block's shingles of a range, ascending, and the place of each one's text in the block.

    A shingle that FREQUENT texts of the block have is sent once, with the count in `many`; its texts go with the row of
    share 0, as do the block's keys and sizes. A set that a task has met before is left out.
    """

    def block(keys: list, sizes: list, names: list, texts: list) -> pa.RecordBatch:
        t, at = np.concatenate(names), np.concatenate(texts)
        order = np.argsort(t, kind="stable")
        t, at = t[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        count = np.diff(np.append(first, len(t)))
        often = np.repeat(count >= FREQUENT, count)
        extra = _pack(np.concatenate([[len(keys), int(often.sum())], np.frombuffer(b"".join(keys), np.int64), np.array(sizes), t[often].astype(np.int64), at[often].astype(np.int64)]).astype(np.int64))
        head = np.zeros(len(t), bool)
        head[first] = True
        use = ~often | head
        many = np.where(often, np.repeat(count, count), 0)[use]
        t, at = t[use], np.where(often, 0, at)[use]
        wide = -(-(1 << NAME) // shares)
        cuts = np.searchsorted(t, np.arange(shares + 1, dtype=np.uint64) * np.uint64(wide))
        name, out = uuid.uuid4().hex, []
        for x, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if z > a or x == 0:
                out.append((name, x, _planes(np.diff(t[a:z], prepend=np.uint64(x * wide)), 5), _planes(at[a:z], 4), _planes(many[a:z], 4), extra if x == 0 else None))
        kinds = (pa.string(), pa.int32(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], ["block", "share", "names", "texts", "many", "extra"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, keys, sizes, names, texts, held = set(), [], [], [], [], 0
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            for i, j in chunks(offsets):
                s, at = shingle_sets(data, offsets, i, j, k)
                for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                    key = set_key(s[a:z]) if z > a else None
                    if key is None or key in seen:
                        continue
                    seen.add(key)
                    names.append(s[a:z] >> np.uint64(64 - NAME))
                    texts.append(np.full(z - a, len(keys), np.uint32))
                    keys.append(key)
                    sizes.append(z - a)
                    held += z - a
                if held >= HELD:
                    yield block(keys, sizes, names, texts)
                    keys, sizes, names, texts, held = [], [], [], [], 0
        if held:
            yield block(keys, sizes, names, texts)

    return rows.mapInArrow(tidy(run), "block string, share int, names binary, texts binary, many binary, extra binary")


def count_shares(blocks: DataFrame, shares: int) -> DataFrame:
    """For each (block, share), what of it occurs in two texts or more: names, texts, many, and the number of texts."""
    wide = -(-(1 << NAME) // shares)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        start = np.uint64(int(pdf["share"].iloc[0]) * wide)
        names = [np.cumsum(_numbers(x, 5), dtype=np.uint64) + start for x in pdf["names"]]
        many = [_numbers(x, 4) for x in pdf["many"]]
        t, n = np.concatenate(names), np.maximum(np.concatenate(many), 1)
        order = np.argsort(t, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], t[order][1:] != t[order][:-1]])) if len(t) else np.zeros(0, np.int64)
        total = np.add.reduceat(n[order], first) if len(t) else n
        df = np.empty(len(t), np.uint64)
        df[order] = np.repeat(total, np.diff(np.append(first, len(t))))
        out, ends = [], np.cumsum([len(x) for x in names])
        for block, a, z, at, m, extra in zip(pdf["block"], [0, *ends], ends, pdf["texts"], many, pdf["extra"]):
            live = df[a:z] > 1
            out.append((block, _planes(np.diff(t[a:z][live], prepend=start), 5), _planes(_numbers(at, 4)[live], 4), _planes(m[live], 4), _planes(df[a:z][live], 5), int(start), extra))
        return pd.DataFrame(out, columns=["block", "names", "texts", "many", "df", "start", "extra"])

    return blocks.groupBy("share").applyInPandas(run, "block string, names binary, texts binary, many binary, df binary, start long, extra binary")


def prefix_lists(rows: DataFrame, k: int, percent: int, shares: int) -> DataFrame:
    """Entries of the prefix lists: h (shingle), key, n, p (place in the order), shares."""
    counted = count_shares(shingle_blocks(rows, k, shares), shares)

    def texts_of(parts: list[tuple], extra: bytes) -> pa.RecordBatch:
        x = _unpack(extra, np.int64)
        c, o = int(x[0]), int(x[1])
        keys, sizes = x[2 : 2 + 2 * c].view("V16"), x[2 + 2 * c : 2 + 3 * c]
        hot, hot_at = x[2 + 3 * c : 2 + 3 * c + o].astype(np.uint64), x[2 + 3 * c + o :]
        cat = lambda i, kind: np.concatenate([p[i] for p in parts]).astype(kind) if parts else np.zeros(0, kind)
        t, at, many, df = cat(0, np.uint64), cat(1, np.int64), cat(2, np.int64), cat(3, np.int64)
        often = many > 0
        if o:  # the frequent ones' texts, with the numbers that have come back
            asc = np.argsort(t[often])
            told, number = t[often][asc], df[often][asc]
            t, at, df = np.concatenate([t[~often], hot]), np.concatenate([at[~often], hot_at]), np.concatenate([df[~often], number[np.searchsorted(told, hot)]])
        order = np.lexsort((t, df, at))
        t, at, df = t[order], at[order], df[order]
        live = np.bincount(at, minlength=c)
        inside = np.arange(len(t)) - np.repeat(np.cumsum(live) - live, live)
        place = inside + (sizes - live)[at]  # what occurs once comes before
        length = sizes - -(-percent * sizes // 100) + 1
        use = place < length[at]
        named = pa.array(keys[at[use]].tolist(), pa.binary())
        cols = [pa.array(t[use].astype(np.int64)), named, pa.array(sizes[at[use]]), pa.array(place[use].astype(np.int32)), pa.array((1 + df[use] // SHARE).astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, ["h", "key", "n", "p", "shares"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, extra = None, [], None
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                if r[0] != now:
                    if now is not None:
                        yield texts_of(parts, extra)
                    now, parts, extra = r[0], [], None
                parts.append((np.cumsum(_numbers(r[1], 5), dtype=np.uint64) + np.uint64(r[5]), _numbers(r[2], 4), _numbers(r[3], 4), _numbers(r[4], 5)))
                extra = r[6] or extra
        if now is not None:
            yield texts_of(parts, extra)

    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(run), "h long, key binary, n long, p int, shares int")


def _alpha(a: str, b: str, percent: int) -> Column:
    """The least intersection of sets of these sizes that are linked."""
    return F.ceil((F.col(a) + F.col(b)) * percent / F.lit(100.0 + percent) - 1e-9)


def _place(percent: int) -> Column:
    """Positional filter at a shingle with places pa and pb that is the first in common."""
    return F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _alpha("na", "nb", percent)


def _suffix(percent: int) -> Column:
    """Suffix filter: sets with signatures sa and sb, counted by bucket, could still meet often enough."""
    most = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    return most >= _alpha("na", "nb", percent)


def suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the suffix filter."""
    of = lambda c: classes.select(F.col("key").alias(c), F.col("n").alias("n" + c), F.col("signature").alias("s" + c))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(_suffix(percent)).select("a", "b")


def _bit(key: Column, size: int) -> Column:
    return (F.conv(F.hex(F.substring(key, 1, 7)), 16, 10).cast("long") % size).cast("long")


def key_filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each key by its hash, and the number of bits: KEY_BITS a key, FILTER at most. It is put together from 64 parts."""
    size = 1 << 16
    while size < FILTER and size < KEY_BITS * keys.count():
        size <<= 1
    wide = size // 64

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(wide // 8, np.uint8)
        at = pdf["at"].to_numpy() % wide
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "bits": [_pack(bits)]})

    at = keys.select(_bit(F.col("key"), size).alias("at")).distinct()  # FILTER rows at most
    found = at.withColumn("part", F.floor(F.col("at") / wide).cast("int")).groupBy("part").applyInPandas(run, "part int, bits binary").collect()
    out = np.zeros(size // 8, np.uint8)
    for r in found:
        out[r["part"] * wide // 8 : (r["part"] + 1) * wide // 8] = _unpack(r["bits"], np.uint8)
    return out, size


def verify(rows: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked. Sets of the classes in question are made again from the texts, which a filter of
    bounded size chooses without moving them; of each pair, the set that has more partners is sent to the other and
    compared there as it comes, so the sets of a leader's partners don't meet in its task."""
    pairs = materialize(pairs, "pairs")
    keys = materialize(pairs.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("partners")), "keys")
    of = lambda c: keys.select(F.col("key").alias(c), F.col("partners").alias("n" + c))
    few = F.col("na") <= F.col("nb")
    pairs = materialize(pairs.join(of("a"), "a").join(of("b"), "b").select(F.when(few, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(few, F.col("b")).otherwise(F.col("a")).alias("b")), "pairs")
    chosen = rows.sparkSession.sparkContext.broadcast(key_filter(keys))  # FILTER bits at most

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, (bits, size) = set(), chosen.value
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            for i, j in chunks(offsets):
                s, at = shingle_sets(data, offsets, i, j, k)
                made = []
                for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                    key = set_key(s[a:z]) if z > a else None
                    if key is None or key in seen:
                        continue
                    bit = int.from_bytes(key[:7], "big") % size
                    if bits[bit >> 3] >> (bit & 7) & 1:
                        seen.add(key)
                        made.append((key, s[a:z].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())], ["key", "set"])

    sets = rows.mapInArrow(tidy(sets_of), "key binary, set binary").join(keys, "key", "left_semi").dropDuplicates(["key"])
    sets = materialize(sets, "sets")
    owners = pairs.select(F.col("a").alias("key")).distinct().join(sets, "key").select(F.col("key").alias("a"), F.lit(None).cast("binary").alias("b"), "set")
    others = pairs.join(sets.withColumnRenamed("key", "b"), "b").select("a", "b", "set")
    ordered = owners.unionByName(others).repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, b, raw in zip(*(batch.column(c) for c in range(3))):
                s = np.frombuffer(raw.as_buffer(), np.uint64)
                if not b.is_valid:
                    mine = s.copy()
                    continue
                at = np.searchsorted(mine, s)
                common = int((mine[np.minimum(at, len(mine) - 1)] == s).sum())
                if 100 * common >= percent * (len(mine) + len(s) - common):
                    found.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], ["a", "b"])

    return materialize(ordered.mapInArrow(tidy(compare), "a binary, b binary"), "links")


def components(links: DataFrame) -> DataFrame:
    """(key, component) of the keys in links (a, b): the smallest key that is reachable, by alternating stars."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: each node's larger neighbours go to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each node and its smaller neighbours go to the least of those.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "edges")
        told = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(told) == before:
            break
        before = tuple(told)
    return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct())


def _pair(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def step_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of entries (h, key, n, p, component, signature) of one list, in different components, that pass the filters."""
    # Sizes of a pair are in the same or neighbouring steps of the threshold, so the step is a second key.
    by = F.col("n").cast("double") if percent == 100 else F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))
    steps = F.sequence(F.floor(by).cast("int"), F.floor(by + (0.0 if percent == 100 else 1.0) + 1e-9).cast("int"))
    side = lambda x: [F.col("key").alias("k" + x), F.col("n").alias("n" + x), F.col("p").alias("p" + x), F.col("component").alias("c" + x), F.col("signature").alias("s" + x)]
    left = rest.select("h", *side("a"), F.explode(steps).alias("step"))
    right = rest.select("h", *side("b"), F.floor(by).cast("int").alias("step"))
    small_first = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ka") < F.col("kb")))
    close = (F.col("ca") != F.col("cb")) & small_first & _place(percent) & _suffix(percent)
    return left.join(right, (left["h"] == right["h"]) & (left["step"] == right["step"]) & close).select(*_pair("ka", "kb")).distinct()


def link_classes(rows: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, component) of all classes that are linked with another."""
    # Ranges of shingles for as many tasks as the session has, and more where they would hold too much.
    total = classes.agg(F.sum("n")).first()[0] or 0
    shares = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // RANGE)
    posts = prefix_lists(rows, k, percent, shares)
    posts = posts.withColumn("share", F.pmod(F.xxhash64("key"), F.col("shares")).cast("int"))
    one = F.struct((F.col("p") / F.col("n")).alias("before"), F.xxhash64("key", "h").alias("o"), "key", "n", "p")

    def led(df: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by)
        return df.withColumn("leader", F.min(one).over(w)).withColumn("entries", F.count("*").over(w))

    live = materialize(led(posts, "h", "share").where("entries > 1 OR shares > 1"), "lists")
    again = led(live.where("shares > 1 AND key = leader.key").drop("leader", "entries"), "h")
    star = lambda df: df.where("key <> leader.key").select(F.col("key").alias("ka"), F.col("leader.key").alias("kb"), F.col("n").alias("na"), F.col("leader.n").alias("nb"), F.col("p").alias("pa"), F.col("leader.p").alias("pb"))
    first = star(live).unionByName(star(again)).where(_place(percent)).select(*_pair("ka", "kb")).distinct()
    first = materialize(suffix_filter(first, classes, percent), "stars")
    links = verify(rows, first, k, percent)
    found = materialize(components(links), "components")

    # Lists of three entries or more can hold pairs that no leader has been in.
    rest = live.where("entries > 2 OR shares > 1").select("h", "key", "n", "p").join(found, "key", "left")
    rest = rest.withColumn("component", F.coalesce("component", "key"))
    mixed = rest.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("h")
    # Signatures come along, so that the join itself gives only pairs that pass all filters.
    rest = materialize(rest.join(mixed, "h", "left_semi").join(classes.select("key", "signature"), "key"), "mixed")
    second = step_pairs(rest, percent)
    second = second.join(first, ["a", "b"], "left_anti")
    more = verify(rows, second, k, percent)
    if more.isEmpty():
        return found
    tree = found.where("key <> component").select(F.col("key").alias("a"), F.col("component").alias("b"))
    return materialize(components(tree.unionByName(more)), "components")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links, itself included)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = materialize(sets_table(rows, k), "table")
    # A class: its least id, its size and signature.
    classes = table.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("signature").alias("signature"))
    classes = materialize(classes, "classes")
    linked = link_classes(rows, classes, k, percent)
    least = classes.select("key", "id").join(linked, "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = least.groupBy("component").agg(F.min("id").alias("component_id"))
    named = least.join(smallest, "component").select(F.col("key").alias("__key"), "component_id")
    # Rows that are alone in their class need no join; the others' side is split if a class is large.
    out = table.select("id", "n", "key").join(named, F.col("key") == F.col("__key"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that with its smallest id, with its columns as they were."""
    found = materialize(near_duplicates(df, id_col, text_col, k, percent), "near")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    return df.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
