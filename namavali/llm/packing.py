"""Best-fit packing by linear grouping, planned on counts and carried out on all pieces.

1. Texts are tokenized (each distinct word of some megabytes of text once, all of them together in arrays) and cut into
   pieces of at most `capacity` tokens.
2. Pieces of over `small` tokens are ranked by length and put into groups of equal cardinality; each group's lengths
   count as its largest. For these few sizes the configurations are optimised (columns of the cutting-stock relaxation,
   the rest by best fit), then the actual pieces take their group's places.
3. What the actual pieces leave free is filled with the small pieces by best fit, longest first.

Rounding lengths up costs room that only small pieces can fill, so the threshold `small` is chosen by planning for each
of SMALL on the counts, scaled down to PLANNED pieces; the fewest sequences win.

A text's ids are those that the library gives, special tokens' strings in it included.

The driver only sees counts by length (at most `capacity` of them), whatever the input's size. Ranks among pieces of one
length are taken in shares and offset by the counts of the shares before, so no key's rows meet in one task.

Defined results: a null text counts as empty: one piece, its end token alone. Repeated rows are packed as rows of their
own. An empty table gives an empty table. Only the id and the text are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, _SPACE, CHUNK_BYTES, chunks, keeps, materialize, text_buffer, tidy

CAPACITY, END = 2048, 0
#: Parts of the capacity up to which pieces may count as small, the number of groups that the others fall into, and the
#: pieces for which the choice is made.
SMALL, GROUPS, PLANNED = (1 / 8, 1 / 4, 1 / 2), 48, 20_000
#: Rows of a share, about, in which ranks are counted.
SHARE_ROWS = 200_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: What a file must say of its text for words to be encoded alone, and for plain ones to be merged here; with any other
#: file the library encodes whole texts. A fixed value.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


@lru_cache(maxsize=4)
def added(path: str) -> tuple[bool, tuple[str, ...]]:
    """Whether the file is of the known kind, and the strings of its special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = spec.get("added_tokens") or []
    alone = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and t["content"] and not re.search(r"\s", t["content"]) for t in tokens)
    known = alone and all(spec.get(k) == v for k, v in KNOWN.items()) and all(spec["model"].get(k) == v for k, v in _MODEL.items()) and bool(spec["model"].get("end_of_word_suffix"))
    return known and max(spec["model"]["vocab"].values()) < 1 << 16, tuple(t["content"] for t in tokens)


#: Bytes of plain words, whose normal form and pre-tokens are plain: ASCII letters, digits and marks without an apostrophe,
#: and Latin letters of two bytes, the first of which is always _WIDE.
_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True
_PLAIN[ord("'")] = False
_WIDE = 0xC3
#: Kinds of lower-cased bytes of plain words: 0 letters, 1 digits, 2 marks.
_KIND = np.full(256, 2, np.uint8)
_KIND[ord("0") : ord("9") + 1] = 1
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 0
#: Bytes of the longest word merged here. The library's time does not grow with the square of a word's length.
LONGEST = 256
#: Strings whose ids are put together at once, and words that the library is given at once.
GATHERED, GIVEN = 1 << 18, 10_000


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges start, start + 1, ... of the given sizes, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_binary array's strings, one after the other, and their n + 1 offsets."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]], offsets - offsets[0]


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of plain words, none empty: lower-cased bytes, the pre-tokens' starts there, and each word's first pre-token. The
    last of the starts and of the first ones is the end."""
    low = _LOWER[data]
    capital = np.flatnonzero((data[:-1] == _WIDE) & (data[1:] < 0x9F)) + 1
    low[capital] |= 0x20
    kind = _KIND[low]
    first = kind == 1
    first[1:] |= kind[1:] != kind[:-1]
    first[offsets[:-1]] = True
    starts = np.append(np.flatnonzero(first), len(low))
    return low, starts, np.searchsorted(starts, offsets)


class Merges:
    """The tokenizer's merges, applied to many pre-tokens at once: each takes its lowest merge, leftmost first, in turn.

    Ranks are found in a table by a hash of the pair; pairs whose place is taken are in a short sorted list.
    """

    BITS, NONE = 18, (1 << 31) - 1

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}  # bytes as printable characters
        self.inner = np.array([vocab[char[b]] for b in range(256)], np.uint32)
        self.last = np.array([vocab[char[b] + suffix] for b in range(256)], np.uint32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        place, at = np.unique(self._place(keys), return_index=True)
        self.keys, self.ranks = np.zeros(1 << self.BITS, np.uint32), np.full(1 << self.BITS, self.NONE, np.int32)
        self.keys[place], self.ranks[place] = keys[at], at
        rest = np.setdiff1d(np.arange(len(keys)), at)
        rest = rest[np.argsort(keys[rest], kind="stable")]
        self.more_keys, self.more_ranks = keys[rest], rest.astype(np.int32)
        self.crowded = np.zeros(1 << self.BITS, bool)
        self.crowded[self._place(self.more_keys)] = True

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.BITS)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE for those that are not merged."""
        keys = left << np.uint32(16) | right
        place = self._place(keys)
        found = self.keys[place] == keys
        out = np.where(found, self.ranks[place], np.int32(self.NONE))
        rest = np.flatnonzero(~found & self.crowded[place])
        if len(rest):
            k = np.minimum(np.searchsorted(self.more_keys, keys[rest]), len(self.more_keys) - 1)
            out[rest] = np.where(self.more_keys[k] == keys[rest], self.more_ranks[k], np.int32(self.NONE))
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens data[offset:next offset], none empty, one after the other, and how many each has."""
        ends, sizes, names = offsets[1:], np.diff(offsets), np.arange(len(offsets) - 1)
        token = self.inner[data]
        token[ends - 1] = self.last[data[ends - 1]]
        rank = np.full(len(token), self.NONE, np.int32)
        rank[:-1] = self.rank(token[:-1], token[1:])
        rank[ends - 1] = self.NONE
        told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(names):
            firsts = ends - sizes
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(rank)), firsts)
            on = best >> 32 != self.NONE
            left, at = np.repeat(on, sizes), best[on] & 0xFFFFFFFF
            told.append((names[~on], sizes[~on], token[~left]))
            token[at] = self.made[rank[at]]
            left[at + 1] = False
            token, rank = token[left], rank[left]
            at = at - firsts[on]
            names, sizes = names[on], sizes[on] - 1
            ends = np.cumsum(sizes)
            at += ends - sizes
            # The merged token's pairs with its neighbours, where it has any, are the only new ones.
            rank[at] = self.NONE
            inner = at[at + 1 < ends]
            rank[inner] = self.rank(token[inner], token[inner + 1])
            inner = at[at > ends - sizes]
            rank[inner - 1] = self.rank(token[inner - 1], token[inner])
        if not told:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        names, sizes, flat = (np.concatenate(x) for x in zip(*told))
        order = np.argsort(names)
        return flat[spread((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


class Ids:
    """Ids of strings: those of string k are `sizes[k]` numbers of `flat` from `starts[k]`."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.starts = flat, sizes, np.cumsum(sizes) - sizes

    def of(self, k: np.ndarray) -> np.ndarray:
        """Ids of the strings k, one after the other."""
        parts = (k[i : i + GATHERED] for i in range(0, len(k), GATHERED))
        return np.concatenate([self.flat[:0], *(self.flat[spread(self.starts[p], self.sizes[p])] for p in parts)])


class WordCache:
    """Ids of pre-tokens and of words that are not plain, kept from batch to batch up to a bound each. Plain words are
    merged by pre-token, the others tokenized."""

    def __init__(self, path: str, most: int = 200_000):
        self.path, self.most = path, most
        self.known, self.ids, self.sizes = pa.array([], pa.large_binary()), pa.array([], pa.uint32()), np.zeros(0, np.int64)
        self.odd: dict[bytes, bytes] = {}

    def _plain(self, low: np.ndarray, starts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids; a word's pre-tokens begin at its entry in `first`."""
        numbers, ids = self._pieces(pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(low)]))
        return np.add.reduceat(ids.sizes[numbers], first[:-1]), ids.of(numbers)

    def _pieces(self, found: pa.Array) -> tuple[np.ndarray, Ids]:
        """Each pre-token's number, and the ids by number."""
        coded = pa.concat_arrays([self.known, found]).dictionary_encode()  # known ones come first and keep their numbers
        fresh = coded.dictionary[len(self.known) :]
        flat, sizes = merges(self.path).encode(*strings(fresh))
        ids = Ids(np.concatenate([self.ids.to_numpy(), flat]), np.concatenate([self.sizes, sizes]))
        numbers = coded.indices.to_numpy()[len(self.known) :]
        if len(self.known) <= self.most:  # a full cache stays as it is: frequent ones have come early
            self.known, self.ids, self.sizes = coded.dictionary, pa.array(ids.flat), ids.sizes
        return numbers, ids

    def _odd(self, found: list[bytes]) -> list[bytes]:
        new = [w for w in found if w not in self.odd]
        more: dict[bytes, bytes] = {}
        for i in range(0, len(new), GIVEN):
            some = new[i : i + GIVEN]
            got = tokenizer(self.path).encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            more.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, got))
        if len(self.odd) <= self.most:
            self.odd.update(more)
        return [self.odd[w] if w in self.odd else more[w] for w in found]

    def get(self, found: pa.Array) -> Ids:
        """Ids of words, a large_binary array."""
        parts = [self._get(found[i:j]) for i, j in chunks(strings(found)[1], CHUNK_BYTES * 4)]
        return Ids(*(np.concatenate(x) for x in zip(*parts))) if parts else Ids(np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _get(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = strings(found)
        wide = np.zeros(len(data), bool)
        if len(data) and data.max() > 127:
            wide[1:] = (data[:-1] == _WIDE) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            wide |= data == _WIDE
        bad = np.flatnonzero(~(_PLAIN[data] | wide))
        n = np.diff(offsets)
        odd = (n == 0) | (n > LONGEST)
        odd[np.searchsorted(offsets, bad, "right") - 1] = True
        for content in added(self.path)[1]:
            odd |= pc.match_substring(found, content.encode()).to_numpy(zero_copy_only=False)
        sizes, flat, plain = np.zeros(len(found), np.int64), np.zeros(0, np.uint32), np.flatnonzero(~odd)
        if len(plain):
            data, offsets = strings(found.filter(pa.array(~odd)))
            low, starts, first = pre_tokens(data, offsets)
            told = [self._plain(low, starts[first[i] : first[j] + 1], first[i : j + 1] - first[i]) for i, j in chunks(first, GATHERED * 4)]
            sizes[plain], flat = np.concatenate([n for n, _ in told]), np.concatenate([x for _, x in told])
        if not odd.any():
            return flat, sizes
        told = self._odd(found.filter(pa.array(odd)).to_pylist())
        sizes[odd] = np.fromiter(map(len, told), np.int64, len(told)) // 4
        out = np.zeros(int(sizes.sum()), np.uint32)
        here = np.repeat(odd, sizes)
        out[here], out[~here] = np.frombuffer(b"".join(told), "<u4"), flat
        return out, sizes


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """One cache for all tasks that a Python process runs."""
    return WordCache(path)


keeps("packing", word_cache.cache_clear)


def encode_texts(column: pa.Array, cache: WordCache) -> Iterator[np.ndarray]:
    """Ids of each text. The tokenizer drops white space, so words between ASCII white space are encoded alone."""
    if not added(cache.path)[0]:
        for text in column.to_pylist():
            yield np.array(tokenizer(cache.path).encode(text or "", add_special_tokens=False).ids, "<u4")
        return
    data, offsets = text_buffer(column)
    for i, j in chunks(offsets, CHUNK_BYTES * 4):
        bounds, part = pa.py_buffer(offsets[i : j + 1] - offsets[i]), pa.py_buffer(data[offsets[i] : offsets[j]])
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), j - i, [None, bounds, part]))
        coded = split.flatten().cast(pa.large_binary()).dictionary_encode()
        words, ids, ends = coded.indices.to_numpy(), cache.get(coded.dictionary), np.asarray(split.offsets, np.int64)
        for a, z in chunks(ends, GATHERED):
            at = words[ends[a] : ends[z]]
            flat, tokens = ids.of(at).astype("<u4", copy=False), np.append(0, np.cumsum(ids.sizes[at]))
            places = tokens[ends[a : z + 1] - ends[a]].tolist()
            for k, n in zip(places, places[1:]):
                yield flat[k:n]


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32."""
    assert bool(_SPACE[list(b" \t\n\x0b\x0c\r")].all())
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path)
        for b in batches:
            rows: list[tuple] = []
            for i, ids in zip(b.column(0).to_pylist(), encode_texts(b.column(1), cache)):
                n = len(ids) + 1
                for k, a in enumerate(range(0, n, capacity)):
                    crc = zlib.crc32(ids[a : a + capacity])
                    rows.append((i, k, a, min(capacity, n - a), crc if a + capacity < n else zlib.crc32(last, crc)))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = (b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run, "packing"), f"id {kind}, piece int, start long, length long, ids_crc32 long")


# ---- the plan, on counts ---------------------------------------------------------------------------------------------


def _knapsack(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the most worth within capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    rest = np.arange(capacity + 1)[None] - sizes[:, None]  # room left after one of each size
    while True:  # one piece more each time
        value = np.where(rest >= 0, best[np.maximum(rest, 0)] + worth[:, None], -1.0)
        k = value.argmax(0)
        more = value[k, np.arange(capacity + 1)] > best + 1e-12
        if not more.any():
            break
        best, took = np.where(more, value[k, np.arange(capacity + 1)], best), np.where(more, k, took)
    out, c = np.zeros(len(sizes)), capacity
    while took[c] >= 0:
        out[took[c]] += 1
        c -= sizes[took[c]]
    return out


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 400) -> list[tuple[dict[int, int], int]]:
    """(how many of each size, how many sequences like that) that hold exactly `counts` pieces of `sizes`."""
    s, n = np.array(sizes), np.array(counts, float)
    out: list[tuple[dict[int, int], int]] = []
    left = np.array(counts, np.int64)
    if len(s):
        cols = np.diag((capacity // s).astype(float))
        for _ in range(rounds):  # simplex with columns made as needed
            inverse = np.linalg.inv(cols)
            x, dual = inverse @ n, inverse.sum(axis=0)
            new = _knapsack(dual, s, capacity)
            if dual @ new <= 1 + 1e-7:
                break
            step = inverse @ new
            ratio = np.where(step > 1e-9, x / np.maximum(step, 1e-9), np.inf)
            cols[:, int(ratio.argmin())] = new
        for j, much in enumerate(np.floor(np.linalg.inv(cols) @ n + 1e-9)):
            col = cols[:, j].astype(np.int64)
            times = int(min([much, *(left[i] // col[i] for i in np.flatnonzero(col))])) if col.any() else 0
            if times > 0:
                left -= col * times
                out.append(({int(s[i]): int(col[i]) for i in np.flatnonzero(col)}, times))
    # What rounding down has left: few pieces a size, by best fit, longest first.
    bins: list[list[int]] = []
    for i in np.argsort(-s, kind="stable"):
        for _ in range(int(left[i])):
            fits = [(capacity - sum(b), k) for k, b in enumerate(bins) if capacity - sum(b) >= s[i]]
            if fits:
                bins[min(fits)[1]].append(int(s[i]))
            else:
                bins.append([int(s[i])])
    for b in bins:
        kinds: dict[int, int] = defaultdict(int)
        for x in b:
            kinds[x] += 1
        out.append((dict(kinds), 1))
    return out


def plan_large(hist: dict[int, int], capacity: int, small: int, groups: int) -> tuple[list[tuple], int]:
    """Places for large pieces: (length, first rank, last rank + 1, group's first place), and their groups' tables.

    hist: pieces by length. Returns (rows of (length, from rank, to rank, size, place)), (rows of
    (size, from place, to place, first sequence, places a sequence, slot)), and the number of sequences.
    """
    large = sorted(((x, c) for x, c in hist.items() if x > small), reverse=True)
    total = sum(c for _, c in large)
    share = -(-total // groups) if total else 1
    spans, size_counts, size, room, place = [], {}, None, 0, 0
    for x, c in large:
        rank = 0
        while c:
            if not room:
                size, room, place = x, share, size_counts.get(x, 0)
            take = min(c, room)
            at = size_counts.get(size, 0)
            spans.append((x, rank, rank + take, size, at))
            size_counts[size] = at + take
            rank, c, room = rank + take, c - take, room - take
    sizes = sorted(size_counts, reverse=True)
    slots, used, sequence = [], defaultdict(int), 0
    for config, times in configurations(sizes, [size_counts[x] for x in sizes], capacity):
        slot = 0
        for x, k in sorted(config.items(), reverse=True):
            slots.append((x, used[x], used[x] + k * times, sequence, k, slot))
            used[x] += k * times
            slot += k
        sequence += times
    return (spans, slots), sequence


def plan_small(gaps: dict[int, int], hist: dict[int, int], capacity: int, first_new: int) -> list[tuple]:
    """Best fit on counts: rows (length, from rank, to rank, gap, from place, to place or new sequence, slot).

    gaps: sequences by free room. Sequences of one gap are ranked; a class is a range of those ranks with the same room
    now. New sequences form the gap `capacity` with ranks from 0. Rows: (length, first rank, gap, first place, how many, slot).
    """
    classes: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # room now -> (gap, from, how many, slot)
    for g, c in sorted(gaps.items()):
        if g and c:
            classes[g].append((g, 0, c, 0))
    rows, opened = [], 0
    for x, c in sorted(hist.items(), reverse=True):
        rank = 0
        while c:
            room = min((r for r, v in classes.items() if r >= x and v), default=None)
            if room is None:  # so many new sequences that each takes as many of this length as it holds
                new = -(-c // (capacity // x))
                classes[capacity].append((-1, opened, new, 0))
                opened += new
                continue
            gap, at, many, slot = classes[room].pop()
            take = min(many, c)
            if take < many:
                classes[room].append((gap, at + take, many - take, slot))
            rows.append((x, rank, rank + take, gap, at, slot))
            classes[room - x].append((gap, at, take, slot + 1))
            rank, c = rank + take, c - take
    return rows


def sequences_of(hist: dict[int, int], capacity: int, small: int, groups: int) -> int:
    """The number of sequences that a plan for these counts makes."""
    (spans, slots), sequences = plan_large(hist, capacity, small, groups)
    lengths: dict[int, list[np.ndarray]] = defaultdict(list)
    for length, a, z, size, _ in sorted(spans, key=lambda r: (r[3], r[4])):
        lengths[size].append(np.full(z - a, length))
    by_place = {size: np.concatenate(v) for size, v in lengths.items()}
    used = np.zeros(sequences, np.int64)
    for size, a, z, first, each, _ in slots:
        np.add.at(used, first + np.arange(z - a) // each, by_place[size][a:z])
    gaps = dict(zip(*(x.tolist() for x in np.unique(capacity - used, return_counts=True))))
    fills = plan_small(gaps, {x: c for x, c in hist.items() if x <= small}, capacity, sequences)
    return sequences + max((place + z - a for _, a, z, gap, place, _ in fills if gap < 0), default=0)


def choose_small(hist: dict[int, int], capacity: int, groups: int) -> int:
    """The length up to which pieces are small, of those in SMALL, with the fewest sequences; the least such."""
    total = sum(hist.values())
    like = hist if total <= PLANNED else {x: max(1, round(c * PLANNED / total)) for x, c in hist.items()}
    return min((int(capacity * part) for part in SMALL), key=lambda small: (sequences_of(like, capacity, small, groups), small))


# ---- carrying it out -------------------------------------------------------------------------------------------------


def with_rank(df: DataFrame, key: str, order: list[str], rows: int) -> DataFrame:
    """df with `rank`, from 0 within each key. Rows are ranked in shares; the counts of earlier shares are added."""
    shares = max(1, rows // SHARE_ROWS) * 8 if rows > SHARE_ROWS else 8
    t = df.withColumn("__share", F.pmod(F.xxhash64(*order), F.lit(shares)).cast("int"))
    counts = t.groupBy(key, "__share").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy(key).orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col(key).alias("__k"), F.col("__share").alias("__s"), before.alias("__before"))
    t = t.withColumn("__in", F.row_number().over(Window.partitionBy(key, "__share").orderBy(*order)) - 1)
    t = t.join(counts, (F.col(key) == F.col("__k")) & (F.col("__share") == F.col("__s")))
    return t.withColumn("rank", F.col("__in") + F.col("__before")).drop("__share", "__in", "__before", "__k", "__s")


def _lookup(table: list[tuple], at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of rows (key, from, ...) sorted, the index of each (key, at)'s row."""
    keys = np.array([(r[0], r[1]) for r in table], np.int64).reshape(-1, 2)
    wide = np.int64(1) << np.int64(44)
    return np.searchsorted(keys[:, 0] * wide + keys[:, 1], key * wide + at, "right") - 1


def best_fit_pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, small: int | None = None, groups: int = GROUPS, end: int = END
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    p = materialize(pieces(df, path, id_col, text_col, capacity, end).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    hist = {r["length"]: r["count"] for r in p.groupBy("length").count().collect()}  # at most `capacity` rows
    small = choose_small(hist, capacity, groups) if small is None else small
    (spans, slots), sequences = plan_large(hist, capacity, small, groups)
    spans, slots = sorted(spans), sorted(slots)
    ranked = materialize(with_rank(p, "length", ["uid"], sum(hist.values())), "ranked")

    def place_large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span, slot = np.array(spans, np.int64).reshape(-1, 5), np.array(slots, np.int64).reshape(-1, 6)
        for b in batches:
            length, rank = b.column(1).to_numpy(), b.column(2).to_numpy()
            s = span[_lookup(spans, rank, length)]
            size, place = s[:, 3], s[:, 4] + rank - s[:, 1]
            t = slot[_lookup(slots, place, size)]
            inside = place - t[:, 1]
            sequence, no = t[:, 3] + inside // t[:, 4], t[:, 5] + inside % t[:, 4]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sequence), pa.array(no)], ["uid", "length", "sequence_id", "slot"])

    placed = "uid long, length long, sequence_id long, slot long"
    columns = [F.col("uid"), F.col("length"), F.col("rank").cast("long").alias("rank")]
    large = materialize(ranked.where(F.col("length") > small).select(*columns).mapInArrow(tidy(place_large, "packing"), placed), "large")
    free = large.groupBy("sequence_id").agg((capacity - F.sum("length")).alias("gap")).where("gap > 0")
    free = materialize(with_rank(free, "gap", ["sequence_id"], sequences), "free")
    gaps = {r["gap"]: r["count"] for r in free.groupBy("gap").count().collect()}  # fewer than `capacity` rows
    fills = sorted(plan_small(gaps, {x: c for x, c in hist.items() if x <= small}, capacity, sequences))

    def place_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = np.array(fills, np.int64).reshape(-1, 6)
        for b in batches:
            length, rank = b.column(1).to_numpy(), b.column(2).to_numpy()
            f = fill[_lookup(fills, rank, length)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(f[:, 3]), pa.array(f[:, 4] + rank - f[:, 1]), pa.array(f[:, 5] + capacity)], ["uid", "length", "gap", "place", "slot"]
            )

    little = ranked.where(F.col("length") <= small).select(*columns).mapInArrow(tidy(place_small, "packing"), "uid long, length long, gap long, place long, slot long")
    new = little.where("gap < 0").withColumn("sequence_id", F.col("place") + F.lit(sequences))
    old = little.where("gap >= 0").join(free.select(F.col("gap"), F.col("rank").cast("long").alias("place"), "sequence_id"), ["gap", "place"])
    names = ["uid", "length", "sequence_id", "slot"]
    every = large.select(names).unionByName(new.select(names)).unionByName(old.select(names))
    # At most `capacity` pieces are in a sequence.
    before = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("slot", "uid").rowsBetween(Window.unboundedPreceding, -1))
    every = every.select("uid", "sequence_id", F.coalesce(before, F.lit(0)).cast("long").alias("offset"))
    return p.join(every, "uid").select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
