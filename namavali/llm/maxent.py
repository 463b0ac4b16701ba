"""Language-model scoring by a hashed maximum-entropy model.

P(word | history) = P(class | history) * P(word | class, history), each with a softmax over features of the history. The
class has the last word and the word before it alone (a skip): frequent words have rows of their own in a table of
weights by class, rarer ones share a row by their ending. Inside the class a word has the bigram of the last word and
itself, with a weight if training has it, so these weights grow with the input. A word's class is its own if it is among
the most frequent, and else follows from its last bytes; classes and rows grow with the vocabulary and the corpus.

Blocks of texts list their distinct words as 64-bit hashes; lists meet by share of the hashes, where all training counts
are added, and go back to the blocks. In each round all blocks are gone through with the class weights as they are; what
is expected of each row and class is added by range of rows, and each weight moves by the logarithm of what was seen over
what is expected (iterative scaling). The class weights have MOST_ROWS rows for each feature at most and are broadcast.

Bigrams meet by share of last word and class, so a frequent word's are dealt out by class. Weights of one last word and
class touch no other's, so a share finds at once where the gradient of their penalised likelihood is zero: with n for
the bigram's count, N and D for the counts and kinds that follow the last word in the class, and q for the word's add-half
estimate in the class, the weight is log(1 + n / (D q)), so that the probability is (n + D q) / (N + D). All unknown words
have one place in each class, so the model's probabilities sum to one.

Defined results: a null text counts as empty and has its end token only; rows repeat as they come; with no training
rows all counts are 0; an empty table gives an empty table; only the id and the text are read. Blocks are named by
partition and number and added in that order, so equal partitions have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _remove, chunks, fold, materialize, mix, text_buffer, word_hashes, words

#: Bytes of text in a block, and in a share of the hashes at a mean.
BLOCK, SHARE_BYTES = 4_000_000, 1 << 24
#: Kinds of word endings that are counted, of which a class has one or more; most words and endings that are classes, so
#: that a class is a byte.
ENDINGS, MOST_OWN, MOST_SUFFIXES = 256, 90, 150
#: Words with rows of their own: at most, and for each cube root of the training tokens.
MOST_ROWS, ROOT_ROWS = 1 << 16, 128
#: Features a token; tokens taken at once; tokens that the classes' own frequencies count for beside a feature's.
ACTIVE, STEP, PRIOR = 2, 8192, 1.0
#: Parts of a unit in which logarithms of probabilities inside a class are told; bits of a name of last word and class.
PARTS, NAME = 4096, 48
END = np.uint64(0x5DEECE66D1234567)
_START = np.uint64(0x2545F4914F6CDD1D)
_SEED = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xC2B2AE3D27D4EB4F)]


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b, max_output_size=1 << 31), kind)


def _planes(x: np.ndarray, bytes_each: int) -> bytes:
    """Numbers packed by byte planes, so that high bytes, which are mostly zero, cost nothing."""
    return _pack(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :bytes_each].T))


def _numbers(raw: bytes, bytes_each: int) -> np.ndarray:
    planes = _unpack(raw, np.uint8).reshape(bytes_each, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :bytes_each] = planes.T
    return out.view("<u8").ravel()


def token_block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and kinds of ending of all tokens, ends included, and each text's number of tokens."""
    hashes, buckets, sizes = [], [], []
    for i, j in chunks(offsets):
        part, starts, ends, row = words(data, offsets, i, j)
        last = part[ends - 1].astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
        two = np.where(ends - starts > 1, part[np.maximum(ends - 2, 0)], 0).astype(np.uint64) if len(ends) else last
        n = np.bincount(row, minlength=j - i)
        at = np.cumsum(n)
        hashes.append(np.insert(word_hashes(part, starts, ends), at, END))
        buckets.append(np.insert((mix(last * np.uint64(256) + two + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.uint8), at, np.uint8(0)))
        sizes.append(n + 1)
    cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return cat(hashes, np.uint64), cat(buckets, np.uint8), cat(sizes, np.int64)


def list_blocks(df: DataFrame, id_col: str, text_col: str, held: int, folds: int, shares: int, block: int = BLOCK) -> DataFrame:
    """Rows of two kinds for each block: share -1 has the texts as places in the block's dictionary, by frequency, and these
    places' order by hash; the others have the dictionary's hashes of a share, their training counts and endings."""

    def out(no: int, ids: list, held_out: list, texts: list[pa.Array]) -> pa.RecordBatch:
        data, offsets = text_buffer(pa.chunked_array(texts).combine_chunks())
        h, bucket, sizes = token_block(data, offsets)
        names, first, at = np.unique(h, return_index=True, return_inverse=True)
        train = np.bincount(at, np.repeat(~np.array(held_out, bool), sizes), len(names)).astype(np.uint32)
        share = ((names >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)
        cuts = np.searchsorted(share, np.arange(shares + 1))
        order = np.argsort(-np.bincount(at, minlength=len(names)), kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        key = f"{TaskContext.get().partitionId():08d}-{no:08d}"
        rows = [(key, -1, ids, held_out, _pack(sizes.astype(np.uint32)), _planes(rank[at], 4), _planes(order, 4))]
        rows += [(key, k, None, None, _pack(names[a:z]), _pack(train[a:z]), _pack(bucket[first[a:z]])) for k, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
        kinds = (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["block", "share", "ids", "held", "a", "b", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, gone, texts, size, no = [], [], [], 0, 0
        for b in batches:
            _, offsets = text_buffer(b.column(2))
            for i, j in chunks(offsets, block):
                ids += b.column(0)[i:j].to_pylist()
                gone += b.column(1)[i:j].to_pylist()
                texts.append(b.column(2)[i:j].cast(pa.string()))
                size += int(offsets[j] - offsets[i])
                if size >= block:
                    yield out(no, ids, gone, texts)
                    ids, gone, texts, size, no = [], [], [], 0, no + 1
        if ids:
            yield out(no, ids, gone, texts)

    away = F.coalesce(fold(F.col(id_col), folds) == held, F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), away.alias("held"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "block string, share int, ids array<long>, held array<boolean>, a binary, b binary, c binary")


def count_words(lists: DataFrame, shares: int) -> DataFrame:
    """For each (block, share), all training counts of its words, in order; and a row for the share's totals, block null,
    with its most frequent words: four times as many as a share has on average of all that can have rows."""
    most = MOST_OWN + 4 * MOST_ROWS // shares

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        h = [_unpack(x, np.uint64) for x in pdf["a"]]
        n = [_unpack(x, np.uint32) for x in pdf["b"]]
        names, first, at = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        total = np.bincount(at, np.concatenate(n).astype(np.float64), len(names)).astype(np.int64)
        bucket = np.concatenate([_unpack(x, np.uint8) for x in pdf["c"]])[first]
        known = total > 0
        body = known & (names != END)
        sums = np.concatenate([np.bincount(bucket[body], total[body], ENDINGS), np.bincount(bucket[body], minlength=ENDINGS)]).astype(np.int64)
        top = np.flatnonzero(body)
        top = top[np.lexsort((names[top], -total[top]))][:most]
        end = total[names == END].sum()
        told = np.concatenate([[end], sums, total[top], bucket[top], names[top].view(np.int64)]).astype(np.int64)
        ends = np.cumsum([len(x) for x in h])[:-1]
        rows = [(b, s, _pack(c)) for b, s, c in zip(pdf["block"], pdf["share"], np.split(total[at], ends))]
        return pd.DataFrame([*rows, (None, int(pdf["share"].iloc[0]), told.tobytes())], columns=["block", "share", "d"])

    return lists.where("share >= 0").select("block", "share", "a", "b", "c").groupBy("share").applyInPandas(run, "block string, share int, d binary")


@dataclass
class Vocabulary:
    """Totals of the training tokens: of all, of classes, and the words with classes of their own.

    Classes: the end, words of their own, and the other words by their ending."""

    tokens: int
    distinct: int
    suffixes: int
    own: np.ndarray  # hashes, ascending
    own_class: np.ndarray
    frequent: np.ndarray  # hashes of the words with rows, ascending
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def kinds(self) -> int:
        return len(self.class_tokens)

    @property
    def shared(self) -> int:
        """The first class of more than one word."""
        return self.kinds - self.suffixes

    def classes(self, names: np.ndarray, ending: np.ndarray) -> np.ndarray:
        out = ending.astype(np.int64) * self.suffixes // ENDINGS + self.shared
        if len(self.own):
            k = np.minimum(np.searchsorted(self.own, names), len(self.own) - 1)
            out = np.where(self.own[k] == names, self.own_class[k], out)
        return np.where(names == END, 0, out)

    @property
    def rows(self) -> int:
        """Rows of a feature: of frequent words, of endings, and of the start of a text."""
        return len(self.frequent) + self.suffixes + 1

    def row(self, names: np.ndarray, ending: np.ndarray) -> np.ndarray:
        out = ending.astype(np.int64) * self.suffixes // ENDINGS + len(self.frequent)
        if len(self.frequent):
            k = np.minimum(np.searchsorted(self.frequent, names), len(self.frequent) - 1)
            out = np.where(self.frequent[k] == names, k, out)
        return out

    def inside(self, counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The add-half estimate of a word in its class."""
        return np.where(cls < self.shared, 1.0, (counts + 0.5) / (self.class_tokens[cls] + 0.5 * (self.class_words[cls] + 1)))


def vocabulary(told: list[bytes]) -> Vocabulary:
    ends, tokens, words_of, top = 0, np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64), []
    for raw in told:
        x = np.frombuffer(raw, np.int64)
        ends += int(x[0])
        tokens += x[1 : 1 + ENDINGS]
        words_of += x[1 + ENDINGS : 1 + 2 * ENDINGS]
        rest = x[1 + 2 * ENDINGS :].reshape(3, -1)
        top += [(-int(c), int(h), int(b)) for c, b, h in rest.T]
    n, v = int(tokens.sum()) + ends, int(words_of.sum()) + (ends > 0)
    suffixes = min(MOST_SUFFIXES, max(8, round(v**0.25)))
    top = sorted(top)
    frequent = np.sort(np.array([h for _, h, _ in top[: min(MOST_ROWS, round(ROOT_ROWS * n ** (1 / 3)))]], np.int64).view(np.uint64))
    top = top[: min(MOST_OWN, suffixes * 3 // 5)]
    class_tokens, class_words = np.zeros(1 + len(top) + suffixes), np.zeros(1 + len(top) + suffixes)
    class_tokens[0] = ends
    for i, (c, _, b) in enumerate(top):
        class_tokens[1 + i], class_words[1 + i] = -c, 1
        tokens[b] += c
        words_of[b] -= 1
    of = np.arange(ENDINGS) * suffixes // ENDINGS + 1 + len(top)
    np.add.at(class_tokens, of, tokens)
    np.add.at(class_words, of, words_of)
    own = np.array([h for _, h, _ in top], np.int64).view(np.uint64)
    order = np.argsort(own)
    return Vocabulary(n, v, suffixes, own[order], (order + 1).astype(np.int64), frequent, class_tokens, class_words)


def contexts(sizes: np.ndarray, places: np.ndarray, names: np.ndarray, ending: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The rows of each token's features: (tokens, ACTIVE)."""
    row = np.append(v.row(names, ending), v.rows - 1)
    at = np.arange(len(places)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.empty((len(places), ACTIVE), np.int32)
    for k in range(ACTIVE):
        back = np.full(len(places), len(names))
        back[k + 1 :] = places[: max(0, len(places) - k - 1)]
        back[at <= k] = len(names)
        out[:, k] = row[back] + k * v.rows
    return out


def bigrams(sizes: np.ndarray, places: np.ndarray, names: np.ndarray, cls: np.ndarray, v: Vocabulary, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct bigrams of a block with words of shared classes, by name of last word and class, and word: names, words'
    places, training counts; and the tokens with such words, and each one's bigram.

    places: of tokens, in names; cls: of names."""
    first = np.zeros(len(places), bool)
    first[np.cumsum(sizes) - sizes] = True
    use = np.flatnonzero(cls[places] >= v.shared)
    last = np.where(first[use], len(names), places[use - 1]).astype(np.int64)
    pairs, at = np.unique(last * len(names) + places[use], return_inverse=True)
    word = pairs % max(len(names), 1)
    before = np.append(names, _START)[pairs // max(len(names), 1)]
    with np.errstate(over="ignore"):
        name = mix(before * _SEED[3] + cls[word].astype(np.uint64) * _SEED[0]) >> np.uint64(64 - NAME)
    order = np.lexsort((names[word], name))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    seen = np.bincount(at, np.repeat(~held, sizes)[use], len(pairs)).astype(np.int64)
    return name[order], word[order], seen[order], use, back[at]


def class_bias(v: Vocabulary) -> np.ndarray:
    return np.log((v.class_tokens + 0.5) / (v.class_tokens + 0.5).sum()).astype(np.float32)


def chances(at: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Tokens by STEP: where they begin, and the classes' probabilities. at: (tokens, ACTIVE) rows."""
    for a in range(0, len(at), STEP):
        f = at[a : a + STEP]
        z = weights[f[:, 0]] + bias
        for k in range(1, ACTIVE):
            z += weights[f[:, k]]
        np.exp(z, out=z)  # a row's weights are at most what makes a class certain, so this stays in range
        z /= z.sum(1, keepdims=True)
        yield a, z


def expected(at: np.ndarray, bias: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
    """Adds to out how often each row and class are expected together."""
    at = at[np.argsort(at[:, 0], kind="stable")]
    for a, p in chances(at, bias, weights):
        for k in range(ACTIVE):
            here = at[a : a + STEP, k]
            if k:
                order = np.argsort(here, kind="stable")
                here, p = here[order], p[order]
            first = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            out[here[first]] += np.add.reduceat(p, first)


def _read(b: pa.RecordBatch) -> Iterator[tuple]:
    """Blocks of a batch: ids, held, sizes, places, names, buckets, counts."""
    for block in b.to_pylist():
        yield (
            block["ids"],
            np.array(block["held"], bool),
            _unpack(block["sizes"], np.uint32).astype(np.int64),
            _numbers(block["order"], 4)[_numbers(block["places"], 4)].astype(np.int64),
            _unpack(block["names"], np.uint64),
            _unpack(block["buckets"], np.uint8),
            _unpack(block["counts"], np.int64) if block["counts"] else None,
        )


def _rounded(x: np.ndarray) -> np.ndarray:
    """x in parts of a unit, which pack well."""
    return (np.round(x * 128) / 128).astype(np.float16)


def class_sums(blocks: DataFrame, v: Vocabulary, shares: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How often each row and class (rows, kinds) are seen together in training, or, with weights, are expected.

    Tasks add up their blocks and send the rows they have met by range; ranges are added, and come to the driver as a table of
    ACTIVE * (MOST_ROWS + MOST_SUFFIXES + 1) rows and 241 classes at most."""
    context, rows, wide, bias = blocks.sparkSession.sparkContext, ACTIVE * v.rows, -(-ACTIVE * v.rows // shares), class_bias(v)
    sent = context.broadcast(weights.astype(np.float16)) if weights is not None else None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((rows, v.kinds), np.float32)
        table = sent.value.astype(np.float32) if sent is not None else None
        for batch in batches:
            for _, held, sizes, places, names, ending, _ in _read(batch):
                use = np.repeat(~held, sizes)
                at = contexts(sizes, places, names, ending, v)[use]
                if table is not None:
                    expected(at, bias, table, out)
                    continue
                cls = v.classes(names, ending)[places][use]
                for k in range(ACTIVE):
                    pairs, n = np.unique(at[:, k] * np.int64(v.kinds) + cls, return_counts=True)
                    out.ravel()[pairs] += n
        if table is not None:
            out[table == 0] = 0  # no weight is there to move
        met = np.flatnonzero(out.any(1))
        cuts = np.searchsorted(met, np.arange(shares + 1) * wide)
        for k, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if z > a:
                cols = [TaskContext.get().partitionId()], [k], [_pack(met[a:z].astype(np.int32))], [_pack(_rounded(np.sqrt(out[met[a:z]])))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["task", "share", "rows", "sums"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")
        first = int(pdf["share"].iloc[0]) * wide
        out = np.zeros((wide, v.kinds))
        for at, x in zip(pdf["rows"], pdf["sums"]):
            out[_unpack(at, np.int32) - first] += _unpack(x, np.float16).reshape(-1, v.kinds).astype(np.float64) ** 2
        return pd.DataFrame({"first": [first], "sums": [_pack(_rounded(np.sqrt(out)))]})

    # Tasks read the blocks' file ranges, which are the same each time, so sums are added in the same order.
    slim = blocks.withColumns({"ids": F.lit(None).cast("array<bigint>"), "counts": F.lit(None).cast("binary")})
    made = slim.mapInArrow(add, "task int, share int, rows binary, sums binary").groupBy("share").applyInPandas(total, "first int, sums binary")
    table = _keep(made, "sums")
    told = table.collect()
    _forget(table)
    out = np.zeros((wide * shares, v.kinds))
    for r in told:
        out[r["first"] : r["first"] + wide] = _unpack(r["sums"], np.float16).reshape(-1, v.kinds).astype(np.float64) ** 2
    if sent is not None:
        sent.unpersist()
    return out[:rows]


def word_lists(blocks: DataFrame, v: Vocabulary, shares: int) -> DataFrame:
    """For each block and share: names of last word and class, how many words follow each, the class, and for each of
    these words 32 bits of its hash, its training count, and the bigram's in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, (_, held, sizes, places, names, buckets, counts) in zip(batch.column(0).to_pylist(), _read(batch)):
                cls = v.classes(names, buckets)
                name, word, seen, _, _ = bigrams(sizes, places, names, cls, v, held)
                first = np.flatnonzero(np.append(True, name[1:] != name[:-1])[: len(name)])
                share = ((name[first] >> np.uint64(NAME - 32)) * np.uint64(shares)) >> np.uint64(32)
                cuts = np.searchsorted(share, np.arange(shares + 1))
                starts = np.append(first, len(name))
                for k, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                    if z > a:
                        i, j = int(starts[a]), int(starts[z])
                        cols = [
                            _planes(np.diff(name[first[a:z]], prepend=np.uint64(0)), 6), _planes(np.diff(starts[a : z + 1]), 4), _pack(cls[word[first[a:z]]].astype(np.uint8)),
                            _pack((names[word[i:j]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)), _planes(counts[word[i:j]], 5), _planes(seen[i:j], 4),
                        ]
                        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in cols)], ["block", "share", "f", "n", "c", "word", "count", "seen"])

    return blocks.mapInArrow(run, "block string, share int, f binary, n binary, c binary, word binary, count binary, seen binary")


def word_weights(lists: DataFrame, v: Vocabulary) -> DataFrame:
    """For each block and share, -PARTS * log10 P(word | class, last word) of the block's bigrams."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        name = [np.cumsum(_numbers(x, 6), dtype=np.uint64) for x in pdf["f"]]
        n = [_numbers(x, 4).astype(np.int64) for x in pdf["n"]]
        _, at = np.unique(np.concatenate(name), return_inverse=True)
        many = np.concatenate(n)
        last = np.repeat(at, many)
        word = np.concatenate([_unpack(x, np.uint32) for x in pdf["word"]])
        pairs, first, where = np.unique(last.astype(np.uint64) << np.uint64(32) | word, return_index=True, return_inverse=True)
        seen = np.bincount(where, np.concatenate([_numbers(x, 4) for x in pdf["seen"]]), len(pairs))
        mine = last[first]
        total, different = np.bincount(mine, seen), np.bincount(mine, seen > 0)
        cls = np.repeat(np.concatenate([_unpack(x, np.uint8) for x in pdf["c"]]), many)[first].astype(np.int64)
        q = v.inside(np.concatenate([_numbers(x, 5) for x in pdf["count"]])[first], cls)
        d = different[mine]
        weight = np.log1p(np.divide(seen, d * q, out=np.zeros(len(q)), where=d > 0))  # 0 for words that don't follow in training
        log = weight + np.log(q) + np.log(np.where(d > 0, d / np.maximum(total[mine] + d, 1), 1.0))  # less the logarithm of the softmax's sum
        told = np.minimum(np.round(-PARTS / np.log(10) * log), 65535).astype(np.uint16)[where]
        ends = np.cumsum([x.sum() for x in n])[:-1]
        rows = [(b, s, _planes(x, 2)) for b, s, x in zip(pdf["block"], pdf["share"], np.split(told, ends))]
        return pd.DataFrame(rows, columns=["block", "share", "w"])

    return lists.groupBy("share").applyInPandas(run, "block string, share int, w binary")


def join_words(blocks: DataFrame, inside: DataFrame) -> DataFrame:
    """Each block after the rows of its bigrams, by share."""
    both = inside.withColumn("kind", F.lit(0)).unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "kind", "share")


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks with what is told of their bigrams, from what join_words gives."""
    inside = []
    for b in batches:
        for r in range(b.num_rows):
            one = b.slice(r, 1)
            if one.column("kind")[0].as_py() == 0:
                inside.append(_numbers(one.column("w")[0].as_py(), 2).astype(np.uint16))
            else:
                yield next(_read(one)), inside
                inside = []


def join_counts(lists: DataFrame, counted: DataFrame) -> DataFrame:
    """A row for each block: its texts, dictionary, and counts."""
    told = counted.where("block IS NOT NULL").select("block", "share", F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("array<boolean>").alias("held"), F.col("d").alias("a"), F.lit(None).cast("binary").alias("b"), F.lit(None).cast("binary").alias("c"), F.lit(1).alias("kind"))
    both = lists.withColumn("kind", F.when(F.col("share") < 0, 2).otherwise(0)).unionByName(told)
    both = both.repartition("block").sortWithinPartitions("block", "kind", "share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, buckets, counts = [], [], []
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == 0:
                    names.append(_unpack(r["a"], np.uint64))
                    buckets.append(_unpack(r["c"], np.uint8))
                elif r["kind"] == 1:
                    counts.append(_unpack(r["a"], np.int64))
                else:
                    cols = [[r["block"]], [r["ids"]], [r["held"]], [r["a"]], [r["b"]], [r["c"]], *([_pack(np.concatenate(x))] for x in (names, buckets, counts))]
                    kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 6)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["block", "ids", "held", "sizes", "places", "order", "names", "buckets", "counts"])
                    names, buckets, counts = [], [], []

    return both.mapInArrow(run, "block string, ids array<long>, held array<boolean>, sizes binary, places binary, order binary, names binary, buckets binary, counts binary")


def _keep(df: DataFrame, tag: str) -> DataFrame:
    """materialize, and the shuffles of df are removed once it is written."""
    conf, clear = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(clear)
    conf.set(clear, "true")
    try:
        return materialize(df, tag)
    finally:
        conf.set(clear, before)


def _forget(*tables: DataFrame) -> None:
    """Removes tables that nothing reads any more."""
    for df in tables:
        for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            _remove(df.sparkSession, path)


def train(blocks: DataFrame, v: Vocabulary, shares: int, rounds: int = 1, rate: float = 0.5) -> np.ndarray:
    """The class weights. Each round goes through all blocks."""
    bias = class_bias(v).astype(np.float64)
    seen = class_sums(blocks, v, shares)
    known, p = seen > 0, np.exp(bias)
    # At first an equal part of what each feature would say alone.
    weights = np.where(known, np.log((seen + PRIOR * p) / ((seen.sum(1, keepdims=True) + PRIOR) * p)) / ACTIVE, 0.0)
    for k in range(rounds):
        hoped = class_sums(blocks, v, shares, weights)
        weights = np.where(known, weights + rate / (1 + k) * np.log((seen + 1) / (hoped + 1)), 0.0)
    return weights.astype(np.float16)


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = 1, folds: int = 5, rounds: int = 1) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shares = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // SHARE_BYTES)
    lists = _keep(list_blocks(df, id_col, text_col, held, folds, shares), "lists")
    counted = _keep(count_words(lists, shares), "counts")
    v = vocabulary([bytes(r["d"]) for r in counted.where("block IS NULL").select("d").collect()])  # a row a share, of a bounded size together
    blocks = _keep(join_counts(lists, counted), "blocks")
    _forget(lists, counted)
    weights, bias = df.sparkSession.sparkContext.broadcast(train(blocks, v, shares, rounds)), class_bias(v)
    inside = _keep(word_weights(word_lists(blocks, v, shares), v), "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value.astype(np.float32)
        for (ids, gone, sizes, places, names, buckets, counts), told in _with_words(batches):
            cls = v.classes(names, buckets)
            model = np.zeros(len(places))
            _, _, _, use, pair = bigrams(sizes, places, names, cls, v, gone)
            if len(use):
                model[use] = np.concatenate(told)[pair] / -PARTS
            base = np.log10((counts + 0.5) / (v.tokens + 0.5 * (v.distinct + 1)))[places]
            c = cls[places]
            for a, p in chances(contexts(sizes, places, names, buckets, v), bias, table):
                model[a : a + STEP] += np.log10(np.maximum(p[np.arange(len(p)), c[a : a + STEP]], 1e-30))
            at = np.cumsum(sizes) - sizes
            total = lambda x: pa.array(np.add.reduceat(x, at))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(gone),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((counts > 0)[places].astype(np.int64), at)),
                    pa.array(np.full(len(ids), v.tokens, np.int64)),
                    total(base),
                    total(model),
                ],
                [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return join_words(blocks, inside).mapInArrow(run, f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
