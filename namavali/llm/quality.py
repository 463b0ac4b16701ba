"""Quality classifier: a generalised additive model with pairwise interactions.

Features of whole texts are binned; cyclic boosting fits one shallow tree on one feature after the other, and the trees
of a feature add up to its lookup table. Then the pairs whose two-way table lowers the loss most get tables of their
own. A score is the sum of a document's table entries: a few vectorised additions.

The model is fitted on at most `TRAIN_ROWS` labelled rows, those with the lowest hashes of their ids; features and
scores cover all rows. Defined results: a null text counts as empty and gets a score like any other; rows repeat as
they come; with no labels every score is 0.5; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, materialize, mix, text_buffer, word_hashes, words

TRAIN_ROWS = 20_000
FEATURES = (
    "log_words word_bytes word_bytes_sd symbols_per_word marks_per_word capitals digits stops_per_word other_bytes lines_per_word "
    "distinct_words repeated_pairs top_word bars_per_word bare_words short_words"
).split()


def _class(chars: bytes | range) -> np.ndarray:
    out = np.zeros(256, np.float32)
    out[list(chars)] = 1
    return out


_SYMBOL, _MARK, _CAPITAL, _DIGIT = _class(b"#*$%&<>~^@{}[]_\\=+"), _class(b"!?"), _class(range(65, 91)), _class(range(48, 58))
_STOP, _OTHER, _LINE, _BAR = _class(b".,;:"), _class(range(128, 256)), _class(b"\n"), _class(b"|")
_LETTER = _class(range(97, 123)) + _OTHER


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, offsets = text_buffer(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)), np.float32)
    for i, j in chunks(offsets):
        n_rows = j - i
        raw = data[offsets[i] : offsets[j]]
        bounds = (offsets[i : j + 1] - offsets[i]).astype(np.int64)
        part, starts, ends, row = words(data, offsets, i, j)
        n = np.bincount(row, minlength=n_rows).astype(np.float64)
        one = np.maximum(n, 1)
        size = (ends - starts).astype(np.float64)
        mean = np.bincount(row, size, n_rows) / one
        sd = np.sqrt(np.maximum(np.bincount(row, size**2, n_rows) / one - mean**2, 0))
        total = lambda table: np.diff(np.concatenate([[0.0], np.cumsum(table[raw], dtype=np.float64)])[bounds])  # noqa: B023, E731
        length = np.maximum(np.diff(bounds), 1)
        h = word_hashes(part, starts, ends)
        order = np.lexsort((h, row))
        hs, rs = h[order], row[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
        distinct = np.bincount(rs[new], minlength=n_rows)
        at = np.flatnonzero(new)
        runs = np.diff(np.append(at, len(hs)))
        top = np.zeros(n_rows)
        np.maximum.at(top, rs[at], runs)
        pair, prow = mix(h[:-1] * np.uint64(3) + h[1:]), row[1:]
        inside = row[:-1] == row[1:]
        pair, prow = pair[inside], prow[inside]
        order = np.lexsort((pair, prow))
        ps, pr = pair[order], prow[order]
        new = np.ones(len(ps), bool)
        new[1:] = (ps[1:] != ps[:-1]) | (pr[1:] != pr[:-1])
        pairs = np.bincount(pr[new], minlength=n_rows)
        bare = np.zeros(len(starts), bool)
        if len(starts):
            bare = np.add.reduceat(np.append(_LETTER[part], 0), np.stack([starts, ends], 1).ravel())[::2] == 0
        out[i:j] = np.stack(
            [
                np.log1p(n),
                mean,
                sd,
                total(_SYMBOL) / one,
                total(_MARK) / one,
                total(_CAPITAL) / length,
                total(_DIGIT) / length,
                total(_STOP) / one,
                total(_OTHER) / length,
                total(_LINE) / one,
                distinct / one,
                1 - pairs / np.maximum(n - 1, 1),
                top / one,
                total(_BAR) / one,
                np.bincount(row, bare, n_rows) / one,
                np.bincount(row, size <= 3, n_rows) / one,
            ],
            axis=1,
        )
    return out


@dataclass
class Gam:
    """Cut points and tables by feature, and tables of pairs."""

    cuts: list[np.ndarray]
    bias: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], 1) if len(self.cuts) else np.zeros((len(x), 0), int)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        z = np.full(len(bins), self.bias)
        for k, t in enumerate(self.tables):
            z += t[bins[:, k]]
        for a, b, t in self.pairs:
            z += t[bins[:, a], bins[:, b]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(self.bins(x))))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree of up to `leaves` leaves over ordered bins, from sums of gradients and curvatures: its value in each bin."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                m = np.arange(a + 1, b)
                v = gain(a, m) + gain(m, b) - gain(a, b)
                if v.max() > best[0]:
                    best = (v.max(), (a, b), int(m[v.argmax()]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best two-level tree over two features, one cut each: its gain and values."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    top = lambda c, a, b: (c[a, b], c[a, -1] - c[a, b], c[-1, b] - c[a, b], c[-1, -1] - c[a, -1] - c[-1, b] + c[a, b])
    a, b = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    value = sum(x**2 / (y + ridge) for x, y in zip(top(cg, a, b), top(ch, a, b)))
    k = np.unravel_index(int(value.argmax()), value.shape)
    i, j = int(a[k]), int(b[k])
    leaf = [x / (y + ridge) for x, y in zip(top(cg, i, j), top(ch, i, j))]
    out = np.empty(g.shape)
    out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = leaf
    return float(value.max()), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, leaves: int = 3, rate: float = 0.15, pairs: int = 6, ridge: float = 2.0) -> Gam:
    """Cyclic boosting on the logistic loss; with fewer than two classes, a constant."""
    if not len(y):
        return Gam([], 0.0)
    p = (y.sum() + 1) / (len(y) + 2)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    m = Gam(cuts, float(np.log(p / (1 - p))), [np.zeros(len(c) + 1) for c in cuts])
    if y.min() == y.max():
        return m
    b = m.bins(x)
    z = m.raw(b)
    for _ in range(rounds):
        for k, t in enumerate(m.tables):
            if len(t) < 2:
                continue
            q = 1 / (1 + np.exp(-z))
            step = rate * _tree(np.bincount(b[:, k], y - q, len(t)), np.bincount(b[:, k], q * (1 - q), len(t)), leaves, ridge)
            t += step
            z += step[b[:, k]]

    def sums(i: int, j: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(m.tables[i]), len(m.tables[j]))
        at = b[:, i] * shape[1] + b[:, j]
        return tuple(np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (y - q, q * (1 - q)))

    q = 1 / (1 + np.exp(-z))
    wide = [k for k, t in enumerate(m.tables) if len(t) > 1]
    ranked = sorted(((_quadrants(*sums(i, j, q), ridge)[0], i, j) for n, i in enumerate(wide) for j in wide[n + 1 :]), reverse=True)
    m.pairs = [(i, j, np.zeros((len(m.tables[i]), len(m.tables[j])))) for _, i, j in ranked[:pairs]]
    for _ in range(rounds // 4):
        for i, j, t in m.pairs:
            q = 1 / (1 + np.exp(-z))
            step = rate * _quadrants(*sums(i, j, q), ridge)[1]
            t += step
            z += step[b[:, i], b[:, j]]
    return m


def feature_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and x, the array of FEATURES. One narrow pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat], ["id", "x"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<float>")


def score_quality(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held: int = 0, folds: int = 5, threshold: float = 0.3, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """Per row: id, held_out, score, predicted. Labels of the fold `held` are never learned from."""
    x = materialize(feature_table(df, id_col, text_col), "features")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)").where(fold(F.col("id"), folds) != held)
    sample = known.join(x, "id").orderBy(F.xxhash64("id"), "id").limit(train_rows).select("x", "y").toPandas()
    model = fit(np.stack(sample["x"].to_numpy()).astype(np.float32), sample["y"].to_numpy(float)) if len(sample) else fit(np.zeros((0, 1)), np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(1).flatten().to_numpy().reshape(len(b), -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(rows))], ["id", "score"])

    scored = x.mapInArrow(run, f"id {x.schema['id'].dataType.simpleString()}, score double")
    held_out = F.coalesce(fold(F.col("id"), folds) == held, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
