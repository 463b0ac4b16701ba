"""Secret scans: pattern kinds, and a token-efficiency test that exposes random strings.

A string that a tokenizer's vocabulary has not met splits into many short tokens. All runs of `RUN` characters are
encoded, whatever they are made of, and those with at most `ratio` characters a token (a share of it for short runs, see
`SHARES`) are reported as kind `random`, unless they are known digests (hexadecimal of a digest's length), UUIDs, numbers
or dates, or overlap a span already found. Runs of fewer than 12 characters are not tested.

Defined results: a null or empty text has no spans; every row is judged by itself, so repeated rows repeat; an empty
table gives an empty table; only the id and the text are read. Whole texts are scanned, however long.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: The kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so a least length in the pattern finds the same ones
#: What the token test looks at.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: Least length of a run and the share of `ratio` that holds from there: rare words come close to it in short runs.
SHARES = ((20, 1.0), (16, 0.95), (12, 0.85))
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
#: Hexadecimal digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512, and half an MD5.
DIGEST_SIZES = frozenset((16, 32, 40, 56, 64, 96, 128))
PLAIN = re.compile(r"[0-9_/=+-]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the three pattern kinds."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def is_known(run: str) -> bool:
    """Digests, UUIDs and plain numbers or dates: not secrets."""
    return bool((DIGEST.fullmatch(run) and len(run) in DIGEST_SIZES) or UUID.fullmatch(run) or PLAIN.fullmatch(run))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """A tiktoken encoding from a file of ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def random_spans(text: str, found: list[tuple[int, int, int]], count: Callable[[str], int], ratio: float) -> list[tuple[int, int, int]]:
    out = []
    for m in RUN.finditer(text):
        run = m.group()
        if is_known(run) or any(a < m.end() and m.start() < b for a, _, b in found):
            continue
        share = next(x for n, x in SHARES if len(run) >= n)
        if len(run) <= share * ratio * count(run):
            out.append((m.start(), 3, m.end()))
    return out


def scan(text: str | None, count: Callable[[str], int], ratio: float) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    found = base_spans(text)
    return sorted(found + random_spans(text, found, count, ratio))


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ratio: float = 2.0) -> DataFrame:
    """Per row: id, spans as an array of (kind, start, end) in code points, and the counts by kind.

    vocabulary: the path of a tiktoken file of ranks, on every machine; pattern: its pre-tokens' pattern.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        count = lambda s: len(enc.encode_ordinary(s))
        for b in batches:
            rows = [scan(t, count, ratio) for t in b.column(1).to_pylist()]
            base = [[s for s in r if s[1] < 3] for r in rows]
            n = lambda k: pa.array([sum(s[1] == k for s in r) for r in rows], pa.int64())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    n(0),
                    n(1),
                    n(2),
                    n(3),
                    pa.array([hashlib.sha256(told(r).encode()).hexdigest() for r in base], pa.string()),
                    pa.array([told(r) for r in rows], pa.string()),
                ],
                [id_col, "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def mask_secrets(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of df with each secret's span replaced; null texts stay null. One narrow pass, no shuffle."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        count = lambda s: len(enc.encode_ordinary(s))
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, t in enumerate(texts):
                if spans := scan(t, count, ratio):
                    parts, end = [], 0
                    for a, _, z in spans:
                        if a >= end:
                            parts += [t[end:a], mark]
                        end = max(end, z)
                    texts[i] = "".join(parts) + t[end:]
            columns = b.columns
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return df.mapInArrow(tidy(run), df.schema)
