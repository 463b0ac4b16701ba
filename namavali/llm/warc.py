"""WARC archives of pages with a two-level capture index.

Each task writes its pages as gzip members of one archive in the shared folder; a payload that another page has too is
written once, by the page with the largest id, and the others are revisit records. The index sorts captures by
reversed-host URL key into compressed blocks; a part's footer is a sparse directory of its blocks, and the list of parts
has a first key each. A lookup bisects parts, then blocks, reads one block, bisects its lines and reads the record's
range. Archives whose task failed are in no index, so retries leave no trace. Reading back looks up every capture's key:
sorted, so that a task's lookups go from block to block, and what they find is read in the archives' order.

Defined results: a null html is an empty payload, a null url is written as about:blank, a null id comes back null.
Repeated rows are written and read back as often as they come; of equal payloads all rows with the largest id are
responses. An empty table gives an empty table. Only id, url and html are read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch

#: Lines of an index block; bytes of archives that one task reads back, about; most bytes of neighbouring records that are
#: read at once.
BLOCK_LINES, TASK_BYTES, READ_BYTES = 2000, 32 << 20, 4 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> str:
    """The host's labels reversed, then port, path and query: com,example)/a?b."""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return quote(url, safe="")
    host = re.sub(r"^www\d*\.", "", host)
    rest = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return quote(",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + rest.lower(), safe=",:)/?&=;%~+!*'(@$")


def capture_key(uri: str, page_id: int | None) -> str:
    """uri: as a record has it."""
    return f"{url_key(uri)} {'-' if page_id is None else page_id}"


def sha1_32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'-' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    tail = urn.strip("<>").rpartition(":")[2]
    return None if tail == "-" else int(tail)


def _uri(url: str | None) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "about:blank"


def record(page_id: int | None, url: str | None, payload: bytes, refers: tuple[int | None, str | None] | None) -> bytes:
    """One gzip member. refers: id and url of the response that has the payload, for a revisit."""
    digest = sha1_32(payload)
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if refers else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(refers[0])}", f"WARC-Refers-To-Target-URI: {_uri(refers[1])}", f"WARC-Refers-To-Date: {DATE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def unpack(member: bytes) -> bytes:
    """A gzip member, decompressed."""
    return zlib.decompress(member, 31)


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/+", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.LocalFileSystem() if path.startswith("/") else pafs.FileSystem.from_uri(path)[0], path if path.startswith("/") else pafs.FileSystem.from_uri(path)[1]


def _range(files: dict, path: str, offset: int, length: int) -> bytes:
    if path not in files:
        if len(files) > 64:
            files.pop(next(iter(files))).close()
        system, at = _fs(path)
        files[path] = system.open_input_file(at)
    return files[path].read_at(length, offset)


def equal_payloads(pages: DataFrame, at_least: int) -> DataFrame:
    """Payloads that several pages have: (digest, keeper's id and url)."""
    size = F.octet_length("html")
    one = pages.where(size >= at_least).select(F.sha2(F.col("html").cast("binary"), 256).alias("digest"), "id", "url")
    groups = one.groupBy("digest").agg(F.max(F.struct("id", "url")).alias("keeper"), F.count("*").alias("n")).where("n > 1")
    return groups.select("digest", F.col("keeper.id").alias("keep_id"), F.col("keeper.url").alias("keep_url"))


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", at_least: int = 0) -> DataFrame:
    """Archives in folder, and the table of captures: key, page_id, file, offset, length, kind."""
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    shared = materialize(equal_payloads(pages, at_least), "payloads")  # Spark broadcasts it if its size is below the threshold
    told = pages.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).join(shared, "digest", "left")
    again = F.col("keep_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep_id"))
    told = told.select("id", "url", F.col("html").cast("binary").alias("html"), again.alias("again"), "keep_id", "keep_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _fs(folder)
        system.create_dir(root, recursive=True)
        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for b in batches:
            rows = []
            for i, url, html, again, keep, keep_url in zip(*(b.column(k).to_pylist() for k in range(6))):
                if out is None:
                    out = system.open_output_stream(_fs(name)[1], compression=None)
                raw = record(i, url, html, (keep, keep_url) if again else None)
                out.write(raw)
                rows.append((capture_key(_uri(url), i), i, name, at, len(raw), "revisit" if again else "response"))
                at += len(raw)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], ["key", "page_id", "file", "offset", "length", "kind"])
        if out is not None:
            out.close()

    return materialize(told.mapInArrow(run, "key string, page_id long, file string, offset long, length long, kind string"), "captures")


def build_index(captures: DataFrame, folder: str, parts: int | None = None, lines: int = BLOCK_LINES) -> list[tuple[str, str, int, int]]:
    """Index parts in folder; the list of parts by first key: (first key, file, directory's offset, its length)."""
    n = parts or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _fs(folder)
        name = f"{folder}/{uuid.uuid4().hex}.idx"
        out, at, held, directory = None, 0, [], []

        def flush() -> None:
            nonlocal at, held
            block = zlib.compress("\n".join(held).encode(), 6)
            out.write(block)
            directory.append((held[0].split("\t", 1)[0], at, len(block)))
            at, held = at + len(block), []

        for b in batches:
            for key, file, offset, length in zip(*(b.column(k).to_pylist() for k in range(4))):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(_fs(name)[1], compression=None)
                held.append(f"{key}\t{file}\t{offset}\t{length}")
                if len(held) >= lines:
                    flush()
        if out is not None:
            if held:
                flush()
            raw = zlib.compress(json.dumps(directory).encode())
            out.write(raw)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name]), pa.array([at]), pa.array([len(raw)])], ["key", "file", "offset", "length"])

    ranged = captures.select("key", "file", "offset", "length").repartitionByRange(n, "key").sortWithinPartitions("key")
    made = materialize(ranged.mapInArrow(run, "key string, file string, offset long, length long"), "parts")
    return sorted((r["key"], r["file"], r["offset"], r["length"]) for r in made.collect())  # one short row a part


class Index:
    """Lookups by capture key, with a few directories and blocks kept."""

    def __init__(self, parts: list[tuple[str, str, int, int]], keep: int = 64):
        self.parts, self.first, self.keep = parts, [p[0] for p in parts], keep
        self.files: dict = {}
        self.kept: OrderedDict = OrderedDict()

    def _get(self, file: str, offset: int, length: int, read):
        if (file, offset) not in self.kept:
            if len(self.kept) >= self.keep:
                self.kept.popitem(last=False)
            self.kept[file, offset] = read(zlib.decompress(_range(self.files, file, offset, length)))
        self.kept.move_to_end((file, offset))
        return self.kept[file, offset]

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """(archive, offset, length) of each capture of that key."""
        out = []
        k = max(bisect.bisect_right(self.first, key) - 1, 0)
        for _, file, offset, length in self.parts[k : k + 1]:
            keys, blocks = self._get(file, offset, length, lambda raw: (lambda d: ([x[0] for x in d], d))(json.loads(raw)))
            for j in range(max(bisect.bisect_left(keys, key) - 1, 0), len(blocks)):  # lines of one key can go on in the next blocks
                if keys[j] > key:
                    break
                names, rows = self._get(file, blocks[j][1], blocks[j][2], lambda raw: (lambda v: ([x.split("\t", 1)[0] for x in v], v))(raw.decode().split("\n")))
                for row in rows[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]:
                    _, at, start, size = row.split("\t")
                    out.append((at, int(start), int(size)))
        return out

    def read(self, key: str) -> tuple[dict[str, str], bytes] | None:
        """Headers and payload of a capture."""
        found = self.find(key)
        return parse(unpack(_range(self.files, *found[0]))) if found else None


def look_up(keys: DataFrame, parts: list[tuple[str, str, int, int]], tasks: int) -> DataFrame:
    """(file, offset, length) of all captures of the distinct keys, through the index; a key without one ends the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(parts)
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                found = index.find(key)
                if not found:
                    raise ValueError(f"no capture {key}")
                rows += found
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 3, (pa.string(), pa.int64(), pa.int64()))], ["file", "offset", "length"])

    return keys.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "file string, offset long, length long")


def neighbours(rows: list[tuple[str, int, int]], most: int = READ_BYTES) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of records that follow each other in a file, of up to `most` bytes together, one record at least."""
    run: list[tuple[str, int, int]] = []
    for r in rows:
        if run and (r[0] != run[-1][0] or r[1] != run[-1][1] + run[-1][2] or r[1] + r[2] - run[0][1] > most):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def read_archives(keys: DataFrame, parts: list[tuple[str, str, int, int]], tasks: int) -> DataFrame:
    """The records of the distinct capture keys: page_id, payload_bytes, payload_digest, record_type, refers_to.

    All are found through the index, a revisit's payload as well. Payloads are hashed again, and a digest that differs
    from its header's ends the query.
    """
    found = materialize(look_up(keys, parts, tasks), "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen = Index(parts), OrderedDict()

        def of(raw: bytes) -> tuple:
            headers, payload = parse(raw)
            said, kind = headers["WARC-Payload-Digest"].partition(":")[2], headers["WARC-Type"]
            refers = _id(headers["WARC-Refers-To"]) if kind == "revisit" else None
            if kind == "revisit":
                key = capture_key(headers["WARC-Refers-To-Target-URI"], refers)
                if key not in seen:
                    target = index.read(key)
                    if target is None:
                        raise ValueError(f"no capture {key}")
                    seen[key] = (len(target[1]), sha1_32(target[1]))
                    if len(seen) > 10_000:
                        seen.popitem(last=False)
                size, digest = seen[key]
            else:
                size, digest = len(payload), sha1_32(payload)
            if digest != said:
                raise ValueError(f"{headers['WARC-Record-ID']}: digest {digest} where {said} is said")
            return _id(headers["WARC-Record-ID"]), size, digest, kind, refers

        for b in batches:
            rows = []
            for near in neighbours(list(zip(*(b.column(k).to_pylist() for k in range(3))))):
                first = near[0][1]
                data = memoryview(_range(index.files, near[0][0], first, near[-1][1] + near[-1][2] - first))
                rows += [of(unpack(data[a - first : a - first + n])) for _, a, n in near]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # By place, not by hash: each task has a run of an archive, and tasks have alike many records.
    placed = found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(df: DataFrame, at_least: int = 0) -> DataFrame:
    """Pages written to archives, indexed, and read back."""
    folder = scratch(df.sparkSession, "warc")
    captures = write_archives(df, folder, at_least=at_least)
    size = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1)
    return read_archives(captures.select("key").distinct(), build_index(captures, folder, tasks), tasks)
