"""Page text from a folder of PDF files, with a pluggable text layer and recognition; and lists of names.

No PDF or recognition library is needed to import this. A reader is an object with `texts(content, start, end)`, giving
(page, text) of the pages there are between start and end, from 1, in one pass over the opened file; a recogniser is a
function of (content, page). Both are shipped to executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions.text import file_name, file_stem
from ..operators.extract import needs_ocr
from .tables import materialize

PAGE_SCHEMA = "pdf_file string, page_num int, text string, text_source string"


class TextReader(Protocol):
    def texts(self, content: bytes, start: int, end: int) -> Iterator[tuple[int, str | None]]: ...


class PdfplumberReader:
    """The text layer by pdfplumber, where that is installed. A file is opened once for all its pages."""

    def texts(self, content: bytes, start: int, end: int) -> Iterator[tuple[int, str | None]]:
        import io

        import pdfplumber

        with pdfplumber.open(io.BytesIO(content)) as pdf:
            for k in range(start, min(end, len(pdf.pages)) + 1):
                yield k, pdf.pages[k - 1].extract_text()


class FormFeedReader:
    """UTF-8 text whose pages are separated by form feeds; anything else is a broken file."""

    def texts(self, content: bytes, start: int, end: int) -> Iterator[tuple[int, str | None]]:
        yield from ((k, t) for k, t in enumerate(content.decode().split("\f"), 1) if start <= k <= end)


def tesseract(content: bytes, page: int, languages: str = "mar+eng", resolution: int = 300) -> str:
    """Recognition by tesseract, where it, its binding and pdfplumber are installed."""
    import io

    import pdfplumber
    import pytesseract

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return pytesseract.image_to_string(pdf.pages[page - 1].to_image(resolution=resolution).original, lang=languages)


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """The *.pdf files of one folder, not of those below it: path, pdf_file (stem), length, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", file_stem(F.col("path")).alias("pdf_file"), "length", "content")


def read_pages(spark: SparkSession, folder: str, reader: TextReader, start: int = 3, end: int = 32, ocr: Callable[[bytes, int], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, status) of the *.pdf files of a folder, see `open_files`."""
    return open_files(pdf_files(spark, folder), reader, start, end, ocr)


def open_files(files: DataFrame, reader: TextReader, start: int = 3, end: int = 32, ocr: Callable[[bytes, int], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, status): pages start to end of each file, and per file its status, number of pages read and error.

    files: path, pdf_file, content. A file that cannot be read is `failed` and keeps no other from being read. What was
    read is written at once, so that each file is opened once, for its pages and its status. Pages that are to be
    recognised go to their file's content as one list a file; the content is not repeated for each page.
    """

    def open_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, name, content in zip(*(b.column(k).to_pylist() for k in range(3))):
                try:
                    rows = [(path, name, k, text, None) for k, text in reader.texts(content, start, end)]
                    rows.append((path, name, None, None, None))
                except Exception as e:  # of one file: told in its status
                    rows = [(path, name, None, None, f"{type(e).__name__}: {e}")]
                kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "pdf_file", "page_num", "text", "error"])

    read = files.select("path", "pdf_file", "content").mapInArrow(open_all, "path string, pdf_file string, page_num int, text string, error string")
    read = materialize(read, "read")
    status = read.groupBy("pdf_file").agg(F.count("page_num").cast("int").alias("n_pages"), F.max("error").alias("error"))
    status = status.select("pdf_file", F.when(F.col("error").isNull(), "completed").otherwise("failed").alias("status"), "n_pages", "error")
    pages = read.where("page_num IS NOT NULL")
    if ocr is None:
        return pages.select("pdf_file", "page_num", "text", F.lit("layer").alias("text_source")), status

    def recognise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, wanted, content in zip(*(b.column(k).to_pylist() for k in range(3))):
                rows = [(name, k, *recognised(ocr, content, k)) for k in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.string()))], ["pdf_file", "page_num", "text", "text_source"])

    layer = pages.where(~needs_ocr("text")).select("pdf_file", "page_num", "text", F.lit("layer").alias("text_source"))
    wanted = pages.where(needs_ocr("text")).groupBy("path").agg(F.sort_array(F.collect_list("page_num")).alias("wanted"))  # of one file, end - start + 1 at most
    again = files.select("path", "pdf_file", "content").join(wanted, "path").select("pdf_file", "wanted", "content")
    return layer.unionByName(again.mapInArrow(recognise, PAGE_SCHEMA)), status


def recognised(ocr: Callable[[bytes, int], str], content: bytes, page: int) -> tuple[str | None, str]:
    """(text, source) of a page; a page that cannot be recognised has no text, and the reason as its source."""
    try:
        return ocr(content, page), "ocr"
    except Exception as e:  # of one page
        return None, f"OCR failed: {e}"


class PdfPagesSource(DataSource):
    """`spark.read.format("pdf_pages").load(folder)` after `spark.dataSource.register(PdfPagesSource)`.

    Options: path (a folder of all machines), reader ("module:class"), ocr ("module:function", for pages of fewer than 100
    characters; none if not given). One partition a file; filters on page_num are pushed, so other pages are not decoded.
    A file that cannot be read gives one row, of the first page asked for, with the reason in `error`; it keeps no other
    from being read. The session needs spark.sql.python.filterPushdown.enabled = true.
    """

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return f"{PAGE_SCHEMA}, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PdfPagesReader(self.options)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _PdfPagesReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.kind = options.get("reader", "namavali.sources.pages:PdfplumberReader")
        self.ocr = options.get("ocr")
        self.start, self.end = 1, 1 << 30

    def pushFilters(self, filters):
        for f in filters:
            at = f.attribute == ("page_num",) if hasattr(f, "attribute") else False
            if at and isinstance(f, EqualTo):
                self.start, self.end = max(self.start, f.value), min(self.end, f.value)
            elif at and isinstance(f, GreaterThanOrEqual):
                self.start = max(self.start, f.value)
            elif at and isinstance(f, GreaterThan):
                self.start = max(self.start, f.value + 1)
            elif at and isinstance(f, LessThanOrEqual):
                self.end = min(self.end, f.value)
            elif at and isinstance(f, LessThan):
                self.end = min(self.end, f.value - 1)
            else:
                yield f

    def _files(self):
        from pyarrow import fs

        path = self.folder
        system, at = (fs.LocalFileSystem(), path.removeprefix("file://")) if path.startswith(("/", "file:")) else fs.FileSystem.from_uri(path)
        return system, at

    def partitions(self):
        from pyarrow import fs

        system, at = self._files()
        found = system.get_file_info(fs.FileSelector(at, recursive=False))
        return [_File(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.endswith(".pdf")] or [_File("")]

    def read(self, partition):
        if not partition.path or self.start > self.end:
            return
        stem = partition.path.rpartition("/")[2].removesuffix(".pdf")
        start = max(1, self.start)
        try:
            system, _ = self._files()
            with system.open_input_file(partition.path) as f:
                content = f.read()
            ocr = _named(self.ocr) if self.ocr else None
            rows = []
            for k, text in _named(self.kind)().texts(content, start, self.end):
                short = ocr is not None and len((text or "").strip()) < 100
                rows.append((stem, k, *(recognised(ocr, content, k) if short else (text, "layer")), None))
        except Exception as e:  # of one file
            rows = [(stem, start, None, None, f"{type(e).__name__}: {e}")]
        yield from rows


def _named(name: str):
    import importlib

    module, _, what = name.partition(":")
    return getattr(importlib.import_module(module), what)


def read_names(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lists of names, one a line: file, line_no (physical, from 1, blank lines counted), name. Blank lines are left out.

    keep: partition columns of the folder that are kept instead of the file's name.
    """
    from ..functions.text import strip

    at = [F.col(c) for c in keep] or [file_name(F.input_file_name()).alias("file")]
    whole = spark.read.text(path, wholetext=True).select(*at, F.posexplode(F.split("value", "\n")).alias("n", "line"))
    return whole.select(*(keep or ("file",)), (F.col("n") + 1).alias("line_no"), strip(F.col("line")).alias("name")).where("name <> ''")
