"""Extraction, deduplication, clusters, validation, reports, sources and streaming."""

import random

import pytest
from pyspark.sql import functions as F

from namavali.operators import clusters, dedup, duplicates, extract, reports, validate
from namavali.plans import pipeline, queries
from namavali.sources import sinks
from namavali.sources.pages import PdfPagesSource, read_names, read_pages
from namavali.sources.tables import with_sequence

PAGE = """विधानसभा मतदारसंघ २८२
1
ABC1234567
नाव : प्रकाश चंद्रकांत चोपडे
वडिलांचे नाव: चंद्रकांत चोपडे
घर क्रमांक : 12
वय : 45 लिंग : पुरुष
2
नाच : मनीषा पिसाळ पतीचे नाव: सुरेखा उर्फ ताई पिसाळ
3
नाव; राहुल
4
नांव : राम५ पाटील
५
नाव : किरण जाधव पत्नीचे नाव: सुनीता जाधव
6
नाव : अब
7
नाव : John Smith पाटील"""


@pytest.fixture
def found(spark):
    pages = spark.createDataFrame([("a", 3, PAGE), ("a", 4, ""), ("a", 5, None)], "pdf_file string, page_num int, text string")
    return extract.extraction(extract.repair(pages))


def test_page(found):
    got = [r.full_name for r in extract.accepted(found).orderBy("block_no", "line_no", "part_no").collect()]
    assert got == ["प्रकाश चंद्रकांत चोपडे", "चंद्रकांत चोपडे", "मनीषा पिसाळ", "सुरेखा", "किरण जाधव पत्नी", "सुनीता जाधव"]
    assert [(r.name, r.reason) for r in extract.rejected(found).collect()] == [("राम५ पाटील", "Contains numbers")]
    assert sorted(r.raw_text[0] for r in extract.block_errors(found).collect()) == ["3", "4", "6", "7"]


def test_blocks_agree_with_the_running_count(spark):
    pages = spark.createDataFrame([("a", 1, PAGE), ("b", 1, "12\n\n 3 \nx\n4"), ("c", 1, "")], "pdf_file string, page_num int, text string")
    lines = extract.segment(extract.lines(pages))
    whole = lines.groupBy("pdf_file", "block_no").agg(F.array_join(F.array_sort(F.collect_list(F.struct("line_no", "line")))["line"], "\n").alias("t"))
    assert {tuple(r) for r in whole.collect()} == {(r.pdf_file, r.block_no, r.block_text) for r in extract.blocks(pages).collect()}
    assert extract.blocks(pages).where("pdf_file = 'a'").count() == 8


@pytest.mark.parametrize(("keys", "size", "want"), [("abaca", 2, [1, 2, 4, 5]), ("abaca", 1000, [1, 2, 4]), ("abacab", 1, [1, 2, 3, 4, 5, 6])])
def test_window(spark, keys, size, want):
    df = spark.createDataFrame([("f", i + 1, k) for i, k in enumerate(keys)], "pdf_file string, seq long, name string")
    for by in ([], ["pdf_file"]):
        assert sorted(r.seq for r in dedup.keep_recent(df, by, ["seq"], size).collect()) == want
        assert sorted(r.seq for r in dedup.deduplicate(df, by, ["seq"], size).collect()) == want


def test_window_equals_plain_loop(spark):
    r = random.Random(5)
    rows = [(f"f{r.randint(0, 3)}", i, r.choice("abcdefghij")) for i in range(600)]
    df = spark.createDataFrame(rows, "pdf_file string, seq long, name string")
    want = []
    for f in {x[0] for x in rows}:
        mine = [x for x in rows if x[0] == f]
        want += [x[1] for x, ok in zip(mine, dedup.accept((x[2] for x in mine), 4)) if ok]
    assert sorted(x.seq for x in dedup.keep_recent(df, ["pdf_file"], ["seq"], 4).collect()) == sorted(want)


def test_stream_equals_batch(spark, tmp_path):
    from namavali.streaming.dedup import keep_recent_stream, read_stream, run_available

    r = random.Random(6)
    df = spark.createDataFrame([("f" + str(i % 2), i, r.choice("abcdefgh")) for i in range(200)], "pdf_file string, seq long, name string")
    for k in range(2):  # two files, in order
        df.where(F.floor(F.col("seq") / 100) == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = keep_recent_stream(read_stream(spark, str(tmp_path / "in"), df.schema, 1), size=3)
    run_available(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted(x.seq for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(x.seq for x in dedup.keep_recent(df, ["pdf_file"], ["seq"], 3).collect())


def test_streamed_run_equals_batch(spark, tmp_path):
    from namavali.streaming.run import finish, run_stream

    pages = queries._pages(spark, "/root/testdata/sf0.001").withColumn("late", F.col("pdf_file") >= "roll_J").cache()
    where = [str(tmp_path / k) for k in ("pages", "out", "check")]
    for late in (False, True):  # the second part comes after the first has been run to its end
        pages.where(F.col("late") == late).drop("late").coalesce(1).write.mode("append").parquet(where[0])
        run_stream(spark, *where, dedup_window=20)
    got, want = finish(spark, where[0], where[1], "both"), pipeline.run(pages.drop("late"), 20, "both")
    same = lambda a, b, *cols: sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))
    assert same(got.full, want.full, *queries.ORDER, "name", "norm") and got.full.count() > 100
    assert same(got.first, want.first, "seq", *queries.FIRST, "name") and got.first.count() > 100
    assert same(duplicates.duplicate_groups(got.first), duplicates.duplicate_groups(want.first), "normalized", "cnt", "first_seq")
    assert same(got.sources, want.sources, "normalized", "pdfs", "n_pdfs")
    assert same(got.errors, want.errors, *queries.extract.KEYS, "block_no", "raw_text", "reason")
    assert same(got.rejected, want.rejected, *queries.extract.KEYS, "block_no", "name", "reason")
    assert same(got.validated.valid, want.validated.valid, "seq", "name") and same(got.validated.summary(), want.validated.summary(), "*")
    assert duplicates.duplicate_groups(got.first).count() > 0


@pytest.mark.parametrize(
    ("latins", "want"),
    [(["rama", "rami", "ramu", "roma"], [[0, 1, 2]]), (["rama", "roma", "rami"], [[0, 1]]), (["rama", "rama", "rami"], [[0, 2]]), (["rama", "ramaa"], [])],
)
def test_greedy(latins, want):
    assert clusters.greedy(latins) == want


def test_distance():
    assert [clusters.distance(a, b, 1) for a, b in (("ab", "ab"), ("ab", "ac"), ("ab", "ba"), ("", "a"), ("abc", "a"))] == [0, 1, 2, 1, 2]


def test_components_do_not_change_the_greedy_result(spark):
    r = random.Random(7)
    names = sorted({"".join(r.choices("कखगघमनरल", k=r.randint(2, 4))) for _ in range(150)}, key=lambda _: r.random())
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "seq long, name string")
    spelled = clusters.spelled(df)
    rows = sorted(spelled.collect(), key=lambda x: x.first_seq)
    want = set()
    for size in {x.latin_len for x in rows}:
        mine = [x for x in rows if x.latin_len == size]
        want |= {frozenset(mine[i].name for i in g) for g in clusters.greedy([x.latin for x in mine])}
    got: dict[int, set] = {}
    for x in clusters.phonetic_clusters(spelled).collect():
        got.setdefault(x.cluster_id, set()).add(x.name)
    assert {frozenset(g) for g in got.values()} == want and sorted(got) == list(range(1, len(want) + 1))


@pytest.mark.parametrize(("mode", "valid", "invalid"), [(None, ["राम", "महेश"], 3), ("both", ["राम", "किरण", "संजीव", "महेश"], 1), ("phonetic_dict", ["राम", "किरण", "महेश"], 2), ("pattern", ["राम", "संजीव", "महेश"], 2)])
def test_validation(spark, mode, valid, invalid):
    arriving = spark.createDataFrame(list(enumerate(["राम", "किंरण", "किरण", "संजीच", "रा", "महेश"])), "seq long, name string")
    v = validate.validate(dedup.keep_first(arriving, [], ["seq"]), mode)
    assert [r.name for r in v.valid.orderBy("seq").collect()] == valid
    s = v.summary().first()
    assert (s.invalid, s.flagged) == (invalid, 3)


def test_duplicates_and_reports(spark):
    df = spark.createDataFrame([(i + 1, n, f) for i, (n, f) in enumerate([("शीतल", "a"), ("शितल", "b"), ("राम", "a"), ("शीतल", "a"), ("किरण", "a"), ("किंरण", "c")])], "seq long, name string, pdf_file string")
    s = duplicates.statistics(df).first()
    assert (s.total, s.unique_names, s.duplicate_groups, s.total_duplicates, s.duplicate_rate) == (6, 3, 2, 3, 50.0)
    lines = [r.line for r in reports.duplicates_report(df, duplicates.duplicate_groups(df), duplicates.statistics(df)).orderBy("section", "item", "line_no").collect()]
    assert lines[6:13] == ["Duplicate rate: 50.00%", "--- Group #1 ---", "Normalized form: शीतल", "Total occurrences: 3", "Variations found:", "  Line 1: शीतल", "  Line 2: शितल"]
    cross = [r.line for r in reports.cross_file_report(duplicates.cross_file(df)).orderBy("section", "item", "line_no").collect()]
    assert cross == ["CROSS-FILE FIRST NAMES REPORT", "Names appearing in multiple PDF files: 2", "कीरण", "  Found in 2 PDF(s):", "    - a", "    - c", "शीतल", "  Found in 2 PDF(s):", "    - a", "    - b"]
    none = df.where("seq = 3")
    assert reports.duplicates_report(none, duplicates.duplicate_groups(none), duplicates.statistics(none)).count() == 0


def test_empty_review(spark):
    v = validate.validate(spark.createDataFrame([], "seq long, name string"))
    lines = [r.line for r in reports.review_report(v).orderBy("section", "item", "line_no").collect()]
    assert lines[1] == "Total items flagged: 0" and lines[-3:] == ["  (No phonetic variants found)", "  (No morphologically invalid names found)", "  (No pattern-based errors found)"]


class Stub:
    """Pages are separated by form feeds; a file that says so is broken."""

    def texts(self, content, start, end):
        if content == b"broken":
            raise ValueError("no pages")
        yield from ((k, t) for k, t in enumerate(content.decode().split("\f"), 1) if start <= k <= end)


def recognise(content, page):
    if page == 3:
        raise ValueError("blank")
    return f"seen {page}"


def test_folder(spark, tmp_path):
    (tmp_path / "in" / "below").mkdir(parents=True)
    (tmp_path / "in" / "a.b.pdf").write_text("\f".join(["cover", "x", PAGE, "short"]))
    (tmp_path / "in" / "c.pdf").write_text("broken")
    (tmp_path / "in" / "below" / "d.pdf").write_text("x")
    (tmp_path / "in" / "e.PDF").write_text("x")
    pages, status = read_pages(spark, str(tmp_path / "in"), Stub(), 3, 32, lambda content, page: f"read {page}")
    assert {(r.pdf_file, r.status, r.n_pages) for r in status.collect()} == {("a.b", "completed", 2), ("c", "failed", 0)}
    assert {(r.page_num, r.text_source) for r in pages.collect()} == {(3, "layer"), (4, "ocr")}
    r = pipeline.run(pages, 1000, "both")
    pipeline.write(r, str(tmp_path / "out"))
    assert [x.value for x in spark.read.text(str(tmp_path / "out/extracted_names")).where("pdf_file = 'a.b'").collect()][:2] == ["प्रकाश चंद्रकांत चोपडे", "चंद्रकांत चोपडे"]
    assert spark.read.text(str(tmp_path / "out/errors_report")).count() > 10
    summary = [x.value for x in spark.read.text(str(tmp_path / "out/summary")).collect()]
    assert summary == ["a.b:", "  Full names: 6", "Global First Names", "  Total unique first names collected: 7", "  Names appearing in multiple PDFs: 0", "Total full names written: 6"]


def test_data_source(spark, tmp_path):
    (tmp_path / "a.pdf").write_text("one\ftwo\fthree")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PdfPagesSource)
    df = spark.read.format("pdf_pages").option("reader", "tests.test_engine:Stub").option("path", str(tmp_path)).load()
    assert [(r.page_num, r.text) for r in df.orderBy("page_num").collect()] == [(1, "one"), (2, "two"), (3, "three")]
    assert [r.text for r in df.where("page_num >= 2 AND page_num < 3").collect()] == ["two"]
    (tmp_path / "b.pdf").write_text("broken")
    read = spark.read.format("pdf_pages").option("reader", "tests.test_engine:Stub").option("ocr", "tests.test_engine:recognise").option("path", str(tmp_path)).load()
    got = {(r.pdf_file, r.page_num, r.text, r.text_source, r.error) for r in read.where("page_num >= 2").collect()}
    assert got == {("a", 2, "seen 2", "ocr", None), ("a", 3, None, "OCR failed: blank", None), ("b", 2, None, None, "ValueError: no pages")}


def test_names_file(spark, tmp_path):
    (tmp_path / "n.txt").write_text("राम\n\n  \n शाम \n")
    assert [(r.file, r.line_no, r.name) for r in read_names(spark, str(tmp_path / "n.txt")).collect()] == [("n.txt", 1, "राम"), ("n.txt", 4, "शाम")]


def test_boxes(spark):
    rects = spark.createDataFrame([(1, 0.0, 0.0, 200.0, 100.0), (1, 0.0, 0.0, 500.0, 100.0)], "page_id int, x0 double, y0 double, x1 double, y1 double")
    rules = [(2, 0.0, float(t), 500.0, 0.0) for t in (0, 100, 150)] + [(2, float(x), 0.0, 0.0, 300.0) for x in (0, 200, 300)]
    ruled = spark.createDataFrame([*rules, (1, 0.0, 0.0, 900.0, 0.0)], "page_id int, x0 double, top double, width double, height double")
    assert {tuple(r) for r in extract.card_boxes(rects, ruled).collect()} == {(1, 0.0, 0.0, 200.0, 100.0), (2, 0.0, 0.0, 200.0, 100.0)}


def test_sequence(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("x"))
    assert sorted((r.seq, r.x) for r in with_sequence(df, ["x"]).collect()) == [(i + 1, i) for i in range(100)]


def test_write_lines(spark, tmp_path):
    sinks.write_lines(spark.range(50).select("id", F.col("id").cast("string").alias("line")), str(tmp_path / "o"), ["id"])
    parts = sorted((tmp_path / "o").glob("part-*"))
    assert [int(x) for p in parts for x in p.read_text().split()] == list(range(50))


@pytest.mark.parametrize("argv", [["-f", "x", "-p", "5-3"], ["-f", "x", "-p", "0-3"], ["-f", "x", "-p", "a"], ["-f", "x", "-w", "-1"]])
def test_bad_arguments(argv):
    with pytest.raises(SystemExit) as e:
        pipeline.arguments(argv)
    assert e.value.code == 1


def test_folder_must_exist(spark, tmp_path, capsys):
    (tmp_path / "f").write_text("x")
    assert [pipeline.main(["-f", str(tmp_path / k), "-o", str(tmp_path / "o")]) for k in ("none", "f")] == [1, 1]
    said = capsys.readouterr().out
    assert "does not exist" in said and "not a directory" in said


def test_arguments():
    a = pipeline.arguments(["-f", "x", "--dedup-window", "0", "-a", "both"])
    assert (a.start, a.end, a.dedup_window, a.output, a.add_correction) == (3, 32, 1000, "./output", "both")


def test_report_errors_has_errors_and_rejects(spark):
    d = "/root/testdata/sf0.001"
    heads = queries.report_errors(spark, d).where("line_no = 0").groupBy("section").count().collect()
    errors = queries.block_errors(spark, d).count() + queries.page_errors(spark, d).count()
    assert {r["section"]: r["count"] for r in heads} == {1: errors, 2: queries.rejected_names(spark, d).count()} and errors > 0
