"""Main text, archives, language model, classifier and packing."""

import base64
import hashlib
import json
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from namavali.llm import html_text, maxent, packing, quality, queries, warc
from namavali.llm.common import text_buffer
from tests.llm.test_text_ops import ODD, WORD, documents, lower

PAGE = "page_id long, url string, html string"

# ---- main text -------------------------------------------------------------------------------------------------------


def test_made_pages():
    """Held-out made pages: words of the main text that are found, and found words that are of it."""
    r, forest = random.Random(99), html_text.model()
    kept, want, both = 0, 0, 0
    for _ in range(150):
        made = html_text.page(r)
        marked = html_text.parse(html_text._MARKED.sub(' class="data-main"', made))
        gold = Counter(w for i, t in enumerate(marked.text) if t and marked.attrs[marked.parent[i]] == "data-main" for w in t.split())
        got = Counter(html_text.main_texts([html_text._MARKED.sub("", made)], forest)[0].split())
        kept, want, both = kept + got.total(), want + gold.total(), both + (got & gold).total()
    assert both / want > 0.95 and both / kept > 0.95


def test_template():
    page = (
        "<!DOCTYPE html><html><head><title>T &amp; t</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
        "<!-- ad --><div class=ad>Buy now, cheap things. Really.</div><article><h1>Title &lt;one&gt;</h1><p><b>First  sentence.<br><p>Second &amp; third\n sentence, with more words in it.</p>"
        "<p>A last paragraph of the article, that ends here.</p></article><div id=comments><div class=comment><p>I think this is great, thanks.</p></div></div>"
        "<form><p>Subscribe to our letter</p><input></form><footer>&copy; example.com &middot; all rights.</footer></body></html>"
    )
    assert html_text.main_texts([page], html_text.model()) == ["Title <one>\n\nFirst sentence.\n\nSecond & third sentence, with more words in it.\n\nA last paragraph of the article, that ends here."]


def test_quotes_open_a_value_only_after_an_equals_sign():
    texts = lambda p: [x for x in html_text.parse(p).text if x]
    first = "Hello main words, here it's fine. There are more of them in this paragraph, as it goes on."
    assert texts(f"<p title=don't>{first}</p><p>Second's paragraph.</p>") == [first, "Second's paragraph."]
    assert html_text.main_texts([f"<div data-x=it's>{first}</div>"], html_text.model()) == [first]
    odd = html_text.parse("""<p a="x>y" b='>' c = "z>">one</p><p "q>two</p><p d=">three""")
    assert [x for x in odd.text if x] == ["one", "two", "three"]


def test_deep_pages_take_linear_time():
    import time

    took = []
    for n in (20_000, 100_000):
        for opening in ("<div>", "<p><button>", "<li><span><b>", "</div><td>"):
            start = time.thread_time()
            t = html_text.parse(opening * n + "deep")
            took.append((n, time.thread_time() - start))
            assert "deep" in "".join(t.text) or "button" in opening
    assert max(s for n, s in took if n == 100_000) < 20 * max(0.1, max(s for n, s in took if n == 20_000))


ARTICLES = "/root/testdata/sf0.001/pages.parquet"


@pytest.mark.skipif(not os.path.exists(ARTICLES), reason="no test tables")
def test_known_articles(spark):
    """Pages whose article stands between its tags, in headings and paragraphs: the text of these, and nothing else."""
    import html

    rows = spark.read.parquet(ARTICLES).collect()
    known = {}
    for x in rows:
        found = re.search(r"<article>(.*)</article>", x.html or "", re.S)
        if found and not re.search(r"<(?!/?(?:h\d|p|b|br|i|em)\b)", found[1]):
            blocks = re.split(r"</?(?:h\d|p)\b[^>]*>", found[1])
            clean = (" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks)
            known[x.page_id] = "\n\n".join(b for b in clean if b)
    got = {x.page_id: x.text for x in html_text.extract(spark.read.parquet(ARTICLES)).collect()}
    same = sum(got[i] == t for i, t in known.items())
    assert len(got) == len(rows) and len(known) > 0.8 * len(rows) and same >= 0.98 * len(known), (same, len(known))


def test_decode_is_the_best_consistent_labelling():
    r = np.random.default_rng(3)
    for _ in range(60):
        n = 9
        parent = [-1, *[int(r.integers(0, i)) for i in range(1, n)]]
        z = r.normal(0, 2, n)
        yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
        best = max(
            (sum(yes[i] if m >> i & 1 else no[i] for i in range(n)), m)
            for m in range(1 << n)
            if all(not m >> i & 1 or parent[i] < 0 or m >> parent[i] & 1 for i in range(n))
        )[1]
        assert [bool(best >> i & 1) for i in range(n)] == html_text.decode(parent, z).tolist()


def test_odd_pages(spark):
    odd = [None, "", "plain text only", "<p>unfinished <div class='x", "<<<>>> a < b", "<!-- never ends", "<script>x", "<div>" * 3000 + "deep", "<p>" + "long words here. " * 40_000, "<a title=\"x>y\">t</a>", "\x00<p>é"]
    df = spark.createDataFrame([(i, None, h) for i, h in enumerate(odd)], PAGE).withColumn("text", F.lit("clash"))
    got = {x.page_id: x for x in html_text.extract(df).collect()}
    assert len(got) == len(odd) and got[0].text == got[1].text == "" and all(x.n_chars == len(x.text) for x in got.values())
    assert html_text.extract(df.limit(0)).count() == 0


# ---- archives --------------------------------------------------------------------------------------------------------


def plain_warc(rows, at_least):
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), i)
    out = set()
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= at_least and last[h or ""] != i
        out.add((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", last[h or ""] if again else None))
    return out


@pytest.mark.parametrize("at_least", [0, 5])
def test_archives(spark, at_least):
    r = random.Random(8)
    pages = ["<p>a</p>", "<p>é 中\r\n\r\nx</p>", None, "", "b" * 200_000, "abc"]
    urls = [None, "", "http://www.Example.com:8080/A b?q=é#f", "https://a.example.org/", "not a url\n", "http://[bad", "http://x.com:99999/"]
    rows = [(i, r.choice(urls), r.choice(pages)) for i in range(60)]
    df = spark.createDataFrame(rows, PAGE).repartition(3)
    assert {tuple(x) for x in warc.archive_round_trip(df, at_least).collect()} == plain_warc(rows, at_least)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_archives_null_ids_and_repeats(spark):
    df = spark.createDataFrame([(None, "u", "x"), (1, "u", "x"), (1, "u", "x"), (None, None, None)], PAGE)
    got = sorted(((x.page_id or 0, x.record_type, x.refers_to or 0) for x in warc.archive_round_trip(df).collect()))
    assert got == [(0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "response", 0)]


def test_index(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h{i % 7}.example.com/{i}", f"page {i}") for i in range(300)], PAGE).repartition(3)
    folder = f"file://{tmp_path}/w"
    captures = warc.write_archives(df, folder)
    parts = warc.build_index(captures, folder, parts=3, lines=16)
    index = warc.Index(parts, keep=4)
    for i in (0, 17, 299, 150):
        assert index.read(warc.capture_key(f"http://h{i % 7}.example.com/{i}", i))[1] == f"page {i}".encode()
    assert index.find(warc.capture_key("http://none.example.com/", 1)) == index.find("") == []
    assert warc.url_key("https://www.a.example.com:443/P?x=1") == "com,example,a)/p?x=1"


def test_everything_is_read_through_the_index(spark, tmp_path):
    rows = [(i // 30, f"http://h{i % 3}.example.com/", f"page {i}") for i in range(120)] + [(7, "u", "x")] * 50
    df = spark.createDataFrame(rows, PAGE).repartition(3)
    folder = f"file://{tmp_path}/w"
    captures = warc.write_archives(df, folder)
    parts = warc.build_index(captures, folder, parts=2, lines=4)  # the lines of a key go over several blocks
    index = warc.Index(parts)
    assert len(index.find(warc.capture_key("u", 7))) == 50
    keys = captures.select("key").distinct()
    back = warc.read_archives(keys, parts, 5)
    assert back.count() == len(rows) and back.rdd.getNumPartitions() == 5
    with pytest.raises(Exception, match="no capture"):
        warc.look_up(keys.unionByName(spark.createDataFrame([("com,example,none)/ 1",)], "key string")), parts, 2).count()
    near = [("f", 0, 5), ("f", 5, 5), ("f", 20, 5), ("g", 25, 5), ("g", 30, 100), ("g", 130, 1)]
    assert [len(x) for x in warc.neighbours(near, 50)] == [2, 1, 1, 1, 1]


# ---- language model --------------------------------------------------------------------------------------------------


def test_maxent(spark):
    r = random.Random(9)
    a, b = [f"al{i}" for i in range(40)], [f"be{i}ou" for i in range(40)]
    texts = ODD + [" ".join(r.choices(v, [1 / (i + 1) for i in range(40)], k=r.randint(1, 80))) for v in [a, b] * 150]
    got = {x.doc_id: x for x in maxent.score_texts(documents(spark, texts).withColumn("score", F.lit("clash"))).collect()}
    tokens = {i: [*WORD.findall(lower(t or "")), None] for i, t in enumerate(texts)}
    train = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = train.total(), len(train)
    for i, ws in tokens.items():
        x = got[i]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, len(ws), sum(train[w] > 0 for w in ws), n)
        assert x.base_score == pytest.approx(base)
    held = [x for x in got.values() if x.held_out and x.doc_id >= len(ODD)]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    assert maxent.score_texts(documents(spark, [])).count() == 0


def plain_maxent(texts, rounds):
    """The model's log10 probability of each text, one token at a time, in dictionaries."""
    tokens = [[*WORD.findall(lower(t or "")), None] for t in texts]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]
    count = Counter(w for ws, use in zip(tokens, train) if use for w in ws)
    words = sorted({w for ws in tokens for w in ws if w is not None})
    data, offsets = text_buffer(pa.array(words))
    h, ending, _ = maxent.token_block(data, offsets)
    ends = np.cumsum([2] * len(words)) - 2  # each word is followed by an end
    ending_of = dict(zip(words, ending[ends].tolist()))
    v = round((len(count)) ** 0.25)
    suffixes = max(8, v)
    hash_of = dict(zip(words, h[ends].view(np.int64).tolist()))
    top = sorted((w for w in count if w is not None), key=lambda w: (-count[w], hash_of[w]))[: suffixes * 3 // 5]
    cls = lambda w: "end" if w is None else w if w in top else ending_of[w] * suffixes // 256
    kinds = ["end", *top, *range(suffixes)]
    size = {c: sum(n for w, n in count.items() if cls(w) == c) for c in kinds}
    many = {c: sum(cls(w) == c for w in count) for c in kinds}
    p = {c: (size[c] + 0.5) / (sum(size.values()) + 0.5 * len(kinds)) for c in kinds}
    ranked = sorted((w for w in count if w is not None), key=lambda w: (-count[w], hash_of[w]))[: round(maxent.ROOT_ROWS * count.total() ** (1 / 3))]
    row = lambda w: w if w in ranked else ending_of[w] * suffixes // 256
    back = lambda ws, i: [(k, row(ws[i - k]) if i >= k else "start of text") for k in (1, 2)]
    seen = {}
    for ws, use in zip(tokens, train):
        for i, w in enumerate(ws if use else []):
            for f in back(ws, i):
                seen.setdefault(f, Counter())[cls(w)] += 1
    weight = {f: {c: math.log((n + p[c]) / ((x.total() + 1) * p[c])) / 2 for c, n in x.items()} for f, x in seen.items()}

    def chances(ws, i):
        z = {c: math.log(p[c]) + sum(weight.get(f, {}).get(c, 0) for f in back(ws, i)) for c in kinds}
        total = sum(map(math.exp, z.values()))
        return {c: math.exp(x) / total for c, x in z.items()}

    for k in range(rounds):
        hoped = {}
        for ws, use in zip(tokens, train):
            for i in range(len(ws) if use else 0):
                q = chances(ws, i)
                for f in back(ws, i):
                    for c in weight[f]:
                        hoped[f, c] = hoped.get((f, c), 0) + q[c]
        for f, x in weight.items():
            for c in x:
                x[c] += 0.5 / (1 + k) * math.log((seen[f][c] + 1) / (hoped[f, c] + 1))
    after = {}
    for ws, use in zip(tokens, train):
        for i, w in enumerate(ws if use else []):
            after.setdefault((ws[i - 1] if i else "start of text", cls(w)), Counter())[w] += 1
    out = []
    for ws in tokens:
        score = 0
        for i, w in enumerate(ws):
            c = cls(w)
            score += math.log10(chances(ws, i)[c])
            if isinstance(c, int):
                q, x = (count[w] + 0.5) / (size[c] + 0.5 * (many[c] + 1)), after.get((ws[i - 1] if i else "start of text", c), Counter())
                score += math.log10((x[w] + len(x) * q) / (x.total() + len(x)) if x else q)
        out.append(score)
    return out


def test_maxent_against_a_plain_model(spark, monkeypatch):
    monkeypatch.setattr(maxent, "BLOCK", 2000)
    monkeypatch.setattr(maxent.list_blocks, "__defaults__", (2000,))
    monkeypatch.setattr(maxent, "ROOT_ROWS", 8)
    r = random.Random(10)
    words = [f"w{i}{e}" for i in range(60) for e in ("ed", "ing", "s", "ou")]
    texts = ODD[:6] + ODD[7:] + [" ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=r.randint(1, 60))) for _ in range(150)]
    texts += texts[20:60]  # copies, some of them held out
    want = plain_maxent(texts, 2)
    df = documents(spark, texts).repartition(3).cache()
    got = {x.doc_id: x.score for x in maxent.score_texts(df, rounds=2).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=5e-3, abs=2e-2)
    assert {x.doc_id: x.score for x in maxent.score_texts(df, rounds=2).collect()} == got


def test_maxent_null_ids_repeats_and_long_texts(spark):
    df = spark.createDataFrame([(None, "a b c"), (3, "a b"), (3, "a b"), (5, "x y z " * 400_000)], "doc_id long, text string").withColumn("held_out", F.lit("clash"))
    rows = maxent.score_texts(df).collect()
    assert sorted((x.doc_id or 0, x.n_tokens) for x in rows) == [(0, 4), (3, 3), (3, 3), (5, 1_200_001)]
    assert len({x.score for x in rows if x.doc_id == 3}) == 1 and all(x.score < 0 for x in rows)


def test_maxent_rows():
    """Frequent words have rows of their own, rarer ones their ending's, the start of a text the last of a feature."""
    v = maxent.vocabulary([told([(r % 256, 1 + 3000 // (r + 1)) for r in range(3000)])])
    assert len(v.frequent) == min(3000, maxent.MOST_ROWS, round(maxent.ROOT_ROWS * v.tokens ** (1 / 3)))
    names, ending = np.arange(3000, dtype=np.uint64), np.arange(3000) % 256
    at = maxent.contexts(np.array([2, 3]), np.array([0, 1, 2, 2999, 0]), names, ending, v)
    row = v.row(names, ending)
    start, n = v.rows - 1, v.rows
    assert at.tolist() == [[start, start + n], [row[0], start + n], [start, start + n], [row[2], start + n], [row[2999], row[2] + n]]
    assert row.max() < start and len(set(row[:20].tolist())) == 20


def told(counts):
    """What one share tells of its words: {ending: count}."""
    tokens, words = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for e, c in counts:
        tokens[e] += c
        words[e] += 1
    top = sorted(((c, i, e) for i, (e, c) in enumerate(counts)), reverse=True)
    return np.concatenate([[3], tokens, words, *np.array([(c, e, i) for c, i, e in top], np.int64).T]).astype(np.int64).tobytes()


def test_maxent_classes():
    v = maxent.vocabulary([told([(r % 256, 1 + r % 7) for r in range(3000)])])
    assert v.suffixes == max(8, round(3001**0.25)) and v.kinds == 1 + len(v.own) + v.suffixes and v.class_tokens.sum() == v.tokens
    big = maxent.vocabulary([told([(r % 256, 1 + r % 7) for r in range(50_000)])])
    assert big.kinds > v.kinds  # classes grow with the vocabulary
    names, counts = np.arange(3000, dtype=np.uint64), np.array([1 + r % 7 for r in range(3000)])
    cls, q = v.classes(names, np.arange(3000) % 256), None
    q = v.inside(counts, cls)
    for c in range(1, v.kinds):
        unknown = 0.5 / (v.class_tokens[c] + 0.5 * (v.class_words[c] + 1)) if c >= v.shared else 0
        assert q[cls == c].sum() + unknown == pytest.approx(1)
    assert v.classes(np.array([maxent.END]), np.array([0]))[0] == 0


# ---- classifier ------------------------------------------------------------------------------------------------------


def test_quality(spark):
    r = random.Random(10)
    good = lambda: " ".join(r.choices("the house and a tree stood by the river in spring".split(), k=80)) + "."
    bad = lambda: " ".join(w.upper() + "!!" for w in good().split())
    texts = ODD + [good() if i % 2 else bad() for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "k long, quality int, toxic int").select((F.col("k") + len(ODD)).alias("doc_id"), F.when(F.col("k") % 2 == 1, 1).otherwise(0).alias("quality"), "toxic")
    got = {x.doc_id: x for x in quality.score_quality(documents(spark, texts), labels).collect()}
    assert len(got) == len(texts) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) and x.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, x in got.items())
    held = [(x.predicted, (i - len(ODD)) % 2) for i, x in got.items() if x.held_out and i >= len(ODD)]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    none = quality.score_quality(documents(spark, texts), labels.limit(0)).collect()
    assert {x.score for x in none} == {0.5}


def test_gam_finds_an_interaction():
    r = np.random.default_rng(11)
    x = r.uniform(-1, 1, (3000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = quality.fit(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9 and (0, 1) in {p[:2] for p in m.pairs}


# ---- packing ---------------------------------------------------------------------------------------------------------


def packed(spark, texts, **options):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = packing.best_fit_pack(documents(spark, texts).withColumn("piece", F.lit("clash")), path, **options).collect()
    at = {}
    for x in rows:
        at.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for s in at.values():
        end = 0
        for a, n in sorted(s):
            assert a == end and n > 0
            end += n
        assert end <= options.get("capacity", 2048)
    return rows, at


def test_packing(spark):
    r = random.Random(12)
    texts = ODD + [" ".join(r.choices("alpha Beta gamma's délta 12 !!".split(), k=r.choice([1, 5, 60, 300, 900]))) for _ in range(150)]
    rows, at = packed(spark, texts)
    tokens = packing.tokenizer(queries.vocabulary("word_bpe_49k.json"))
    by = {}
    for x in sorted(rows, key=lambda x: (x.doc_id, x.piece)):
        by.setdefault(x.doc_id, []).append((x.piece, x.start, x.length, x.ids_crc32))
    total = 0
    for i, t in enumerate(texts):
        ids = tokens.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        assert by[i] == [(k, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    assert len(at) <= 1.05 * total / 2048 + 2
    assert packing.best_fit_pack(documents(spark, []), queries.vocabulary("word_bpe_49k.json")).count() == 0


def test_packing_needs_no_more_than_best_fit(spark):
    """Against best-fit decreasing of the same pieces, one by one."""
    r = random.Random(31)
    texts = ["a " * int(min(6000, r.lognormvariate(6, 1.1))) for _ in range(300)]
    rows, at = packed(spark, texts)
    rooms = []
    for n in sorted((x.length for x in rows), reverse=True):
        fits = min((room for room in rooms if room >= n), default=None)
        if fits is not None:
            rooms.remove(fits)
        rooms.append((2048 if fits is None else fits) - n)
    assert len(at) <= len(rooms)


def test_packing_special_strings_and_other_files(spark, tmp_path):
    """Ids are the library's: special tokens in a text, and files whose normal form is another."""
    import json

    texts = ["<|endoftext|> a b", "x<|startoftext|>y <|endoftext|", "a  B\u00a0c don't Ab1", "\u0130 \u1e9e"]
    path = queries.vocabulary("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        other = json.load(f)
    other["normalizer"]["normalizers"] = other["normalizer"]["normalizers"][:2]  # no lower case
    (tmp_path / "other.json").write_text(json.dumps(other))
    for file, known in ((path, True), (str(tmp_path / "other.json"), False)):
        assert packing.added(file)[0] is known
        whole = packing.tokenizer(file)
        got = {x.doc_id: x.ids_crc32 for x in packing.best_fit_pack(documents(spark, texts), file).collect()}
        assert got == {i: zlib.crc32(np.array([*whole.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in enumerate(texts)}
    assert 49407 in packing.tokenizer(path).encode(texts[0], add_special_tokens=False).ids


def test_packing_in_many_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_ROWS", 10)
    packed(spark, ["a b c"] * 120 + ["d " * 700] * 30 + ["e " * 1200] * 20, groups=3)


def test_configurations_hold_all():
    r = random.Random(13)
    sizes = sorted(r.sample(range(30, 100), 12), reverse=True)
    counts = [r.randint(1, 400) for _ in sizes]
    used = Counter()
    total = 0
    for config, times in packing.configurations(sizes, counts, 100):
        assert sum(s * k for s, k in config.items()) <= 100
        total += times
        for s, k in config.items():
            used[s] += k * times
    assert used == Counter(dict(zip(sizes, counts)))
    assert total <= sum(s * c for s, c in zip(sizes, counts)) / 100 * 1.35


def test_words_are_encoded_alone():
    tokens = packing.tokenizer(queries.vocabulary("word_bpe_49k.json"))
    import pyarrow as pa

    r = random.Random(14)
    texts = ["".join(r.choice("ab 'sé1!\n\t ́Σς🙂") for _ in range(r.randint(0, 40))) for _ in range(500)]
    got = list(packing.encode_texts(pa.array(texts), packing.WordCache(queries.vocabulary("word_bpe_49k.json"), most=50)))
    assert [g.tolist() for g in got] == [tokens.encode(t, add_special_tokens=False).ids for t in texts]




def _calls(f) -> int:
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        f()
    finally:
        sys.setprofile(None)
    return n


def test_encoding_takes_no_step_of_python_per_word():
    """The time of words that occur once, and of one long word, is not spent word by word or merge by merge."""
    r = random.Random(15)
    path = queries.vocabulary("word_bpe_49k.json")
    tokens = packing.tokenizer(path)
    packing.merges(path), packing.added(path)
    many = " ".join({"".join(r.choices("aeinorst", k=r.randint(3, 12))).capitalize() + r.choice(["", ",", "."]) for _ in range(20_000)})
    for text in (many, "".join(r.choices("abcde", k=5_000))):
        got = []
        assert _calls(lambda: got.extend(packing.encode_texts(pa.array([text]), packing.WordCache(path)))) < 4_000
        assert [g.tolist() for g in got] == [tokens.encode(text, add_special_tokens=False).ids]


def test_merges_find_each_pair():
    m = packing.merges(queries.vocabulary("word_bpe_49k.json"))
    with open(queries.vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {}
    for k, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        rank[model["vocab"][a], model["vocab"][b]] = k
    assert len(m.more_keys) > 100  # pairs that share a place in the table
    r = np.random.default_rng(16)
    pairs = np.concatenate([np.array(list(rank)), r.integers(0, len(model["vocab"]), (300_000, 2))]).astype(np.uint32)
    assert m.rank(pairs[:, 0], pairs[:, 1]).tolist() == [rank.get((a, b), m.NONE) for a, b in pairs.tolist()]


def test_words_in_small_groups(monkeypatch):
    """The same ids whatever is put together at once and however little is kept: capitals, Latin letters, digits, empty texts."""
    r = random.Random(17)
    path = queries.vocabulary("word_bpe_49k.json")
    tokens = packing.tokenizer(path)
    alphabet = list("abAB ÀÉÖ×÷ßÿÞþ09.,!?'-_<|>\x7f\x00\x1c\x85  ́ Ãã\t\n") + ["<|endoftext|>", "é" * 130]
    texts = [None, "", " ", *("".join(r.choices(alphabet, k=r.randint(0, 30))) for _ in range(300)), None, ""]
    want = [tokens.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (0, 40, 400_000):
        for size, group in ((1 << 20, 1 << 18), (60, 3)):
            monkeypatch.setattr(packing, "CHUNK_BYTES", size)
            monkeypatch.setattr(packing, "GATHERED", group)
            cache = packing.WordCache(path, most)
            for _ in range(2):
                assert [g.tolist() for g in packing.encode_texts(pa.array(texts), cache)] == want
    assert [g.tolist() for g in packing.encode_texts(pa.array(texts).slice(5, 9), cache)] == want[5:14]
