"""Main-text extraction by gradient-boosted trees over DOM nodes, decoded along the hierarchy.

A page becomes a tree of block elements whose leaves are runs of text. Each node has features of its tag, attribute
tokens, depth, siblings and subtree (text, links, paragraphs). Trees give the probability that a node holds main text;
then the most likely labelling of the whole tree is taken among those in which nothing kept lies under something
dropped. The trees are fitted on pages made by `page()`, whose parts are known; the number of pages and the seed are
parameters, so the model is the same in every run.

Defined results: a null or empty html has an empty text; damaged markup is read leniently, an unfinished tag or comment
at the end is dropped; rows repeat as they come; an empty table gives an empty table; only id, url and html are read.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text without markup, and none of the page's.
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
#: Their text is dropped, whatever stands around it.
DEAD = frozenset("head select button svg math template object audio video canvas label option datalist".split())
#: An end tag that may be left out: the tags whose start closes it, up to a boundary.
_CLOSED_BY = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr")}
CLOSED_BY = {k: (what.split(), until.split()) for k, (what, until) in _CLOSED_BY.items()}
P_BOUNDARY = "td th caption table html body".split()

#: A quote opens a value only after an equals sign.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
AGAINST = re.compile(
    r"nav|menu|side-?bar|foot|masthead|banner|breadcrumb|cookie|consent|gdpr|notice|alert|popup|modal|overlay|promo|sponsor|advert|adsense|(?<![a-z])ads?(?![a-z])|"
    r"share|social|follow|related|recommend|trending|popular|widget|comment|disqus|repl(?:y|ies)|respond|discussion|newsletter|subscri|sign-?up|log-?in|search|form|"
    r"pagination|pager|copyright|legal|toolbar|tags?(?![a-z])|contentinfo|complementary|navigation|rail|(?<![a-z])header(?![a-z])"
)
FOR = re.compile(r"article|content|post|entry|main|story|body|text|blog|prose|page")
TALK = re.compile(r"comment|disqus|repl(?:y|ies)|respond|discussion")

#: Kinds of tags that are features of their own.
KINDS = {k: i for i, names in enumerate(("#text", "p pre", "h1 h2 h3 h4 h5 h6", "ul ol dl menu", "li dd dt", "nav", "header", "footer", "aside", "article main", "div section center", "form fieldset", "table tbody tr td th thead tfoot caption", "figure figcaption", "blockquote")) for k in names.split()}
N_KINDS = 15
MAIN, SIDE = frozenset(("article", "main")), frozenset(("nav", "header", "footer", "aside", "form"))


@dataclass
class Tree:
    """Nodes in page order, parents before children."""

    parent: list[int]
    tag: list[str]
    attrs: list[str]
    text: list[str]  # of leaves
    linked: list[int]  # characters in links, of leaves


def parse(page: str) -> Tree:
    t = Tree([-1], ["html"], [""], [""], [0])
    stack, dead = [0], 0  # open blocks; how many of them are dead
    places: dict[str, list[int]] = defaultdict(list, {"html": [0]})  # of open blocks in the stack, by tag
    run: list[str] = []
    linked, link = 0, False
    pos, end = 0, len(page)

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join(_html.unescape("".join(run)).split())
            if text:
                t.parent.append(stack[-1])
                t.tag.append("#text")
                t.attrs.append("")
                t.text.append(text)
                t.linked.append(min(linked, len(text)))
            run, linked = [], 0

    def close(k: int) -> None:
        """Closes the open blocks from place k of the stack on."""
        nonlocal dead
        while len(stack) > k:
            tag = t.tag[stack.pop()]
            places[tag].pop()
            dead -= tag in DEAD

    def nearest(tags: list[str]) -> int:
        """The place of the last open block of these tags, -1 if there is none."""
        return max(places[x][-1] if places[x] else -1 for x in tags)

    while pos < end:
        at = page.find("<", pos)
        if at < 0:
            at = end
        if at > pos:
            if not dead:
                run.append(page[pos:at])
                if link:
                    linked += at - pos
            pos = at
            continue
        if page.startswith("<!--", pos):
            z = page.find("-->", pos + 4)
            pos = end if z < 0 else z + 3
            continue
        if page[pos + 1 : pos + 2] in ("!", "?"):
            z = page.find(">", pos)
            pos = end if z < 0 else z + 1
            continue
        m = TAG.match(page, pos) or LOOSE.match(page, pos)
        if m is None:
            if re.match(r"</?[a-zA-Z]", page[pos : pos + 3]):  # a tag that never ends
                break
            if not dead:
                run.append("<")
            pos += 1
            continue
        pos = m.end()
        closing, name, rest = m.group(1), m.group(2).lower(), m.group(3)
        if name in RAW and not closing:
            z = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
            pos = z.end() if z else end
            continue
        if name == "a":
            link = not closing
        if name == "br":
            if not dead:
                run.append("\n")
            continue
        if name not in BLOCKS and name not in DEAD:
            continue
        flush()
        if closing:
            if (k := nearest([name])) > 0:
                close(k)
                link = False
            continue
        if name in ("html", "body") and places[name]:
            continue
        if name in BLOCKS and (k := nearest(["p"])) > nearest(P_BOUNDARY):
            close(k)
        if name in CLOSED_BY:
            what, until = CLOSED_BY[name]
            if (k := nearest(what)) > nearest(until):
                close(k)
        if name == "body" and dead:  # a head that was not closed
            close(1)
        t.parent.append(stack[-1])
        t.tag.append(name)
        t.attrs.append(" ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(rest)).lower() if rest.strip(" /") else "")
        t.text.append("")
        t.linked.append(0)
        if name not in VOID:
            places[name].append(len(stack))
            stack.append(len(t.parent) - 1)
            dead += name in DEAD
    if not dead:
        flush()
    return t


NAMES = [f"kind{i}" for i in range(N_KINDS)] + (
    "against for against_above for_above talk_above depth place siblings position log_text link_share leaf_text nodes paragraphs stops in_main in_side text_share before_links up_kind"
).split()


def features(t: Tree) -> np.ndarray:
    n = len(t.parent)
    parent = np.array(t.parent)
    size = np.array([len(x) for x in t.text], float)
    stop = np.array([x.count(".") + x.count(",") for x in t.text], float)
    linked = np.array(t.linked, float)
    par = np.array([k == "p" for k in t.tag], float)
    leaf = (size > 0).astype(float)
    nodes = np.ones(n)
    against = np.array([len(AGAINST.findall(a)) if a else 0 for a in t.attrs], float)
    fo = np.array([len(FOR.findall(a)) if a else 0 for a in t.attrs], float)
    talk = np.array([bool(a and TALK.search(a)) for a in t.attrs], float)
    main = np.array([k in MAIN for k in t.tag], float)
    side = np.array([k in SIDE for k in t.tag], float)
    depth, place, kids = np.zeros(n), np.zeros(n), np.zeros(n)
    up = [against.copy(), fo.copy(), talk.copy(), main.copy(), side.copy()]
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        place[i] = kids[p]
        kids[p] += 1
        for u in up:
            u[i] += u[p]
    own = size.copy()
    sub = [own, stop.copy(), linked.copy(), par.copy(), leaf.copy(), nodes]
    for i in range(n - 1, 0, -1):
        for s in sub:
            s[parent[i]] += s[i]
    length, stops, links, pars, leaves, nodes = sub
    share = links / np.maximum(length, 1)
    before = np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        before[i] = share[last[t.parent[i]]] if t.parent[i] in last else -1
        last[t.parent[i]] = i
    x = np.zeros((n, len(NAMES)), np.float32)
    kind = np.array([KINDS.get(k, 10) for k in t.tag])
    x[np.arange(n), kind] = 1
    safe = np.maximum(parent, 0)
    x[:, N_KINDS:] = np.stack(
        [against, fo, up[0], up[1], up[2], depth, place, kids[safe], np.arange(n) / n, np.log1p(length), share, length / np.maximum(leaves, 1), nodes, pars / nodes, stops / np.maximum(length, 1), up[3], up[4], length / max(length[0], 1), before, kind[safe]],
        axis=1,
    )
    return x


# ---- gradient-boosted trees ------------------------------------------------------------------------------------------


@dataclass
class Forest:
    """Complete trees of one depth as arrays: (trees, inner nodes) and (trees, leaves)."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.bias), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while True:
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
                if at[0] >= inner:
                    break
            z += v[at - inner]
        return z


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 24, ridge: float = 1.0) -> Forest:
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    b = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)  # bin <= j  <=>  x <= cuts[j]
    inner = 2**depth - 1
    m = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1)), 0.0)
    z = np.zeros(len(y))
    for t in range(trees):
        q = 1 / (1 + np.exp(-z))
        g, h = y - q, q * (1 - q)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            local = at - first
            best, choice = np.full(wide, 1e-6), np.full((wide, 2), -1)
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                nb = len(c) + 1
                sums = [np.bincount(local * nb + b[:, k], w, wide * nb).reshape(wide, nb).cumsum(1) for w in (g, h)]
                total = [s[:, -1:] for s in sums]
                gl, hl = sums[0][:, :-1], sums[1][:, :-1]
                gain = gl**2 / (hl + ridge) + (total[0] - gl) ** 2 / (total[1] - hl + ridge) - total[0] ** 2 / (total[1] + ridge)
                j = gain.argmax(1)
                v = gain[np.arange(wide), j]
                better = v > best
                best[better] = v[better]
                choice[better] = np.stack([np.full(wide, k), j], 1)[better]
            for node, (k, j) in enumerate(choice):
                if k >= 0:
                    m.feature[t, first + node], m.cut[t, first + node] = k, cuts[k][j]
            right = x[np.arange(len(y)), m.feature[t, at]] > m.cut[t, at]
            at = 2 * at + 1 + right
        at -= inner
        m.leaf[t] = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        z += m.leaf[t][at]
    return m


# ---- pages with known parts ------------------------------------------------------------------------------------------


def page(r: random.Random) -> str:
    """A page whose main text is in elements with a mark, `data-main`."""
    word = lambda: "".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") + r.choice(("", "n", "r", "s")) for _ in range(r.randint(1, 4)))

    def words(a: int, z: int) -> str:
        return " ".join(word() + r.choice(("", "", "", "", ",")) for _ in range(r.randint(a, z)))

    def prose(a: int, z: int) -> str:
        return " ".join(words(3, 14).strip(",").capitalize() + "." for _ in range(r.randint(a, z)))

    def attr(*names: str, often: float = 0.75) -> str:
        if r.random() > often:
            return ""
        name = r.choice(names) + r.choice(("", "", "", "-box", "-wrap", "-1"))
        return f' {r.choice(("class", "class", "id"))}="{name}"'

    links = lambda a, z: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(r.randint(a, z)))
    div = lambda: r.choice(("div", "div", "section"))

    def nav() -> str:
        inside = f"<ul>{links(3, 9)}</ul>" if r.random() < 0.8 else " | ".join(f'<a href="/{word()}">{word()}</a>' for _ in range(r.randint(3, 8)))
        return f"<nav{attr('nav', 'menu', 'navbar', often=0.4)}>{inside}</nav>" if r.random() < 0.6 else f"<div{attr('menu', 'nav', 'navigation', 'topnav')}>{inside}</div>"

    def ad() -> str:
        body = r.choice((prose(1, 3), words(2, 8), f'<a href="/{word()}">{words(2, 8)}</a>', f"<p>{prose(1, 2)}</p>"))
        return f"<{(d := r.choice(('div', 'aside', 'div')))}{attr('ad', 'ads', 'advert', 'sponsored', 'promo', 'banner-ad', often=0.95)}>{body}</{d}>"

    def notice() -> str:
        d = div()
        return f"<{d}{attr('cookie', 'cookie-notice', 'notice', 'consent', 'alert', 'gdpr-banner', often=0.95)}><p>{prose(1, 3)}</p>{r.choice(('', '<button>ok</button>', '<a href=/p>' + word() + '</a>'))}</{d}>"

    def form() -> str:
        return f"<form{attr('search', 'newsletter', 'signup', 'comment-form', often=0.6)}>{r.choice(('', f'<p>{prose(1, 2)}</p>', f'<h3>{words(1, 3)}</h3>'))}<label>{word()}</label><input name=q><button>{word()}</button>{r.choice(('', f'<p>{words(3, 9)}</p>'))}</form>"

    def side() -> str:
        d = r.choice(("aside", "div", "div"))
        parts = [r.choice((f"<h3>{words(1, 3)}</h3><ul>{links(3, 8)}</ul>", ad(), f"<div{attr('widget', 'related', 'popular')}><h4>{words(1, 3)}</h4><p>{prose(1, 3)}</p></div>", form())) for _ in range(r.randint(1, 3))]
        return f"<{d}{attr('sidebar', 'side', 'rail', 'widget-area', 'related', 'right-sidebar', often=0.9 if d == 'div' else 0.4)}>{''.join(parts)}</{d}>"

    def talk() -> str:
        d, li = r.choice((("div", "div"), ("section", "div"), ("ol", "li"), ("section", "article")))
        each = "".join(f"<{li}{attr('comment', 'reply', 'comment-body', often=0.7)}>{r.choice(('', f'<h4>{words(1, 2)}</h4>', f'<b>{word()}</b>'))}<p>{prose(1, 6)}</p></{li}>" for _ in range(r.randint(1, 6)))
        return f"<{d}{attr('comments', 'comment-list', 'discussion', 'disqus_thread', 'responses', often=0.97)}>{r.choice(('', f'<h3>{words(1, 3)}</h3>'))}{each}{r.choice(('', form()))}</{d}>"

    def footer() -> str:
        inside = r.choice((f"{r.choice(('&copy;', '&#169;', 'Copyright', ''))} {words(1, 4)}{r.choice((' |', '.', ' &ndash;', ''))} {prose(0, 3)}", f"<p>{prose(1, 2)}</p>", f"<ul>{links(2, 6)}</ul><p>{words(2, 8)}</p>"))
        return f"<footer{attr('footer', 'foot', often=0.3)}>{inside}</footer>" if r.random() < 0.65 else f"<div{attr('footer', 'site-footer', 'copyright', often=0.95)}>{inside}</div>"

    def header() -> str:
        inside = r.choice(("", f"<h1>{words(1, 3)}</h1>", f"<p>{words(2, 6)}</p>", f"<div{attr('logo', 'tagline', often=0.6)}>{words(1, 5)}</div>")) + r.choice(("", nav()))
        return f"<header{attr('header', 'masthead', 'site-header', often=0.4)}>{inside}</header>" if r.random() < 0.7 else f"<div{attr('header', 'masthead', 'top', often=0.95)}>{inside}</div>"

    def block() -> str:
        k, m = r.random(), " data-main"
        if k < 0.62:
            text = prose(1, 8) if r.random() < 0.85 else words(1, 3).strip(",").capitalize() + r.choice((".", "", "!", "?"))
            text = text if r.random() < 0.8 else (f"<{(b := r.choice(('b', 'i', 'em', 'strong', 'span', 'font')))}>{text}" + r.choice((f"</{b}>", "", "<br>", f"<br></{b}>"))) if r.random() < 0.3 else text.replace(" ", f' <a href="/{word()}">{word()}</a> ', 1)
            return f"<p{m}>{text}{'</p>' if r.random() < 0.9 else ''}"
        if k < 0.72:
            return f"<h2{m}>{words(1, 7)}</h2>"
        if k < 0.8:
            tag = r.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li{m}>{words(2, 20)}</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>"
        if k < 0.86:
            return f"<blockquote><p{m}>{prose(1, 3)}</p></blockquote>"
        if k < 0.9:
            return f"<figure><img src=x><figcaption{m}>{words(3, 12)}</figcaption></figure>"
        if k < 0.93:
            return "<table>" + "".join(f"<tr><td{m}>{words(1, 4)}</td><td{m}>{words(1, 4)}</td></tr>" for _ in range(r.randint(2, 5))) + "</table>"
        if k < 0.95:
            return f"<pre{m}>{words(3, 30)}</pre>"
        if k < 0.975:
            return ad()
        return f"<div{attr('share', 'social', 'related', 'tags', 'newsletter', often=0.95)}>{r.choice((f'<ul>{links(2, 5)}</ul>', words(2, 6), form()))}</div>"

    def article() -> str:
        head = f"<h1 data-main>{words(2, 12)}</h1>" if r.random() < 0.85 else ""
        n = r.choice((0, 1, 1, 2, 3, 4, 6, 9, 14, 25))
        body = f"<p data-main>{prose(1, 9)}</p>" + "".join(block() for _ in range(n))
        if r.random() < 0.15:
            body = f"<div{attr('content', 'entry', 'body', often=0.5)}>{body}</div>"
        d = r.choice(("article", "article", "article", "main", "div", "section"))
        return f"<{d}{attr('content', 'post', 'entry-content', 'story', 'article-body', 'main', 'text', often=0.35 if d in ('article', 'main') else 0.8)}>{head}{body}</{d}>"

    some = lambda f, p: f() if r.random() < p else ""
    middle = [article(), some(talk, 0.4)]
    if r.random() < 0.4:
        middle.insert(r.choice((0, 1, 2)), side())
    inside = "".join(middle)
    if r.random() < 0.35:
        d = r.choice(("div", "main", "div"))
        inside = f"<{d}{attr('wrapper', 'container', 'page', 'layout', often=0.6)}>{inside}</{d}>"
    body = some(header, 0.5) + some(nav, 0.6) + some(notice, 0.35) + some(ad, 0.4) + some(form, 0.15) + inside + some(ad, 0.2) + some(form, 0.15) + some(footer, 0.85) + some(notice, 0.08)
    if r.random() < 0.25:
        body = f"<div{attr('page', 'site', 'wrapper', often=0.5)}>{body}</div>"
    tail = "</body></html>" if r.random() < 0.85 else ""
    heads = (f"<title>{words(1, 9)}</title>", '<meta charset="utf-8">', f"<style>.{word()} > a {{color: red}}</style>", f"<script>if (a < b) document.write('<div>{words(1, 4)}</div>');</script>", '<link rel="icon" href="/i.png">')
    head = "".join(r.sample(heads, r.randint(0, len(heads))))
    return f"{r.choice(('<!DOCTYPE html>', ''))}<html>{r.choice((f'<head>{head}</head>', f'<head>{head}', ''))}<body>{body}{tail}"


_MARKED = re.compile(r" data-main(?=[ >])")


def labelled(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of made pages: 1 if there is main text in the node."""
    r, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        made = page(r)
        t = parse(_MARKED.sub("", made))
        marked = parse(_MARKED.sub(' class="data-main"', made))
        y = np.zeros(len(t.parent))
        for i in range(len(t.parent) - 1, 0, -1):
            if marked.tag[i] == "#text" and marked.attrs[marked.parent[i]] == "data-main":
                y[i] = 1
            if y[i]:
                y[t.parent[i]] = 1
        xs.append(features(t))
        ys.append(y)
    return np.concatenate(xs), np.concatenate(ys)


@lru_cache(maxsize=2)
def model(pages: int = 900, seed: int = 7) -> Forest:
    return fit(*labelled(pages, seed))


def decode(parent: list[int], z: np.ndarray) -> np.ndarray:
    """The most likely labels in which a kept node's parent is kept. z: log-odds of nodes."""
    yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
    n = len(parent)
    keep, drop = yes.copy(), no.copy()
    for i in range(n - 1, 0, -1):
        p = parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = np.zeros(n, bool)
    out[0] = keep[0] >= drop[0]
    for i in range(1, n):
        out[i] = out[parent[i]] and keep[i] >= drop[i]
    return out


def main_texts(pages: list[str | None], forest: Forest) -> list[str]:
    trees = [parse(p) if p else None for p in pages]
    xs = [features(t) for t in trees if t]
    z = forest.raw(np.concatenate(xs)) if xs else np.zeros(0)
    out, at = [], 0
    for t in trees:
        if t is None:
            out.append("")
            continue
        n = len(t.parent)
        kept = decode(t.parent, z[at : at + n])
        at += n
        out.append("\n\n".join(x for x, k in zip(t.text, kept) if k and x))
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", batch: int = 256) -> DataFrame:
    """Per row: id, url, text, n_chars."""
    forest = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), batch):
                part = b.slice(i, batch)
                texts = main_texts(part.column(2).to_pylist(), forest)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    made = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
    return made.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
