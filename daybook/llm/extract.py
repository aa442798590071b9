"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded from the root down.

A page is parsed into a tree of elements and text runs. Each node has
features of its subtree (text, density, links), its attributes' tokens, its
depth, siblings and ancestors. Boosted trees give each node the probability
that it holds, or lies in, the article. Decoding takes the most probable set
of kept nodes in which a kept node's parent is kept as well: dropping a node
drops all below it, so an ancestor and its descendants can't contradict one
another. The kept text runs are the text.

Training: pages have no labels, so ``TRAIN_PAGES`` pages (a fixed sample, the
smallest hashes of html) lend their words to pages laid out anew with random
containers, names and order, where it is known what is article and what is
menu, notice, sidebar, advert, form, comment or footer. MLlib fits the trees;
they are a few thousand numbers and go to the tasks. Pages are independent: no
shuffle beyond the sample's.

Defined results: null and empty html, and pages without article text, give the
empty string. Broken markup is read as far as it goes: unclosed elements end
with their parent, unknown end tags are skipped, an unfinished character
reference stays as it stands. Repeated pages give equal rows. If no page has a
word there is nothing to train on and every text is empty.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, fresh, prepared_session, staged, table

TRAIN_PAGES, LAYOUTS, TREES, DEPTH, STEP, SEED = 200, 4, 25, 5, 0.2, 17

# Element names by their role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"head", "script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "title", "textarea", "select"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: Elements that stand inside a word without parting it and end no paragraph.
SILENT = {"wbr", "script", "style", "template", "noscript", "link", "meta"}
ROLES = [
    {"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "button", "label", "input", "dialog"},
    {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd"}, {"a"}, {"div", "section", "span"},
    {"table", "tr", "td", "th", "tbody"}, {"html", "body"},
]
#: Parts of class, id and role names.
GOOD = "article body content entry main post story text".split()
BAD = ("ad ads advert advertisement banner breadcrumb byline comment comments consent cookie cookies copyright disqus flash foot footer form gdpr head header login menu "
       "message meta modal nav navbar navigation newsletter notice pager pagination popup privacy promo promotion recommended related reply respond "
       "search share sharing sidebar signup social sponsor sponsored subscribe tags teaser toolbar top widget").split()
BUCKETS = 16

# A quote opens a value only after "=", as in browsers; any other is part of a name. What has no end ends with the page.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
IN_HEAD = {"meta", "link", "script", "style", "title", "base", "noscript", "template"}
BREAKS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "aside", "nav", "header", "footer", "form", "body", "html", "blockquote"}


@dataclass
class Page:
    """Nodes in page order; a node's parent comes before it. ``text`` is None for elements."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    tokens: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    label: list[int | None] = field(default_factory=list)
    #: White space came right before the node, be it kept or not.
    gap: list[bool] = field(default_factory=list)
    blank: bool = False

    def add(self, tag: str, parent: int, tokens: list[str], text: str | None, label: int | None) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.tokens.append(tokens)
        self.text.append(text)
        self.label.append(label)
        self.gap.append(self.blank)
        self.blank = False
        return len(self.tag) - 1


def attribute_tokens(raw: str, labelled: bool) -> tuple[list[str], int | None]:
    tokens, label = [], None
    for name, value in ATTR.findall(raw):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", value.strip("\"'"))
            tokens += re.findall(r"[a-z]+", spaced.lower())
        elif labelled and name == "data-label":
            label = int(value.strip("\"'"))
    return tokens, label


def parse(source: str, labelled: bool = True) -> Page:
    """Tree of a page. ``labelled`` is for generated layouts: on an input page data-label may be anything and is not read."""
    page = Page()
    open_ = [page.add("#root", -1, [], None, None)]
    at, end, hidden = 0, len(source), 0

    def run(text: str) -> None:
        if text and text.isspace():
            page.blank = True
        if text and not hidden and not text.isspace():
            page.add("#text", open_[-1], [], entities.unescape(text), None)
        elif text and not hidden and page.text[-1] is not None:
            page.text[-1] += " "

    def close(n: int) -> None:
        nonlocal hidden
        while len(open_) > n:
            hidden -= page.tag[open_.pop()] in HIDDEN

    while at < end:
        m = TAG.search(source, at)
        if m is None:
            run(source[at:])
            break
        run(source[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        name = m.group(2).lower()
        if m.group(1):
            for k in range(len(open_) - 1, 0, -1):
                if page.tag[open_[k]] == name:
                    close(k)
                    break
            continue
        if name not in IN_HEAD and page.tag[open_[-1]] == "head":
            close(len(open_) - 1)
        broken = BREAKS.get(name) or ({"p"} if name not in INLINE and name not in VOID and name not in SILENT else ())
        if broken:
            for k in range(len(open_) - 1, 0, -1):
                t = page.tag[open_[k]]
                if t in broken:
                    close(k)
                    break
                if t in SCOPE:
                    break
        tokens, label = attribute_tokens(m.group(3), labelled) if m.group(3) else ([], None)
        node = page.add(name, open_[-1], tokens, None, label)
        if name in VOID or m.group(3).endswith("/") and name not in INLINE | SCOPE | {"p"}:
            continue
        open_.append(node)
        hidden += name in HIDDEN
        if name in RAW:
            stop = re.compile(rf"</{name}\b", re.I).search(source, at)
            at = stop.start() if stop else end
    return page


# -------------------------------------------------------------------- features

_ROLE = {t: i for i, ts in enumerate(ROLES) for t in ts}
_GOOD, _BAD = set(GOOD), set(BAD)
_EXCLUDING = {1, 2, 3, 4, 5}
N_FEATURES = len(ROLES) + 22 + BUCKETS


def bucket(token: str) -> int:
    """A fixed place for an attribute token."""
    return sum(ord(c) * (i + 1) for i, c in enumerate(token)) % BUCKETS


def features(page: Page) -> np.ndarray:
    n = len(page.tag)
    parent = page.parent
    out = np.zeros((n, N_FEATURES), np.float32)
    chars, links, marks, tags, kids = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    depth, order, before = [0] * n, [0] * n, [0] * n
    good, bad, role_up, in_main, in_link = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    seen = 0
    for i in range(n):
        p = parent[i]
        role = _ROLE.get(page.tag[i], -1)
        own_good = sum(t in _GOOD for t in page.tokens[i])
        own_bad = sum(t in _BAD for t in page.tokens[i])
        before[i] = seen
        if p >= 0:
            depth[i], order[i] = depth[p] + 1, kids[p]
            kids[p] += 1
            good[i], bad[i] = good[p] + (own_good > 0), bad[p] + (own_bad > 0)
            role_up[i] = role_up[p] + (role in _EXCLUDING)
            in_main[i] = in_main[p] or role == 0
            in_link[i] = in_link[p] or role == 9
        text = page.text[i]
        if text is not None:
            chars[i] = len(text)
            links[i] = len(text) if in_link[i] else 0
            marks[i] = text.count(",") + text.count(".")
            seen += len(text)
        else:
            tags[i] = 1
        row = out[i]
        if role >= 0:
            row[role] = 1
        row[-BUCKETS - 1], row[-BUCKETS - 2] = own_good, own_bad
        for t in page.tokens[i]:
            row[N_FEATURES - BUCKETS + bucket(t)] = 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        tags[p] += tags[i]
    total = max(1, chars[0])
    c, up = np.array(chars, np.float64), np.maximum(np.array(parent), 0)
    k = len(ROLES)
    siblings = np.maximum(1, np.array(kids)[up])
    columns = [
        [t is not None for t in page.text], depth, np.log1p(c), c / total, np.array(links) / np.maximum(1, c), np.log1p(c / np.maximum(1, tags)),
        np.array(marks) / np.maximum(1, c), np.log1p(kids), np.array(order) / siblings, siblings, np.array(before) / total,
        good, bad, role_up, in_main, np.log1p(c[up]), c / np.maximum(1, c[up]), np.array(links)[up] / np.maximum(1, c[up]),
        [_ROLE.get(page.tag[p], -1) if p >= 0 else -1 for p in parent], np.log1p(tags),
    ]
    for j, values in enumerate(columns):
        out[:, k + j] = values
    return out


# ----------------------------------------------------------------- boosted trees

def tree_arrays(node) -> tuple[list[int], list[float], list[int], list[int], list[float]]:
    """A fitted tree as arrays: feature (-1: leaf), threshold, left, right, value."""
    feature, threshold, left, right, value = [], [], [], [], []

    def walk(x) -> int:
        at = len(feature)
        for xs, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, float(x.prediction()))):
            xs.append(v)
        if "InternalNode" in x.getClass().getName():
            split = x.split()
            feature[at], threshold[at] = split.featureIndex(), split.threshold()
            left[at], right[at] = walk(x.leftChild()), walk(x.rightChild())
        return at

    walk(node)
    return feature, threshold, left, right, value


@dataclass
class Forest:
    trees: list[tuple]
    weights: list[float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.zeros(len(x)), np.arange(len(x))
        for w, (feature, threshold, left, right, value) in zip(self.weights, self.trees):
            f, t, lo, hi, v = (np.array(a) for a in (feature, threshold, left, right, value))
            at = np.zeros(len(x), np.int64)
            while (f[at] >= 0).any():
                inner = f[at] >= 0
                goes_left = x[rows, np.maximum(f[at], 0)] <= t[at]
                at = np.where(inner, np.where(goes_left, lo[at], hi[at]), at)
            margin += w * v[at]
        return 1 / (1 + np.exp(-2 * margin))


def layout(rnd: random.Random, words: list[str]) -> str:
    """A page of known parts: elements with data-label 1 are article, with 0 are not."""
    pick = rnd.choice

    def prose(lo: int, hi: int) -> str:
        return entities.escape(" ".join(pick(words) for _ in range(rnd.randint(lo, hi))).capitalize()) + "."

    def linked(lo: int, hi: int) -> str:
        items = [f'<a href="/{i}">{prose(1, 4)}</a>' for i in range(rnd.randint(lo, hi))]
        return pick(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items), "".join(f"<p>{x}</p>" for x in items)])

    def named(tags: list[str], names: list[str], inner: str, label: int) -> str:
        tag, name = pick(tags), pick([*names, ""])
        attr = f' {pick(["class", "id"])}="{name}{pick(["", "", " box", "-wrap", " x1"])}"' if name or tag in ("div", "section") else ""
        return f'<{tag}{attr if name else (f" class={names[0]}" if tag in ("div", "section") else "")} data-label="{label}">{inner}</{tag}>'

    para = lambda: "".join(pick(["<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<p>{} <a href='/x'>more</a></p>", "<blockquote>{}</blockquote>", "<p><em>{}</em></p>"]).format(
        " ".join(prose(4, 20) for _ in range(pick([1, 1, 3, 6, 12]))))
        for _ in range(pick([1, 1, 2, 4, 8])))
    body = pick(["<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", ""]).format(prose(2, 9)) + para()
    body += pick(["", "", f"<h2>{prose(2, 5)}</h2>{para()}", "<ul>" + "".join(f"<li>{prose(3, 12)}</li>" for _ in range(4)) + "</ul>"])
    inside = [
        lambda: named(["div"], ["ad", "advert", "sponsored", "promo", "ads banner"], prose(3, 20), 0),
        lambda: named(["div", "section"], ["share", "social", "sharing toolbar"], linked(2, 4), 0),
        lambda: named(["aside", "div"], ["related", "recommended", "widget"], linked(2, 6), 0),
        lambda: named(["form", "div"], ["newsletter", "subscribe", "signup form"], f"{prose(3, 9)}<input name=e><button>{prose(1, 2)}</button>", 0),
    ]
    comments = lambda: named(["section", "div"], ["comments", "comment-list", "disqus", "respond"], "".join(
        f'<div class="{pick(["comment", "reply", "c"])}"><p>{prose(4, 30)}</p></div>' for _ in range(rnd.randint(1, 5))), 0)
    if rnd.random() < 0.4:
        body += pick(inside)()
    if rnd.random() < 0.2:
        body += comments()
    article = named(*pick([(["article"], ["post", "entry"]), (["article"], [""]), (["main"], ["content"]), (["div"], ["content", "post", "entry-content", "article-body", "story", "main text"])]), body, 1)
    notice = lambda: named(["div", "section"], ["cookie-notice", "notice", "consent banner", "gdpr popup", "message"], f"<p>{prose(5, 30)}</p>", 0)
    before = [
        lambda: named(["nav", "div"], ["menu", "navbar", "navigation", "breadcrumb"], linked(2, 8), 0),
        lambda: named(["header", "div"], ["header", "site-header", "top head"], f"<h1>{prose(1, 4)}</h1>" + pick(["", linked(2, 5)]), 0),
        notice, *inside,
    ]
    after = [
        lambda: named(["aside", "div"], ["sidebar", "widget", "related"], pick([linked(2, 8), f"<h3>{prose(1, 3)}</h3><p>{prose(5, 25)}</p>"]), 0),
        comments, notice, *inside, lambda: named(["div", "p"], ["meta", "tags", "copyright"], prose(3, 12), 0),
    ]
    top = [x() for x in rnd.sample(before, rnd.randint(0, 4))]
    bottom = [x() for x in rnd.sample(after, rnd.randint(0, 4))]
    foot = named(["footer", "footer", "div"], ["footer", "site-footer", "foot copyright"], f"&copy; {prose(1, 20)}" + pick(["", linked(1, 4)]), 0) if rnd.random() < 0.85 else ""
    middle = article
    if rnd.random() < 0.3:
        middle = f'<div class="{pick(["wrap", "container", "page", "row"])}">{article}{"".join(bottom)}</div>'
        bottom = []
    page = "".join(top) + middle + "".join(bottom) + foot
    return f"<html><head><title>{prose(2, 6)}</title></head><body>{page}" + pick(["</body></html>", ""])


def labels(page: Page) -> np.ndarray:
    """1 for nodes in the article or with article text below them."""
    n = len(page.tag)
    inherited, out = [0] * n, np.zeros(n)
    for i in range(1, n):
        inherited[i] = page.label[i] if page.label[i] is not None else inherited[page.parent[i]]
        out[i] = inherited[i]
    for i in range(n - 1, 0, -1):
        if out[i] and page.label[i] != 0:
            out[page.parent[i]] = 1
    return out


def fit(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> Forest | None:
    """Trees fitted on layouts that borrow the words of ``train_pages`` pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    prepared_session(pages.sparkSession)
    source = pages.select(col(html).alias("html")).where("length(html) > 0")
    hashed = source.withColumn("h", F.xxhash64("html"))
    # copies of a page count once
    least = hashed.select("h").distinct().orderBy("h").limit(train_pages)
    sample = hashed.join(F.broadcast(least), "h", "left_semi").dropDuplicates(["h", "html"])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source_, h in zip(batch["html"], batch["h"]):
                words = " ".join(t for t in parse(source_, labelled=False).text if t).split()[:4000]
                for k in range(LAYOUTS if words else 0):
                    page = parse(layout(random.Random(int(h) * 31 + k), words))
                    yield pd.DataFrame({"x": list(features(page).astype(float)), "label": labels(page)})

    nodes = staged(sample.repartition(8, "h").mapInPandas(rows, "x array<double>, label double"), "dom-nodes")
    if nodes.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=32, cacheNodeIds=False)
    model = trees.fit(nodes.select(array_to_vector("x").alias("features"), "label"))
    return Forest([tree_arrays(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))


# -------------------------------------------------------------------- decoding

def decode(page: Page, probability: np.ndarray) -> list[bool]:
    """The most probable kept set in which every kept node's parent is kept."""
    n = len(page.tag)
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p).tolist(), np.log1p(-p).tolist()
    keep[0] = 0.0  # the root is no choice
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and keep[i] > drop[i]
    return kept


def main_text(page: Page, kept: list[bool]) -> str:
    """Kept text runs; elements that are not inline part blocks, and a blank stands between blocks."""
    out: list[str] = []
    block = -1
    for i in range(1, len(page.tag)):
        if page.gap[i]:
            out.append(" ")
        if page.text[i] is None:
            if page.tag[i] not in INLINE and page.tag[i] not in SILENT:
                out.append(" ")
        elif kept[i]:
            up = page.parent[i]
            while up > 0 and page.tag[up] in INLINE:
                up = page.parent[up]
            if up != block:
                out.append(" ")
                block = up
            out.append(page.text[i])
    return " ".join("".join(out).split())


def extract(pages: DataFrame, forest: Forest | None, html: str = "html") -> DataFrame:
    """Append ``text`` and ``n_chars``; clashing input columns are replaced."""
    spark = prepared_session(pages.sparkSession)
    shared = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("text string, n_chars long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        for part in parts:
            out = []
            values = part.tolist()
            for at in range(0, len(values), 64):
                parsed = [parse(v, labelled=False) if v else None for v in values[at : at + 64]]
                found = [features(p) for p in parsed if p is not None]
                odds = trees.probability(np.concatenate(found)) if trees and found else np.zeros(sum(map(len, found)))
                start = 0
                for p in parsed:
                    text = ""
                    if p is not None:
                        n = len(p.tag)
                        if trees:
                            text = main_text(p, decode(p, odds[start : start + n]))
                        start += n
                    out.append((text, len(text)))
            yield pd.DataFrame(out, columns=["text", "n_chars"])

    own = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    name = fresh(pages, "main_text")
    out = pages.select(*[col(c) for c in own], run(col(html)).alias(name))
    return out.select(*[col(c) for c in own], F.col(name)["text"].alias("text"), F.col(name)["n_chars"].alias("n_chars"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages)).select("page_id", "url", "text", "n_chars")
