"""Main text of web pages: boosted trees over DOM nodes, then the best consistent choice of nodes.

Each element has features of its subtree (text, links, density, punctuation), its place (depth, position, siblings)
and the words of its tag and attributes, also those of its ancestors.  Boosted trees give the probability that an
element is kept.  A kept element has a kept parent; among all choices that hold to this, the likeliest one is taken
by a pass up and a pass down the tree.

There are no labelled pages, so the trees are trained on pages of the table with foreign blocks grafted in: menus,
notices, adverts, forms, side bars and comments whose place is known, made of the page's own words, in varying
tags and with or without telling attributes.  The sample's size is a parameter.

Defined cases: null and empty pages, and pages without kept text, have an empty text; an unfinished tag at the end is
dropped; unclosed elements end with their parent, pictures and players that nothing closes at the next block; what is never shown (scripts, styles, templates, the head) is never
text; repeated rows give repeated rows; without pages nothing is trained and the result is empty.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.words import slices

#: Pages that are trained on, about, and variants of each: a bound on what one task holds.
SAMPLE, VARIANTS = 240, 4
TREES, DEPTH, BINS, RATE = 60, 4, 32, 0.2

# Elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe svg title select textarea datalist audio video canvas".split())
#: Of these, what ends at the next block if nothing closes it further on.
LOOSE = frozenset("svg audio video canvas".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option".split())
#: What an opening element closes, up to the nearest element of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
SCOPE = frozenset("table td th caption button object template html".split())

#: Words of attributes (class, id, role, aria-label) by what they tell.
TELLING = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager toc skip sitemap",
    "header": "header masthead topbar branding logo hero top",
    "footer": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside rail widget widgets complementary related recommended recommendations popular trending latest more also teaser",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner dfp outbrain taboola affiliate",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall privacy disclaimer",
    "form": "form search searchbox login signin register contact input",
    "comment": "comment comments commentlist reply replies respond disqus discussion thread reactions reviews",
    "share": "share sharing social follow tweet facebook twitter whatsapp tags tag meta byline author print",
    "content": "content article post entry body main story text page maincontent articlebody prose markdown",
}
_KIND = {w: i for i, words in enumerate(TELLING.values()) for w in words.split()}
_TAG_KIND = {"nav": 0, "menu": 0, "header": 1, "footer": 2, "aside": 3, "dialog": 5, "form": 6, "fieldset": 6, "search": 6, "article": 9, "main": 9}
_TAGS = ({"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "li", "dd", "dt"}, {"a"}, {"div", "section"}, {"table", "tr", "td", "th", "tbody"})
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNFINISHED = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
_MARKS = re.compile(r"[.,;:!?]")


class Tree(HTMLParser):
    """Elements of a page in order, and its text by block."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.words, self.marked = ["#"], [-1], [0], [None]
        #: (element, text) in page order; None ends a block.
        self.pieces: list[tuple[int, str] | None] = []
        self.open = [0]
        #: Where elements of each tag, blocks, and bounds of scopes are among the open ones, so that none is sought.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.hidden = 0
        lower = html.lower()
        self.closing = {tag: lower.count(f"</{tag}") for tag in LOOSE}
        #: Open elements that hide what follows and that nothing closes.
        self.loose: list[int] = []
        tail = _UNFINISHED.search(html)
        self.feed(html[:tail.start()] if tail else html)
        self.close()

    def _pop(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.hidden -= self.tag[node] in HIDDEN
            self.places[self.tag[node]].pop()
        del self.open[depth:]
        for places in (self.blocks, self.scopes, self.loose):
            while places and places[-1] >= depth:
                places.pop()

    def _push(self, node: int) -> None:
        tag, place = self.tag[node], len(self.open)
        self.open.append(node)
        self.places.setdefault(tag, []).append(place)
        self.hidden += tag in HIDDEN
        if tag in BLOCK:
            self.blocks.append(place)
        if tag in SCOPE:
            self.scopes.append(place)
        if tag in LOOSE and not self.closing[tag]:
            self.loose.append(place)

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of a tag, 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.pieces.append(None)
            if self.loose:
                self._pop(self.loose[0])
            if self._last("p") > (self.scopes[-1] if self.scopes else 0):
                self._pop(self._last("p"))
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            bound = max(map(self._last, within))
            # The outermost element that ends, inside of the bound.
            cut = min((places[at] for places in map(self.places.get, ends) if places and (at := bisect_right(places, bound)) < len(places)), default=0)
            if cut:
                self._pop(cut)
        kinds, mark = 0, None
        for key, value in attrs:
            if key in ("class", "id", "role", "aria-label") and value:
                for word in _TOKEN.findall(value):
                    kind = _KIND.get(word.lower())
                    if kind is not None:
                        kinds |= 1 << kind
            elif key == "data-graft":
                mark = value
        if tag in _TAG_KIND:
            kinds |= 1 << (10 + _TAG_KIND[tag])
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.words.append(kinds)
        self.marked.append(mark)
        if tag == "br":
            self.pieces.append((self.open[-1], " "))
        if tag not in VOID:
            self._push(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.pieces.append(None)
        if tag in LOOSE:
            self.closing[tag] -= 1
        at = self._last(tag)
        if at and (tag in BLOCK or not self.blocks or at > self.blocks[-1]):
            self._pop(at)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.pieces.append((self.open[-1], data))


FEATURES = 19 + 10 + 10 + len(_TAGS) + 1 + 20


def features(tree: Tree) -> np.ndarray:
    """One row for each element."""
    n = len(tree.tag)
    parent = np.array(tree.parent)
    chars, marks, count, spaces = (np.zeros(n) for _ in range(4))
    before = np.zeros(n)
    total, seen = 0.0, -1
    for piece in tree.pieces:
        if piece is None:
            continue
        node, text = piece
        size = len(text.strip())
        if node > seen:
            before[seen + 1:node + 1] = total
            seen = node
        chars[node] += size
        if size:
            marks[node] += len(_MARKS.findall(text))
            spaces[node] += text.count(" ")
        total += size
    before[seen + 1:] = total
    is_link = np.array([t == "a" for t in tree.tag], float)
    is_p = np.array([t in ("p", "blockquote", "pre") for t in tree.tag], float)
    is_field = np.array([t in ("input", "select", "textarea", "button", "label") for t in tree.tag], float)
    link_chars = np.where(is_link > 0, chars, 0.0)
    count += 1
    subtree = np.stack([chars, marks, count, spaces, is_link, is_p, is_field, link_chars])
    own = subtree[0].copy()
    depth, children, place = np.zeros(n), np.zeros(n), np.zeros(n)
    above = np.zeros(n, np.int64)
    words = np.array(tree.words)
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        place[i] = children[p]
        children[p] += 1
        above[i] = above[p] | words[p]
    inside_link = np.zeros(n, bool)
    for i in range(1, n):
        inside_link[i] = inside_link[parent[i]] or tree.tag[parent[i]] == "a"
    subtree[7] += np.where(inside_link, chars, 0.0)
    for i in range(n - 1, 0, -1):
        subtree[:, parent[i]] += subtree[:, i]
    text, mark, nodes, blanks, links, paragraphs, fields, linked = subtree
    up = np.maximum(parent, 0)
    page = max(total, 1.0)
    safe = np.maximum(text, 1.0)
    columns = [depth, children, place, children[up], np.log1p(text), np.log1p(linked), linked / safe, text / nodes, mark / safe, blanks / safe, np.log1p(paragraphs), np.log1p(links), np.log1p(fields),
               text / page, text / np.maximum(text[up], 1.0), before / page, np.log1p(own), np.log1p(nodes), text[up] / page]
    columns += [(words >> k & 1).astype(float) for k in range(20)]
    columns += [np.array([t in group for t in tree.tag], float) for group in _TAGS]
    columns.append(np.array([t in HIDDEN for t in tree.tag], float))
    columns += [(above >> k & 1).astype(float) for k in range(20)]
    return np.stack(columns, 1).astype(np.float32)


def labels(tree: Tree) -> np.ndarray:
    """1 for elements of the main text or around it; for pages with grafted marks ("main", "other")."""
    n = len(tree.tag)
    inside = np.full(n, -1)
    for i in range(1, n):
        mark = tree.marked[i]
        inside[i] = 1 if mark == "main" else 0 if mark == "other" or tree.tag[i] in HIDDEN else inside[tree.parent[i]]
    kept = inside == 1
    for i in range(n - 1, 0, -1):
        if kept[i]:
            kept[tree.parent[i]] = True
    kept[0] = True
    return kept.astype(float)


_MAIN = re.compile(r"<article\b[^>]*>(.*?)(?:</article>|\Z)", re.S)
_MENUS = re.compile(r"<(nav|footer|header|aside|form)\b|<(div|section)(?=[^>]*class=\"(?:" + "|".join(sorted({w for k, v in TELLING.items() if k != "content" for w in v.split()}, key=len, reverse=True)) + r")\")")
_TAG = re.compile(r"<[^>]*>")


def grafted(html: str, seed: int) -> str | None:
    """A page with known main text and foreign blocks of known place, or None for a page without an article."""
    body = _MAIN.search(html)
    if not body:
        return None
    rng = random.Random(seed)
    words = _TAG.sub(" ", body[1]).split() or ["a"]

    def some(a: int, b: int) -> str:
        at = rng.randrange(len(words))
        return " ".join(words[at:at + rng.randint(a, b)]) or words[0]

    def name(kind: str) -> str:
        if rng.random() < 0.15:
            return rng.choice(("", ' class="box"', ' id="x1"', ' class="c-3 wrap"'))
        word = rng.choice(TELLING[kind].split())
        return f' {rng.choice(("class", "id", "class"))}="{rng.choice(("", "site-", "js-", "main-" if kind != "content" else ""))}{word}{rng.choice(("", "-box", " wide", "-wrapper"))}"'

    def block(kind: str) -> str:
        tag = rng.choice({"menu": ("nav", "div", "ul", "nav"), "header": ("header", "div"), "footer": ("footer", "div"), "side": ("aside", "div", "section"), "form": ("form", "div"), "comment": ("section", "div", "ol")}.get(kind, ("div", "section", "aside")))
        item = "li" if tag in ("ul", "ol") else "div"
        if kind in ("menu", "share") or kind in ("side", "footer", "header") and rng.random() < 0.6:
            inner = "".join(f"<{item}><a href='/x'>{some(1, 6)}</a></{item}>" for _ in range(rng.randint(2, 9)))
        elif kind == "form":
            inner = f"<label>{some(1, 3)}</label><input name=q><button>{some(1, 2)}</button><p>{some(2, 12)}</p>"
        elif kind == "comment":
            inner = f"<h3>{some(1, 3)}</h3>" + "".join(f"<{item}{name('comment')}><b>{some(1, 2)}</b><p>{some(4, 50)}</p><a href='#'>{some(1, 1)}</a></{item}>" for _ in range(rng.randint(1, 6)))
        elif kind == "notice":
            inner = f"<p>{some(6, 40)}</p><button>{some(1, 2)}</button><a href='/p'>{some(1, 3)}</a>"
        else:
            inner = f"<p>{some(3, 30)}</p>" if rng.random() < 0.6 else some(3, 30)
        if kind in ("header",) and rng.random() < 0.5:
            inner = f"<h1>{some(1, 5)}</h1>" + inner
        return f'<{tag}{name(kind)} data-graft="other">{inner}</{tag}>'

    def blocks(kinds: str, most: int) -> str:
        return "".join(block(rng.choice(kinds.split())) for _ in range(rng.randint(0, most)))

    # The page's own text, cut into blocks of several kinds.
    main, parts = body[1], re.split(r"(?=<p\b|<h\d\b)", body[1])
    if rng.random() < 0.5 and len(parts) > 1:
        more = []
        for part in parts:
            roll = rng.random()
            more.append(f"<ul><li>{some(3, 15)}</li><li>{some(3, 15)}</li></ul>" if roll < 0.08 else f"<h2>{some(1, 6)}</h2>" if roll < 0.16 else f"<blockquote>{some(5, 40)}</blockquote>" if roll < 0.2 else f"<table><tr><td>{some(1, 4)}</td><td>{some(1, 4)}</td></tr></table>" if roll < 0.24 else f"<p>{some(4, 60)} <a href='/l'>{some(1, 5)}</a> {some(4, 40)}</p>" if roll < 0.3 else "")
            more.append(part)
            if rng.random() < 0.06:
                more.append(block(rng.choice(("ad", "share", "side", "notice"))))
        main = "".join(more)
    if rng.random() < 0.25:
        main = f"<header><h1>{some(2, 9)}</h1></header>" + main
    roll = rng.random()
    tag, own = ("article", "") if roll < 0.5 else ("main", "") if roll < 0.62 else ("div", name("content")) if roll < 0.9 else ("section", name("content"))
    if rng.random() < 0.3:
        main = f"<div{name('content')}>{main}</div>"
    inside = blocks("comment share side ad", 2) if rng.random() < 0.3 else ""
    old = html[:body.start()]
    start = old.rfind("<body")
    lead = old[old.find(">", start) + 1:] if start >= 0 else ""
    tail = html[body.end():]
    lead, tail = (_MENUS.sub(lambda m: m[0] + ' data-graft="other"', x) for x in (lead, tail))
    if rng.random() < 0.4:
        lead = tail = ""
    return (f"<html><head><title>{some(1, 8)}</title></head><body>{blocks('header menu notice ad', 3)}{lead}{blocks('menu side ad form', 2)}"
            f'<{tag}{own} data-graft="main">{main}{inside}</{tag}>{blocks("comment side ad share form", 3)}{tail}{blocks("footer notice menu", 2)}</body></html>')


def boost(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Logistic gradient boosting of full trees over binned features."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)], 1)
    n, k = x.shape
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    z, inner = np.full(n, base), (1 << DEPTH) - 1
    feature, cut, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf, np.float32), np.zeros((TREES, 1 << DEPTH))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            key = ((at - first)[:, None] * k + np.arange(k)) * BINS + binned
            gs = np.bincount(key.ravel(), np.repeat(g, k), width * k * BINS).reshape(width, k, BINS).cumsum(2)
            hs = np.bincount(key.ravel(), np.repeat(h, k), width * k * BINS).reshape(width, k, BINS).cumsum(2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + 1) + (ga - gs)**2 / (ha - hs + 1) - ga**2 / (ha + 1)
            for j in range(width):
                f, b = divmod(int(gain[j].argmax()), BINS)
                if gain[j, f, b] > 1e-6 and b < len(edges[f]):
                    feature[t, first + j], cut[t, first + j] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] >= cut[t, at])
        at -= inner
        leaf[t] = -RATE * np.bincount(at, g, 1 << DEPTH) / (np.bincount(at, h, 1 << DEPTH) + 1)
        z += leaf[t][at]
    return {"feature": feature, "cut": cut, "leaf": leaf, "base": np.array(base)}


def log_odds(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    z, rows = np.full(len(x), float(model["base"])), np.arange(len(x))
    inner = model["feature"].shape[1]
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"], strict=True):
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, feature[at]] >= cut[at])
        z += leaf[at - inner]
    return z


def choose(parent: list[int], z: np.ndarray) -> np.ndarray:
    """The likeliest kept elements, where a kept element's parent is kept; the root is kept.

    Against dropping a whole subtree, keeping an element is worth its log odds and what is worth keeping below.
    """
    n = len(parent)
    worth = np.clip(z, -12, 12)
    for i in range(n - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parent[i]] and worth[i] > 0
    return kept


def text_of(tree: Tree, kept: np.ndarray) -> str:
    blocks, now = [], []
    for piece in [*tree.pieces, None]:
        if piece is not None:
            if kept[piece[0]]:
                now.append(piece[1])
        elif now:
            block = " ".join("".join(now).split())
            if block:
                blocks.append(block)
            now = []
    return "\n".join(blocks)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, marks = [], []
        for html, seed in zip(batch.column("html").to_pylist(), batch.column("rank").to_pylist(), strict=True):
            for variant in range(VARIANTS):
                made = grafted(html, seed * VARIANTS + variant)
                if made:
                    tree = Tree(made)
                    rows.append(features(tree).astype("<f4").tobytes())
                    marks.append(labels(tree).astype("u1").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(marks, pa.binary())], ["rows", "marks"])


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = pd.concat([*batches] or [pd.DataFrame({"rows": [], "marks": []})]).sort_values(["rows"], kind="stable")
    if len(frames):
        x = np.concatenate([np.frombuffer(r, "<f4").reshape(-1, FEATURES) for r in frames["rows"]])
        y = np.concatenate([np.frombuffer(m, "u1") for m in frames["marks"]]).astype(float)
        model = boost(x, y)
        yield pd.DataFrame({"feature": [model["feature"].astype("<i8").tobytes()], "cut": [model["cut"].astype("<f4").tobytes()], "leaf": [model["leaf"].astype("<f8").tobytes()], "base": [float(model["base"])]})


def train(pages: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """Trees of fixed size, from about ``sample`` pages; None where no page has an article to learn from."""
    some = pages.where("html is not null").select("html", F.xxhash64("html").alias("rank"))
    n = max(1, pages.count())
    chosen = some.where(F.abs(F.col("rank") % 1_000_000) < 900_000 * sample / n).limit(sample)
    rows = chosen.mapInArrow(_training, "rows binary, marks binary")
    found = rows.repartition(1).mapInPandas(_fit, "feature binary, cut binary, leaf binary, base double").first()  # at most one row
    if found is None:
        return None
    shape = (TREES, (1 << DEPTH) - 1)
    return {"feature": np.frombuffer(found["feature"], "<i8").reshape(shape), "cut": np.frombuffer(found["cut"], "<f4").reshape(shape), "leaf": np.frombuffer(found["leaf"], "<f8").reshape(TREES, -1), "base": np.array(found["base"])}


def main_text(html: str | None, model: dict[str, np.ndarray] | None) -> str:
    if not html:
        return ""
    tree = Tree(html)
    z = log_odds(model, features(tree)) if model else np.ones(len(tree.tag))
    return text_of(tree, choose(tree.parent, z))


def extract(pages: DataFrame, model: dict[str, np.ndarray] | None, id_column: str = "page_id") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for each row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            trees = [Tree(x) if x else None for x in batch.column("html").to_pylist()]
            rows = [features(t) for t in trees if t]
            z = (log_odds(shared.value, np.concatenate(rows)) if shared.value else np.ones(sum(map(len, rows)))) if rows else np.zeros(0)
            out, at = [], 0
            for tree in trees:
                n = len(tree.tag) if tree else 0
                out.append(text_of(tree, choose(tree.parent, z[at:at + n])) if tree else "")
                at += n
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_column).cast("long").alias("page_id"), F.col("url"), F.col("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
