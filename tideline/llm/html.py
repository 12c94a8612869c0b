"""Main text of web pages by template deduction from the distinct pages of the same host.

A page is a tree of elements and blocks of text. The tokens of a page are its elements, told apart by their place (the
elements around them and their names), and its texts, told apart by place and wording. Tokens of one host with the
same occurrence vector, the counts page by page, form an equivalence class. Classes that are frequent enough and
whose tokens nest in tokens of valid classes make the template of the host, a tree. What is not template fills slots
between its tokens. The smallest element of the template that encloses the slots of the article is the region of
the main text; template texts in it, such as a notice on every page, are no part of the article.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import BROADCAST_ROWS, slices
from tideline.session import stage

# Fixed values of HTML: elements without content, with raw content, inside lines; what closes what.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
NO_TEXT = frozenset("head nav footer aside form button select menu dialog object audio video canvas map".split()) | RAW
MAIN = frozenset({"article", "main"})
NO_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer menu "
    "modal nav navbar navigation newsletter notice notices popup promo related respond share sidebar social sponsor "
    "sponsored subscribe widget complementary contentinfo".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
INSIDE = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)

#: A host of fewer distinct pages has no template, and a class is frequent from this share of the pages on.
LEAST_PAGES = 2
SUPPORT = 0.5
#: Slots of at least this share of a host's text belong to the article, and headings.
SLOT_SHARE = 0.08
#: Texts are template from so many pages on, for a few pages may well quote the same; and none are if they are more than
#: this share of a host's text: then its pages are variants of one page.
LEAST_TEXT_PAGES, CONSTANT_SHARE = 4, 0.2
FLUSH = 100_000
TEMPLATES_MB = 64


def host_of(url: Column) -> Column:
    """Lower-cased host of an absolute URL, null if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(F.length(found) > 0, F.lower(found))


class Page:
    """A page as a tree: per element its parent, place and kind; per block its element and text, in page order.

    The scanner goes forward only: the end of a tag is looked for once, quotes are minded until they turn out not to
    be closed, and what is closed is known from the numbers of open elements. A place is a 64-bit digest of the
    place around it and the names of the element, so deep nesting costs no more than flat.
    """

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.place: list[int] = [0]
        self.tag: list[str] = [""]
        self.barred: list[int] = [0]  # 1: by its names, 2: by what it is
        self.blocks: list[tuple[int, str]] = []
        self._open: list[int] = [0]  # open elements; the block element of each; whether inside an article
        self._block: list[int] = [0]
        self._main: list[bool] = [False]
        self._count: Counter = Counter()
        self._text: list[str] = []
        self._read(source)

    def _read(self, source: str) -> None:
        at, last, quotes = 0, source.rfind(">"), True
        while at <= last and (found := START.search(source, at)):
            begin = found.start()
            if begin > last:
                break
            if begin > at:
                self._text.append(source[at:begin])
            if found[1]:
                end = source.find("-->", found.end())
                at = end + 3 if end >= 0 else len(source)
                continue
            inside = INSIDE.match(source, found.end()) if quotes else None
            if quotes and inside is None:
                quotes = False
            at = inside.end() if inside else source.index(">", found.end() - (found[3] is None)) + 1
            if not found[3]:
                continue
            tag = found[3].lower()
            if found[2]:
                self._close(tag)
            else:
                attributes = source[found.end() : at - 1]
                self._begin(tag, attributes)
                if tag in RAW and not attributes.endswith("/"):
                    end = _end_of(tag).search(source, at)
                    at = end.end() if end else len(source)
                    self._close(tag)
        if at < len(source):
            self._text.append(source[at:])
        self._end_block()

    def _end_block(self) -> None:
        if self._text:
            text = " ".join(references.unescape("".join(self._text)).split())
            self._text.clear()
            if text:
                self.blocks.append((self._block[-1], text))

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self._text.append(" ")
        else:
            self._end_block()
            if tag in CLOSES:
                self._pop_to(CLOSES[tag].split(), stop=_LISTS)
            elif tag not in ("html", "body", "head"):
                self._pop_to(("p",), stop=_BOXES)
        if tag in VOID:
            return
        names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)).lower() if attributes else ""
        around = self._open[-1]
        k = len(self.parent)
        self.parent.append(around)
        self.place.append(_digest(f"{self.place[around]}/{tag}.{names}"))
        self.tag.append(tag)
        self.barred.append(self._bar(tag, names, attributes))
        self._open.append(k)
        self._block.append(self._block[-1] if tag in INLINE and not self.barred[k] else k)
        self._main.append(self._main[-1] or tag in MAIN)
        self._count[tag] += 1

    def _bar(self, tag: str, names: str, attributes: str) -> int:
        if tag in NO_TEXT or (tag == "header" and not self._main[-1]) or (attributes and HIDDEN.search(attributes)):
            return 2
        if not names or tag in MAIN or tag in ("html", "body"):
            return 0
        words = WORDS.findall(names)
        return int(not NO_TEXT_WORDS.isdisjoint(words) or (words == ["header"] and not self._main[-1]))

    def _cut(self, k: int) -> None:
        for tag in map(self.tag.__getitem__, self._open[k:]):
            self._count[tag] -= 1
        del self._open[k:], self._block[k:], self._main[k:]

    def _close(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        if self._count[tag]:
            k = len(self._open) - 1
            while self.tag[self._open[k]] != tag:
                k -= 1
            self._cut(k)

    def _pop_to(self, tags: Iterable[str], stop: frozenset) -> None:
        if not any(self._count[t] for t in tags):
            return
        k = len(self._open) - 1
        while k > 0:
            # Open elements inside a line are passed over by way of the block they stand in.
            tag = self.tag[self._open[k]]
            if tag in tags:
                self._cut(k)
                return
            if tag in stop:
                return
            k = min(k - 1, self._depth_of(self._block[k])) if tag in INLINE else k - 1

    def _depth_of(self, element: int) -> int:
        low, high = 0, len(self._open) - 1
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self._open[middle] < element else (low, middle)
        return low

    # ---- what counts ----

    def below(self, own: Iterable[tuple[int, int]]) -> list[int]:
        """Sums over each element and all inside it of numbers given by element."""
        out = [0] * len(self.parent)
        for k, n in own:
            out[k] += n
        for k in range(len(out) - 1, 0, -1):
            out[self.parent[k]] += out[k]
        return out

    def counting(self) -> list[bool]:
        """Which elements hold text that counts: not in menus, forms and the like, told by what they are or their names.

        Names do not bar the outermost element of the kind that holds half of the page's text or more.
        """
        hard = [b == 2 for b in self.barred]
        for k in range(1, len(hard)):
            hard[k] = hard[k] or hard[self.parent[k]]
        text = self.below((k, len(t)) for k, t in self.blocks if not hard[k])
        soft = [False] * len(hard)
        named = [False] * len(hard)
        for k in range(1, len(hard)):
            up = self.parent[k]
            wide = not named[up] and 2 * text[k] >= text[0]
            named[k] = named[up] or self.barred[k] == 1
            soft[k] = soft[up] or (self.barred[k] == 1 and not wide)
        return [not (h or s) for h, s in zip(hard, soft)]


_LISTS = frozenset({"ul", "ol", "dl", "table", "select"})
_BOXES = frozenset({"div", "td", "th", "li", "section", "article", "main", "button", "object"})


@lru_cache(maxsize=None)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I)


def _digest(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def text_token(place: int, text: str) -> int:
    return _digest(f"{place}\n{text}")


#: What the page itself, the element of place 0, stands in.
TOP = -1
SHARE_OF_PAGE = 1_000_000
TOKEN = (
    "host string, token long, around long, tag string, pages long, vector_a long, vector_b long, total long, chars long, most long"
)


def page_tokens(distinct: DataFrame) -> DataFrame:
    """Tokens of distinct pages (host, page, html), added up per task.

    ``vector_a`` and ``vector_b`` are sums, over the pages that have the token, of two digests of page and count, so
    tokens of equal sums have equal occurrence vectors. ``chars`` is the text that counts inside an element, in parts of
    that of its page, so that no long page outweighs the others; ``around`` is the place a token stands in, ``tag`` null
    for a text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*key, *value) for key, value in sums.items()]
            sums.clear()
            columns = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 6]
            names = [part.split()[0] for part in TOKEN.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        def add(key: tuple, page: int, n: int, chars: int) -> None:
            vector = xxhash.xxh64_intdigest(f"{page} {n}")
            old = sums.setdefault(key, [0, 0, 0, 0, 0, 0])
            for k, v in enumerate((1, vector >> 33, vector & 0x7FFFFFFF, n, chars)):
                old[k] += v
            old[5] = max(old[5], n)

        for batch in slices(batches):
            for host, mark, source in zip(*(c.to_pylist() for c in batch.columns)):
                page = Page(source or "")
                counts = page.counting()
                chars = page.below((k, len(t)) for k, t in page.blocks if counts[k])
                elements: dict[tuple, list[int]] = {}
                for k in range(len(page.parent)):
                    around = page.place[page.parent[k]] if k else TOP
                    cell = elements.setdefault((page.place[k], around, page.tag[k]), [0, 0])
                    cell[0] += 1
                    cell[1] += chars[k]
                texts = Counter((text_token(page.place[k], t), page.place[k], len(t)) for k, t in page.blocks if counts[k])
                share = lambda n: n * SHARE_OF_PAGE // max(chars[0], 1)  # noqa: B023, E731
                for (token, around, tag), (n, inside) in elements.items():
                    add((host, token, around, tag[:40]), mark, n, share(inside))
                for (token, around, length), n in texts.items():
                    add((host, token, around, None), mark, n, share(length * n))
                if len(sums) > FLUSH:
                    yield flush()
        yield flush()

    return distinct.mapInArrow(run, TOKEN)


def template_of(tokens: pd.DataFrame, n_pages: int) -> dict:
    """Region and template texts of a host from its frequent tokens.

    A class, the tokens of one occurrence vector, is valid if it has the page itself, or if each of its tokens stands in
    a token of the class or in one other class, the same for all of them, that is valid. Tokens of valid classes are
    the template.
    """
    rows = list(tokens[["token", "around", "tag", "pages", "vector_a", "vector_b", "total", "chars"]].itertuples(index=False))
    class_of = {(r.token, r.tag is None): (r.pages, r.vector_a, r.vector_b, r.total) for r in rows}
    outer: dict[tuple, set] = {}
    for r in rows:
        around = "top" if r.around == TOP else class_of.get((r.around, False))
        if around != class_of[r.token, r.tag is None]:
            outer.setdefault(class_of[r.token, r.tag is None], set()).add(around)
    valid: dict[tuple, bool] = {}

    def is_valid(own: tuple) -> bool:
        chain = []
        while own not in valid:
            around = outer.get(own, set())
            if len(around) != 1 or own in chain:
                valid[own] = False
            elif around == {"top"}:
                valid[own] = True
            elif None in around:
                valid[own] = False
            else:
                chain.append(own)
                (own,) = around
        for k in reversed(chain):
            (around,) = outer[k]
            valid.setdefault(k, valid[around])
        return valid[own] if not chain else valid[chain[0]]

    template = [r for r in rows if is_valid(class_of[r.token, r.tag is None])]
    elements = {r.token: r for r in template if r.tag is not None}
    whole = elements[0].chars if 0 in elements else 0
    texts = [r for r in template if r.tag is None and r.pages >= LEAST_TEXT_PAGES and r.around in elements]
    if sum(r.chars for r in texts) > CONSTANT_SHARE * whole:
        texts = []
    slots = {t: r.chars for t, r in elements.items()}
    for r in elements.values():
        if r.around in slots:
            slots[r.around] -= r.chars
    for r in texts:
        if r.around in slots:
            slots[r.around] -= r.chars
    return {"region": _region(elements, slots, whole), "texts": sorted(int(r.token) for r in texts)}


def _region(elements: dict, slots: dict[int, int], whole: int) -> int:
    """The smallest element around all slots of the article; 0, the page itself, if that is the template's only one.

    An article or main element that holds most of the text is the region. Otherwise slots count that hold a
    share of the text, and headings, so no part of an article that stands beside its longest one is left out.
    """
    mains = [t for t, r in elements.items() if r.tag in MAIN and 2 * r.chars >= whole > 0]
    if mains:
        return int(min(mains, key=lambda t: (elements[t].chars, t)))
    chosen = [t for t, n in slots.items() if n > 0 and (n >= SLOT_SHARE * whole or elements[t].tag in HEADINGS)]
    common: list[int] | None = None
    for t in chosen:
        line = []
        while t in elements:
            line.append(t)
            t = elements[t].around
        line.reverse()
        common = line if common is None else [a for a, b in zip(common, line) if a == b]
    return int(common[-1]) if common else 0


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``(host, page, html)``: each page of a host once, by a digest of its html; empty pages and those without a host are left out."""
    page = F.xxhash64("html").alias("page")
    known = pages.select(host_of(F.col("url")).alias("host"), page, "html").where("host is not null and length(html) > 0")
    copies = stage(known.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "page"), "copies")
    side = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    once = known.join(side, ["host", "page"], "left_anti")
    return once.unionByName(known.join(side, ["host", "page"], "left_semi").dropDuplicates(["host", "page"]))


def templates(pages: DataFrame) -> DataFrame:
    """``(host, template)`` of every host with at least ``LEAST_PAGES`` distinct pages, as JSON."""
    distinct = distinct_pages(pages)
    added = [F.sum(c).alias(c) for c in ("pages", "vector_a", "vector_b", "total", "chars")]
    tokens = page_tokens(distinct).groupBy("host", "token", "around", "tag").agg(*added, F.max("most").alias("most")).where("pages > 1")
    tokens = stage(tokens, "tokens")
    known = pages.where("length(html) > 0").select(host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page"))
    sizes = known.where("host is not null").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    frequent = tokens.join(sizes.where(F.col("n_pages") >= LEAST_PAGES), "host").where(F.col("pages") >= SUPPORT * F.col("n_pages"))

    def deduce(group: pd.DataFrame) -> pd.DataFrame:
        found = template_of(group.astype({"tag": object}).where(group.notna(), None), int(group["n_pages"].iloc[0]))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "template": [json.dumps(found)]})

    return frequent.groupBy("host").applyInPandas(deduce, "host string, template string")


@lru_cache(maxsize=10_000)
def _parsed(template: str) -> tuple[int, frozenset]:
    found = json.loads(template)
    return found["region"], frozenset(found["texts"])


def main_blocks(source: str, template: str | None = None) -> list[str]:
    """Blocks of the main text of one page; without a template, those in its article, else in its body."""
    page = Page(source)
    counts = page.counting()
    blocks = [(k, text) for k, text in page.blocks if counts[k]]
    region, constant = _parsed(template) if template else (0, frozenset())
    inside: list[tuple[int, str]] = []
    if region:
        within = _within(page, [place == region for place in page.place])
        inside = [(k, text) for k, text in blocks if within[k]]
    if not inside:
        within = _within(page, [tag in MAIN for tag in page.tag])
        inside = [(k, text) for k, text in blocks if within[k]] or blocks
    return [text for k, text in inside if not constant or text_token(page.place[k], text) not in constant]


def _within(page: Page, marks: list[bool]) -> list[bool]:
    for k in range(1, len(marks)):
        marks[k] = marks[k] or marks[page.parent[k]]
    return marks


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages``.

    A null or empty page has an empty text. Pages without a host, and hosts of fewer than ``LEAST_PAGES`` distinct
    pages, have no template; for them the article or main element counts, else the body. Copies of a page are one
    page to the template. Repeated rows give one row each; of columns beyond page_id, url and html none is read.
    """
    kept = stage(templates(pages), "templates")
    size = kept.agg(F.sum(F.octet_length("template") + F.octet_length("host"))).first()[0] or 0
    side = F.broadcast(kept) if size <= TEMPLATES_MB << 20 else kept
    source = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(side, "host", "left")
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sources, found = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = ["\n".join(main_blocks(s or "", t)) for s, t in zip(sources, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                names=schema.names,
            )

    return source.select("page_id", "url", "html", "template").mapInArrow(run, schema)
