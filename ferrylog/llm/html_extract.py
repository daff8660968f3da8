"""Main text of web pages, from templates deduced per host.

Tokens of a page are its element paths and its text blocks, inside articles and
outside. Tokens of one host with the same occurrence vector, the same number of
times on the same distinct pages, form an equivalence class. A class is valid if its
tokens first occur in one order on every page that has them. Valid classes nest by their
elements: the text blocks of a valid class belong to the template if half of the host's
pages that have their element show them, so a host may have several templates, each on a
quarter of its pages or more. Hosts under ``MIN_PAGES`` distinct pages show no template.

What the template repeats is no content and is dropped, in articles, too; a page of
which nothing would be left is not made from the template and keeps its blocks. The
slot with the main text is the page's own article, else the innermost
element on half of the pages that holds most of the changing text.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by element, role, class or id. Character references
are decoded, white space inside a block becomes one space, blocks are joined by
an empty line. Null html counts as empty, null urls share an empty host, pages
without text have an empty text; equal rows stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import fresh
from ferrylog.session import written

TAG = re.compile(
    r"""<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)|<[!?][^>]*(?:>|$)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
SPACES = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre"
    " section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of these ends an open paragraph.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
ARTICLE = frozenset(("article", "main"))
#: Never content, wherever they stand.
ASIDE = frozenset("nav footer aside form button select dialog head menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog".split())
#: Words of class and id names.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion"
    " sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond"
    " reply replies disqus cookie cookies consent gdpr notice notices popup modal newsletter subscribe"
    " subscription share sharing social related recommended widget toolbar pagination pager login signup"
    " masthead topbar".split()
)
#: Distinct pages that show a template, of a host and of a text block.
MIN_PAGES = 4


def _digest(above: int, name: str, is_text: bool = False) -> int:
    """Digest of an element path or a text block, from that of the path above it."""
    return xxhash.xxh3_64_intdigest(f"{above}{'#' if is_text else '/'}{name}") - (1 << 63)


ROOT = _digest(0, "")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(raw: str) -> dict[str, str]:
    out = {}
    for m in ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    return out


def _aside(tag: str, raw: str, in_article: bool) -> bool:
    """Whether an element is no part of the content."""
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "article", "main") and "role" not in raw:
        marked = _attributes(raw) if tag == "article" and raw.strip() else {}
        names = {p.lower() for p in NAME_PARTS.findall(marked.get("class", ""))}
        return bool(names & {"comment", "comments", "reply"})
    if not raw.strip():
        return False
    found = _attributes(raw)
    if "hidden" in found or found.get("role", "").lower() in ROLES:
        return True
    names = {
        p.lower() for key in ("class", "id") for p in NAME_PARTS.findall(found.get(key, ""))
    }
    return bool(names & NAMES) or ("header" in names and not in_article and tag == "div")


class Node(NamedTuple):
    """A distinct element path of a page: its digest, tag, depth and its parent's number."""

    digest: int
    tag: str
    depth: int
    parent: int


class Page:
    """Element paths with their counts, and text blocks in page order.

    A block is (number of its path, inside an article, text). Numbers grow downwards.
    """

    def __init__(self, html: str) -> None:
        self.nodes = [Node(ROOT, "", 0, -1)]
        self.numbers: dict[int, int] = {ROOT: 0}
        self.counts = [1]
        #: The blocks ahead of each path's first element.
        self.firsts = [0]
        self.blocks: list[tuple[int, bool, str]] = []
        #: (tag, path, aside, in article)
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self.parts: list[str] = []
        self.place = (0, False, False)
        at = 0
        while True:
            m = TAG.search(html, at)
            if m is None:
                self._text(html[at:])
                break
            self._text(html[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._close(tag)
            else:
                raw = m[3] if m[2] else m[6]
                if tag in RAW and not raw.endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
                    if end is None:
                        if tag in ("script", "style"):
                            break
                    else:
                        at = end.start()
                        end = TAG.match(html, at)
                        at = end.end() if end else len(html)
                    continue
                self._open(tag, raw)
        self._flush()

    def _text(self, text: str) -> None:
        if text and not self.stack[-1][2]:
            if not self.parts:
                self.place = self.stack[-1][1:]
            self.parts.append(text)

    def _flush(self) -> None:
        if self.parts:
            text = SPACES.sub(" ", unescape("".join(self.parts))).strip()
            self.parts = []
            if text:
                path, _, article = self.place
                self.blocks.append((path, article, text))

    def _open(self, tag: str, raw: str) -> None:
        if tag in BLOCK:
            self._flush()
            self._end("p")
        for other in CLOSES.get(tag, ()):
            self._end(other)
        if tag == "br":
            self._text(" ")
        if tag in VOID or raw.endswith("/"):
            return
        _, path, aside, article = self.stack[-1]
        if tag in BLOCK:
            path = self._node(path, tag)
        aside = aside or _aside(tag, raw, article)
        self.stack.append((tag, path, aside, article or (tag in ARTICLE and not aside)))

    def _node(self, parent: int, tag: str) -> int:
        digest = _digest(self.nodes[parent].digest, tag)
        number = self.numbers.setdefault(digest, len(self.nodes))
        if number == len(self.nodes):
            self.nodes.append(Node(digest, tag, self.nodes[parent].depth + 1, parent))
            self.counts.append(0)
            self.firsts.append(len(self.blocks))
        self.counts[number] += 1
        return number

    def _end(self, tag: str) -> None:
        """Close an open element of this kind unless a container is in between."""
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.stack[k][0]
            if name == tag:
                del self.stack[k:]
                return
            if name in BLOCK and name != "p":
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if any(name == tag for name, *_ in self.stack):
            while self.stack[-1][0] != tag:
                self.stack.pop()
            self.stack.pop()

    def within(self, digest: int) -> list[bool]:
        """Whether each path is the one with this digest or below it."""
        out: list[bool] = []
        for node in self.nodes:
            out.append(node.digest == digest or (node.parent >= 0 and out[node.parent]))
        return out

    @property
    def has_article(self) -> bool:
        return any(article for _, article, _ in self.blocks)


def content(html: str, slot: int | None, repeated: frozenset[int] | set[int]) -> str:
    """The page's text by its host's template."""
    page = Page(html)
    if page.has_article:
        inside = [(path, text) for path, article, text in page.blocks if article]
    else:
        below = page.within(ROOT if slot is None else slot)
        blocks = [(path, text) for path, _, text in page.blocks]
        inside = [b for b in blocks if below[b[0]]] or blocks
    own = inside
    if repeated:
        own = [(p, t) for p, t in inside if _digest(page.nodes[p].digest, t, True) not in repeated]
    return "\n\n".join(text for _, text in own or inside)


TOKENS = (
    "host string, page long, token long, parent long, tag string, depth int, n long, first long, chars long"
)


def _page_tokens(html: str) -> list[tuple]:
    """(token, parent, tag, depth, n, first, chars) of a page; text blocks have no tag."""
    page = Page(html)
    chars = [0] * len(page.nodes)
    texts: dict[tuple[int, str], list[int]] = {}
    for k, (path, _, text) in enumerate(page.blocks):
        chars[path] += len(text)
        texts.setdefault((path, text), [0, k])[0] += 1
    for k in range(len(page.nodes) - 1, 0, -1):
        chars[page.nodes[k].parent] += chars[k]
    rows = []
    for k, (digest, tag, depth, parent) in enumerate(page.nodes):
        above = page.nodes[max(parent, 0)].digest
        rows.append((digest, above, tag, depth, page.counts[k], 2 * page.firsts[k], chars[k]))
    for (path, text), (n, first) in texts.items():
        node = page.nodes[path]
        rows.append((_digest(node.digest, text, True), node.digest, None, node.depth, n, 2 * first + 1, n * len(text)))
    return rows


def _tokens(pages: DataFrame) -> DataFrame:
    """Tokens of every distinct page; ``pages`` has host, page and html."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long, string = pa.int64(), pa.string()
        kinds = [string, long, long, long, string, pa.int32(), long, long, long]
        for batch in batches:
            rows = []
            for host, number, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(host, number, *token) for token in _page_tokens(html)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[field.split()[0] for field in TOKENS.split(", ")],
            )

    # equal rows are one page
    values = [F.max(c).alias(c) for c in ("parent", "tag", "depth", "n", "first", "chars")]
    return pages.mapInArrow(tokens, TOKENS).groupBy("host", "page", "token").agg(*values)


def classes(pages: DataFrame) -> DataFrame:
    """The tokens on an eighth of their host's pages or more, with their classes.

    (host, token, parent, tag, depth, chars, pages, support, vector, valid); ``pages``
    has host, page and html. Tokens of equal ``vector`` are a class.
    """
    seen = written(_tokens(pages), "tokens")
    sizes = seen.filter(F.col("token") == ROOT).groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # a host's rare texts can't be part of its template and may be many
    common = (
        seen.groupBy("host", "token")
        .agg(
            *(F.max(c).alias(c) for c in ("parent", "tag", "depth")),
            F.sum("chars").alias("chars"),
            F.count(F.lit(1)).alias("support"),
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
        )
        .join(sizes, "host")
        .filter("8 * support >= pages")
    )
    common = written(common, "classes")
    order = F.array_sort(F.collect_list(F.struct("first", "depth", "token")))
    ordered = (
        seen.select("host", "token", "page", "first", "depth")
        .join(common.select("host", "token", "vector"), ["host", "token"])
        .groupBy("host", "vector", "page")
        .agg(F.xxhash64(F.transform(order, lambda x: x["token"])).alias("order"))
        .groupBy("host", "vector")
        .agg((F.min("order") == F.max("order")).alias("valid"))
    )
    return common.join(ordered, ["host", "vector"])


def deduce(rows: pd.DataFrame) -> tuple[int | None, list[int]]:
    """(slot, repeated text blocks) from the classes of a host's tokens."""
    pages = int(rows.pages.iloc[0])
    paths = {int(r.token): r for r in rows.itertuples() if r.tag is not None}
    order = sorted(paths, key=lambda t: (paths[t].depth, t))
    repeated, fixed = [], dict.fromkeys(order, 0)
    for r in rows.itertuples():
        if r.tag is not None or not r.valid or pages < MIN_PAGES or r.support < MIN_PAGES:
            continue
        around = paths[int(r.parent)]
        if 4 * around.support >= pages and 2 * r.support >= around.support:
            repeated.append(int(r.token))
            fixed[int(r.parent)] += int(r.chars)
    for t in reversed(order[1:]):
        fixed[int(paths[t].parent)] += fixed[t]
    changing = {t: int(paths[t].chars) - fixed[t] for t in order}
    whole = max((changing[t] for t in order[1:]), default=0)
    slot, inside = None, set()
    for t in order[1:]:
        r = paths[t]
        if slot is not None and int(r.parent) in inside:
            inside.add(t)
        if 2 * r.support < pages or (slot is not None and t not in inside):
            continue
        if 4 * changing[t] >= 3 * whole > 0 and r.tag not in ("p", "li", "ul", "tr", "td"):
            slot, inside = t, {t}
    return slot, sorted(repeated)


def templates(pages: DataFrame) -> DataFrame:
    """(host, slot, repeated) of every host; ``pages`` has host, page and html."""

    def of_host(rows: pd.DataFrame) -> pd.DataFrame:
        slot, repeated = deduce(rows)
        return pd.DataFrame(
            {"host": [rows.host.iloc[0]], "slot": pd.array([slot], "Int64"), "repeated": [repeated]}
        )

    # at most eight times a page's tokens a host
    return classes(pages).groupBy("host").applyInPandas(
        of_host, "host string, slot long, repeated array<long>"
    )


def extracted(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    host, own, slot, repeated = fresh(pages, "_host", "_html", "_slot", "_repeated")
    name = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    rows = pages.withColumn(host, F.lower(name)).withColumn(own, F.coalesce(F.col(html), F.lit("")))
    number = F.xxhash64(F.col(url), F.col(own))
    found = written(
        templates(rows.select(F.col(host).alias("host"), number.alias("page"), F.col(own).alias("html"))),
        "templates",
    )
    found = found.select(F.col("host").alias(host), F.col("slot").alias(slot), F.col("repeated").alias(repeated))

    @F.pandas_udf("string")
    def main_text(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, slots, fixed in parts:
            yield pd.Series(
                [
                    content(h, None if pd.isna(s) else int(s), frozenset(() if f is None else map(int, f)))
                    for h, s, f in zip(texts, slots, fixed, strict=True)
                ],
                dtype=object,
            )

    joined = rows.join(found, host, "left").withColumn(out, main_text(own, slot, repeated))
    return joined.drop(host, own, slot, repeated)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = extracted(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
