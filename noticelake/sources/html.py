"""HTML pages as arrays of nodes.

The only step that leaves the JVM is reading tags: one Arrow UDF turns a page into an
array of nodes plus the array of its visible strings. Nodes are numbered in document
order and carry the end of their subtree and the range of strings below them, so every
selection after that (rows, cells, links, labelled fields, text) is a native array
expression inside the same row: no explode, no shuffle, each page read once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, clean
from ..operators.unnest import unnest

# Elements without content, and elements whose text is never shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(["script", "style", "template"])
ATTRIBUTES = ["id", "class", "href", "src", "title", "alt", "name", "content", "value", "data-title"]

NODE = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("pos", "parent", "end", "s_from", "s_to")]
    + [T.StructField("tag", T.StringType())]
    + [T.StructField("attr_" + n.replace("-", "_"), T.StringType()) for n in ATTRIBUTES]
)
PAGE = T.StructType([
    T.StructField("nodes", T.ArrayType(NODE)),
    T.StructField("strings", T.ArrayType(T.StringType())),
])


# A text and the plain tag behind it, and elements whose content is read by rules of its own.
PLAIN_TAG = re.compile(r'([^<]*)<(/?)([A-Za-z][A-Za-z0-9]*)((?: [A-Za-z][A-Za-z-]*="[^"]*")*) ?(/?)>')
PLAIN_ATTRIBUTE = re.compile(r' ([A-Za-z-]+)="([^"]*)"')
OWN_RULES = HIDDEN | frozenset("iframe math noembed noframes noscript plaintext svg textarea title xmp".split())
NOTHING = [None] * len(ATTRIBUTES)


class _Nodes(HTMLParser):
    """Flat node list of one page; unclosed and stray tags are tolerated."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.strings: list[str] = []
        self.open: list[int] = []

    @classmethod
    def of(cls, page: str) -> _Nodes:
        """A page of plain tags alone is cut by one pattern, any other one is read by the parser; both give the same nodes."""
        reader = cls()
        if not reader._plain(page):
            reader = cls()
            reader.feed(page)
            reader.close()
        reader._close_to(0)
        return reader

    def _plain(self, page: str) -> bool:
        """Read a page of plain tags; False as soon as anything else comes."""
        at = 0
        for found in PLAIN_TAG.finditer(page):
            if found.start() != at:
                return False
            at = found.end()
            before, ends, tag, given, closed = found.groups()
            tag = tag.lower()
            if tag in OWN_RULES:
                return False
            if before:
                self.handle_data(unescape(before) if "&" in before else before)
            if ends:
                if given or at - found.end(1) != len(tag) + 3:
                    return False
                self.handle_endtag(tag)
                continue
            attrs = []
            if given:
                if "&" in given:
                    if "&" in given.replace("&amp;", ""):
                        return False
                    attrs = [(name.lower(), value.replace("&amp;", "&")) for name, value in PLAIN_ATTRIBUTE.findall(given)]
                else:
                    attrs = [(name.lower(), value) for name, value in PLAIN_ATTRIBUTE.findall(given)]
            if closed:
                self.handle_startendtag(tag, attrs)
            else:
                self.handle_starttag(tag, attrs)
        tail = page[at:]
        if "<" in tail:
            return False
        if tail:
            self.handle_data(unescape(tail))
        return True

    def handle_starttag(self, tag, attrs):
        parent = self.open[-1] if self.open else -1
        here = len(self.nodes)
        values = NOTHING
        if attrs:
            given = dict(reversed(attrs))
            values = [None if a not in given else (given[a] or "") for a in ATTRIBUTES]
        self.nodes.append([here, parent, here + 1, len(self.strings), len(self.strings), tag, *values])
        if tag not in VOID:
            self.open.append(here)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]][5] == tag:
                self._close_to(depth)
                return

    def handle_data(self, data):
        shown = data.strip()
        if shown and not (self.open and self.nodes[self.open[-1]][5] in HIDDEN):
            self.strings.append(shown)

    def _close_to(self, depth):
        for node in self.open[depth:]:
            self.nodes[node][2] = len(self.nodes)
            self.nodes[node][4] = len(self.strings)
        del self.open[depth:]


def _read_pages(pages: pa.Array) -> pa.Array:
    """Columnar form of a batch of pages; node attributes never become row dicts."""
    columns: list[list] = [[] for _ in NODE.names]
    strings: list[str] = []
    node_ends, string_ends = [0], [0]
    for page in pages.to_pylist():
        reader = _Nodes.of(page or "")
        for column, values in zip(columns, zip(*reader.nodes)):
            column.extend(values)
        strings.extend(reader.strings)
        node_ends.append(node_ends[-1] + len(reader.nodes))
        string_ends.append(len(strings))
    kinds = [pa.int32() if f.dataType.typeName() == "integer" else pa.string() for f in NODE.fields]
    nodes = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], NODE.names)
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(node_ends, pa.int32()), nodes),
            pa.ListArray.from_arrays(pa.array(string_ends, pa.int32()), pa.array(strings, pa.string())),
        ],
        PAGE.names,
    )


def parse_html(c: Column) -> Column:
    """struct<nodes, strings> of an HTML string column.

    Marked non-deterministic so that the optimizer never reads a page twice: a filter on
    something found on the page stays above the one evaluation.
    """
    return F.arrow_udf(_read_pages, PAGE).asNondeterministic()(c)


def with_page(df: DataFrame, html: str, name: str = "page") -> DataFrame:
    """Add the parsed page as one column; the markup itself is dropped from then on."""
    return df.withColumn(name, parse_html(F.col(html))).drop(html)


class Page:
    """Selections over one parsed page column. Every method returns a Column."""

    def __init__(self, page: Column | str = "page") -> None:
        page = F.col(page) if isinstance(page, str) else page
        self.nodes = page["nodes"]
        self.strings = page["strings"]

    def text(self, node: Column) -> Column:
        """Visible text of a node: its strings joined by one space."""
        span = F.slice(self.strings, node["s_from"] + 1, node["s_to"] - node["s_from"])
        return clean(F.array_join(span, " "))

    def all_text(self) -> Column:
        return clean(F.array_join(self.strings, " "))

    def select(self, *tags: str, where: Callable[[Column], Column] | None = None) -> Column:
        return F.filter(self.nodes, lambda n: self._match(n, tags, where))

    def first(self, *tags: str, where: Callable[[Column], Column] | None = None) -> Column:
        return F.get(self.select(*tags, where=where), F.lit(0))

    def inside(self, node: Column, *tags: str, where: Callable[[Column], Column] | None = None) -> Column:
        """Descendants of a node: a slice of the node array, filtered."""
        below = F.slice(self.nodes, node["pos"] + 2, node["end"] - node["pos"] - 1)
        return F.filter(below, lambda n: self._match(n, tags, where))

    def below(self, outer: Column, nodes: Column) -> Column:
        """Those of ``nodes`` that lie inside the node ``outer``."""
        return F.filter(nodes, lambda n: (n["pos"] > outer["pos"]) & (n["pos"] < outer["end"]))

    def rows(self) -> Column:
        """Every table row as the array of its cell texts."""
        return F.transform(self.select("tr"), lambda r: F.transform(self.inside(r, "td", "th"), self.text))

    def first_two_cells(self) -> Column:
        """(label, value) of every row with at least two cells, in order."""
        usable = F.filter(self.rows(), lambda r: (F.size(r) >= 2) & (F.get(r, F.lit(0)) != ""))
        return F.transform(usable, lambda r: field(F.get(r, F.lit(0)), F.get(r, F.lit(1))))

    def paired_cells(self) -> Column:
        """(label, value) pairs of rows that may hold several pairs side by side."""

        def pairs(r: Column) -> Column:
            count = F.floor(F.size(r) / 2).cast("int")
            starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: field(F.get(r, i * 2), F.get(r, i * 2 + 1)))

        return F.filter(F.flatten(F.transform(self.rows(), pairs)), lambda p: p["label"] != "")

    def meta(self, *names: str) -> Column:
        node = self.first("meta", where=lambda n: n["attr_name"].isin(*names))
        return clean(node["attr_content"])

    @staticmethod
    def _match(n: Column, tags: tuple[str, ...], where) -> Column:
        ok = n["tag"].isin(*tags) if tags else F.lit(True)
        return ok if where is None else ok & F.coalesce(where(n), F.lit(False))


def field(label: Column, value: Column) -> Column:
    return F.struct(label.alias("label"), value.alias("value"))


def lookup(pairs: Column, label: str) -> Column:
    """Value of a label; the last pair wins, a missing label is NULL."""
    return F.try_element_at(F.filter(pairs, lambda p: p["label"] == label), F.lit(-1))["value"]


def lookup_containing(pairs: Column, *parts: str) -> Column:
    """Value of the first label that contains one of the parts."""
    return F.get(F.filter(pairs, lambda p: p["label"].rlike("|".join(parts))), F.lit(0))["value"]


def has_class(n: Column, name: str) -> Column:
    return F.concat(F.lit(" "), F.regexp_replace(n["attr_class"], r"\s+", " "), F.lit(" ")).contains(f" {name} ")


# The labels printed as "label：value" lines on sale pages.
LINE_LABELS = ["已購置年限", "廠牌", "型號", "零件或附件", "牌照異動登記", "原牌照種類", "物品說明"]


def line_fields(strings: Column) -> Column:
    """(label, value) of every visible string that starts with a known label and ：."""
    pattern = f"^({'|'.join(LINE_LABELS)})："
    lines = F.filter(F.transform(strings, clean), lambda s: s.rlike(pattern))
    return F.transform(
        lines, lambda s: field(F.regexp_extract(s, pattern, 1), clean(F.regexp_replace(s, pattern, "")))
    )


def article_scope(page: Page) -> Column:
    """The longest article-like element, else main; NULL means the whole page."""

    def article_like(n: Column) -> Column:
        return (
            (n["tag"] == "article")
            | (n["tag"].isin("section", "div") & has_class(n, "cp"))
            | has_class(n, "content_detail")
            | has_class(n, "article-content")
        )

    sized = F.transform(
        page.select(where=article_like),
        lambda n: F.struct(F.length(page.text(n)).alias("size"), (-n["pos"]).alias("order"), n.alias("node")),
    )
    return F.coalesce(F.array_max(sized)["node"], page.first("main"))


def page_nodes(df: DataFrame, key: str = "page_id", page: str = "page") -> DataFrame:
    """Long form: one row per element with its visible text."""
    p = Page(page)
    flat = F.transform(
        p.nodes, lambda n: F.struct(n.alias("node"), p.text(n).alias("text"))
    )
    return unnest(df, flat, "x", key).select(
        key, F.col("x.node.pos").alias("pos"), F.col("x.node.parent").alias("parent"), F.col("x.node.tag").alias("tag"),
        F.col("x.node.attr_class").alias("class"), F.col("x.node.attr_href").alias("href"), F.col("x.text").alias("text"),
    )


def page_links(df: DataFrame, key: str = "page_id", page: str = "page") -> DataFrame:
    """Anchors with a target, in page order."""
    p = Page(page)
    links = F.transform(
        p.select("a", where=lambda n: n["attr_href"].isNotNull()),
        lambda n: F.struct(n["attr_href"].alias("href"), p.text(n).alias("text")),
    )
    return unnest(df, links, "x", key, position="link_no").select(
        key, "link_no", F.col("x.href").alias("href"), blank_to_null(F.col("x.text")).alias("text")
    )
