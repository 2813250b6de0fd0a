"""Page operators: noise, main content, sections, their classes and quality (H1-H8, SRC10)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from placeforge.functions import scalars as S

# Elements and classes that are noise; the containers of the main content (element, id, class), in their order; words of the
# section classes, in their order, and their headings; words of tables.
NOISE_TAGS = ("nav", "header", "footer", "aside", "script", "style", "noscript")
NOISE_CLASSES = ("wds-global-navigation", "wds-community-header", "advertisement", "ad-slot", "rail-module", "page-side-tools", "categories", "page-footer")
CONTAINERS = (("main", "content", None), (None, None, "mw-parser-output"), (None, None, "page-content"), ("article", None, None), ("main", None, None), (None, "content", None), (None, None, "content"), ("body", None, None))
SECTION_WORDS = {
    "exits": ("exits", "exit", "station exits"),
    "platforms": ("platforms", "platform", "platform layout"),
    "bus_stops": ("nearby bus stops", "bus stops", "bus interchanges", "buses"),
    "lines": ("lines", "line", "line information"),
    "layout": ("layout", "station layout"),
}
SECTION_HEADINGS = ("Exits", "Platforms", "Bus Stops", "Lines", "Layout")
EXIT_WORDS, STOP_WORDS = ("exit", "destination", "location"), ("bus stop", "bus service", "bus no")
HEADERS = ("h2", "h3", "h4")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def page_status(status: Column, html: Column) -> DataFrame:
    """SRC10: (outcome, html) of a fetch."""
    return F.struct(F.when(status == 200, "ok").when(status == 404, "not_found").otherwise("failed").alias("outcome"), F.when(status == 200, html).alias("html"))


@dataclass
class _Element:
    tag: str
    id: str | None
    classes: tuple[str, ...]
    start: int
    inner: int
    last: int  # the end of what is inside
    end: int


class _Page(HTMLParser):
    """Elements and texts of a page that no noise element holds, in document order, by their places in the source.

    An end tag closes the nearest open element of its name and those within; one without such an element is ignored.
    """

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.source = source
        self.lines = [0, *(m.end() for m in re.finditer("\n", source))]
        self.elements: list[_Element] = []
        self.children: dict[int, list[_Element]] = {}
        self.siblings: list[tuple[int, int]] = []  # of each element: its parent and its place there
        self.texts: list[tuple[int, str]] = []
        self.noise: list[tuple[int, int]] = []
        self.open: list[tuple[str, int | None]] = []  # names, and elements outside noise
        self.names: Counter[str] = Counter()
        self.hidden: tuple[int, int] | None = None  # depth and start of the noise element that is open
        self.feed(source)
        self.close()
        self._shut(0, len(source), len(source))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        at, values = self._at(), dict(reversed(attrs))
        behind = at + len(self.get_starttag_text())
        classes = tuple((values.get("class") or "").split())
        if self.hidden is None and (tag in NOISE_TAGS or any(c in NOISE_CLASSES for c in classes)):
            if tag in VOID:
                self.noise.append((at, behind))
                return
            self.hidden = len(self.open), at
        number = None
        if self.hidden is None:
            number, parent = len(self.elements), self.open[-1][1] if self.open else -1
            self.elements.append(_Element(tag, values.get("id"), classes, at, behind, behind, behind))
            own = self.children.setdefault(parent, [])
            self.siblings.append((parent, len(own)))
            own.append(self.elements[-1])
        if tag not in VOID:
            self.open.append((tag, number))
            self.names[tag] += 1

    def handle_endtag(self, tag):
        if not self.names[tag]:
            return
        depth = next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag)
        at = self._at()
        behind = self.source.find(">", at) + 1 or len(self.source)
        if not self.source.startswith("</", at):  # <div/>
            at = behind = at + len(self.get_starttag_text())
        self._shut(depth, at, behind)

    def _shut(self, depth: int, at: int, behind: int) -> None:
        while len(self.open) > depth:
            tag, number = self.open.pop()
            self.names[tag] -= 1
            end = behind if len(self.open) == depth else at
            if number is not None:
                self.elements[number].last, self.elements[number].end = at, end
            elif self.hidden and self.hidden[0] == len(self.open):
                self.noise.append((self.hidden[1], end))
                self.hidden = None

    def handle_data(self, data):
        if self.hidden is None and data.strip():
            self.texts.append((self._at(), data))

    def markup(self, start: int, end: int) -> str:
        """The source from start to end without noise."""
        parts = []
        for a, b in self.noise[bisect_left(self.noise, (start,)) :]:
            if a >= end:
                break
            parts.append(self.source[start:a])
            start = b
        return "".join(parts) + self.source[start:end]

    def text(self, e: _Element, sep: str = "") -> str:
        """Its texts, each without white space around it."""
        return sep.join(t.strip() for _, t in self.texts[bisect_left(self.texts, (e.start,)) : bisect_right(self.texts, (e.end,))])

    def container(self) -> _Element | None:
        for tag, own, c in CONTAINERS:
            for e in self.elements:
                if tag in (None, e.tag) and own in (None, e.id) and (c is None or c in e.classes):
                    return e
        return None

    def sections(self) -> Iterator[tuple[str, str, str, str]]:
        """(kind, title, text, markup): `page` if there is a container; an `element` for each that follows a heading there as its
        sibling, up to the next heading; each `table`."""
        top = self.container()
        if top is None:
            return
        first = next(k for k, e in enumerate(self.elements) if e is top) + 1
        inside = [(e, s) for e, s in zip(self.elements[first:], self.siblings[first:]) if e.start < top.end]
        yield "page", "", "", ""
        for e, (parent, place) in inside:
            if e.tag in HEADERS:
                title = self.text(e)
                for x in self.children[parent][place + 1 :]:
                    if x.tag in HEADERS:
                        break
                    yield "element", title, self.text(x, " "), self.markup(x.start, x.end)
        for e, _ in inside:
            if e.tag == "table":
                yield "table", "", self.text(e), self.markup(e.start, e.end)


@F.udf(StructType([StructField("clean", StringType()), StructField("main", StringType())]), useArrow=False)
def _parts(html: str | None) -> tuple[str | None, str | None]:
    """The page without noise and what its container holds, from one parse; equal calls of a query are worked out once. Rows come by the
    hundred: an Arrow batch has 10,000 pages, of which Python would hold the sources and both results."""
    page = _Page(html or "")
    top = page.container()
    return None if html is None else page.markup(0, len(html)), None if top is None else page.markup(top.inner, top.last)


def strip_noise(html: Column) -> Column:
    """H1: noise elements, by name or class, and all they hold go; a null stays null."""
    return _parts(html)["clean"]


def main_content(html: Column) -> Column:
    """H2: what the first of the usual containers holds, without noise, whole pages' body last; null if there is none."""
    return _parts(html)["main"]


def visible_text(html: Column) -> Column:
    """Text without tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]*>", " "), r"\s+", " "))


def classify_section(text: Column) -> Column:
    """H4: the first class with a word in the text; null is `other`."""
    low, out = F.lower(text), F
    for name, words in SECTION_WORDS.items():
        out = out.when(F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w)), name)
    return out.otherwise("other")


def route_tables(table_text: Column, section: Column) -> Column:
    """H5: the classes to which a table also goes, besides its own."""
    low = F.lower(table_text)
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))
    return F.array_compact(F.array(F.when(has(EXIT_WORDS) & (section != "exits"), "exits"), F.when(has(STOP_WORDS) & (section != "bus_stops"), "bus_stops")))


def sections(pages: DataFrame) -> DataFrame:
    """H3, H5: (page_id, seq, kind, title, text, html) of each page's elements under a heading and of its tables, with their markup; kind is
    `page` (once, if the page has a container), `element` or `table`, whose cells' texts are joined without a blank. Pages are dealt evenly first, as a small file may hold many, and a task's rows leave it by the thousand; a null page has no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("seq", pa.int32()), ("kind", pa.string()), ("title", pa.string()), ("text", pa.string()), ("html", pa.string())])
        full = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        for x in batches:
            out, size = [], 0
            for page, html in zip(x.column(0), x.column(1)):
                for k, f in enumerate(_Page(html.as_py() or "").sections()):
                    out.append((page.as_py(), k, *f))
                    size += len(f[2]) + len(f[3])
                if size > 4_000_000 or len(out) > 10_000:
                    yield full(out)
                    out, size = [], 0
            if out:
                yield full(out)

    spark = pages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)  # a number is kept; bytes would tell too few
    return pages.select("page_id", "html").repartition(tasks, "page_id").mapInArrow(run, "page_id long, seq int, kind string, title string, text string, html string")


def routed_sections(found: DataFrame) -> DataFrame:
    """H4, H5: (page_id, seq, section, text, html); a table goes to every class it fits, unless the class holds the same already. The row of
    the page itself has the section `page`."""
    own = F.when(F.col("kind") == "page", "page").otherwise(classify_section(F.col("title")))
    each = F.when(F.col("kind") == "table", route_tables(F.col("text"), F.lit("other"))).otherwise(F.array(own))
    same = Window.partitionBy("page_id", "section", "html").orderBy("seq")  # elements come before tables
    both = found.withColumn("section", F.explode(each)).repartition("page_id").withColumn("n", F.row_number().over(same)).where("kind <> 'table' or n = 1")
    return both.select("page_id", "seq", "section", "text", "html")


def format_sections(routed: DataFrame, names: DataFrame) -> DataFrame:
    """H6: names (page_id, name): the name, then the classes in their order, each heading once, with the markup of its elements; without
    `other`; '' for a page without a container."""
    order = F.array_position(F.array(F.lit("page"), *map(F.lit, SECTION_WORDS)), F.col("section"))
    rows = routed.where("section <> 'other'").groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "seq", "html"))).alias("b"))

    def part(k: int, heading: str) -> Column:
        own = F.filter("b", lambda x: x["o"] == k)
        return F.when(F.size(own) > 0, F.concat(F.lit(f" <h2>{heading}</h2> "), F.array_join(F.transform(own, lambda x: x["html"]), " "))).otherwise("")

    parts = [part(k, heading) for k, heading in enumerate(SECTION_HEADINGS, 2)]
    full = F.concat(F.lit("<h1>"), F.coalesce("name", F.lit("")), F.lit("</h1>"), *parts)
    return names.join(rows, "page_id", "left").select("page_id", F.when(F.col("b").isNull(), "").otherwise(F.trim(F.regexp_replace(full, r"\s+", " "))).alias("content"))


def extraction_stats(before: Column, after: Column) -> list[Column]:
    """H7."""
    b, a = F.length(before), F.length(after)
    return [b.alias("size_before"), a.alias("size_after"), S.reduction_percent(b, a).alias("reduction_percent"), S.reduction_ratio(b, a).alias("reduction_ratio")]


def content_issues(content: Column, least: int = 500) -> Column:
    """H8: names of what is wrong; empty is valid."""
    low = F.lower(content)
    lacking = [F.when(~low.contains(w), F.lit(f"missing_{w}")) for w in ("exit", "platform", "line", "station")]
    return F.array_compact(F.array(F.when(F.length(content) < least, "too_short"), *lacking, F.when(~low.contains("<table"), "no_table")))
