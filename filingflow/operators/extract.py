"""Extraction from captured pages.

One ``mapInArrow`` pass over the pages table reads each page's tags with the
standard library's ``html.parser`` into flat lists: elements in document order, each
with the range of elements and of text pieces below it.  "Inside" is then a range, so
nothing is recursive and no nesting is too deep.  Everything after the texts of the
configured elements — chunking a flat cell list into rows, padding, de-duplication,
the second half of a header — is a JVM column expression from
:mod:`filingflow.functions.arrays`.

Pages are processed independently, so the job partitions like the pages table; a
few pages at a time are held.  A null page has no elements; ids may be of any type,
null or repeated.

Selectors are a small CSS subset: ``tag``, ``.class``, ``#id``,
``[attr="value"]`` compounds, descendant combinator (space) and selector
lists (comma, results in document order).

Three capture modes, one per crawler flavour of the reference:

``flat``      header texts and a flat list of cell texts (X1); rows come
              from :func:`chunk_cells` by header width.
``spans``     per row the visible, non-empty span texts (X2, X4); rows are
              padded to the header width.  By default only the outermost
              visible spans are cells and hidden spans are never listed;
              ``faithful=True`` lists every descendant span as the reference
              does (a hidden span directly in the row is listed, a visible
              nested span is listed twice).
``rendered``  per row every span's rendered text, equal texts once, padded;
              headers are the second half of the header cells (X3).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.functions import arrays as A
from filingflow.operators.common import explode_positions

# Fixed values of the HTML standard: elements without an end, elements whose text is
# no text, and which open element a start tag ends if its end tag was left out.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW_TEXT = {"script", "style"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
    "section", "table", "ul",
}
P_SCOPE = {"div", "article", "section", "body", "td", "th", "li", "button"}
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
}


class Page(HTMLParser):
    """A page as lists: element ``e`` holds the elements ``e + 1 .. stop[e] - 1`` and the
    pieces ``first[e] .. last[e] - 1``; a piece is (text, innermost hidden span around
    it, the same for spans hidden by exactly the reference's style)."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.tags, self.attrs, self.stop, self.first, self.last, self.pieces = [], [], [], [], [], []
        self.veiled, self.veiled_exact = [], []  # is the element a hidden span
        self._open, self._tags, self._veils, self._exact = [], Counter(), [-1], [-1]
        self.feed(html or "")
        self.close()
        self._pop(0)

    def _pop(self, depth: int) -> None:
        while len(self._open) > depth:
            e = self._open.pop()
            self._tags[self.tags[e]] -= 1
            self.stop[e], self.last[e] = len(self.tags), len(self.pieces)
            for veils in (self._veils, self._exact):
                if veils[-1] == e:
                    veils.pop()

    def _end(self, tags: set[str], scope: set[str] = frozenset()) -> None:
        """Ends the innermost open element of some tags, unless one of ``scope`` is inside it."""
        if not any(self._tags[t] for t in tags):
            return
        for depth in range(len(self._open) - 1, -1, -1):
            tag = self.tags[self._open[depth]]
            if tag in tags:
                return self._pop(depth)
            if tag in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._end({"p"}, P_SCOPE)
        if tag in ENDS:
            self._end(*ENDS[tag])
        attrs, e = {k: v or "" for k, v in attrs}, len(self.tags)
        style = attrs.get("style", "") if tag == "span" else ""
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.veiled.append(style.replace(" ", "").lower().rstrip(";") == "display:none")
        self.veiled_exact.append(style == "display:none")
        self.first.append(len(self.pieces))
        if tag == "br":
            self.pieces.append(("\n", self._veils[-1], self._exact[-1]))
        self.stop.append(e + 1)
        self.last.append(len(self.pieces))
        if tag not in VOID:
            self._open.append(e)
            self._tags[tag] += 1
            if self.veiled[e]:
                self._veils.append(e)
            if self.veiled_exact[e]:
                self._exact.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop(len(self._open) - 1)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._end({tag})

    def handle_data(self, data):
        if not self._open or self.tags[self._open[-1]] not in RAW_TEXT:
            self.pieces.append((data, self._veils[-1], self._exact[-1]))

    # Texts ----------------------------------------------------------------------------
    def whole_text(self, e: int) -> str:
        """All text, trimmed."""
        return "".join(t for t, _, _ in self.pieces[self.first[e] : self.last[e]]).strip()

    def inner_text(self, e: int) -> str:
        """Rendered text: hidden spans contribute nothing; trimmed."""
        if self.veiled[e]:
            return ""
        return "".join(t for t, veil, _ in self.pieces[self.first[e] : self.last[e]] if veil <= e).strip()

    def stripped(self, e: int, veil: int | None = None) -> str:
        """Text pieces stripped and concatenated; with ``veil`` (1: any hidden span, 2: the
        exact style) without the pieces of hidden spans inside the element."""
        pieces = self.pieces[self.first[e] : self.last[e]]
        return "".join(p[0].strip() for p in pieces if veil is None or p[veil] <= e)

    def inside(self, e: int, tag: str) -> list[int]:
        return [i for i in range(e + 1, self.stop[e]) if self.tags[i] == tag]

    # Selectors ------------------------------------------------------------------------
    def select(self, selector: str, within: int | None = None) -> list[int]:
        """Elements that match a selector list, in document order, each once."""
        found: set[int] = set()
        for alternative in selector.split(","):
            ranges = [(0, len(self.tags)) if within is None else (within + 1, self.stop[within])]
            for compound in map(_compound, alternative.split()):
                hits, end = [], 0
                for a, b in ranges:  # in order; one inside the last was looked at
                    hits += [e for e in range(max(a, end), b) if self._matches(e, compound)]
                    end = max(end, b)
                ranges = [(e + 1, self.stop[e]) for e in hits]
            found.update(hits)
        return sorted(found)

    def _matches(self, e: int, compound: tuple) -> bool:
        tag, classes, wanted = compound
        attrs = self.attrs[e]
        return (
            (not tag or self.tags[e] == tag)
            and (not classes or classes <= set(attrs.get("class", "").split()))
            and all(k in attrs and v in (None, attrs[k]) for k, v in wanted)
        )


_COMPOUND = re.compile(r"""([a-zA-Z0-9_-]+)|\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:=["']?([^"'\]]*)["']?)?\]""")


def _compound(text: str) -> tuple[str | None, set[str], list[tuple[str, str | None]]]:
    """(tag, classes, attributes with the value asked for or none) of one compound selector."""
    tag, classes, wanted = None, set(), []
    for name, cls, ident, attr, value in _COMPOUND.findall(text):
        tag = name.lower() or tag
        classes |= {cls} - {""}
        wanted += [("id", ident)] * bool(ident) + [(attr, value or None)] * bool(attr)
    return tag, classes, wanted


# One page → lists --------------------------------------------------------------------
def _listed_spans(page: Page, row: int, cell: str) -> list[str]:
    """Non-empty texts of every cell element in the row, as the reference lists them: a
    hidden span inside a cell element is taken out, and with it what is inside."""
    out, end_cell, end_gone = [], row, 0
    for e in range(row + 1, page.stop[row]):
        if page.veiled_exact[e] and e < end_cell:
            end_gone = max(end_gone, page.stop[e])
        if page.tags[e] == cell:
            end_cell = max(end_cell, page.stop[e])
            if e >= end_gone and (text := page.stripped(e, 2)):
                out.append(text)
    return out


def _visible_spans(page: Page, row: int, cell: str) -> list[str]:
    """Non-empty texts of the outermost cell elements that are not hidden."""
    out, end = [], 0
    for e in page.inside(row, cell):
        if e >= end:
            end = page.stop[e]
            if not page.veiled[e] and (text := page.stripped(e, 1)):
                out.append(text)
    return out


def page_lists(page: Page, cfg: dict, mode: str, faithful: bool = False) -> tuple[list[str], list[str], list[list[str]]]:
    """One page → (headers, flat cells, rows of cells).

    ``header`` is matched inside the first ``header_scope`` element (the
    document when unset); ``row`` inside the first ``table`` element (the
    document when unset).  A selector can carry its own ancestors, so "all
    matches anywhere" and "inside the first container" are both expressible."""

    def matched(scope: str, key: str) -> list[int]:
        if not cfg.get(key):
            return []
        if not cfg.get(scope):
            return page.select(cfg[key])
        around = page.select(cfg[scope])
        return page.select(cfg[key], around[0]) if around else []

    headers = [page.stripped(e) if mode == "spans" else page.inner_text(e) for e in matched("header_scope", "header")]
    rows, cell = matched("table", "row"), cfg.get("cell", "span")
    if mode == "flat":
        return headers, [page.inner_text(e) for e in rows], []
    if mode == "spans":
        pick = _listed_spans if faithful else _visible_spans
        return headers, [], [pick(page, e, cell) for e in rows]
    if mode == "rendered":
        return headers, [], [[page.inner_text(s) for s in page.inside(e, cell)] for e in rows]
    raise ValueError(f"unknown mode {mode!r}")


def firm_texts(page: Page, cfg: dict) -> tuple[str | None, ...]:
    """Company code, company name and report title: the first match's text."""
    found = (page.select(cfg[k])[:1] if cfg.get(k) else [] for k in ("code", "name", "title"))
    return tuple(page.whole_text(e[0]) if e else None for e in found)


# Spark jobs ---------------------------------------------------------------------------
PAGES_PER_YIELD = 64
_TEXTS = pa.list_(pa.string())
_FIRM = {"code": pa.string(), "name": pa.string(), "title": pa.string()}
_LISTS = {"headers": _TEXTS, "cells": _TEXTS, "rows": pa.list_(_TEXTS)}
_SQL = {pa.string(): "string", _TEXTS: "array<string>", pa.list_(_TEXTS): "array<array<string>>"}


def _per_page(pages: DataFrame, html: str, columns: dict[str, pa.DataType], of: Callable[[Page], tuple]) -> DataFrame:
    """(page_id, columns) of every page; a few pages' lists are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_PER_YIELD):
                part = batch.slice(at, PAGES_PER_YIELD)
                found = [of(Page(text.as_py())) for text in part.column(1)]
                lists = [pa.array([f[k] for f in found], t) for k, t in enumerate(columns.values())]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["page_id", *columns])

    schema = f"page_id {dict(pages.dtypes)['page_id']}, " + ", ".join(f"{c} {_SQL[t]}" for c, t in columns.items())
    return pages.select("page_id", html).mapInArrow(run, schema)


def extract_cells(
    pages: DataFrame, config: dict, mode: str = "flat", faithful: bool = False, html: str = "html"
) -> DataFrame:
    """(page_id, headers, cells, rows) per page; see the module doc for modes."""
    cfg = dict(config)
    return _per_page(pages, html, _LISTS, lambda page: page_lists(page, cfg, mode, faithful))


def table_rows(extracted: DataFrame, mode: str = "flat") -> DataFrame:
    """Rows of each page's table: (page_id, headers, row_no, row).

    flat: H17 chunk by header width.  spans: H18 pad.  rendered: H21 header
    half, H19 de-duplication, H18 pad.
    """
    if mode == "flat":
        shaped = extracted.select(
            "page_id", "headers", A.chunk_cells("cells", F.size("headers")).alias("_rows")
        )
    elif mode == "spans":
        shaped = extracted.select(
            "page_id",
            "headers",
            F.transform("rows", lambda r: A.pad_row(r, F.size("headers"))).alias("_rows"),
        )
    elif mode == "rendered":
        half = A.second_half("headers")
        # Not aliased "headers" in this select: a lambda's reference to
        # "headers" would resolve to that lateral alias instead of the input.
        shaped = extracted.select(
            "page_id",
            half.alias("_half"),
            F.transform("rows", lambda r: A.pad_row(A.dedupe_row(r), F.size(half))).alias("_rows"),
        ).withColumnRenamed("_half", "headers")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    rows = explode_positions(shaped, F.col("_rows"), "row_no", "row", ["page_id", "headers"])
    return rows.withColumn("malformed", A.row_too_long("row", F.size("headers")))


def firm_info(pages: DataFrame, config: dict, html: str = "html") -> DataFrame:
    """Company code, company name and report title per page."""
    cfg = dict(config)
    return _per_page(pages, html, _FIRM, lambda page: firm_texts(page, cfg))


def parse_pages(
    pages: DataFrame, table_config: dict, firm_config: dict, mode: str = "flat",
    faithful: bool = False, html: str = "html",
) -> DataFrame:
    """X5 and X1-X3 from one parse of each page: firm fields plus the table
    lists (what :func:`firm_info` and :func:`extract_cells` give apart)."""
    tcfg, fcfg = dict(table_config), dict(firm_config)
    return _per_page(pages, html, _FIRM | _LISTS, lambda page: firm_texts(page, fcfg) + page_lists(page, tcfg, mode, faithful))


def page_summary(parsed: DataFrame, mode: str = "flat") -> DataFrame:
    """(page_id, code, name, title, headers, table, n_rows) from
    :func:`parse_pages`, in the same stage as the parse (no join)."""
    none = F.array().cast("array<array<string>>")
    table = F.coalesce(A.chunk_cells("cells", F.size("headers")), none) if mode == "flat" else F.col("rows")
    shaped = parsed.select("page_id", "code", "name", "title", "headers", table.alias("table"))
    return shaped.withColumn("n_rows", F.size("table").cast("bigint"))


def assemble_report(listing: DataFrame, summary: DataFrame, key: str = "page_id") -> DataFrame:
    """Listing row + firm info + the table and its number of rows, joined
    on the page (``summary`` from :func:`page_summary`, one row per page)."""
    f = summary.withColumnRenamed(key, "_f_key")
    j = listing.join(f, listing[key] == f["_f_key"], "left").drop("_f_key")
    return j.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("bigint"))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Fast path for simple markup: ``<li><a href>text</a></li>`` pairs with
    a regular expression in the JVM (no Python worker)."""
    pat = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    return pages.select(
        "page_id",
        F.arrays_zip(
            F.regexp_extract_all(html, F.lit(pat), 1).alias("href"),
            F.regexp_extract_all(html, F.lit(pat), 2).alias("text"),
        ).alias("links"),
    )
