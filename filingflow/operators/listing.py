"""Report listing rows: projection, filters, search, de-duplication.

F1-F5, F12, W3, W4, J8, U5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators.common import keep_rows
from filingflow.operators.ordering import first_per_key

SUBMITTED_FORMAT = "dd/MM/yyyy HH:mm:ss"


# H1 + H2 + F1 ---------------------------------------------------------------------
def project_by_header(
    df: DataFrame,
    headers: str = "headers",
    cells: str = "cells",
    wanted: Sequence[str] = T.LISTING_COLUMNS,
) -> DataFrame:
    """Cells picked by the position of each wanted column in the page header.

    Only wanted columns present in the header are produced, in wanted order
    (column ``cols``, an array), each cell ``''`` when the row is shorter.
    Also returns one column per wanted name (null when the header lacks it).
    """
    h, c = F.col(headers), F.col(cells)
    picked = []
    named = []
    for name in wanted:
        pos = F.array_position(h, F.lit(name)).cast("int")
        cell = F.coalesce(F.try_element_at(c, pos), F.lit(""))
        picked.append(F.when(pos > 0, F.array(cell)).otherwise(F.array().cast("array<string>")))
        named.append(F.when(pos > 0, cell).alias(name))
    return df.select("*", F.concat(*picked).alias("cols"), *named)


def listing_from_text(df: DataFrame, text: str = "row_text", headers: str = "headers") -> DataFrame:
    """Row inner text → cleaned cells (H1, H2) → projected columns (F1)."""
    with_cells = df.withColumn("cells", T.split_cells(T.clean_row_text(text)))
    return project_by_header(with_cells, headers, "cells")


# F2 -------------------------------------------------------------------------
def filter_listing_names(df: DataFrame, headers: str = "headers", cols: str = "cols") -> DataFrame:
    """Drop rows whose name cell (second projected cell) is a header text or
    contains ``Filter``."""
    name = F.try_element_at(F.col(cols), F.lit(2))
    bad = F.coalesce(F.array_contains(F.col(headers), name), F.lit(False)) | F.coalesce(
        name.contains("Filter"), F.lit(False)
    )
    return keep_rows(df, ~bad)


# F3 -------------------------------------------------------------------------
def filter_listing_cells(df: DataFrame, cells: str = "cells") -> DataFrame:
    """Table rows with 5 or 6 cells whose summary (4th cell) is longer than
    one character (a 4-cell row fails in the reference; it is dropped)."""
    c = F.col(cells)
    return keep_rows(df, F.size(c).between(5, 6) & (F.length(F.try_element_at(c, F.lit(4))) > 1))


def filter_listing(df: DataFrame, style: str = "name", **kw) -> DataFrame:
    """F2 (``style='name'``, the header-projected crawler) or F3
    (``style='cells'``, the table-row crawler)."""
    if style == "name":
        return filter_listing_names(df, **kw)
    if style == "cells":
        return filter_listing_cells(df, **kw)
    raise ValueError(f"style must be 'name' or 'cells', not {style!r}")


# F4, F5, F12 -------------------------------------------------------------------
def submitted_at(c: Column | str) -> Column:
    """Submission time text ``dd/MM/yyyy HH:mm:ss`` → timestamp (no zone)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(SUBMITTED_FORMAT)).cast("timestamp_ntz")


def search_listing(
    df: DataFrame,
    symbol: str | None = None,
    symbol_contains: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    symbol_col: str = "symbol",
    time_col: str = "submitted_at",
) -> DataFrame:
    """Rows of one symbol (or symbols containing a text) submitted between two
    dates, both days included.  Dates are ``yyyy-MM-dd``."""
    cond = F.lit(True)
    if symbol is not None:
        cond = cond & (F.col(symbol_col) == symbol)
    if symbol_contains is not None:
        cond = cond & F.col(symbol_col).contains(symbol_contains)
    ts = F.col(time_col)
    if date_from is not None:
        cond = cond & (ts >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        cond = cond & (ts < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp_ntz"))
    return df.where(cond)


# J8 -------------------------------------------------------------------------
def new_submissions(df: DataFrame, known: DataFrame, key: Sequence[str] = ("symbol", "submitted_at")) -> DataFrame:
    """Rows whose (symbol, submission time) is not held yet."""
    key = list(key)
    k = known.select(*[F.col(c).alias(f"_k_{c}") for c in key]).distinct()
    cond = None
    for c in key:
        e = df[c] == k[f"_k_{c}"]
        cond = e if cond is None else cond & e
    return df.join(k, cond, "left_anti")


# W3, W4 ---------------------------------------------------------------------
def first_submission(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First listing row per key in arrival order (groups are limited before the shuffle)."""
    return first_per_key(df, key, order, descending=False)


def last_write(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins per key (the tables dict keyed by summary)."""
    return first_per_key(df, key, order, descending=True)


# U5 -------------------------------------------------------------------------
def append_results(*dfs: DataFrame) -> DataFrame:
    """Per-symbol results appended into one table (columns by name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
