"""Column → Column array functions.

Higher-order built-ins (``transform``, ``filter``, ``slice``) keep the work in
the JVM; no row of cells ever goes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _width(n: Column | int) -> Column:
    return F.lit(n) if isinstance(n, int) else n


# H17 -------------------------------------------------------------------------
def chunk_cells(cells: Column | str, width: Column | int) -> Column:
    """Flat cell list → rows of ``width`` cells; the last row null-padded.

    A width of 0 (or less, or null) cannot shape a table: the result is null.
    """
    c, n = _col(cells), _width(width)
    n_rows = F.ceil(F.size(c) / n).cast("int")
    starts = F.sequence(F.lit(0), n_rows - 1)
    rows = F.transform(
        starts,
        lambda i: F.concat(
            F.slice(c, i * n + 1, n),
            F.array_repeat(F.lit(None).cast("string"), F.greatest(n - (F.size(c) - i * n), F.lit(0))),
        ),
    )
    empty = F.array().cast("array<array<string>>")
    return F.when(n > 0, F.when(F.size(c) > 0, rows).otherwise(empty))


def flatten_rows(rows: Column | str) -> Column:
    """Inverse of :func:`chunk_cells` up to the null padding."""
    return F.filter(F.flatten(_col(rows)), lambda x: x.isNotNull())


# H18 -------------------------------------------------------------------------
def pad_row(row: Column | str, width: Column | int) -> Column:
    """Right-pad with ``''`` to ``width``; a longer row is returned as is."""
    r, n = _col(row), _width(width)
    return F.concat(r, F.array_repeat(F.lit(""), F.greatest(n - F.size(r), F.lit(0))))


def row_too_long(row: Column | str, width: Column | int) -> Column:
    """A row with more cells than headers cannot form the table (malformed)."""
    return F.size(_col(row)) > _width(width)


# H19, H20, H21 -----------------------------------------------------------------
def dedupe_row(row: Column | str) -> Column:
    """Equal texts in one row kept once, first occurrence order kept."""
    return F.array_distinct(_col(row))


def drop_empty(row: Column | str) -> Column:
    return F.filter(_col(row), lambda x: x != F.lit(""))


def second_half(headers: Column | str) -> Column:
    """Headers ``n//2 .. n-1`` (the rendered table repeats its header)."""
    h = _col(headers)
    half = F.floor(F.size(h) / 2).cast("int")
    return F.slice(h, half + 1, F.size(h) - half)


# H22 -------------------------------------------------------------------------
def row_to_pairs(headers: Column | str, row: Column | str) -> Column:
    """Cells zipped with their header: array<struct(name, value)>.

    A map would reject repeated header texts; a list of pairs keeps them.
    """
    h, r = _col(headers), _col(row)
    n = F.size(h)
    pairs = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            F.try_element_at(h, i).alias("name"), F.try_element_at(r, i).alias("value")
        ),
    )
    return F.when(n > 0, pairs).otherwise(F.array().cast("array<struct<name:string,value:string>>"))


# A12 -------------------------------------------------------------------------
def align_truncate(*arrays: Column | str) -> Column:
    """Parallel lists cut to the shortest, zipped to one list of structs."""
    cols = [_col(a) for a in arrays]
    n = F.least(*[F.size(c) for c in cols]) if len(cols) > 1 else F.size(cols[0])
    return F.arrays_zip(*[F.slice(c, 1, n) for c in cols])
