"""Incremental resume: checkpoints, resume filter, advance and reset.

F8, F10, M1, M2, M3.  A checkpoint is one row per symbol
``(symbol, current_page, last_row_index)``; a symbol without one starts at
``{1, 0}``.  Listing rows carry ``(symbol, page, row_idx)`` (row index on its
page, 0-based, counting every row the page shows).

All joins are between per-symbol tables (one row per symbol on the checkpoint
side) and the listing; the checkpoint table grows with the number of symbols,
not with the data, and AQE broadcasts it once it has measured it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


START_PAGE = 1
START_ROW = 0


def with_checkpoint(rows: DataFrame, checkpoints: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Attach each row's checkpoint; ``{1, 0}`` where the symbol has none."""
    cp = checkpoints.select(
        F.col(symbol).alias("_cp_symbol"),
        F.col("current_page").alias("_cp_page"),
        F.col("last_row_index").alias("_cp_row"),
    )
    j = rows.join(cp, rows[symbol] == cp["_cp_symbol"], "left")
    return j.withColumn("_cp_page", F.coalesce("_cp_page", F.lit(START_PAGE))).withColumn(
        "_cp_row", F.coalesce("_cp_row", F.lit(START_ROW))
    ).drop("_cp_symbol")


# F8 -------------------------------------------------------------------------
def resume_rows(rows: DataFrame, checkpoints: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows at or after each symbol's checkpoint position.

    The intended rule: later pages whole, the checkpoint page from
    ``last_row_index`` on (the reference's carried-over row index on later
    pages is a bug and is not copied).
    """
    j = with_checkpoint(rows, checkpoints, symbol)
    keep = (F.col("page") > F.col("_cp_page")) | (
        (F.col("page") == F.col("_cp_page")) & (F.col("row_idx") >= F.col("_cp_row"))
    )
    return j.where(keep).drop("_cp_page", "_cp_row")


# F10 ------------------------------------------------------------------------
def is_complete(current_page: str = "current_page", number_pages: str = "number_pages") -> F.Column:
    """A symbol is done when its checkpoint page is past the last page."""
    return F.col(current_page) > F.col(number_pages)


# M1 -------------------------------------------------------------------------
def advance_checkpoints(
    processed: DataFrame,
    page_sizes: DataFrame,
    checkpoints: DataFrame | None = None,
    symbol: str = "symbol",
) -> DataFrame:
    """New checkpoint after the processed rows.

    The last processed row (greatest ``(page, row_idx)``) moves the checkpoint
    to the next row; when it was the page's last row, to the next page at row
    0.  Symbols without processed rows keep their old checkpoint.
    """
    last = processed.groupBy(symbol).agg(
        F.max(F.struct("page", "row_idx")).alias("_last")
    ).select(symbol, F.col("_last.page").alias("page"), F.col("_last.row_idx").alias("row_idx"))
    sizes = page_sizes.select(
        F.col(symbol).alias("_ps_symbol"), F.col("page").alias("_ps_page"), F.col("n_rows").alias("_ps_n")
    )
    j = last.join(
        sizes, (last[symbol] == sizes["_ps_symbol"]) & (last["page"] == sizes["_ps_page"]), "left"
    )
    page_done = F.coalesce(F.col("row_idx") + 1 >= F.col("_ps_n"), F.lit(False))
    new = j.select(
        F.col(symbol).alias(symbol),
        F.when(page_done, F.col("page") + 1).otherwise(F.col("page")).cast("bigint").alias("current_page"),
        F.when(page_done, F.lit(0)).otherwise(F.col("row_idx") + 1).cast("bigint").alias("last_row_index"),
    )
    if checkpoints is None:
        return new
    old = checkpoints.select(
        F.col(symbol).alias(symbol),
        F.col("current_page").cast("bigint").alias("current_page"),
        F.col("last_row_index").cast("bigint").alias("last_row_index"),
    )
    kept = old.join(new.select(F.col(symbol).alias("_n_symbol")), old[symbol] == F.col("_n_symbol"), "left_anti")
    return new.unionByName(kept)


# M2 -------------------------------------------------------------------------
def reset_checkpoints(checkpoints: DataFrame, symbols: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Listed symbols go back to ``{1, 0}`` (a row is written even where none
    existed); other checkpoints are unchanged.  One outer join of the two lists."""
    reset = symbols.select(F.col(symbol).alias("_r_symbol")).distinct()
    j = checkpoints.join(reset, checkpoints[symbol] == reset["_r_symbol"], "full")
    redo = F.col("_r_symbol").isNotNull()
    return j.select(
        F.coalesce(checkpoints[symbol], "_r_symbol").alias(symbol),
        F.when(redo, F.lit(START_PAGE)).otherwise(F.col("current_page")).cast("bigint").alias("current_page"),
        F.when(redo, F.lit(START_ROW)).otherwise(F.col("last_row_index")).cast("bigint").alias("last_row_index"),
    )


# M3 -------------------------------------------------------------------------
def drop_symbols(df: DataFrame, symbols: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Everything captured for the listed symbols removed (anti-join)."""
    s = symbols.select(F.col(symbol).alias("_drop_symbol"))
    return df.join(s, df[symbol] == s["_drop_symbol"], "left_anti")
