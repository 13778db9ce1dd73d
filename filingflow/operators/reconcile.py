"""Reports captured versus reports announced (A3, A4, A13; S12 messages)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.functions import text as T


# A3 -------------------------------------------------------------------------
def reports_per_symbol(catalog: DataFrame, symbol: str = "symbol", report: str = "report_dir") -> DataFrame:
    """Distinct report folders per symbol (``got``)."""
    return catalog.groupBy(symbol).agg(F.count_distinct(report).alias("got"))


# A13 + H8 ---------------------------------------------------------------------
def expected_reports(
    pager: DataFrame, arrived: DataFrame | None = None, symbol: str = "symbol", text: str = "pager_text"
) -> DataFrame:
    """Announced report count per symbol.

    A readable pager gives its total.  Without one the crawler counts the rows
    it processes, starting from the pager's third number when there is one
    (the reference keeps it when only the page size is unusable) else 0.
    ``arrived`` holds one row per processed listing row.
    """
    p = pager.select(
        F.col(symbol).alias(symbol),
        T.pager_is_paged(text).alias("_paged"),
        T.pager_total(text).alias("_total"),
        T.pager_pages(text).alias("number_pages"),
    )
    if arrived is None:
        return p.select(symbol, F.col("_total").alias("expected"), "number_pages")
    counted = arrived.groupBy(F.col(symbol).alias("_a_symbol")).agg(F.count(F.lit(1)).alias("_arrived"))
    j = p.join(counted, p[symbol] == counted["_a_symbol"], "left")
    expected = F.when(F.col("_paged"), F.col("_total")).otherwise(
        F.col("_total") + F.coalesce(F.col("_arrived"), F.lit(0))
    )
    return j.select(symbol, expected.cast("bigint").alias("expected"), "number_pages")


# A4 -------------------------------------------------------------------------
def reconcile(expected: DataFrame, got: DataFrame, symbol: str = "symbol") -> DataFrame:
    """(symbol, got, expected, status, message): success when equal."""
    g = got.select(F.col(symbol).alias("_g_symbol"), F.col("got"))
    j = expected.join(g, expected[symbol] == g["_g_symbol"], "left")
    got_n = F.coalesce(F.col("got"), F.lit(0)).cast("bigint")
    status = F.when(got_n == F.col("expected"), F.lit("success")).otherwise(F.lit("warning"))
    return j.select(
        F.col(symbol).alias(symbol),
        got_n.alias("got"),
        F.col("expected").cast("bigint").alias("expected"),
        status.alias("status"),
        F.concat(got_n.cast("string"), F.lit("/"), F.col("expected").cast("string")).alias("message"),
    )


# S12 ------------------------------------------------------------------------
def format_log_lines(status: DataFrame, ts: str = "ts", symbol: str = "symbol") -> DataFrame:
    """Reconciliation rows → log lines in the crawler's layout."""
    stamp = F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(","), F.date_format(ts, "SSS")
    )
    body = F.when(
        F.col("status") == "success",
        F.concat(F.lit(" - INFO - " + T.SUCCESS_MESSAGE + " "), F.col(symbol)),
    ).otherwise(F.concat(F.lit(" - WARNING - " + T.WARNING_MESSAGE + " "), F.col(symbol)))
    return status.select(F.concat(stamp, body, F.lit(": "), F.col("message")).alias("value"))
