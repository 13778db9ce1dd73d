"""Symbol → tax code.

The modal code of a symbol's report-index rows; ties go to the smallest code;
a missing code is the text ``'nan'`` and competes like any other value (the
reference reads every value as text).  Done as two aggregations: counts per
(symbol, code), then the smallest ``struct(-count, code)`` per symbol.  Both
combine map-side, so a symbol with a third of all rows is still spread over
all tasks; nothing collects a symbol's values in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING_TEXT = "nan"


def tax_code_mode(
    index: DataFrame,
    symbols: DataFrame | None = None,
    symbol: str = "symbol",
    code: str = "Mã doanh nghiệp",
    drop_missing: bool = False,
) -> DataFrame:
    """(Symbol, tax_code); with ``symbols`` every listed symbol is kept and
    those without index rows get null (J6)."""
    codes = index.select(F.col(symbol).alias("_sym"), F.col(code).cast("string").alias("_code"))
    if drop_missing:
        codes = codes.where(F.col("_code").isNotNull())
    else:
        codes = codes.withColumn("_code", F.coalesce("_code", F.lit(MISSING_TEXT)))
    counts = codes.groupBy("_sym", "_code").agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy("_sym").agg(
        F.min(F.struct((-F.col("_n")).alias("neg"), F.col("_code").alias("code"))).alias("_best")
    )
    best = best.select(F.col("_sym"), F.col("_best.code").alias("tax_code"))
    if symbols is None:
        return best.select(F.col("_sym").alias("Symbol"), "tax_code")
    listed = symbols.select(F.col(symbol).alias("Symbol"))
    return listed.join(best, listed["Symbol"] == best["_sym"], "left").select("Symbol", "tax_code")
