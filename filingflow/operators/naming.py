"""Collision-free report folders (H3, H4 via :mod:`text`, W1).

Reports whose base folder is equal get ``base``, ``base__1``, ``base__2`` …
in arrival order ``(page, row_idx)``; numbers in use on disk are skipped.
A base shared by a third of all reports (``NO_NAME`` is exactly that case), or by
a million folders on disk, is numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators.ordering import ordered_index


def base_folders(
    listing: DataFrame,
    title: str = "Tiêu đề",
    date: str = "Thời gian gửi",
    backup: str = "Trích yếu",
    root: str = T.CRAWL_ROOT,
    symbol: str = "symbol",
    max_title: int = 50,
    max_path: int = 20,
) -> DataFrame:
    """H4 for every listing row → column ``base``."""
    prefix = F.concat(F.lit(root + "/"), F.col(symbol))
    return listing.withColumn(
        "base", T.report_name(title, date, backup, prefix, max_title=max_title, max_path=max_path)
    )


#: Numbers of a base that one task orders together.
RANGE = 4096


def _used_numbers(folders: DataFrame | None, bases: DataFrame) -> DataFrame:
    """(base, n): the numbers of ``base, base__1, …`` in use, ``base`` itself being 0.
    A folder uses its own name and its number in a shorter name's series, a base of the
    listing only the latter."""
    names = bases if folders is None else bases.unionByName(folders)
    used = names.where(F.col("name").rlike(r"__[1-9][0-9]{0,17}$")).select(
        F.regexp_replace("name", r"__[0-9]+$", "").alias("base"),
        F.regexp_extract("name", r"__([0-9]+)$", 1).cast("bigint").alias("n"),
    )
    if folders is not None:
        used = used.unionByName(folders.select(F.col("name").alias("base"), F.lit(0).cast("bigint").alias("n")))
    return used.distinct()


def _steps(used: DataFrame) -> DataFrame:
    """(base, at, used): from the ``at``-th free number of a base on (counted from 0),
    ``used`` numbers before it are in use.  Numbers are ranked range by range."""
    ranked = ordered_index(used, ["base"], ["n"], "rank", bucket=F.expr(f"n div {RANGE}"))
    # Inside a run of consecutive numbers the count of free ones before is constant.
    return ranked.groupBy("base", (F.col("n") - F.col("rank") + 1).alias("at")).agg(F.max("rank").alias("used"))


def assign_paths(
    listing: DataFrame,
    existing: DataFrame | None = None,
    symbol: str = "symbol",
    order: Sequence[str] = ("page", "row_idx"),
) -> DataFrame:
    """``report_dir`` per row from its ``base`` column.

    New reports of a base take the free numbers of ``base, base__1, …`` in
    order.  In use are the folders of ``existing`` (column ``report_dir``),
    gaps included, and, so that all names differ (Q17), every base of this
    listing that is itself written ``base__N`` of another.

    The i-th new report skips the numbers in use below the i-th free one.  Reports and
    steps of a base meet in ranges of ``RANGE`` positions: inside a range the steps so
    far are a running maximum, and those of the ranges before come from one number per
    range, so neither the reports nor the folders of a hot base are one task's."""
    numbered = ordered_index(listing, [symbol, "base"], list(order), "_w1_rn", bucket=order[0])
    numbered = numbered.withColumn("_w1_at", F.col("_w1_rn") - 1).drop("_w1_rn")
    folders = None if existing is None else existing.select(F.col("report_dir").alias("name"))
    steps = _steps(_used_numbers(folders, listing.select(F.col("base").alias("name")).distinct()))
    reports = numbered.select(F.struct(*listing.columns).alias("_w1_row"), "base", "_w1_at", F.lit(0).cast("bigint").alias("_w1_used"))
    marks = steps.select(F.lit(None).cast(reports.schema["_w1_row"].dataType).alias("_w1_row"), "base", F.col("at").alias("_w1_at"), F.col("used").cast("bigint").alias("_w1_used"))
    both = reports.unionByName(marks).withColumn("_w1_range", F.expr(f"_w1_at div {RANGE}"))
    before = Window.partitionBy("_w1_b").orderBy("_w1_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = both.groupBy(F.col("base").alias("_w1_b"), F.col("_w1_range").alias("_w1_r")).agg(F.max("_w1_used").alias("_w1_u"))
    ranges = ranges.withColumn("_w1_u", F.max("_w1_u").over(before))
    inside = Window.partitionBy("base", "_w1_range").orderBy("_w1_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = both.withColumn("_w1_used", F.max("_w1_used").over(inside)).where("_w1_row IS NOT NULL")
    held = held.join(ranges, (held["base"] == ranges["_w1_b"]) & (held["_w1_range"] == ranges["_w1_r"]), "left")
    n = F.col("_w1_at") + F.greatest(F.col("_w1_used"), F.coalesce(F.col("_w1_u"), F.lit(0)))
    path = F.when(n == 0, F.col("base")).otherwise(F.concat(F.col("base"), F.lit("__"), n.cast("string")))
    return held.select("_w1_row.*", path.alias("report_dir"))


def path_conflicts(paths: DataFrame, path: str = "report_dir") -> DataFrame:
    """Final paths held by more than one report (Q17: a base that itself
    ends in ``__N`` can meet a generated name).  Empty when all are unique."""
    return paths.groupBy(path).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
