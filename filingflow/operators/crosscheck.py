"""Cross-check of captured reports against an external truth table.

H5-H7, H9, J1, J2, F7, A9.  Reports get ``year``, ``range`` (period) and
``type`` from their title; both sides get the composite key
``year_range_type`` and the reports are left-joined to the truth rows.

Join strategy: the key has few distinct values (years × periods × types), so
some are "hot" on the report side, most of all the null key of a large symbol.
:func:`hot_keys` counts them: the reports of a key with more than its share of
all rows are dealt over tasks by a hash of the row and the truth rows of that
key, and of no other, are repeated for each task.  A repeated truth row meets at
least one report there, so the repetition is never more than the join's result.
The truth side is an external check file: when it is small, AQE still turns the
join into a broadcast-hash join after measuring it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingflow.functions import text as T

CLASH = ("year", "range", "type")


def tag_reports(reports: DataFrame, title: str = "Tên báo cáo") -> DataFrame:
    """Add year ('nan' when absent), range, type (default Riêng) and key."""
    year = T.year_of(title, missing="nan")
    rng = T.period_of(title)
    kind = T.statement_type_of(title, default=T.DEFAULT_TYPE)
    return reports.select(
        "*",
        year.alias("year"),
        rng.alias("range"),
        kind.alias("type"),
        T.report_key(year, rng, kind).alias("key"),
    )


def tag_truth(truth: DataFrame) -> DataFrame:
    """Year reduced to its four digits (null when absent) and the key."""
    year = T.year_of("year")
    return truth.withColumn("year", year).withColumn("key", T.report_key(year, "range", "type"))


def hot_keys(reports: DataFrame, title: str = "Tên báo cáo", by: Sequence[str] = (), parts: int = 1024) -> DataFrame:
    """(``by``, key, deal): the keys with more than a ``parts``-th of all reports
    and the number of tasks their rows are dealt over.

    Fewer than ``parts`` rows for any input.  Titles are counted before their
    parts are read, once for each title of a symbol."""
    titles = reports.groupBy(*by, title).agg(F.count(F.lit(1)).alias("_n"))
    keys = tag_reports(titles, title).groupBy(*by, "key").agg(F.sum("_n").alias("_n"))
    share = keys.agg(F.floor(F.sum("_n") / parts) + 1).scalar()
    hot = keys.withColumn("_share", share).where("_n > _share")
    return hot.select(*by, "key", F.ceil(F.col("_n") / F.col("_share")).cast("int").alias("deal"))


def map_source(
    reports: DataFrame,
    truth: DataFrame,
    title: str = "Tên báo cáo",
    by: Sequence[str] = (),
    null_keys: str = "match",
    salt: int | None = None,
    parts: int = 1024,
) -> DataFrame:
    """Every report row with its matching truth rows (1:n), or nulls.

    Null keys match each other by default, as a pandas merge does
    (``null_keys='drop'`` makes them unmatched).  ``by`` adds columns such as
    the symbol to the key when many symbols are checked at once.  The columns
    ``year, range, type`` of both sides are kept with ``_src``/``_truth``
    suffixes; the truth's ``key`` is dropped (equal to the report's when
    matched).

    Keys with more than a ``parts``-th of all reports are found by a count and
    dealt over tasks (:func:`hot_keys`); ``salt=N`` deals every key over N tasks
    without a count, ``salt=0`` none.  The result is the same.
    """
    src = tag_reports(reports, title)
    for c in CLASH:
        src = src.withColumnRenamed(c, f"{c}_src")
    tru = tag_truth(truth)
    for c in CLASH:
        tru = tru.withColumnRenamed(c, f"{c}_truth")
    tru = tru.withColumnRenamed("key", "_t_key")
    by = list(by)
    for c in by:
        tru = tru.withColumnRenamed(c, f"_t_{c}")
    if salt is None:
        hot = hot_keys(reports, title, by, parts)
        hot = F.broadcast(hot.select(*[F.col(c).alias(f"_h_{c}") for c in by], F.col("key").alias("_h_key"), "deal"))
        deal = F.coalesce("deal", F.lit(1))
        src = _dealt(src, hot, {"key": "_h_key", **{c: f"_h_{c}" for c in by}}, "_salt", F.pmod(F.xxhash64(*src.columns), deal).cast("int"))
        tru = _dealt(tru, hot, {"_t_key": "_h_key", **{f"_t_{c}": f"_h_{c}" for c in by}}, "_t_salt", F.explode(F.sequence(F.lit(0), deal - 1)))
    elif salt > 1:
        src = src.withColumn("_salt", F.pmod(F.xxhash64(*src.columns), F.lit(salt)))
        tru = tru.withColumn("_t_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    eq = (lambda a, b: a.eqNullSafe(b)) if null_keys == "match" else (lambda a, b: a == b)
    cond = eq(src["key"], tru["_t_key"])
    for c in by:
        cond = cond & (src[c] == tru[f"_t_{c}"])
    if salt is None or salt > 1:
        cond = cond & (src["_salt"] == tru["_t_salt"])
    out = src.join(tru, cond, "left").drop("_t_key", *[f"_t_{c}" for c in by])
    if salt is None or salt > 1:
        out = out.drop("_salt", "_t_salt")
    return out


def _dealt(rows: DataFrame, hot: DataFrame, pairs: dict[str, str], name: str, salt: Column) -> DataFrame:
    """``rows`` with the column ``name``, made from the ``deal`` of their key in ``hot`` (null if not hot)."""
    cond = F.lit(True)
    for mine, theirs in pairs.items():
        cond = cond & rows[mine].eqNullSafe(hot[theirs])
    return rows.join(hot, cond, "left").select(*[rows[c] for c in rows.columns], salt.alias(name))


def mapped_reports(merged: DataFrame, match_col: str = "tax_code") -> DataFrame:
    """Keep rows whose truth match carries a value."""
    return merged.where(F.col(match_col).isNotNull())


def map_counts(merged: DataFrame, truth: DataFrame, match_col: str = "tax_code") -> DataFrame:
    """Rows after the join, truth rows, mapped rows — one row."""
    m = merged.select(
        F.lit(1).alias("_src"), F.lit(0).alias("_tru"), F.col(match_col).isNotNull().alias("_hit")
    )
    t = truth.select(F.lit(0).alias("_src"), F.lit(1).alias("_tru"), F.lit(False).alias("_hit"))
    return m.unionByName(t).agg(
        F.sum("_src").cast("bigint").alias("n_source"),
        F.sum("_tru").cast("bigint").alias("n_truth"),
        F.count_if("_hit").alias("n_mapped"),
    )
