"""Crawl audit: which symbols are clean and which must be scraped again.

U1-U4, A1, A5, A10, A11, J3, J4, J9, O1-O3.  Inputs are log lines (one row per
line, column ``value``, optional ``file``) and report-index rows (one row per
listed report, columns ``symbol`` and ``STT``).

Every step is an aggregation with map-side combine or a join between
per-symbol aggregates (one row per symbol on each side), so a symbol that owns
a large part of the log or of the index costs one partial aggregate per task,
never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from filingflow.functions import text as T


# S10 → H10/H12/H23: one parsed row per log line ---------------------------------
def parse_log(logs: DataFrame, line: str = "value") -> DataFrame:
    """Log lines → (ts, level, event, symbol, got, expected, + input columns)."""
    ok = T.log_symbol(line, "success")
    warn = T.log_symbol(line, "warning")
    counts = T.log_counts(line)
    return logs.select(
        "*",
        T.log_time(line).alias("ts"),
        T.log_level(line).alias("level"),
        F.when(ok.isNotNull(), F.lit("success"))
        .when(warn.isNotNull(), F.lit("warning"))
        .alias("event"),
        F.coalesce(ok, warn).alias("symbol"),
        F.when(ok.isNotNull() | warn.isNotNull(), counts["got"]).alias("got"),
        F.when(ok.isNotNull() | warn.isNotNull(), counts["expected"]).alias("expected"),
    )


# U1 -------------------------------------------------------------------------
def log_sets(logs: DataFrame, line: str = "value") -> DataFrame:
    """(symbol, in_success, in_warning) over all lines (search, not full match).

    A line is tested against both patterns independently, as the reference
    does.
    """
    hits = logs.select(
        F.inline(
            F.array(
                F.struct(
                    T.log_symbol(line, "success").alias("symbol"),
                    F.lit(True).alias("ok"),
                    F.lit(False).alias("warn"),
                ),
                F.struct(
                    T.log_symbol(line, "warning").alias("symbol"),
                    F.lit(False).alias("ok"),
                    F.lit(True).alias("warn"),
                ),
            )
        )
    ).where(F.col("symbol").isNotNull())
    return hits.groupBy("symbol").agg(
        F.bool_or("ok").alias("in_success"), F.bool_or("warn").alias("in_warning")
    )


# A5 -------------------------------------------------------------------------
# A number as pandas reads it from a CSV cell (public pandas behaviour).
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def stt_uniqueness(index: DataFrame, symbol: str = "symbol", stt: str = "STT") -> DataFrame:
    """Rows vs distinct STT per symbol, as a pandas read of the index sees it.

    A column whose values are all numbers is compared numerically (``1`` and
    ``1.0`` are one value), otherwise as text; a missing STT counts as one
    value.  Rows are first reduced to (symbol, STT) pairs, so a symbol with
    a third of all rows is combined map-side like any other.  An STT column
    of an integer type needs no reading as text: its pairs are counted.
    """
    if isinstance(index.select(stt).schema[0].dataType, IntegralType):
        pairs = index.groupBy(F.col(symbol).alias("symbol"), F.col(stt).alias("_stt")).agg(F.count(F.lit(1)).alias("_n"))
        per = pairs.groupBy("symbol").agg(F.sum("_n").cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
        return per.withColumn("stt_unique", F.col("n_rows") == F.col("n_distinct"))
    pairs = index.groupBy(
        F.col(symbol).alias("symbol"), F.col(stt).cast("string").alias("_stt")
    ).agg(F.count(F.lit(1)).alias("_n"))
    v = F.col("_stt")
    is_num = v.rlike(_NUMBER)
    whole = F.when(v.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(v).try_cast("decimal(38,0)"))
    per = pairs.groupBy("symbol").agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.count(v).alias("_n_text"),
        F.max(v.isNull().cast("bigint")).alias("_has_null"),
        F.bool_and(F.coalesce(is_num, F.lit(True))).alias("_all_num"),
        F.bool_and(F.coalesce(whole.isNotNull(), v.isNull())).alias("_all_whole"),
        F.count_distinct(F.when(is_num, F.trim(v).try_cast("double"))).alias("_n_num"),
        F.count_distinct(whole).alias("_n_whole"),
    )
    # whole numbers are compared exactly: a double holds them up to 2**53 only
    n_distinct = (
        F.when(F.col("_all_whole"), F.col("_n_whole")).when(F.col("_all_num"), F.col("_n_num")).otherwise(F.col("_n_text"))
    ) + F.col("_has_null")
    return per.select(
        "symbol", "n_rows", n_distinct.cast("bigint").alias("n_distinct")
    ).withColumn("stt_unique", F.col("n_rows") == F.col("n_distinct"))


# U2, U3, J9 ---------------------------------------------------------------------
def classify_symbols(sets: DataFrame, index_stats: DataFrame, index_files: DataFrame | None = None) -> DataFrame:
    """(symbol, status, reason): clean or error; the two sets are disjoint.

    error = (warning − success) ∪ (success without a readable index)
            ∪ (success whose index repeats an STT); clean = the rest of success.

    ``index_files`` holds the index files present: ``symbol`` and, as in
    :func:`filingflow.sources.files.index_inventory`, ``has_stt`` (the file can be
    read and has the column; without it every file counts as such).  A file that is
    not ``has_stt`` is no index, whatever rows ``index_stats`` has; one with a header
    and no rows repeats nothing.  Without ``index_files`` only symbols with index
    rows have an index.
    """
    stats = index_stats.select(
        F.col("symbol").alias("_idx_symbol"), F.col("stt_unique").alias("_stt_unique")
    )
    if index_files is not None:
        usable = F.col("has_stt") if "has_stt" in index_files.columns else F.lit(True)
        present = index_files.groupBy(F.col("symbol").alias("_file_symbol")).agg(F.bool_and(usable).alias("_usable"))
        stats = present.join(stats, F.col("_file_symbol") == F.col("_idx_symbol"), "full").select(
            F.coalesce("_idx_symbol", "_file_symbol").alias("_idx_symbol"),
            F.coalesce("_stt_unique", F.lit(True)).alias("_stt_unique"),
            F.coalesce("_usable", F.lit(True)).alias("_usable"),
        ).where("_usable").drop("_usable")
    joined = sets.join(stats, sets["symbol"] == stats["_idx_symbol"], "left")
    reason = (
        F.when(~F.col("in_success"), F.lit("warning_only"))
        .when(F.col("_idx_symbol").isNull(), F.lit("no_index"))
        .when(~F.col("_stt_unique"), F.lit("duplicate_stt"))
    )
    return joined.select(
        "symbol",
        F.when(reason.isNull(), F.lit("clean")).otherwise(F.lit("error")).alias("status"),
        reason.alias("reason"),
    )


def audit_logs(logs: DataFrame, index: DataFrame, line: str = "value", index_files: DataFrame | None = None) -> DataFrame:
    """Logs + report index → classified symbols (the reference's audit)."""
    return classify_symbols(log_sets(logs, line), stt_uniqueness(index), index_files)


# A1 -------------------------------------------------------------------------
def crawl_kpi(classified: DataFrame) -> DataFrame:
    """One row: clean count, error count, error rate % (0 when empty)."""
    agg = classified.agg(
        F.count_if(F.col("status") == "clean").alias("success"),
        F.count_if(F.col("status") == "error").alias("error"),
    )
    return agg.withColumn("error_rate", T.error_rate("error", F.col("success") + F.col("error")))


# A10 ------------------------------------------------------------------------
def total_scraped(sets: DataFrame) -> DataFrame:
    """|warning − success| + |success| before index validation."""
    return sets.agg(F.count(F.lit(1)).alias("total_scraped"))


# S11, H11, J3, U4 -----------------------------------------------------------------
def latest_log(logs: DataFrame, file: str = "file") -> DataFrame:
    """Lines of the file greatest by name only."""
    newest = logs.agg(F.max(file).alias("_newest"))
    # A one-row side: broadcasting it is bounded by construction.
    return logs.join(F.broadcast(newest), F.col(file) == F.col("_newest"), "left_semi")


def log_summary(logs: DataFrame, line: str = "value", file: str = "file") -> DataFrame:
    """Positional summary of the newest log: success rows, then warning rows
    whose symbol has no success row (duplicates kept).

    The per-symbol "has a success row" flag is an aggregation joined back,
    so the newest-log rows are derived in two branches, not three.
    """
    parsed = latest_log(logs, file).select(T.parse_log_tokens(line).alias("p")).select("p.*")
    parsed = parsed.where(F.col("kind").isNotNull())
    ok_symbols = parsed.groupBy(F.col("symbol").alias("_ok_symbol")).agg(
        F.bool_or(F.col("kind") == "success").alias("_has_ok")
    )
    j = parsed.join(ok_symbols, parsed["symbol"].eqNullSafe(ok_symbols["_ok_symbol"]), "left")
    keep = (F.col("kind") == "success") | ~F.coalesce(F.col("_has_ok"), F.lit(False))
    return j.where(keep).select(
        F.col("symbol").alias("Symbol"), F.col("report_count").alias("report_count"), "kind"
    )


# J4, O1, A11 ------------------------------------------------------------------------
def open_symbols(symbols: DataFrame, clean: DataFrame, descending: bool = True) -> DataFrame:
    """Symbols of the list that are not clean, sorted (descending by default)."""
    done = clean.select(F.col("symbol").alias("_clean_symbol"))
    out = symbols.join(done, symbols["symbol"] == done["_clean_symbol"], "left_anti")
    return out.orderBy(F.col("symbol").desc() if descending else F.col("symbol").asc())


def count_open(symbols: DataFrame, clean: DataFrame) -> DataFrame:
    """Distinct open symbols as a one-row table."""
    done = clean.select(F.col("symbol").alias("_clean_symbol"))
    out = symbols.join(done, symbols["symbol"] == done["_clean_symbol"], "left_anti")
    return out.agg(F.count_distinct("symbol").alias("n_open"))


# O3 ------------------------------------------------------------------------
def first_row(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row under an explicit total order (a top-1, map-side combined)."""
    return df.orderBy(*order).limit(1)
