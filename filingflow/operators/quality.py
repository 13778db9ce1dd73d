"""Quality checks on captured statements: contamination and duplicates.

F6, F9, J5, A6 (marker rate) and H24, J7, A7 (duplicate statements).

Statements are held as a long cell table, one row per cell::

    symbol, report_dir, statement, row_idx, col_idx, col_name, value, unreadable

``row_idx`` is the row position in the file (the header-mode reader puts the
header labels in ``col_name``; the headerless reader counts the header line as
row 0).  A file that could not be parsed has one row with ``unreadable`` true.

Table equality (H24) follows ``DataFrame.equals`` on re-read CSVs: same
labels, same shape, same parsed values and the same parsed column types (an
integer column differs from a float column holding the same numbers; missing
equals missing).  It is computed as a fingerprint per statement with two
aggregations that Spark combines map-side:

1. per (statement, column): counts that decide the column's parsed type, and
   for each candidate type the XOR of 64-bit hashes of
   ``(row_idx, col_idx, canonical value)``;
2. per statement: XOR of the chosen column hashes and of hashes of
   ``(col_idx, label, type)``, plus the row and column counts.

XOR of position-salted hashes needs no ordering and no collected lists, so a
statement of any size is combined in every task that holds part of it.
Fingerprints are only compared between statements of one report (a few
pairs each), so a false match has a chance of about 2^-64 per pair.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.functions import text as T

# pandas' default missing-value tokens when it reads a CSV (public pandas
# behaviour, `pandas.read_csv` na_values default), and its boolean words.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
BOOL_WORDS = ["True", "TRUE", "true", "False", "FALSE", "false"]
INT_RE = r"^\s*[+-]?[0-9]+\s*$"
NUM_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

STATEMENT_KEY = ("symbol", "report_dir", "statement")


def _root(new_root: str) -> str:
    """File readers report absolute paths; a relative local root is made
    absolute so re-rooted index paths compare equal to them."""
    if new_root and "://" not in new_root and not new_root.startswith(("/", "file:")):
        return os.path.abspath(new_root)
    return new_root


# F6, H13 ---------------------------------------------------------------------------
def index_reports(
    index: DataFrame, new_root: str = "", path_col: str = "Saving_path", old_prefix: str = T.CRAWL_ROOT
) -> DataFrame:
    """Index rows → (symbol, report_dir): rows without a saved path dropped,
    the path re-rooted under ``new_root`` (one row per index row)."""
    rows = index.where(F.col(path_col).isNotNull())
    return rows.select("symbol", T.rebase_path(path_col, old_prefix, _root(new_root)).alias("report_dir"))


# F6, H13, J5 ---------------------------------------------------------------------
def existing_index_rows(
    index: DataFrame,
    files: DataFrame,
    path_col: str = "Saving_path",
    old_prefix: str = T.CRAWL_ROOT,
    new_root: str = "",
    file_key: str = "report_dir",
) -> DataFrame:
    """Index rows whose saved path is set and whose file exists, joined with
    the per-file columns of ``files`` (one row per ``file_key``).

    Rows that repeat a path are all kept (each counts again, as in the
    reference).
    """
    rows = index.where(F.col(path_col).isNotNull()).withColumn(
        "_path", T.rebase_path(path_col, old_prefix, _root(new_root))
    )
    return rows.join(files, rows["_path"] == files[file_key], "inner").drop("_path")


# F9 -------------------------------------------------------------------------
def marker_flags(
    cells: DataFrame,
    marker: str = T.BALANCE_SHEET_MARKER,
    file_key: Sequence[str] = ("report_dir",),
) -> DataFrame:
    """Per file: does any first-column cell contain ``marker``; unreadable."""
    first_col_hit = (F.col("col_idx") == 0) & F.coalesce(F.col("value").contains(marker), F.lit(False))
    return cells.groupBy(*file_key).agg(
        F.bool_or(first_col_hit).alias("has_marker"),
        F.bool_or(F.coalesce(F.col("unreadable"), F.lit(False))).alias("unreadable"),
    )


# A6 -------------------------------------------------------------------------
def marker_rate(existing: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Files checked, files with the marker, unreadable files, rate %.

    The rate divides by all existing files, unreadable ones included.
    """
    agg = existing.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("has_marker")).alias("error_files"),
        F.count_if(F.col("unreadable")).alias("unreadable_files"),
    )
    return agg.withColumn("error_rate", T.error_rate("error_files", "total_files"))


def contamination_rate(
    index: DataFrame,
    cells: DataFrame,
    statement: str = "KQKD",
    marker: str = T.BALANCE_SHEET_MARKER,
    by: Sequence[str] = (),
    new_root: str = "",
) -> DataFrame:
    """F6 + J5 + F9 + A6 in one call: index rows with a saved path whose
    ``statement`` file exists, and the share whose first column holds the
    marker (cells read headerless, so the header line counts)."""
    flags = marker_flags(cells.where(F.col("statement") == statement), marker)
    return marker_rate(existing_index_rows(index, flags, new_root=new_root), by)


# H24 ------------------------------------------------------------------------
def statement_fingerprints(cells: DataFrame, key: Sequence[str] = STATEMENT_KEY) -> DataFrame:
    """One row per statement: (key..., n_rows, n_cols, fp, unreadable)."""
    key = list(key)
    v = F.col("value")
    missing = v.isNull() | v.isin(NA_TOKENS)
    data = F.col("row_idx") >= 0
    c = cells.select(
        *key,
        "row_idx",
        "col_idx",
        "col_name",
        F.coalesce(F.col("unreadable"), F.lit(False)).alias("_bad"),
        F.when(missing, None).otherwise(v).alias("_v"),
    )
    pv = F.col("_v")
    is_num = pv.rlike(NUM_RE)
    is_int = is_num & pv.rlike(INT_RE)
    is_bool = pv.isin(BOOL_WORDS)
    null_tok = F.lit("\u0000missing")
    # Each canonical form is only used when the whole column has that type,
    # so a cell is converted only when it passes that type's test (a failed
    # text-to-double conversion costs an exception per cell).
    canon = {
        "int": F.coalesce(F.when(is_int, F.trim(pv).try_cast("bigint").cast("string")), null_tok),
        "double": F.coalesce(F.when(is_num, F.trim(pv).try_cast("double").cast("string")), null_tok),
        "bool": F.coalesce(F.when(is_bool, F.lower(pv)), null_tok),
        "text": F.coalesce(pv, null_tok),
    }
    pos = [F.col("row_idx"), F.col("col_idx")]
    aggs = [
        # A text has no place in a hash aggregation: its rows would be sorted first.
        F.min(F.when(F.col("col_name").isNotNull(), F.xxhash64("col_name"))).alias("_name"),
        F.count_if(data).alias("_n"),
        F.count_if(data & pv.isNotNull()).alias("_present"),
        F.count_if(data & is_int).alias("_int"),
        F.count_if(data & is_int & F.trim(pv).try_cast("bigint").isNull()).alias("_wide"),
        F.count_if(data & is_num).alias("_num"),
        F.count_if(data & is_bool).alias("_bool"),
        F.bool_or("_bad").alias("_bad"),
        F.max("row_idx").alias("_max_row"),
    ]
    for t, expr in canon.items():
        aggs.append(F.bit_xor(F.when(data, F.xxhash64(*pos, expr))).alias(f"_h_{t}"))
    per_col = c.groupBy(*key, "col_idx").agg(*aggs)
    n, present = F.col("_n"), F.col("_present")
    tag = (
        F.when(n == 0, F.lit("empty"))
        .when(present == 0, F.lit("double"))
        # an integer beyond 64 bits leaves the column's cells as they are written
        .when((F.col("_int") == n) & (F.col("_wide") > 0), F.lit("text"))
        .when((F.col("_int") == n), F.lit("int"))
        .when(F.col("_num") == present, F.lit("double"))
        .when((F.col("_bool") == n), F.lit("bool"))
        .otherwise(F.lit("text"))
    )
    per_col = per_col.withColumn("_tag", tag)

    chosen = F.when(F.col("_tag") == "empty", F.lit(0).cast("bigint"))
    for t in canon:
        chosen = chosen.when(F.col("_tag") == t, F.col(f"_h_{t}"))
    chosen = F.coalesce(chosen.otherwise(F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))

    per_col = per_col.select(
        *key,
        "_bad",
        "_max_row",
        "col_idx",
        chosen.bitwiseXOR(F.xxhash64(F.lit("label"), "col_idx", "_name", "_tag")).alias("_c"),
    )
    return per_col.groupBy(*key).agg(
        (F.coalesce(F.max("_max_row"), F.lit(-1)) + 1).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_cols"),
        F.bit_xor("_c").alias("fp"),
        F.bool_or("_bad").alias("unreadable"),
    )


# J7, A7 ---------------------------------------------------------------------
def duplicate_pairs(
    fingerprints: DataFrame,
    report: Sequence[str] = ("symbol", "report_dir"),
    symbol: str = "symbol",
    index: DataFrame | None = None,
) -> DataFrame:
    """Pairs of equal statements inside each report, summed per symbol.

    Unreadable files are left out, as the reference skips files it cannot
    read.  Σ n(n-1)/2 over groups of equal fingerprints equals the number of
    equal pairs found by comparing every pair.  With ``index`` (report-index
    rows carrying the report columns) a report is counted once per index row
    that lists it, as the reference walks the index rows.
    """
    fp = fingerprints.where(~F.col("unreadable"))
    groups = fp.groupBy(*report, "n_rows", "n_cols", "fp").agg(F.count(F.lit(1)).alias("_n"))
    pairs = groups.withColumn("_pairs", (F.col("_n") * (F.col("_n") - 1) / 2).cast("bigint"))
    per_report = pairs.groupBy(*report).agg(F.sum("_pairs").alias("_pairs"))
    if index is not None:
        listed = index.groupBy(*report).agg(F.count(F.lit(1)).alias("_listed"))
        per_report = per_report.join(listed, list(report), "inner").withColumn(
            "_pairs", F.col("_pairs") * F.col("_listed")
        )
    return per_report.groupBy(symbol).agg(F.sum("_pairs").cast("bigint").alias("dup_pairs"))


def duplicate_total(per_symbol: DataFrame) -> DataFrame:
    return per_symbol.agg(F.coalesce(F.sum("dup_pairs"), F.lit(0)).cast("bigint").alias("total_duplicates"))
