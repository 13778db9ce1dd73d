"""Composed flows of the reference, as lazy DataFrame plans.

* :func:`rescrape_plan` (M4, L2): audit → open symbols → reset their
  checkpoints → drop their captured rows.
* :func:`dashboard` (L3): the quality figures shown by the reference's
  dashboard, each its own DataFrame (the UI itself is not built).
* :func:`crawl_pass` (L1 after capture): listing rows resumed from the
  checkpoints, named, reconciled, checkpoints advanced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.operators import audit, naming, quality, reconcile, resume
from filingflow.sources import files


def rescrape_plan(
    logs: DataFrame, index: DataFrame, symbols: DataFrame, checkpoints: DataFrame, index_files: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(symbols to capture again, sorted descending; checkpoint table after
    resetting them to {1, 0}).  ``index_files``: see :func:`audit.classify_symbols`."""
    classified = audit.audit_logs(logs, index, index_files=index_files)
    clean = classified.where(F.col("status") == "clean")
    open_syms = audit.open_symbols(symbols, clean)
    new_cp = resume.reset_checkpoints(checkpoints, open_syms)
    return open_syms, new_cp


def purge_captured(captured: DataFrame, open_symbols: DataFrame) -> DataFrame:
    """M3: captured rows of the symbols to capture again removed."""
    return resume.drop_symbols(captured, open_symbols)


def dashboard(
    logs: DataFrame, index: DataFrame, catalog: DataFrame, existing_with_flags: DataFrame, fingerprints: DataFrame
) -> dict[str, DataFrame]:
    """The dashboard's figures: crawl KPI, crawled file count, contamination
    rate, duplicate statements.  Each report its own total (the reference
    shows the success count in place of the contamination total)."""
    return {
        "crawl_kpi": audit.crawl_kpi(audit.audit_logs(logs, index)),
        "crawled_files": catalog.agg(F.count(F.lit(1)).alias("n_files")),
        "contamination": quality.marker_rate(existing_with_flags),
        "duplicates": quality.duplicate_total(quality.duplicate_pairs(fingerprints)),
    }


def crawl_pass(
    listing: DataFrame,
    checkpoints: DataFrame,
    pager: DataFrame,
    existing_paths: DataFrame | None = None,
    max_title: int = 50,
    max_path: int = 20,
) -> dict[str, DataFrame]:
    """One crawl pass over captured listing rows: resumed rows with report
    folders, reconciliation per symbol (folders on disk and new ones), and the
    advanced checkpoints."""
    todo = resume.resume_rows(listing, checkpoints)
    named = naming.assign_paths(
        naming.base_folders(todo, max_title=max_title, max_path=max_path), existing_paths
    )
    held = named.select("symbol", "report_dir")
    if existing_paths is not None:
        folder = F.regexp_replace("report_dir", "/+$", "")
        held = held.unionByName(existing_paths.select(F.element_at(F.split(folder, "/"), -2).alias("symbol"), folder.alias("report_dir")))
    got = reconcile.reports_per_symbol(held)
    status = reconcile.reconcile(reconcile.expected_reports(pager, todo), got)
    sizes = listing.groupBy("symbol", "page").agg(F.count(F.lit(1)).alias("n_rows"))
    new_cp = resume.advance_checkpoints(todo, sizes, checkpoints)
    return {"reports": named, "status": status, "checkpoints": new_cp}


def write_pass(out: dict[str, DataFrame], root: str, columns: list[str], order: list[str]) -> None:
    """The index of a :func:`crawl_pass` in the crawl's layout: the reports of a symbol
    whose folders are complete as ``root/SYM/success.csv``, of others as ``warning.csv``."""
    status = out["status"].select(F.col("symbol").alias("_p_symbol"), F.col("status").alias("_p_status"))
    rows = out["reports"].join(status, F.col("symbol") == F.col("_p_symbol"))
    rows = rows.withColumn("_p_path", F.concat("symbol", F.lit("/"), "_p_status", F.lit(".csv")))
    files.write_csv_files(rows, "_p_path", columns, order, root)
