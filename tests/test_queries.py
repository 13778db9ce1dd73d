"""Every registered query against its SQL oracle on the smallest data set,
and the rows-only ones for a stable schema."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from filingflow.plans.catalog import ORACLE, QUERIES
from filingflow.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["symbol", "status", "reason"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE:
        assert len(df.columns) > 0
        return
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    order_d = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    a = sorted((tuple(norm(r[i]) for i in order_s) for r in rows), key=repr)
    b = sorted((tuple(norm(r[i]) for i in order_d) for r in rel.fetchall()), key=repr)
    assert a == b


def test_registry_is_complete():
    # Every operator family of the inventory keeps its registered query.
    expected = {
        "parse_crawl_log", "classify_symbols", "crawl_kpi", "total_scraped", "stt_uniqueness", "log_summary",
        "open_symbols", "count_open", "map_source", "mapped_reports", "map_counts", "tax_code_mode",
        "marker_rate", "marker_total", "duplicate_pairs", "duplicate_total", "resume_rows",
        "advance_checkpoint", "reset_checkpoint", "reconcile_counts", "pager_pages", "report_paths",
        "search_listing", "search_symbol", "first_submission", "last_write", "new_submissions",
        "work_batches", "listing_rows", "clean_row_text", "listing_cells_filter", "page_links", "page_title",
        "assembled_report", "page_table", "page_rendered", "page_link_pairs", "chunk_cells", "pad_row",
        "dedupe_row", "drop_empty_cells", "header_half", "row_pairs", "aligned_truncate", "scalar_bundle",
        "latest_log_file", "first_row", "append_results", "drop_symbols", "existing_rows", "rescrape_plan",
        "files_roundtrip_symbols", "files_roundtrip_checkpoints", "files_roundtrip_index",
        "files_roundtrip_logs", "files_roundtrip_statements", "files_roundtrip_truth", "file_count",
        "stream_status", "stream_first_submission", "status_log_lines", "crawl_pass", "rescrape_purge", "crawl_reports",
        "crawl_checkpoints", "file_catalog", "reference_index", "reference_checkpoints", "reference_statements",
        "reference_statements_headerless", "reference_contamination", "reference_unreadable", "index_inventory", "reference_audit",
        "purge_stored", "stored_search", "stored_search_symbol", "newest_log_summary", "crawl_index", "page_hidden_spans",
    }
    assert expected <= set(QUERIES)
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)
