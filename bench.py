"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (all rows computed,
nothing collected to the driver).  One warm-up pass, then ``$BENCH_RUNS``
timed passes; a query's time is the median.  The same SQL oracles run in
DuckDB for reference (``duckdb_queries``).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filingflow.plans.catalog import ORACLE, QUERIES  # noqa: E402
from filingflow.session import build_session  # noqa: E402
from filingflow.sources.tables import TABLE_NAMES  # noqa: E402

HEADLINE = [
    "parse_crawl_log",
    "classify_symbols",
    "crawl_kpi",
    "log_summary",
    "open_symbols",
    "map_source",
    "map_counts",
    "tax_code_mode",
    "marker_rate",
    "duplicate_pairs",
    "resume_rows",
    "advance_checkpoint",
    "reconcile_counts",
    "report_paths",
    "search_listing",
    "first_submission",
    "last_write",
    "new_submissions",
    "work_batches",
    "listing_rows",
    "chunk_cells",
    "page_links",
    "page_title",
    "assembled_report",
    "rescrape_plan",
    "stream_status",
]


def run_spark(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def run_duck(con, name: str) -> float:
    t0 = time.perf_counter()
    con.sql(ORACLE[name]).fetchall()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="filingflow-bench")
    times: dict[str, list[float]] = {n: [] for n in names}
    for n in names:  # warm-up
        run_spark(spark, n, sf)
    for _ in range(runs):
        for n in names:
            times[n].append(run_spark(spark, n, sf))
    spark.stop()
    med = {n: round(statistics.median(v), 3) for n, v in times.items()}

    duck: dict[str, float] = {}
    try:
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET threads={cpus}")
        for t in TABLE_NAMES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        for n in names:
            if n in ORACLE:
                run_duck(con, n)
                duck[n] = round(statistics.median(run_duck(con, n) for _ in range(runs)), 3)
    except Exception as e:  # noqa: BLE001 - the reference timing is optional
        duck = {"error": str(e)[:200]}

    sf_value = sf.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_median_query_seconds",
                "value": round(sum(med.values()), 3),
                "unit": "sec",
                "queries": med,
                "sf": float(sf_value) if sf_value.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs": runs,
                "duckdb_queries": duck,
            }
        )
    )


if __name__ == "__main__":
    main()
