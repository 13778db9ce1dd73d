"""Composed flows on a small crawl tree in the reference's file layout."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from filingflow.operators import audit, crosscheck, quality
from filingflow.plans import flows
from filingflow.sources import files
from filingflow.streaming import status as streams

LOG1 = [
    "2024-11-12 11:37:09,123 - INFO - Scraping Successfully AAA: 2/2",
    "2024-11-12 11:38:10,001 - WARNING - Not enough reports BBB: 1/3",
]
LOG2 = [
    "2024-11-13 09:00:00,000 - INFO - Scraping Successfully CCC: 1/1",
    "2024-11-13 09:01:00,000 - WARNING - Not enough reports AAA: 1/2",
]
KQKD_BAD = "Chỉ tiêu,Mã số\nTÀI SẢN NGẮN HẠN,100\n"
KQKD_OK = "Chỉ tiêu,Mã số\nDoanh thu,01\n"


def build(root):
    crawl = os.path.join(root, "crawl_table")
    for sym, reports in {"AAA": ["BCTC quý 1 năm 2023_x", "BCTC năm 2022_y"], "CCC": ["_BCTC riêng năm 2021"]}.items():
        rows = []
        for i, rep in enumerate(reports):
            d = os.path.join(crawl, sym, rep)
            os.makedirs(d)
            body = KQKD_BAD if (sym, i) == ("AAA", 0) else KQKD_OK
            for name in ("BCDKT", "KQKD", "LCTT_TT", "LCTT_GT"):
                open(os.path.join(d, f"{name}.csv"), "w").write(body if name in ("BCDKT", "KQKD") else f"h\n{name}\n")
            rows.append({"STT": str(i + 1), "Tên báo cáo": rep.split("_")[0] or rep, "Mã doanh nghiệp": "0100",
                         "Saving_path": f"./crawl_table/{sym}/{rep}"})
        pd.DataFrame(rows).to_csv(os.path.join(crawl, sym, "success.csv"))
    logs = os.path.join(root, "logging")
    os.makedirs(logs)
    open(os.path.join(logs, "20241112_113700_crawl.log"), "w").write("\n".join(LOG1) + "\n")
    open(os.path.join(logs, "20241113_090000_crawl.log"), "w").write("\n".join(LOG2) + "\n")
    cps = os.path.join(root, "checkpoints")
    os.makedirs(cps)
    for sym, cp in {"AAA": (3, 0), "BBB": (2, 4)}.items():
        open(os.path.join(cps, f"checkpoint_{sym}.json"), "w").write(
            json.dumps({"current_page": cp[0], "last_row_index": cp[1]}))
    pd.DataFrame({"symbol": ["AAA", "BBB", "CCC", "DDD"]}).to_csv(os.path.join(root, "symbols.csv"))
    pd.DataFrame({"stock_code": ["AAA"], "year": [2023], "range": ["Quý I"], "type": ["Riêng"],
                  "tax_code": ["0100"]}).to_csv(os.path.join(root, "truth.csv"), index=False)
    return crawl, logs, cps


def test_audit_and_rescrape_from_files(spark, tmp_path):
    crawl, logs, cps = build(str(tmp_path))
    lines = files.read_logs(spark, logs)
    index = files.read_report_index(spark, crawl).select("symbol", "STT")
    syms = files.read_symbols(spark, str(tmp_path / "symbols.csv"))
    checkpoints = files.read_checkpoint_files(spark, cps, symbols=syms)
    got = {r["symbol"]: r["status"] for r in audit.audit_logs(lines, index).collect()}
    assert got == {"AAA": "clean", "BBB": "error", "CCC": "clean"}
    open_syms, cp = flows.rescrape_plan(lines, index, syms, checkpoints)
    assert [r["symbol"] for r in open_syms.collect()] == ["DDD", "BBB"]
    assert sorted(tuple(r) for r in cp.collect()) == [
        ("AAA", 3, 0), ("BBB", 1, 0), ("CCC", 1, 0), ("DDD", 1, 0)
    ]
    latest = files.read_latest_log(spark, logs)
    summary = audit.log_summary(latest)
    assert sorted(tuple(r) for r in summary.collect()) == [("AAA", "1/2", "warning"), ("CCC", "1/1", "success")]


def test_dashboard_figures_from_files(spark, tmp_path):
    crawl, logs, _ = build(str(tmp_path))
    lines = files.read_logs(spark, logs)
    index = files.read_report_index(spark, crawl)
    catalog = files.file_catalog(spark, crawl, "*.csv")
    kqkd = files.read_statements(spark, crawl, names=["KQKD"], header=False)
    existing = quality.existing_index_rows(index, quality.marker_flags(kqkd), new_root=crawl)
    fps = quality.statement_fingerprints(files.read_statements(spark, crawl))
    d = flows.dashboard(lines, index.select("symbol", "STT"), catalog, existing, fps)
    assert d["crawled_files"].first()["n_files"] == 14  # 12 statements + 2 index files
    c = d["contamination"].first()
    assert (c["total_files"], c["error_files"], c["error_rate"]) == (3, 1, 100.0 / 3)
    # Per report BCDKT = KQKD, and the two cash-flow tables differ by content.
    assert d["duplicates"].first()["total_duplicates"] == 3
    k = d["crawl_kpi"].first()
    assert (k["success"], k["error"]) == (2, 1)


def test_crosscheck_from_files(spark, tmp_path):
    crawl, _, _ = build(str(tmp_path))
    index = files.read_report_index(spark, crawl)
    truth = files.read_truth(spark, str(tmp_path / "truth.csv")).withColumnRenamed("stock_code", "symbol")
    merged = crosscheck.map_source(index, truth, by=["symbol"])
    mapped = crosscheck.mapped_reports(merged).select("symbol", "Tên báo cáo", "tax_code").collect()
    assert [tuple(r) for r in mapped] == [("AAA", "BCTC quý 1 năm 2023", "0100")]


def test_crawl_pass(spark):
    listing = spark.createDataFrame(
        [("AAA", p, r, f"Báo cáo {p}-{r}", "24/07/2024 00:00:00", "Tóm tắt") for p in (1, 2) for r in range(3)],
        "symbol string, page long, row_idx long, `Tiêu đề` string, `Thời gian gửi` string, `Trích yếu` string",
    )
    cps = spark.createDataFrame([("AAA", 2, 1)], "symbol string, current_page long, last_row_index long")
    pager = spark.createDataFrame([("AAA", "1-3 / 6")], "symbol string, pager_text string")
    out = flows.crawl_pass(listing, cps, pager, max_path=200)
    assert out["reports"].count() == 2
    st = out["status"].first()
    assert (st["got"], st["expected"], st["status"]) == (2, 6, "warning")
    cp = out["checkpoints"].first()
    assert (cp["current_page"], cp["last_row_index"]) == (3, 0)
    held = spark.createDataFrame([(f"./crawl_table/AAA/old {i}",) for i in range(4)], "report_dir string")
    st = flows.crawl_pass(listing, cps, pager, held, max_path=200)["status"].first()
    assert (st["got"], st["expected"], st["status"]) == (6, 6, "success")


def test_stream_status_incremental(spark, tmp_path):
    src, out, ck = str(tmp_path / "logs"), str(tmp_path / "out"), str(tmp_path / "ck")
    os.makedirs(src)
    open(os.path.join(src, "a.log"), "w").write("\n".join(LOG1) + "\n")
    open(os.path.join(src, "skip.txt"), "w").write(LOG2[0] + "\n")
    streams.run_status(spark, src, out, ck, glob="*.log").awaitTermination()
    first = {r["symbol"]: (r["in_success"], r["in_warning"]) for r in streams.read_status(spark, out).collect()}
    assert first == {"AAA": (True, False), "BBB": (False, True)}
    open(os.path.join(src, "b.log"), "w").write("\n".join(LOG2) + "\n")
    streams.run_status(spark, src, out, ck, glob="*.log").awaitTermination()
    after = {r["symbol"]: (r["in_success"], r["in_warning"]) for r in streams.read_status(spark, out).collect()}
    lines = spark.createDataFrame([(x,) for x in LOG1 + LOG2], "value string")
    batch = {r["symbol"]: (r["in_success"], r["in_warning"]) for r in audit.log_sets(lines).collect()}
    assert after == batch


def test_readme_usage_runs(spark, tmp_path, monkeypatch):
    import shutil

    build(str(tmp_path))
    monkeypatch.chdir(tmp_path)  # for the pandas writes below
    pd.DataFrame({"symbol": ["AAA", "BBB", "CCC", "DDD"]}).to_csv("symbols_all.csv")
    shutil.copy("truth.csv", "test_kqkt.csv")
    readme = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")).read()
    code = readme.split("## Usage on a crawl tree")[1].split("```python")[1].split("```")[0]
    # Spark resolves relative paths against its own working directory.
    for rel in ("logging", "crawl_table", "symbols_all.csv", "checkpoints", "test_kqkt.csv"):
        code = code.replace(f'"{rel}"', f'"{tmp_path}/{rel}"')
    code = code.replace('"out/', f'"{tmp_path}/out/')
    ns: dict = {}
    exec(code, ns)  # noqa: S102 - the documented example itself
    assert [tuple(r) for r in ns["redo"].collect()] == [("DDD",), ("BBB",)]
    assert ns["rate"].first()["error_files"] == 1
    assert sorted(tuple(r) for r in ns["dups"].collect()) == [("AAA", 2), ("CCC", 1)]
    assert ns["mapped"].count() == 1
