"""Crawl audit (U1-U3, A1, A5, A10, J3, J4, H11) on the FIXTURES log rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingflow.operators import audit
from filingflow.plans import flows

LINES = [
    "2024-11-12 11:37:09,123 - INFO - Scraping Successfully AAA: 85/85",
    "2024-11-12 11:38:10,001 - WARNING - Not enough reports BBB: 3/85",
    "2024-11-12 11:39:00,500 - WARNING - Not enough reports AAA: 80/85",
    "2024-11-12 11:40:00,000 - INFO - Scraping Successfully CCC: 2/2",
    "2024-11-12 11:41:00,000 - INFO - Scraping Successfully DDD: 2/2",
    "2024-11-12 11:42:00,000 - INFO - some other message",
]
INDEX = [("AAA", "1"), ("AAA", "2"), ("AAA", "3"), ("CCC", "1"), ("CCC", "1")]


def logs(spark, file="20241112_113700_crawl.log"):
    return spark.createDataFrame([(x, file) for x in LINES], "value string, file string")


def index(spark):
    return spark.createDataFrame(INDEX, "symbol string, STT string")


def test_classify(spark):
    c = audit.audit_logs(logs(spark), index(spark))
    got = {r["symbol"]: (r["status"], r["reason"]) for r in c.collect()}
    assert got == {
        "AAA": ("clean", None),
        "BBB": ("error", "warning_only"),
        "CCC": ("error", "duplicate_stt"),
        "DDD": ("error", "no_index"),
    }


def test_kpi_and_total(spark):
    k = audit.crawl_kpi(audit.audit_logs(logs(spark), index(spark))).first()
    assert (k["success"], k["error"], k["error_rate"]) == (1, 3, 75.0)
    assert audit.total_scraped(audit.log_sets(logs(spark))).first()["total_scraped"] == 4


def test_null_stt_counts_once(spark):
    idx = spark.createDataFrame([("A", None), ("A", None), ("B", None), ("B", "1")], "symbol string, STT string")
    got = {r["symbol"]: r["stt_unique"] for r in audit.stt_uniqueness(idx).collect()}
    assert got == {"A": False, "B": True}


def test_log_summary_latest_file(spark):
    old = spark.createDataFrame([(LINES[1].replace("BBB", "ZZZ"), "20240101_000000_crawl.log")], "value string, file string")
    s = audit.log_summary(logs(spark).unionByName(old))
    got = sorted((r["Symbol"], r["report_count"], r["kind"]) for r in s.collect())
    assert got == [
        ("AAA", "85/85", "success"),
        ("BBB", "3/85", "warning"),
        ("CCC", "2/2", "success"),
        ("DDD", "2/2", "success"),
    ]


def test_open_symbols_sorted_desc(spark):
    syms = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",), ("EEE",)], "symbol string")
    clean = audit.audit_logs(logs(spark), index(spark)).where(F.col("status") == "clean")
    assert [r["symbol"] for r in audit.open_symbols(syms, clean).collect()] == ["EEE", "CCC", "BBB"]


def test_rescrape_plan(spark):
    syms = spark.createDataFrame([("AAA",), ("BBB",), ("EEE",)], "symbol string")
    cps = spark.createDataFrame([("AAA", 3, 2), ("BBB", 2, 5)], "symbol string, current_page long, last_row_index long")
    open_syms, cp = flows.rescrape_plan(logs(spark), index(spark), syms, cps)
    assert [r["symbol"] for r in open_syms.collect()] == ["EEE", "BBB"]
    assert sorted(tuple(r) for r in cp.collect()) == [("AAA", 3, 2), ("BBB", 1, 0), ("EEE", 1, 0)]


@settings(max_examples=8, deadline=None)
@given(
    ok=st.sets(st.sampled_from("ABCDEFGH"), max_size=6),
    warn=st.sets(st.sampled_from("ABCDEFGH"), max_size=6),
    idx=st.lists(st.tuples(st.sampled_from("ABCDEFGH"), st.integers(1, 3)), max_size=12),
)
def test_classified_sets_disjoint_and_complete(spark, ok, warn, idx):
    lines = [f"2024-01-01 00:00:00,000 - INFO - Scraping Successfully {s}: 1/1" for s in ok]
    lines += [f"2024-01-01 00:00:00,000 - WARNING - Not enough reports {s}: 0/1" for s in warn]
    lg = spark.createDataFrame([(x,) for x in lines] or [("",)], "value string")
    ix = spark.createDataFrame([(s, str(n)) for s, n in idx] or [("none", "1")], "symbol string, STT string")
    rows = audit.audit_logs(lg, ix).collect()
    clean = {r["symbol"] for r in rows if r["status"] == "clean"}
    error = {r["symbol"] for r in rows if r["status"] == "error"}
    assert clean.isdisjoint(error)
    assert clean | error == ok | warn
    assert clean <= ok


def test_stt_compared_as_pandas_reads_it(spark):
    import io

    import pandas as pd

    cases = {"N": ["1", "1.0", "2"], "T": ["1", "a", "1.0"], "M": ["1", None, "2"], "D": [None, None, "3"]}
    rows = [(k, v) for k, vals in cases.items() for v in vals]
    got = {r["symbol"]: r["stt_unique"] for r in
           audit.stt_uniqueness(spark.createDataFrame(rows, "symbol string, STT string")).collect()}
    for k, vals in cases.items():
        # With the index column the crawler writes (a lone empty cell would be
        # a blank line, which pandas skips).
        csv = ",STT\n" + "\n".join(f"{i}," + ("" if v is None else v) for i, v in enumerate(vals)) + "\n"
        col = pd.read_csv(io.StringIO(csv))["STT"]
        assert got[k] == (len(col) == len(col.unique())), k
