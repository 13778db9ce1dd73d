"""Cases found by review: empty indexes, pandas-written CSV, deep trees, wide numbers, exact hidden style."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingflow.operators import audit, extract, quality
from filingflow.sources import files


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_index_file_without_rows_is_clean(spark, tmp_path):
    root = str(tmp_path)
    pd.DataFrame({"STT": [1, 2]}).to_csv(str(tmp_path / "x.csv"), index=False)
    write(f"{root}/AAA/success.csv", "STT\n1\n1\n")
    write(f"{root}/BBB/success.csv", "STT\n")
    write(f"{root}/CCC/success.csv", "STT\n1\n2\n")
    logs = spark.createDataFrame(
        [(f"2024-01-01 00:00:00,000 - INFO - Scraping Successfully {s}: 1/1",) for s in ("AAA", "BBB", "CCC", "DDD")], "value string"
    )
    index = files.read_report_index(spark, root)
    got = audit.audit_logs(logs, index, index_files=files.index_symbols(spark, root)).collect()
    assert {r["symbol"]: (r["status"], r["reason"]) for r in got} == {
        "AAA": ("error", "duplicate_stt"), "BBB": ("clean", None), "CCC": ("clean", None), "DDD": ("error", "no_index"),
    }
    assert files.index_symbols(spark, root + "/none").count() == 0 and files.read_report_index(spark, root + "/none").count() == 0


def test_index_as_pandas_writes_it(spark, tmp_path):
    names = ["STT", "Tên công ty", "Saving_path"]
    a = pd.DataFrame([["1", 'Cty "X", TNHH', "p/1"], ["2", "two\nlines", "p/2"]], columns=names)
    b = pd.DataFrame([["p/3", "5"]], columns=["Saving_path", "STT"])
    for sym, df in (("AAA", a), ("BBB", b)):
        os.makedirs(tmp_path / sym)
        df.to_csv(tmp_path / sym / "success.csv", index=False)
    rows = {(r["symbol"], r["STT"]): r for r in files.read_report_index(spark, str(tmp_path)).collect()}
    assert set(rows) == {("AAA", "1"), ("AAA", "2"), ("BBB", "5")}
    assert rows["AAA", "1"]["Tên công ty"] == 'Cty "X", TNHH' and rows["AAA", "2"]["Tên công ty"] == "two\nlines"
    assert rows["BBB", "5"]["Saving_path"] == "p/3" and rows["BBB", "5"]["Tên công ty"] is None


def test_catalog_of_any_depth(spark, tmp_path):
    deep = "/".join(f"_{i}" for i in range(7))
    for p in ("a.csv", "b/c.csv", f"{deep}/d.csv", "b/e.txt"):
        write(str(tmp_path / p), "x")
    found = files.file_catalog(spark, str(tmp_path)).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found) == ["a.csv", "c.csv", "d.csv"]


def cells(spark, name, values):
    rows = [("S", "r", name, i, 0, "c", v, False) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, files.CELL_SCHEMA)


def test_wide_integers_differ(spark):
    tables = [["12345678901234567890", "1"], ["12345678901234567891", "1"], ["12345678901234567890", "1"]]
    df = cells(spark, "t0", tables[0]).unionByName(cells(spark, "t1", tables[1])).unionByName(cells(spark, "t2", tables[2]))
    fp = {r["statement"]: r["fp"] for r in quality.statement_fingerprints(df).collect()}
    assert fp["t0"] == fp["t2"] != fp["t1"]
    index = spark.createDataFrame([("S", "9007199254740993"), ("S", "9007199254740992"), ("T", "1"), ("T", "1.0"), ("U", "1"), ("U", "01")], "symbol string, STT string")
    got = {r["symbol"]: r["n_distinct"] for r in audit.stt_uniqueness(index).collect()}
    assert got == {"S": 2, "T": 1, "U": 1}
    typed = spark.createDataFrame([("S", 1), ("S", None), ("S", None), ("T", 2), ("T", 1)], "symbol string, STT long")
    got = {r["symbol"]: (r["n_rows"], r["n_distinct"], r["stt_unique"]) for r in audit.stt_uniqueness(typed).collect()}
    assert got == {"S": (3, 2, False), "T": (2, 2, True)}


def test_faithful_mode_hides_the_exact_style_only():
    page = '<div class="row"><span>a<span style="display:none">x</span></span><span>b<span style="DISPLAY: none;">y</span></span></div>'
    page = extract.Page(page)
    (row,) = page.select(".row")
    assert "x" not in "".join(extract._listed_spans(page, row, "span")) and "y" in "".join(extract._listed_spans(page, row, "span"))


def test_work_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    from filingflow import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Cluster:
        conf = Conf()

        class sparkContext:  # noqa: N801
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_root(Cluster())
    assert F is not None
