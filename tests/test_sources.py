"""File sources in the reference layout."""

import json
import os

import pyarrow as pa

from filingflow.sources import files


def test_symbols_and_checkpoints(spark, tmp_path):
    sym = tmp_path / "symbols.csv"
    sym.write_text(",ticker\n0,AAA\n1,BBB\n2,A32\n")
    s = files.read_symbols(spark, str(sym))
    assert sorted(r["symbol"] for r in s.collect()) == ["A32", "AAA", "BBB"]
    cpd = tmp_path / "checkpoints"
    cpd.mkdir()
    (cpd / "checkpoint_AAA.json").write_text(json.dumps({"current_page": 2, "last_row_index": 3}))
    (cpd / "checkpoint_A32.json").write_text(json.dumps({"current_page": 9, "last_row_index": 0}))
    cp = files.read_checkpoint_files(spark, str(cpd), symbols=s)
    got = sorted(tuple(r) for r in cp.collect())
    assert got == [("A32", 9, 0), ("AAA", 2, 3), ("BBB", 1, 0)]


def test_logs_and_catalog(spark, tmp_path):
    d = tmp_path / "logging"
    d.mkdir()
    (d / "20241112_113700_crawl.log").write_text("a\nb\n")
    (d / "notes.txt").write_text("c\n")
    logs = files.read_logs(spark, str(d))
    assert sorted((r["value"], r["file"]) for r in logs.collect()) == [
        ("a", "20241112_113700_crawl.log"), ("b", "20241112_113700_crawl.log")
    ]
    os.makedirs(tmp_path / "tree" / "AAA" / "_r")
    (tmp_path / "tree" / "AAA" / "_r" / "KQKD.csv").write_text("x\n1\n")
    (tmp_path / "tree" / "AAA" / "success.csv").write_text("STT\n1\n")
    n = files.count_files(files.file_catalog(spark, str(tmp_path / "tree"), "*.csv")).first()
    assert n["n_files"] == 2  # the "_r" folder is listed too
    assert files.count_files(files.file_catalog(spark, str(tmp_path / "none"), "*.csv")).first()["n_files"] == 0
    assert files.read_statements(spark, str(tmp_path / "none")).count() == 0
    cells = files.read_statements(spark, str(tmp_path / "tree"), names=["KQKD"])
    assert sorted((r["row_idx"], r["value"]) for r in cells.collect()) == [(-1, None), (0, "1")]


def test_read_latest_log(spark, tmp_path):
    d = tmp_path / "logging"
    d.mkdir()
    (d / "20241112_113700_crawl.log").write_text("old\n")
    (d / "20241113_090000_crawl.log").write_text("new1\nnew2\n")
    got = sorted(r["value"] for r in files.read_latest_log(spark, str(d)).collect())
    assert got == ["new1", "new2"]
    (d / "20241114_090000_crawl.log").write_text("")
    assert files.read_latest_log(spark, str(d)).count() == 0  # the newest log has no line yet


def test_scale_conf():
    from filingflow.session import scale_conf

    conf = scale_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 24


def test_legacy_statement_names_and_truth_columns(spark, tmp_path):
    rep = tmp_path / "tree" / "HHG" / "Bao cao quy 2"
    rep.mkdir(parents=True)
    (rep / "KQKT.csv").write_text("a,b\nTÀI SẢN NGẮN HẠN,1\n")
    (rep / "LCTT_TT2.csv").write_text("a,b\nx,2\n")
    cells = files.read_statements(spark, str(tmp_path / "tree"), names=files.LEGACY_STATEMENT_FILES, header=False)
    assert sorted({r["statement"] for r in cells.collect()}) == ["KQKT", "LCTT_TT2"]
    bad = tmp_path / "truth.csv"
    bad.write_text("stock_code,year\nHHG,2024\n")
    import pytest

    with pytest.raises(ValueError):
        files.read_truth(spark, str(bad))


def test_report_index_pandas_missing_words(spark, tmp_path):
    import pandas as pd

    d = tmp_path / "crawl" / "AAA"
    d.mkdir(parents=True)
    pd.DataFrame({"STT": ["1", "2"], "Mã doanh nghiệp": ["NA", "0100"], "Saving_path": ["null", "./crawl_table/AAA/r"]}) \
        .to_csv(d / "success.csv")
    rows = files.read_report_index(spark, str(tmp_path / "crawl")).orderBy("STT").collect()
    assert [(r["Mã doanh nghiệp"], r["Saving_path"]) for r in rows] == [(None, None), ("0100", "./crawl_table/AAA/r")]
    raw = files.read_report_index(spark, str(tmp_path / "crawl"), pandas_na=False).orderBy("STT").first()
    assert raw["Mã doanh nghiệp"] == "NA"


def test_many_small_files_share_a_batch_and_rows_of_large_ones_are_parted(tmp_path, monkeypatch):
    for i in range(40):
        folder = tmp_path / f"S{i}" / "r"
        folder.mkdir(parents=True)
        (folder / "KQKD.csv").write_text("" if i == 3 else "a,b\n1,x\n2\n")
        (folder.parent / "success.csv").write_text("" if i == 3 else "STT,Saving_path\n1,p\n2\n")
    (tmp_path / "S0" / "r" / "KQKD.csv").write_text("a,b\n" + "1,x\n" * 100)

    def given():
        return iter([pa.RecordBatch.from_arrays([pa.array([f"S{i}{rest}" for i in range(40)])], ["rel"])])

    rest = "/r/KQKD.csv"
    cells = list(files._parse_statements(f"file:{tmp_path}", True)(given()))
    assert len(cells) == 1 and cells[0].num_rows == 202 + 38 * 6 + 1
    monkeypatch.setattr(files, "ROWS_PER_YIELD", 20)
    parted = list(files._parse_statements(f"file:{tmp_path}", True)(given()))
    assert pa.Table.from_batches(parted) == pa.Table.from_batches(cells).combine_chunks() and max(b.num_rows for b in parted) <= 40
    rows = pa.Table.from_batches(cells).to_pylist()
    assert [r["value"] for r in rows if r["symbol"] == "S1"] == [None, None, "1", "x", "2", ""]
    assert [(r["row_idx"], r["unreadable"]) for r in rows if r["symbol"] == "S3"] == [(-1, True)]
    monkeypatch.undo()
    rest = ""
    index, = files._parse_index(f"file:{tmp_path}", "success")(given())
    assert index.num_rows == 39 * 3 + 1
    assert [(r["row"], r["n_rows"], r["STT"], r["Saving_path"]) for r in index.to_pylist() if r["symbol"] == "S1"] == [(-1, 2, None, None), (0, None, "1", "p"), (1, None, "2", "")]
