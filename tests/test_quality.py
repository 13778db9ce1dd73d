"""Contamination and duplicate statements on a small crawl tree (FIXTURES
§2 Quality), read through the CSV-tree source."""

import itertools
import os

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingflow.operators import mapping, quality
from filingflow.sources import files


def write_tree(root):
    rep = os.path.join(root, "AAA", "Bao cao 1")
    os.makedirs(rep)
    kqkd = "Chỉ tiêu,Mã số\nTÀI SẢN NGẮN HẠN,100\nTiền,110\n"
    open(os.path.join(rep, "BCDKT.csv"), "w").write(kqkd)
    open(os.path.join(rep, "KQKD.csv"), "w").write(kqkd)
    open(os.path.join(rep, "LCTT_TT.csv"), "w").write("Chỉ tiêu,Mã số\n")
    open(os.path.join(rep, "LCTT_GT.csv"), "w").write("Chỉ tiêu,Mã số\n")
    pd.DataFrame(
        {"STT": ["1"], "Tên báo cáo": ["BCTC"], "Saving_path": ["./crawl_table/AAA/Bao cao 1"]}
    ).to_csv(os.path.join(root, "AAA", "success.csv"))
    return root


def test_marker_rate_and_duplicates(spark, tmp_path):
    root = write_tree(str(tmp_path / "crawl"))
    idx = files.read_report_index(spark, root)
    assert idx.first()["symbol"] == "AAA"
    kqkd = files.read_statements(spark, root, names=["KQKD"], header=False)
    flags = quality.marker_flags(kqkd)
    existing = quality.existing_index_rows(idx, flags, new_root=root)
    r = quality.marker_rate(existing).first()
    assert (r["total_files"], r["error_files"], r["error_rate"]) == (1, 1, 100.0)
    cells = files.read_statements(spark, root)
    fps = quality.statement_fingerprints(cells)
    per = quality.duplicate_pairs(fps).collect()
    assert [(x["symbol"], x["dup_pairs"]) for x in per] == [("AAA", 2)]


def cells_df(spark, tables):
    rows = []
    for name, (header, data) in tables.items():
        for j, h in enumerate(header):
            rows.append(("S", "R", name, -1, j, h, None, False))
        for i, row in enumerate(data):
            for j, v in enumerate(row):
                rows.append(("S", "R", name, i, j, header[j], v, False))
    return spark.createDataFrame(rows, files.CELL_SCHEMA)


def pairs(spark, tables):
    fps = quality.statement_fingerprints(cells_df(spark, tables))
    out = quality.duplicate_pairs(fps).collect()
    return out[0]["dup_pairs"] if out else 0


def test_int_vs_float_column_differs(spark):
    t = {"A": (["x"], [["1"], ["2"]]), "B": (["x"], [["1.0"], ["2.0"]])}
    assert pairs(spark, t) == 0
    t = {"A": (["x"], [["1.5"], ["2"]]), "B": (["x"], [["1.50"], ["2.0"]])}
    assert pairs(spark, t) == 1
    t = {"A": (["x"], [["1"], [""]]), "B": (["x"], [["1.0"], ["NaN"]])}
    assert pairs(spark, t) == 1


def test_labels_and_order_matter(spark):
    assert pairs(spark, {"A": (["x"], [["a"]]), "B": (["y"], [["a"]])}) == 0
    assert pairs(spark, {"A": (["x"], [["a"], ["b"]]), "B": (["x"], [["b"], ["a"]])}) == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["1", "2", "a", ""]), min_size=1, max_size=3), min_size=2, max_size=5))
def test_pairs_equal_brute_force(spark, bodies):
    tables = {f"T{i}": (["c"], [[v] for v in body]) for i, body in enumerate(bodies)}
    pdfs = {k: pd.DataFrame([r for r in v[1]], columns=v[0]) for k, v in tables.items()}

    def parsed(df):
        import io
        return pd.read_csv(io.StringIO(df.to_csv(index=False)))

    expect = sum(parsed(pdfs[a]).equals(parsed(pdfs[b])) for a, b in itertools.combinations(sorted(pdfs), 2))
    assert pairs(spark, tables) == expect


def test_tax_code_mode(spark):
    idx = spark.createDataFrame(
        [("S1", c) for c in ["b", "a", "b", "a", "c"]] + [("S2", None), ("S2", None), ("S2", "x")],
        "symbol string, code string",
    )
    syms = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "symbol string")
    got = {r["Symbol"]: r["tax_code"] for r in mapping.tax_code_mode(idx, syms, code="code").collect()}
    assert got == {"S1": "a", "S2": "nan", "S3": None}
    got = {r["Symbol"]: r["tax_code"] for r in mapping.tax_code_mode(idx, code="code", drop_missing=True).collect()}
    assert got == {"S1": "a", "S2": "x"}


def test_duplicates_counted_per_index_row(spark):
    tables = {"A": (["x"], [["1"]]), "B": (["x"], [["1"]])}
    fps = quality.statement_fingerprints(cells_df(spark, tables))
    idx = spark.createDataFrame([("S", "R"), ("S", "R")], "symbol string, report_dir string")
    got = quality.duplicate_pairs(fps, index=idx).first()
    assert got["dup_pairs"] == 2


def test_contamination_rate_wrapper(spark, tmp_path):
    root = write_tree(str(tmp_path / "crawl"))
    idx = files.read_report_index(spark, root)
    cells = files.read_statements(spark, root, header=False)
    r = quality.contamination_rate(idx, cells, new_root=root).first()
    assert (r["total_files"], r["error_files"]) == (1, 1)
    r = quality.contamination_rate(idx, cells, statement="LCTT_TT", new_root=root).first()
    assert (r["total_files"], r["error_files"]) == (1, 0)


def test_fingerprints_are_aggregated_without_sorting_cells(spark):
    cells = spark.range(6).selectExpr(
        "'S' AS symbol", "'/r' AS report_dir", "cast(id div 2 AS string) AS statement", "id % 2 AS row_idx", "0L AS col_idx",
        "CASE id div 2 WHEN 0 THEN 'a' WHEN 1 THEN 'a' END AS col_name", "'1' AS value", "false AS unreadable",
    )
    fps = quality.statement_fingerprints(cells)
    assert "SortAggregate" not in fps._jdf.queryExecution().executedPlan().toString()
    fp = {r["statement"]: r["fp"] for r in fps.collect()}
    assert fp["0"] == fp["1"] != fp["2"]
