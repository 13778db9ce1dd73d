"""Trees, index inventory and statements with empty, broken and odd files."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingflow.operators import audit, quality, reconcile
from filingflow.sources import files, tree

INDEXES = {
    "empty": b"",
    "blank": b"\n\n",
    "head": b"STT,Saving_path\n",
    "nostt": b"x,y\n1,2\n",
    "nostthead": b"x,y\n",
    "good": "﻿STT,Saving_path\n1,a\n2,b\n".encode(),
    "twice": b"STT,Saving_path\n1,a\n1.0,b\n",
    "ragged": b"STT,x\n1,2\n1,2,3\n",
    "bytes": b"STT,x\n1,\xff\xfe\n",
    "quote": b'STT,x\n1,"abc\n',
    "big": b"STT,x\n1," + b"y" * 300_000 + b"\n2,z\n",
    "short": b"STT,x\n1\n2,b\n",
    "_under": b"STT\n7\n",
    "many": b"STT,x\n" + b"".join(b"%d,a\n" % i for i in range(45_000)),
    "manybad": b"STT,x\n" + b"1,a\n" * 45_000 + b"1,2,3\n",
}


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def reference_status(path):
    """A symbol with a success line, as a plain read of its index decides."""
    try:
        df = pd.read_csv(path)
        return "clean" if len(df) == len(df["STT"].unique()) else "error"
    except Exception:
        return "error"


def test_every_entry_is_listed(spark, tmp_path):
    root = tmp_path / "t"
    deep = "/".join(["_a", ".b", "c d", "e%20f", "ü", "g"])
    data = {f"{deep}/x.csv": b"12", "e.csv": b"", "s/._h.csv": b"1", "s/n.txt": b"123", f"{STAGED}/0/1.csv": b"1"}
    for p, d in data.items():
        write(str(root / p), d)
    os.makedirs(root / "s" / "hollow" / "er")
    os.symlink(root, root / "s" / "loop")
    rows = tree.list_tree(spark, str(root)).collect()
    found = {(r["parent"] + "/" + r["name"]).lstrip("/"): (r["level"], r["is_dir"], r["bytes"]) for r in rows}
    expect = {}
    for folder, names, leaves in os.walk(root):
        rel = os.path.relpath(folder, root)
        for n in [*names, *leaves]:
            p = n if rel == "." else f"{rel}/{n}"
            if not p.startswith(STAGED):
                is_dir = n in names and not os.path.islink(os.path.join(folder, n))
                expect[p] = (p.count("/"), is_dir, None if n in names else os.path.getsize(os.path.join(folder, n)))
    assert found == expect
    catalog = files.file_catalog(spark, str(root))
    assert {r["path"]: r["bytes"] for r in catalog.collect()} == {str(root / p): len(d) for p, d in data.items() if p.endswith(".csv") and not p.startswith(STAGED)}
    assert tuple(files.count_files(catalog).first()) == (3, 3)
    assert tree.list_tree(spark, str(root), levels=1).where("level > 0").count() == 0
    assert tree.list_tree(spark, str(tmp_path / "none")).count() == 0
    assert files.file_catalog(spark, str(root), "n*.t?t").count() == 1


STAGED = tree.STAGING + "x"


def test_report_folders_with_or_without_files(spark, tmp_path):
    for p in ("AAA/r1", "AAA/_r2", "AAA/r1/sub", "BBB/r"):
        os.makedirs(tmp_path / p)
    write(str(tmp_path / "AAA/success.csv"), b"")
    got = reconcile.reports_per_symbol(tree.report_folders(spark, str(tmp_path))).collect()
    assert {r["symbol"]: r["got"] for r in got} == {"AAA": 2, "BBB": 1}


def test_inventory_as_a_plain_read(spark, tmp_path):
    for name, data in INDEXES.items():
        write(str(tmp_path / name / "success.csv"), data)
    os.makedirs(tmp_path / "nofile")
    write(str(tmp_path / "file-in-root.csv"), b"x")
    root = str(tmp_path)
    got = {r["symbol"]: r for r in files.index_inventory(spark, root).collect()}
    assert set(got) == set(INDEXES)
    for name in INDEXES:
        try:
            df = pd.read_csv(tmp_path / name / "success.csv")
            expect = (True, "STT" in df.columns, len(df), list(df.columns))
        except Exception:
            expect = (False, False, None, None)
        r = got[name]
        assert (r["readable"], r["has_stt"], r["n_rows"], r["header"]) == expect, name
        assert (r["error"] is None) == r["readable"] and r["path"] == f"{root}/{name}/success.csv"
    rows = files.read_report_index(spark, root)
    assert {r["symbol"]: r["count"] for r in rows.groupBy("symbol").count().collect()} == {n: got[n]["n_rows"] for n in INDEXES if got[n]["n_rows"]}
    logs = spark.createDataFrame([(f"2024-01-01 00:00:00,000 - INFO - Scraping Successfully {n}: 1/1",) for n in [*INDEXES, "nofile"]], "value string")
    status = {r["symbol"]: r["status"] for r in audit.audit_logs(logs, rows, index_files=files.index_symbols(spark, root)).collect()}
    assert status == {n: reference_status(str(tmp_path / n / "success.csv")) for n in [*INDEXES, "nofile"]}
    assert files.index_inventory(spark, root + "/none").count() == 0 and files.read_report_index(spark, root + "/none").count() == 0


def test_unreadable_statements_are_rows(spark, tmp_path):
    crawl, marker = tmp_path / "crawl", "TÀI SẢN NGẮN HẠN"
    bodies = {
        "ok": b"a,b\n1,2\n", "marked": f"a,b\n{marker},2\n".encode(), "empty": b"", "ragged": b"a\n1,2\n",
        "bytes": b"a,b\n\xff,2\n", "quote": b'a\n"x\n', "head": b"a,b\n", "wide": b"a," + b"z" * 200_000 + b"\n" + f"x{marker}y,1\n".encode(),
    }
    lines = ["STT,Saving_path"]
    for i, (name, data) in enumerate(bodies.items()):
        write(str(crawl / "AAA" / name / "KQKD.csv"), data)
        lines += [f"{i},./crawl_table/AAA/{name}"] * (2 if name == "empty" else 1)
    lines += ["98,", "99,./crawl_table/AAA/absent"]
    write(str(crawl / "AAA" / "success.csv"), "\n".join(lines).encode())
    write(str(crawl / "BBB" / "r" / "KQKD.csv"), bodies["marked"])
    write(str(crawl / "BBB" / "success.csv"), b"STT\n1\n")
    write(str(crawl / "CCC" / "r" / "KQKD.csv"), bodies["marked"])
    total = errors = 0
    for symbol in ("AAA", "BBB", "CCC"):
        try:
            paths = pd.read_csv(crawl / symbol / "success.csv")["Saving_path"].dropna()
        except Exception:
            continue
        for p in paths:
            file = crawl / p.removeprefix("./crawl_table/") / "KQKD.csv"
            if file.exists():
                total += 1
                try:
                    errors += bool(pd.read_csv(file, header=None).iloc[:, 0].astype(str).str.contains(marker, na=False).any())
                except Exception:
                    pass
    cells = files.read_statements(spark, str(crawl), header=False)
    rate = quality.contamination_rate(files.read_report_index(spark, str(crawl)), cells, new_root=str(crawl)).first()
    assert (rate["total_files"], rate["error_files"], rate["unreadable_files"]) == (total, errors, 5) == (9, 2, 5)
    unreadable = cells.where("unreadable").select("report_dir").collect()
    assert sorted(r["report_dir"].rsplit("/", 1)[1] for r in unreadable) == ["bytes", "empty", "quote", "ragged"]
    with_header = files.read_statements(spark, str(crawl))
    assert sorted(r["report_dir"].rsplit("/", 1)[1] for r in with_header.where("unreadable").collect()) == ["bytes", "empty", "quote"]
    assert with_header.select("symbol", "report_dir", "statement").distinct().count() == len(bodies) + 2


def test_chunks_keep_row_numbers(spark, tmp_path, monkeypatch):
    df = pd.DataFrame({"a": range(45_001), "b": "x"})
    os.makedirs(tmp_path / "S" / "r")
    df.to_csv(tmp_path / "S" / "r" / "KQKD.csv", index=False)
    cells = files.read_statements(spark, str(tmp_path))
    got = cells.groupBy("col_name").agg(F.min("row_idx"), F.max("row_idx"), F.count("*"), F.sum(F.expr("IF(col_idx = 0, CAST(value AS BIGINT) - row_idx, 0)"))).collect()
    assert sorted(map(tuple, got)) == [("a", -1, 45_000, 45_002, 0), ("b", -1, 45_000, 45_002, 0)]


def texts(spark, n, tag):
    return spark.range(n).selectExpr("concat('S', id % 3, '/r ', id, '/x.csv') AS path", f"concat('{tag}', id) AS content").repartition(4)


def present(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f)).read() for d, _, names in os.walk(root) for f in names}


def test_files_are_written_all_or_none(spark, tmp_path):
    root = str(tmp_path / "out")
    files.write_named_files(texts(spark, 9, "old"), root)
    before = present(root)
    assert before == {f"S{i % 3}/r {i}/x.csv": f"old{i}" for i in range(9)}
    broken = texts(spark, 9, "new").withColumn("content", F.expr("IF(path LIKE '%8%', raise_error('lost'), content)"))
    with pytest.raises(Exception, match="lost"):
        files.write_named_files(broken, root)
    assert {p: t for p, t in present(root).items() if not p.startswith(tree.STAGING)} == before
    assert files.count_files(files.file_catalog(spark, root)).first()["n_files"] == 9
    assert tree.drop_unfinished(spark, root) == 1 and present(root) == before


def test_a_committed_write_is_finished_later(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    files.write_named_files(texts(spark, 6, "old"), root)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tree, "_move", lost)
        with pytest.raises(RuntimeError):
            files.write_named_files(texts(spark, 6, "new"), root)
    # Some files are in place, some are not, and the marker is there.
    (staging,) = [n for n in os.listdir(root) if n.startswith(tree.STAGING)]
    first = spark.read.parquet(f"{root}/{staging}/table").orderBy("path").first()
    os.replace(f"{root}/{first['staged']}", f"{root}/{first['path']}")
    assert tree.drop_unfinished(spark, root) == 0
    tree.finish_writes(spark, root)
    assert present(root) == {f"S{i % 3}/r {i}/x.csv": f"new{i}" for i in range(6)}


def test_roots_belong_to_the_default_file_system(spark, tmp_path):
    assert tree.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert tree.plain(f"file://{tmp_path}") == str(tmp_path) and tree.plain("hdfs://n/x") == "hdfs://n/x"


def test_folders_of_symbols_are_deleted(spark, tmp_path):
    for s in ("AAA", "BBB", "CCC"):
        write(str(tmp_path / "t" / s / "r" / "KQKD.csv"), b"x")
    write(str(tmp_path / "out.csv"), b"x")
    names = spark.createDataFrame([("AAA",), ("CCC",), ("AAA",), ("none",), ("..",), ("",), (None,), ("/tmp",)], "symbol string")
    for _ in range(2):
        tree.delete_folders(spark, str(tmp_path / "t"), names)
        assert os.listdir(tmp_path / "t") == ["BBB"]


def test_csv_files_line_by_line(spark, tmp_path):
    rows = [(f"S{i % 3}/success.csv", i, ['a,"b"', "x\ny", None, "é"][i % 4]) for i in range(40)] + [(None, 1, "z")]
    df = spark.createDataFrame(rows, "path string, STT long, `Tiêu đề` string").repartition(5)
    files.write_csv_files(df, "path", ["STT", "Tiêu đề"], ["STT"], str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["S0", "S1", "S2"]
    for s in range(3):
        got = pd.read_csv(tmp_path / "out" / f"S{s}" / "success.csv", keep_default_na=False)
        assert [tuple(r) for r in got.itertuples(index=False)] == [(n, t or "") for p, n, t in rows if p == f"S{s}/success.csv"]
    files.write_csv_files(df.limit(0), "path", ["STT"], ["STT"], str(tmp_path / "none"))
    assert files.count_files(files.file_catalog(spark, str(tmp_path / "none"))).first()["n_files"] == 0
