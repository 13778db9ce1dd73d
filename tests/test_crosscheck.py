"""Cross-check join options (J1): null keys, salting, per-symbol keys."""

from filingflow.operators import crosscheck

REPORTS = [("A", "BCTC quý 1 năm 2023"), ("A", "Giải trình"), ("B", "BCTC hợp nhất năm 2022")]
TRUTH = [
    ("A", "2023", "Quý I", "Riêng", "001"),
    ("A", None, None, "Riêng", "002"),
    ("B", "2022.0", "Năm", "Tổng hợp", "003"),
]


def frames(spark):
    r = spark.createDataFrame(REPORTS, "symbol string, `Tên báo cáo` string")
    t = spark.createDataFrame(TRUTH, "symbol string, year string, range string, type string, tax_code string")
    return r, t


def rows(df):
    return sorted((r["symbol"], r["Tên báo cáo"], r["tax_code"]) for r in df.collect())


def test_null_keys_match_and_drop(spark):
    r, t = frames(spark)
    got = rows(crosscheck.map_source(r, t, by=["symbol"]))
    assert got == [("A", "BCTC quý 1 năm 2023", "001"), ("A", "Giải trình", "002"), ("B", "BCTC hợp nhất năm 2022", "003")]
    got = rows(crosscheck.map_source(r, t, by=["symbol"], null_keys="drop"))
    assert ("A", "Giải trình", None) in got


def test_salted_join_equals_plain(spark):
    r, t = frames(spark)
    plain = rows(crosscheck.map_source(r, t))
    for option in ({"salt": 4}, {"salt": 0}, {"parts": 2}):
        assert rows(crosscheck.map_source(r, t, **option)) == plain
    c = crosscheck.map_counts(crosscheck.map_source(r, t), t).first()
    assert (c["n_source"], c["n_truth"], c["n_mapped"]) == (3, 3, 3)


def test_hot_keys_are_found_and_dealt(spark):
    reports = [("BIG", f"Giải trình {i}") for i in range(4000)] + [(f"S{i}", "BCTC quý 1 năm 2023") for i in range(500)]
    r = spark.createDataFrame(reports, "symbol string, `Tên báo cáo` string")
    t = spark.createDataFrame(
        [("BIG", None, None, "Riêng", "001"), ("BIG", None, None, "Riêng", "002"), ("S1", "2023", "Quý I", "Riêng", "003")],
        "symbol string, year string, range string, type string, tax_code string",
    )
    hot = crosscheck.hot_keys(r, by=["symbol"]).collect()
    assert [(h["symbol"], h["key"], h["deal"]) for h in hot] == [("BIG", None, 800)]  # share: 4500 // 1024 + 1 = 5 rows
    for null_keys, n in (("match", 8000 + 500), ("drop", 4500)):
        got = crosscheck.map_source(r, t, by=["symbol"], null_keys=null_keys)
        plain = crosscheck.map_source(r, t, by=["symbol"], null_keys=null_keys, salt=0)
        assert got.columns == plain.columns
        assert len(rows_or_null(got)) == n and rows_or_null(got) == rows_or_null(plain)


def test_no_reports(spark):
    r, t = frames(spark)
    assert crosscheck.map_source(r.limit(0), t, by=["symbol"]).count() == 0
    assert crosscheck.map_source(r, t.limit(0), by=["symbol"]).where("tax_code IS NULL").count() == 3


def rows_or_null(df):
    return sorted((r["symbol"], r["Tên báo cáo"], r["tax_code"] or "") for r in df.collect())
