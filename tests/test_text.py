"""Column functions against the inline golden rows (FIXTURES §2)."""

from pyspark.sql import functions as F

from filingflow.functions import text as T


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_and_split(spark):
    assert one(spark, T.split_cells(T.clean_row_text("x")), "\n\t1\tBC\n\nX\t") == ["1", "BC", "X"]


def test_clean_keeps_inner_commas(spark):
    assert one(spark, T.clean_row_text("x"), ",,a,b,,") == "a,b"


def test_sanitize(spark):
    assert one(spark, T.sanitize_name("x"), 'a<b>:c"/d\\e|?*f') == "a_b__c__d_e___f"


TITLES = [
    ("BCTC Hợp nhất quý 2 năm 2023", "Quý II", "Tổng hợp", "2023", "2023_Quý II_Tổng hợp"),
    ("BCTC riêng Quý IV/2022", "Quý IV", "Riêng", "2022", "2022_Quý IV_Riêng"),
    ("BCTC công ty mẹ bán niên năm 2021", "Bán niên", "Riêng", "2021", "2021_Bán niên_Riêng"),
    ("BCTC năm 2020", "Năm", "Riêng", "2020", "2020_Năm_Riêng"),
    ("Giải trình", None, "Riêng", "nan", None),
    ("BCTC riêng hợp nhất năm 2019", "Năm", "Riêng", "2019", "2019_Năm_Riêng"),
]


def test_period_type_year_key(spark):
    df = spark.createDataFrame([(t[0],) for t in TITLES], "x string")
    year = T.year_of("x", missing="nan")
    period = T.period_of("x")
    kind = T.statement_type_of("x", default=T.DEFAULT_TYPE)
    got = df.select("x", period.alias("p"), kind.alias("t"), year.alias("y"), T.report_key(year, period, kind).alias("k")).collect()
    by = {r["x"]: (r["p"], r["t"], r["y"], r["k"]) for r in got}
    for title, p, t, y, k in TITLES:
        assert by[title] == (p, t, y, k), title


def test_type_without_default_is_null(spark):
    assert one(spark, T.statement_type_of("x"), "Giải trình") is None


def test_pager(spark):
    rows = spark.createDataFrame([("1-15 / 85",), ("1-15 / 90",), ("no numbers",), ("1-0 / 7",)], "x string")
    got = rows.select("x", T.pager_total("x").alias("t"), T.pager_pages("x").alias("p")).collect()
    assert [(r["t"], r["p"]) for r in got] == [(85, 6), (90, 6), (0, 1), (7, 1)]


def test_log_patterns(spark):
    lines = [
        "2024-11-12 11:37:09,123 - INFO - Scraping Successfully AAA: 85/85",
        "2024-11-12 11:38:10,001 - WARNING - Not enough reports BBB: 3/85",
        "2024-11-12 11:42:00,000 - INFO - some other message",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    r = df.select(
        T.log_symbol("x", "success").alias("ok"),
        T.log_symbol("x", "warning").alias("warn"),
        T.parse_log_tokens("x").alias("tok"),
        T.log_counts("x").alias("ge"),
        T.log_time("x").alias("ts"),
        T.log_level("x").alias("lvl"),
    ).collect()
    assert (r[0]["ok"], r[0]["warn"]) == ("AAA", None)
    assert (r[1]["ok"], r[1]["warn"]) == (None, "BBB")
    assert r[0]["tok"]["symbol"] == "AAA" and r[0]["tok"]["report_count"] == "85/85"
    assert r[1]["tok"]["symbol"] == "BBB" and r[1]["tok"]["report_count"] == "3/85"
    assert r[2]["tok"]["kind"] is None
    assert (r[1]["ge"]["got"], r[1]["ge"]["expected"]) == (3, 85)
    assert str(r[0]["ts"]) == "2024-11-12 11:37:09.123000"
    assert [x["lvl"] for x in r] == ["INFO", "WARNING", "INFO"]


def test_unicode_symbol(spark):
    line = "2024-11-12 11:37:09,123 - INFO - Scraping Successfully ĐẠT_1: 2/2"
    assert one(spark, T.log_symbol("x", "success"), line) == "ĐẠT_1"


def test_report_name_thresholds(spark):
    df = spark.createDataFrame(
        [("Báo cáo quý 1", "24/07/2024 00:00:00", "Tóm tắt", "./crawl_table/AAA"),
         ("T" * 60, "24/07/2024 00:00:00", "Tóm tắt", "./crawl_table/AAA"),
         ("Báo cáo", "24/07/2024 00:00:00", "x", "./crawl_table/AAA")],
        "t string, d string, b string, p string",
    )
    short = df.select(T.report_name("t", "d", "b", "p").alias("r")).collect()
    assert all(r["r"] == "./crawl_table/AAA/NO_NAME" for r in short)  # 20-char default limit (Q8)
    wide = df.select(T.report_name("t", "d", "b", "p", max_path=200).alias("r")).collect()
    assert wide[0]["r"] == "./crawl_table/AAA/Báo cáo quý 1_24_07_2024 00_00_00"
    assert wide[1]["r"] == "./crawl_table/AAA/Tóm tắt_24_07_2024 00_00_00"
    assert wide[2]["r"] == "./crawl_table/AAA/NO_NAME"


def test_rate_and_rebase(spark):
    df = spark.createDataFrame([(3, 4), (0, 0)], "e long, t long")
    assert [r["r"] for r in df.select(T.error_rate("e", "t").alias("r")).collect()] == [75.0, 0.0]
    assert one(spark, T.rebase_path("x", "./crawl_table", "/data"), "./crawl_table/AAA/r1") == "/data/AAA/r1"
    assert one(spark, T.symbol_from_file("x"), "checkpoint_A32.json") == "A32"
