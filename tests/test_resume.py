"""Resume, checkpoints, naming and batches."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators import batches, listing, naming, ordering, resume

SCHEMA = "symbol string, page long, row_idx long"


def listing_rows(spark, pages=3, per_page=4, symbol="AAA"):
    return spark.createDataFrame(
        [(symbol, p, r) for p in range(1, pages + 1) for r in range(per_page)], SCHEMA
    )


def test_resume_from_checkpoint(spark):
    cp = spark.createDataFrame([("AAA", 2, 3)], "symbol string, current_page long, last_row_index long")
    kept = sorted((r["page"], r["row_idx"]) for r in resume.resume_rows(listing_rows(spark), cp).collect())
    assert kept == [(2, 3), (3, 0), (3, 1), (3, 2), (3, 3)]


def test_advance_and_reset(spark):
    rows = listing_rows(spark)
    sizes = rows.groupBy("symbol", "page").agg(F.count(F.lit(1)).alias("n_rows"))
    done = rows.where(F.col("page") == 3)
    cp = resume.advance_checkpoints(done, sizes).first()
    assert (cp["current_page"], cp["last_row_index"]) == (4, 0)
    mid = rows.where((F.col("page") == 2) & (F.col("row_idx") <= 1))
    cp = resume.advance_checkpoints(mid, sizes).first()
    assert (cp["current_page"], cp["last_row_index"]) == (2, 2)
    old = spark.createDataFrame([("AAA", 4, 0), ("BBB", 2, 1)], "symbol string, current_page long, last_row_index long")
    err = spark.createDataFrame([("AAA",), ("CCC",)], "symbol string")
    got = sorted(tuple(r) for r in resume.reset_checkpoints(old, err).collect())
    assert got == [("AAA", 1, 0), ("BBB", 2, 1), ("CCC", 1, 0)]


@settings(max_examples=10, deadline=None)
@given(page=st.integers(1, 4), row=st.integers(0, 4))
def test_resume_plus_earlier_is_everything(spark, page, row):
    rows = listing_rows(spark)
    cp = spark.createDataFrame([("AAA", page, row)], "symbol string, current_page long, last_row_index long")
    later = {(r["page"], r["row_idx"]) for r in resume.resume_rows(rows, cp).collect()}
    earlier = {(p, r) for p in range(1, 4) for r in range(4) if (p, r) < (page, row)}
    assert later | earlier == {(p, r) for p in range(1, 4) for r in range(4)}
    assert not later & earlier


def test_paths_numbered_and_unique(spark):
    df = spark.createDataFrame(
        [("AAA", p, r, "t", "d", "x") for p in (1, 2) for r in (0, 1)] + [("AAA", 3, 0, "t", "d", "x")],
        "symbol string, page long, row_idx long, `Tiêu đề` string, `Thời gian gửi` string, `Trích yếu` string",
    )
    named = naming.assign_paths(naming.base_folders(df))
    got = [r["report_dir"] for r in named.orderBy("page", "row_idx").collect()]
    base = "./crawl_table/AAA/NO_NAME"
    assert got[:3] == [base, base + "__1", base + "__2"]
    assert naming.path_conflicts(named).count() == 0
    existing = spark.createDataFrame([(base,), (base + "__1",)], "report_dir string")
    again = naming.assign_paths(naming.base_folders(df), existing)
    first = again.orderBy("page", "row_idx").first()["report_dir"]
    assert first == base + "__2"


def test_ordered_index_hot_group(spark):
    # One symbol holds most rows: numbering must still be 1..n in order.
    rows = [("HOT", i) for i in range(500)] + [("COLD", i) for i in range(7)]
    df = spark.createDataFrame(rows, "symbol string, k long")
    out = ordering.ordered_index(df, ["symbol"], ["k"], "rn", bucket=F.floor(F.col("k") / 16))
    small = ordering.ordered_index(df, ["symbol"], ["k"], "rn")
    assert sorted(tuple(r) for r in small.collect()) == sorted(tuple(r) for r in out.collect())
    got = {(r["symbol"], r["k"]): r["rn"] for r in out.collect()}
    assert all(got[("HOT", i)] == i + 1 for i in range(500))
    assert all(got[("COLD", i)] == i + 1 for i in range(7))


def test_batches_of_twenty(spark):
    df = spark.range(45).withColumnRenamed("id", "k")
    got = {r["k"]: r["batch"] for r in batches.assign_batches(df, ["k"]).collect()}
    assert got[0] == 0 and got[19] == 0 and got[20] == 1 and got[44] == 2
    # Other buckets give the same positions.
    split = ordering.ordered_index(df, [], ["k"], "rn", bucket=F.floor(F.col("k") / 7))
    assert sorted((r["k"], r["rn"]) for r in split.collect()) == [(i, i + 1) for i in range(45)]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("A", "t1", 1, 0, "x"), ("A", "t1", 1, 1, "y"), ("A", "t2", 2, 0, "z")],
        "symbol string, submitted_at string, page long, row_idx long, v string",
    )
    first = {r["submitted_at"]: r["v"] for r in listing.first_submission(df, ["symbol", "submitted_at"], ["page", "row_idx"]).collect()}
    last = {r["submitted_at"]: r["v"] for r in listing.last_write(df, ["symbol", "submitted_at"], ["page", "row_idx"]).collect()}
    assert first == {"t1": "x", "t2": "z"} and last == {"t1": "y", "t2": "z"}
    known = spark.createDataFrame([("A", "t1")], "symbol string, submitted_at string")
    assert [r["v"] for r in listing.new_submissions(df, known).collect()] == ["z"]


def test_listing_projection_and_filters(spark):
    headers = ["STT", "Tên báo cáo", "Đơn vị"]
    df = spark.createDataFrame(
        [("1\tBC quý 1\n\tCty A", headers), ("2\tTên báo cáo\tx", headers), ("3\tFilter\tx", headers), ("4", headers)],
        "row_text string, headers array<string>",
    )
    out = listing.filter_listing_names(listing.listing_from_text(df))
    got = [(r["STT"], r["Tên báo cáo"], r["Đơn vị"], r["Trích yếu"]) for r in out.collect()]
    assert got == [("1", "BC quý 1", "Cty A", None), ("4", "", "", None)]


def test_new_reports_take_free_numbers(spark):
    df = spark.createDataFrame(
        [("S", 1, i, b) for i, b in enumerate(["r/S/base"] * 4 + ["r/S/only1"] * 2 + ["r/S/x", "r/S/x", "r/S/x__1", "r/S/x__1"])],
        "symbol string, page long, row_idx long, base string",
    )
    existing = spark.createDataFrame([("r/S/base",), ("r/S/base__2",), ("r/S/only1__1",)], "report_dir string")
    got = [r["report_dir"] for r in naming.assign_paths(df, existing).orderBy("row_idx").collect()]
    assert got[:6] == ["r/S/base__1", "r/S/base__3", "r/S/base__4", "r/S/base__5", "r/S/only1", "r/S/only1__2"]
    # a base written like another's second name keeps its own; the other skips it
    assert got[6:] == ["r/S/x", "r/S/x__2", "r/S/x__1", "r/S/x__1__1"]


@settings(max_examples=8, deadline=None)
@given(titles=st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=12), m=st.integers(0, 3))
def test_assigned_paths_unique(spark, titles, m):
    rows = [("S", i // 4 + 1, i % 4, t, "d", "summary") for i, t in enumerate(titles)]
    df = spark.createDataFrame(
        rows, "symbol string, page long, row_idx long, `Tiêu đề` string, `Thời gian gửi` string, `Trích yếu` string"
    )
    based = naming.base_folders(df, max_title=50, max_path=200)
    # The first m names of the series for title "a" are already on disk.
    base_a = "./crawl_table/S/a_d"
    ex = [base_a if k == 0 else f"{base_a}__{k}" for k in range(m)]
    existing_df = spark.createDataFrame([(p,) for p in ex], "report_dir string") if ex else None
    paths = [r["report_dir"] for r in naming.assign_paths(based, existing_df).collect()]
    assert len(paths) == len(set(paths))
    assert not set(paths) & set(ex)


def test_filter_listing_styles_and_purge(spark):
    from filingflow.plans import flows

    df = spark.createDataFrame(
        [(["1", "a", "b", "long summary", "t"],), (["1", "a", "b", "x", "t"],), (["1", "a", "b", "sum"],)],
        "cells array<string>",
    )
    assert listing.filter_listing(df, "cells").count() == 1
    captured = spark.createDataFrame([("AAA", 1), ("BBB", 2)], "symbol string, v long")
    gone = spark.createDataFrame([("BBB",)], "symbol string")
    assert [r["symbol"] for r in flows.purge_captured(captured, gone).collect()] == ["AAA"]


def plain_paths(bases, folders):
    """The free numbers of every base in order, in plain Python."""
    import re

    used = {}
    for name, own in [*((b, False) for b in set(bases)), *((f, True) for f in set(folders))]:
        if m := re.fullmatch(r"(.*)__([1-9][0-9]{0,17})", name):
            used.setdefault(m[1], set()).add(int(m[2]))
        if own:
            used.setdefault(name, set()).add(0)
    at, out = {}, []
    for b in bases:
        n = at.get(b, 0)
        while n in used.get(b, ()):
            n += 1
        at[b] = n + 1
        out.append(b if n == 0 else f"{b}__{n}")
    return out


def test_hot_base_with_many_folders_and_gaps(spark, monkeypatch):
    import random

    from filingflow.operators import naming

    monkeypatch.setattr(naming, "RANGE", 64)
    rng = random.Random(7)
    folders = [f"r/S/HOT__{n}" for n in range(1, 6000) if rng.random() < 0.8] + [f"r/S/HOT__{10 ** 6 + n}" for n in range(300)]
    folders += ["r/S/HOT", "r/S/b__2", "r/S/b__02", "r/S/c__1", "r/S/c__1__1", "r/S/d__3"] + folders[:50]
    bases = rng.choices(["r/S/HOT", "r/S/b", "r/S/c__1", "r/S/c", "r/S/d", "r/S/b__4"], [30, 2, 1, 1, 1, 1], k=3000)
    rows = [("S", i // 15, i % 15, b) for i, b in enumerate(bases)]
    listing = spark.createDataFrame(rows, "symbol string, page long, row_idx long, base string")
    got = naming.assign_paths(listing, spark.createDataFrame([(f,) for f in folders], "report_dir string"))
    assert got.columns == ["symbol", "page", "row_idx", "base", "report_dir"]
    paths = [r["report_dir"] for r in got.orderBy("page", "row_idx").collect()]
    assert paths == plain_paths(bases, folders)
    assert naming.assign_paths(listing).count() == 3000


def test_no_task_orders_more_than_a_range(spark):
    from pyspark.sql import functions as F

    from filingflow.operators import naming

    used = spark.range(40_000).where("id % 10 <> 3").selectExpr("'HOT' AS base", "id AS n")
    steps = naming._steps(used)
    assert steps.groupBy("base", F.expr(f"at div {naming.RANGE}")).count().agg(F.max("count")).first()[0] <= naming.RANGE
    assert steps.count() == 4001 and steps.agg(F.max("used")).first()[0] == 36_000


def test_batches_of_urls_use_many_ranges(spark):
    from pyspark.sql import functions as F

    from filingflow.operators import batches, ordering

    urls = [f"https://example.org/report/{(i * 7919) % 20_000:06d}" for i in range(20_000)]
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, i long").repartition(8)
    got = {r["url"]: r["batch"] for r in batches.assign_batches(df, ["url"]).collect()}
    assert got == {u: k // 20 for k, u in enumerate(sorted(urls))}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ordering.range_index(df, ["url"]).groupBy(F.floor((F.col("rn") - 1) / 1)).count().limit(1).collect()]
        ranges = df.repartitionByRange("url").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sizes == [1] and len(ranges) >= 6 and max(r["count"] for r in ranges) < 6000
    odd = spark.createDataFrame([("b",), (None,), ("a",), ("",)], "url string")
    assert [(r["url"], r["batch"]) for r in batches.assign_batches(odd, ["url"], size=1).orderBy("batch").collect()] == [(None, 0), ("", 1), ("a", 2), ("b", 3)]
