"""Reference-shaped inputs derived from the driver's tables.

The driver's tables have another subject (orders, line items, events, pages,
documents).  Each function here maps them, with plain column expressions that
SQL can repeat, onto one of the reference's data shapes: crawl log lines,
report-index rows, report titles, checkpoints, statement cells, captured
pages.  The operators then run unchanged on these shapes, and their work
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators.common import explode_positions
from filingflow.sources.tables import read_table


def _idiv(c: str, n: int) -> Column:
    return F.expr(f"{c} div {n}")


def _sym(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


# Crawl log -------------------------------------------------------------------
def crawl_log(spark: SparkSession, data_dir: str) -> DataFrame:
    """orders → log lines (file, value).

    Status F → success message, O → warning message, P → unrelated line.
    Symbol ``C<o_orderkey div 2>``, so a symbol gets up to two lines; the file
    is named after the calendar month of the order (twelve files).
    """
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    ts = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        F.lit(","),
        F.lpad((k % 1000).cast("string"), 3, "0"),
    )
    sym = _sym("C", _idiv("o_orderkey", 2))
    expected = (k % 90 + 1).cast("string")
    got_warn = F.greatest(k % 90 - k % 5, F.lit(0)).cast("string")
    value = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(ts, F.lit(f" - INFO - {T.SUCCESS_MESSAGE} "), sym, F.lit(": "), expected, F.lit("/"), expected),
        )
        .when(
            F.col("o_orderstatus") == "O",
            F.concat(ts, F.lit(f" - WARNING - {T.WARNING_MESSAGE} "), sym, F.lit(": "), got_warn, F.lit("/"), expected),
        )
        .otherwise(F.concat(ts, F.lit(" - INFO - Opened listing page "), k.cast("string")))
    )
    file = F.concat(F.lit("2024"), F.date_format("o_orderdate", "MM"), F.lit("01_000000_crawl.log"))
    return o.select(file.alias("file"), value.alias("value"))


def report_index(spark: SparkSession, data_dir: str) -> DataFrame:
    """lineitem → report-index rows (symbol, STT); the two orders of a symbol
    number their rows from 0 and from 10."""
    li = read_table(spark, data_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select(
        _sym("C", _idiv("l_orderkey", 2)).alias("symbol"),
        (F.col("l_orderkey") % 2 * 10 + F.col("l_linenumber")).cast("bigint").alias("STT"),
    )


def index_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """(symbol) of the index files present with a header: those of symbols with
    a low-priority order, whether or not line items give them rows."""
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_orderpriority")
    return o.where(F.col("o_orderpriority") == "5-LOW").select(_sym("C", _idiv("o_orderkey", 2)).alias("symbol"))


def symbol_list(spark: SparkSession, data_dir: str) -> DataFrame:
    """All symbols of the crawl: ``C<o_orderkey div 2>``, distinct."""
    o = read_table(spark, data_dir, "orders").select("o_orderkey")
    return o.select(_sym("C", _idiv("o_orderkey", 2)).alias("symbol")).distinct()


# Report titles and truth table (cross-check) ------------------------------------
def report_titles(spark: SparkSession, data_dir: str) -> DataFrame:
    """orders → report listing rows with a Vietnamese report title.

    Type words by ``o_orderkey % 6`` (one without type word, one with two),
    ``quý N`` unless ``k % 5 = 0`` (then ``bán niên`` when ``k % 3 = 0``),
    Roman ``Quý N/yyyy`` when ``k % 11 = 0``, ``năm yyyy`` unless ``k % 7 = 0``.
    """
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    k = F.col("o_orderkey")
    yr = F.year("o_orderdate").cast("string")
    type_word = (
        F.when(k % 6 == 0, "hợp nhất")
        .when(k % 6 == 1, "riêng")
        .when(k % 6 == 2, "công ty mẹ")
        .when(k % 6 == 3, "Tổng hợp")
        .when(k % 6 == 4, "")
        .otherwise("riêng hợp nhất")
    )
    roman = F.when(k % 4 == 0, "I").when(k % 4 == 1, "II").when(k % 4 == 2, "III").otherwise("IV")
    period = (
        F.when(k % 5 == 0, F.when(k % 3 == 0, F.lit("bán niên")).otherwise(F.lit("")))
        .when(k % 11 == 0, F.concat(F.lit("Quý "), roman, F.lit("/"), yr))
        .otherwise(F.concat(F.lit("quý "), (k % 4 + 1).cast("string")))
    )
    year_part = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("năm "), yr))
    title = F.concat(
        F.lit("Báo cáo tài chính "), type_word, F.lit(" "), period, F.lit(" "), year_part
    )
    return o.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
        _sym("K", F.col("o_custkey")).alias("symbol"), title.alias("Tên báo cáo"),
    )


def truth_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """The check table of all reports: one row per (stock code, calendar year,
    range, type) with the zero-padded customer key as tax code, missing where
    every order of the group is pending.  A report whose title names no year
    finds no row; one without a period has a null key and meets the null keys
    of its symbol."""
    from filingflow.operators.crosscheck import tag_reports

    t = tag_reports(report_titles(spark, data_dir))
    code = F.when(F.col("o_orderstatus") != "P", F.lpad(F.col("o_custkey").cast("string"), 10, "0"))
    return t.groupBy(
        F.col("symbol").alias("stock_code"), F.year("o_orderdate").cast("string").alias("year"), "range", "type"
    ).agg(F.min(code).alias("tax_code"))


# Tax codes -----------------------------------------------------------------------
def tax_index(spark: SparkSession, data_dir: str) -> DataFrame:
    """orders → index rows (symbol ``K<custkey>``, code = priority, missing
    when ``o_orderkey % 7 = 0``)."""
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return o.select(
        _sym("K", F.col("o_custkey")).alias("symbol"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("Mã doanh nghiệp"),
    )


def tax_symbols(spark: SparkSession, data_dir: str) -> DataFrame:
    c = read_table(spark, data_dir, "customer").select("c_custkey")
    return c.select(_sym("K", F.col("c_custkey")).alias("symbol"))


# Statement files from documents (marker check) ------------------------------------
def document_index(spark: SparkSession, data_dir: str) -> DataFrame:
    """documents → index rows (symbol = lang, saved path, null when
    ``n_chars % 10 = 0``)."""
    d = read_table(spark, data_dir, "documents").select("doc_id", "lang", "n_chars")
    path = F.concat(F.lit("./crawl_table/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"))
    return d.select(
        F.col("lang").alias("symbol"),
        F.when(F.col("n_chars") % 10 == 0, F.lit(None).cast("string")).otherwise(path).alias("Saving_path"),
    )


def document_cells(spark: SparkSession, data_dir: str) -> DataFrame:
    """Statement files = documents; lines are rows, commas part the cells."""
    d = read_table(spark, data_dir, "documents").select("doc_id", "lang", "text")
    d = d.select(
        F.col("lang").alias("symbol"),
        F.concat(F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")).alias("report_dir"),
        (F.length("text") == 0).alias("unreadable"),
        "text",
    )
    rows = explode_positions(
        d, F.split("text", "\n"), "row_idx", "line", ["symbol", "report_dir", "unreadable"]
    )
    cells = explode_positions(
        rows, F.split("line", ","), "col_idx", "value", ["symbol", "report_dir", "row_idx", "unreadable"]
    )
    return cells.select(
        "symbol",
        "report_dir",
        F.lit("KQKD").alias("statement"),
        F.col("row_idx").cast("bigint").alias("row_idx"),
        F.col("col_idx").cast("bigint").alias("col_idx"),
        F.lit(None).cast("string").alias("col_name"),
        "value",
        "unreadable",
    )


# Statement tables from line items (duplicate check) --------------------------------
def lineitem_cells(spark: SparkSession, data_dir: str) -> DataFrame:
    """Report = customer, statement = order, rows = its line items in
    (linenumber, partkey, suppkey, extendedprice) order, two columns."""
    from filingflow.operators.ordering import ordered_index

    li = read_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_returnflag", "l_linestatus",
    )
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey")
    li = ordered_index(
        li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "pos"
    )
    li = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    cells = li.select(
        F.col("o_custkey").cast("string").alias("symbol"),
        F.col("o_custkey").cast("string").alias("report_dir"),
        F.col("l_orderkey").cast("string").alias("statement"),
        (F.col("pos") - 1).alias("row_idx"),
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("col_idx"), F.lit("returnflag").alias("col_name"),
                         F.col("l_returnflag").alias("value")),
                F.struct(F.lit(1).cast("bigint").alias("col_idx"), F.lit("linestatus").alias("col_name"),
                         F.col("l_linestatus").alias("value")),
            )
        ),
    )
    return cells.withColumn("unreadable", F.lit(False))


# Paged listing and checkpoints from events ------------------------------------------
ROWS_PER_PAGE = 15


def event_listing(spark: SparkSession, data_dir: str) -> DataFrame:
    """events → listing rows of symbol ``U<user_id>`` in (ts, event_id) order,
    15 rows per page: (symbol, event_id, event_type, ts, page, row_idx)."""
    from filingflow.operators.ordering import ordered_index

    e = read_table(spark, data_dir, "events").select("event_id", "user_id", "event_type", "ts")
    e = e.select(_sym("U", F.col("user_id")).alias("symbol"), "event_id", "event_type", "ts")
    e = ordered_index(e, ["symbol"], ["ts", "event_id"], "_pos", bucket=F.to_date("ts"))
    p = F.col("_pos") - 1
    return e.select(
        "symbol",
        "event_id",
        "event_type",
        "ts",
        (F.floor(p / ROWS_PER_PAGE) + 1).cast("bigint").alias("page"),
        (p % ROWS_PER_PAGE).cast("bigint").alias("row_idx"),
    )


def event_checkpoints(spark: SparkSession, data_dir: str) -> DataFrame:
    """A stored checkpoint for users with at least as many purchases as views."""
    e = read_table(spark, data_dir, "events").select("user_id", "event_type")
    u = e.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("_buy"), F.count_if(F.col("event_type") == "view").alias("_view")
    )
    return u.where(F.col("_buy") >= F.col("_view")).select(
        _sym("U", F.col("user_id")).alias("symbol"),
        (F.col("user_id") % 5 + 1).cast("bigint").alias("current_page"),
        F.when(F.col("user_id") % 3 == 0, F.lit(0))
        .otherwise(F.col("user_id") % ROWS_PER_PAGE)
        .cast("bigint")
        .alias("last_row_index"),
    )


def event_folders(spark: SparkSession, data_dir: str) -> DataFrame:
    """Report folders of earlier passes: rows before the checkpoint, but for
    error events, whose reports were never saved."""
    from filingflow.operators import naming, resume

    rows = resume.with_checkpoint(event_listing_rows(spark, data_dir), event_checkpoints(spark, data_dir))
    before = (F.col("page") < F.col("_cp_page")) | ((F.col("page") == F.col("_cp_page")) & (F.col("row_idx") < F.col("_cp_row")))
    held = rows.where(before & (F.col("event_type") != "error"))
    return naming.base_folders(held, max_title=50, max_path=200).select(F.col("base").alias("report_dir"))


def event_error_symbols(spark: SparkSession, data_dir: str) -> DataFrame:
    """Users with more error events than purchases."""
    e = read_table(spark, data_dir, "events").select("user_id", "event_type")
    g = e.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("_err"),
        F.count_if(F.col("event_type") == "purchase").alias("_buy"),
    )
    return g.where(F.col("_err") > F.col("_buy")).select(_sym("U", F.col("user_id")).alias("symbol"))


# Reconciliation from orders / line items --------------------------------------------
def order_pager(spark: SparkSession, data_dir: str) -> DataFrame:
    o = read_table(spark, data_dir, "orders").select("o_orderkey")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit("Không có dữ liệu")).otherwise(
        F.concat(F.lit("1-15 / "), (F.col("o_orderkey") % 8).cast("string"))
    )
    return o.select(_sym("O", F.col("o_orderkey")).alias("symbol"), text.alias("pager_text"))


def order_catalog(spark: SparkSession, data_dir: str) -> DataFrame:
    """Captured report folders: one per (order, line number)."""
    li = read_table(spark, data_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select(
        _sym("O", F.col("l_orderkey")).alias("symbol"),
        F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("report_dir"),
    )


def order_arrivals(spark: SparkSession, data_dir: str) -> DataFrame:
    """Listing rows processed on unpaged listings: one per line item."""
    li = read_table(spark, data_dir, "lineitem").select("l_orderkey")
    return li.select(_sym("O", F.col("l_orderkey")).alias("symbol"))


# Report folders from pages ------------------------------------------------------------
def page_listing(spark: SparkSession, data_dir: str) -> DataFrame:
    p = read_table(spark, data_dir, "pages").select("page_id", "url")
    pid = F.col("page_id")
    date = F.concat(
        F.lpad((pid % 28 + 1).cast("string"), 2, "0"), F.lit("/"),
        F.lpad((pid % 12 + 1).cast("string"), 2, "0"), F.lit("/2024 00:00:00"),
    )
    backup = F.when(pid % 9 == 0, F.lit("x")).otherwise(F.concat(F.lit("Báo cáo "), (pid % 3).cast("string")))
    return p.select(
        _sym("P", pid % 7).alias("symbol"),
        "page_id",
        F.col("url").alias("Tiêu đề"),
        date.alias("Thời gian gửi"),
        backup.alias("Trích yếu"),
        (F.floor(pid / ROWS_PER_PAGE) + 1).cast("bigint").alias("page"),
        (pid % ROWS_PER_PAGE).cast("bigint").alias("row_idx"),
    )


# Submissions -------------------------------------------------------------------------
def order_submissions(spark: SparkSession, data_dir: str) -> DataFrame:
    from filingflow.operators.listing import submitted_at

    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    text = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    return o.select(
        _sym("K", F.col("o_custkey")).alias("symbol"),
        "o_orderkey",
        submitted_at(text).alias("submitted_at"),
    )


def lineitem_submissions(spark: SparkSession, data_dir: str) -> DataFrame:
    li = read_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    return li.select(
        _sym("O", F.col("l_orderkey")).alias("symbol"),
        F.year("l_shipdate").cast("bigint").alias("submitted_at"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
    )


def supplier_submissions(spark: SparkSession, data_dir: str) -> DataFrame:
    li = read_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    return li.select(
        _sym("S", F.col("l_suppkey")).alias("symbol"),
        F.date_format("l_shipdate", "dd/MM/yyyy HH:mm:ss").alias("submitted_at"),
        "l_orderkey", "l_linenumber", "l_returnflag",
    )


# Listing row texts ---------------------------------------------------------------------
LISTING_HEADER = T.LISTING_COLUMNS[:5]


def event_row_texts(spark: SparkSession, data_dir: str) -> DataFrame:
    """events → inner text of a listing row (cells split by tabs/newlines)
    with the page header; signups carry a header text as name, errors a
    ``Filter`` name."""
    e = read_table(spark, data_dir, "events").select("event_id", "user_id", "event_type", "props", "ts")
    name = (
        F.when(F.col("event_type") == "signup", F.lit("Tên báo cáo"))
        .when(F.col("event_type") == "error", F.concat(F.lit("Filter "), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.col("event_type"), F.lit(" report")))
    )
    text = F.concat(
        F.col("event_id").cast("string"), F.lit("\n\t"), name, F.lit("\t"),
        F.lit("Đơn vị "), F.col("user_id").cast("string"), F.lit("\n"), F.col("props"), F.lit("\t"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.lit("\t\n"),
    )
    return e.select(
        "event_id",
        text.alias("row_text"),
        F.array(*[F.lit(h) for h in LISTING_HEADER]).alias("headers"),
    )


def symbol_checkpoints(spark: SparkSession, data_dir: str) -> DataFrame:
    """Checkpoints for the audit's symbols ``C<k>`` with an order that is not pending."""
    o = read_table(spark, data_dir, "orders").select("o_orderkey", "o_orderstatus")
    s = o.groupBy(F.expr("o_orderkey div 2").alias("k")).agg(F.bool_or(F.col("o_orderstatus") != "P").alias("_any"))
    return s.where("_any").select(
        _sym("C", F.col("k")).alias("symbol"),
        (F.col("k") % 4 + 1).cast("bigint").alias("current_page"),
        (F.col("k") % 3).cast("bigint").alias("last_row_index"),
    )


def event_listing_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """The paged event listing with report-listing columns: title
    ``<event_type> <event_id>``, submission time, summary ``Tóm tắt <user>``."""
    lst = event_listing(spark, data_dir)
    return lst.select(
        "*",
        F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("Tiêu đề"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("Thời gian gửi"),
        F.concat(F.lit("Tóm tắt "), F.substring("symbol", 2, 20)).alias("Trích yếu"),
    )


def event_pager(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pager text per user: ``1-15 / <number of events>``."""
    e = read_table(spark, data_dir, "events").select("user_id")
    g = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select(
        _sym("U", F.col("user_id")).alias("symbol"),
        F.concat(F.lit("1-15 / "), F.col("n").cast("string")).alias("pager_text"),
    )
