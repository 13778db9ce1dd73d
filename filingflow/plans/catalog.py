"""Registered queries (one per operator family of the inventory) and their
SQL oracles.

``QUERIES[name](spark, data_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
same computation in plain SQL over the driver's tables, written independently
of the Spark code.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators import audit
from filingflow.plans import derive
from filingflow.session import new_work_dir
from filingflow.sources import files
from filingflow.sources.tables import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# Shared SQL pieces ------------------------------------------------------------
W = r"[\p{L}\p{N}_]"
LOG_CTE = rf"""
log AS (
  SELECT '2024' || strftime(o_orderdate, '%m') || '01_000000_crawl.log' AS file,
         CASE o_orderstatus
           WHEN 'F' THEN ts || ' - INFO - Scraping Successfully ' || sym || ': ' || exp || '/' || exp
           WHEN 'O' THEN ts || ' - WARNING - Not enough reports ' || sym || ': ' || got_w || '/' || exp
           ELSE ts || ' - INFO - Opened listing page ' || CAST(o_orderkey AS VARCHAR)
         END AS value
  FROM (SELECT o_orderkey, o_orderstatus, o_orderdate,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',' ||
                 lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS ts,
               'C' || CAST(o_orderkey // 2 AS VARCHAR) AS sym,
               CAST(o_orderkey % 90 + 1 AS VARCHAR) AS exp,
               CAST(greatest(o_orderkey % 90 - o_orderkey % 5, 0) AS VARCHAR) AS got_w
        FROM orders) o
)"""
SETS_CTE = rf"""
sets AS (
  SELECT symbol, bool_or(ok) AS in_success, bool_or(warn) AS in_warning FROM (
    SELECT nullif(regexp_extract(value, 'INFO - Scraping Successfully ({W}+):', 1), '') AS symbol,
           true AS ok, false AS warn FROM log
    UNION ALL
    SELECT nullif(regexp_extract(value, 'WARNING - Not enough reports ({W}+):', 1), ''),
           false, true FROM log
  ) h WHERE symbol IS NOT NULL GROUP BY symbol
)"""
INDEX_CTE = r"""
idx AS (
  SELECT 'C' || CAST(l_orderkey // 2 AS VARCHAR) AS symbol, CAST(l_orderkey % 2 * 10 + l_linenumber AS BIGINT) AS STT
  FROM lineitem
),
idx_files AS (
  SELECT DISTINCT 'C' || CAST(o_orderkey // 2 AS VARCHAR) AS symbol FROM orders WHERE o_orderpriority = '5-LOW'
),
idx_stats AS (
  SELECT symbol, count(*) AS n_rows,
         count(DISTINCT STT) + max(CASE WHEN STT IS NULL THEN 1 ELSE 0 END) AS n_distinct
  FROM idx GROUP BY symbol
)"""
CLASSIFY_CTE = r"""
classified AS (
  SELECT symbol, CASE WHEN reason IS NULL THEN 'clean' ELSE 'error' END AS status, reason FROM (
    SELECT s.symbol,
           CASE WHEN NOT s.in_success THEN 'warning_only'
                WHEN st.n_rows <> st.n_distinct THEN 'duplicate_stt'
                WHEN st.symbol IS NULL AND f.symbol IS NULL THEN 'no_index' END AS reason
    FROM sets s LEFT JOIN idx_stats st ON s.symbol = st.symbol LEFT JOIN idx_files f ON s.symbol = f.symbol) r
)"""
AUDIT_WITH = "WITH " + ",".join([LOG_CTE, SETS_CTE, INDEX_CTE, CLASSIFY_CTE])


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_logs(
        derive.crawl_log(spark, d), derive.report_index(spark, d), index_files=derive.index_files(spark, d)
    )


# L2 audit ---------------------------------------------------------------------
@register(
    "parse_crawl_log",
    "WITH " + LOG_CTE + rf"""
SELECT file, value,
       CAST(substr(value, 1, 19) AS TIMESTAMP)
         + to_milliseconds(CAST(substr(value, 21, 3) AS BIGINT)) AS ts,
       nullif(regexp_extract(value, '^.{{23}} - ([A-Z]+) - ', 1), '') AS level,
       CASE WHEN regexp_extract(value, 'INFO - Scraping Successfully ({W}+):', 1) <> '' THEN 'success'
            WHEN regexp_extract(value, 'WARNING - Not enough reports ({W}+):', 1) <> '' THEN 'warning'
       END AS event,
       coalesce(nullif(regexp_extract(value, 'INFO - Scraping Successfully ({W}+):', 1), ''),
                nullif(regexp_extract(value, 'WARNING - Not enough reports ({W}+):', 1), '')) AS symbol,
       CASE WHEN regexp_matches(value, '(INFO - Scraping Successfully|WARNING - Not enough reports) {W}+:')
            THEN TRY_CAST(split_part(regexp_extract(value, ':\s*([0-9]+/[0-9]+)\s*$', 1), '/', 1) AS BIGINT) END AS got,
       CASE WHEN regexp_matches(value, '(INFO - Scraping Successfully|WARNING - Not enough reports) {W}+:')
            THEN TRY_CAST(split_part(regexp_extract(value, ':\s*([0-9]+/[0-9]+)\s*$', 1), '/', 2) AS BIGINT) END AS expected
FROM log
""",
)
def q_parse_crawl_log(spark: SparkSession, d: str) -> DataFrame:
    return audit.parse_log(derive.crawl_log(spark, d))


@register("classify_symbols", AUDIT_WITH + "\nSELECT symbol, status, reason FROM classified")
def q_classify_symbols(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d)


@register(
    "crawl_kpi",
    AUDIT_WITH
    + """
SELECT success, error,
       CASE WHEN success + error > 0 THEN 100.0 * CAST(error AS DOUBLE) / CAST(success + error AS DOUBLE)
            ELSE 0.0 END AS error_rate
FROM (SELECT count(*) FILTER (WHERE status = 'clean') AS success,
             count(*) FILTER (WHERE status = 'error') AS error FROM classified) k
""",
)
def q_crawl_kpi(spark: SparkSession, d: str) -> DataFrame:
    return audit.crawl_kpi(_classified(spark, d))


@register(
    "total_scraped",
    "WITH " + LOG_CTE + "," + SETS_CTE + "\nSELECT count(*) AS total_scraped FROM sets",
)
def q_total_scraped(spark: SparkSession, d: str) -> DataFrame:
    return audit.total_scraped(audit.log_sets(derive.crawl_log(spark, d)))


@register(
    "stt_uniqueness",
    """
SELECT CAST(l_orderkey AS VARCHAR) AS symbol, count(*) AS n_rows,
       count(DISTINCT l_linenumber) + max(CASE WHEN l_linenumber IS NULL THEN 1 ELSE 0 END) AS n_distinct,
       count(*) = count(DISTINCT l_linenumber) + max(CASE WHEN l_linenumber IS NULL THEN 1 ELSE 0 END) AS stt_unique
FROM lineitem GROUP BY l_orderkey
""",
)
def q_stt_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.sources.tables import read_table

    li = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("symbol"), F.col("l_linenumber").alias("STT")
    )
    return audit.stt_uniqueness(li)


@register(
    "log_summary",
    "WITH "
    + LOG_CTE
    + r""",
latest AS (SELECT value FROM log WHERE file = (SELECT max(file) FROM log)),
toks AS (
  SELECT CASE WHEN contains(value, 'Scraping Successfully') THEN 'success'
              WHEN contains(value, 'Not enough reports') THEN 'warning' END AS kind,
         string_split_regex(trim(value), '\s+') AS t
  FROM latest
),
parsed AS (
  SELECT kind,
         replace(CASE kind WHEN 'success' THEN t[8] ELSE t[9] END, ':', '') AS symbol,
         CASE kind WHEN 'success' THEN t[9] ELSE t[10] END AS report_count
  FROM toks WHERE kind IS NOT NULL
)
SELECT symbol AS Symbol, report_count, kind FROM parsed WHERE kind = 'success'
UNION ALL
SELECT symbol, report_count, kind FROM parsed p
WHERE kind = 'warning'
  AND NOT EXISTS (SELECT 1 FROM parsed s WHERE s.kind = 'success' AND s.symbol IS NOT DISTINCT FROM p.symbol)
""",
)
def q_log_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.log_summary(derive.crawl_log(spark, d))


@register("newest_log_summary", ORACLE["log_summary"])
def q_newest_log_summary(spark: SparkSession, d: str) -> DataFrame:
    """The logs as files, of which the newest is found by its name and read alone."""
    path = new_work_dir(spark, "newest-log")
    logs = derive.crawl_log(spark, d).select(F.col("file").alias("log"), "value")
    logs.write.partitionBy("log").text(f"{path}/logs")
    return audit.log_summary(files.read_latest_log(spark, f"{path}/logs"))


@register(
    "open_symbols",
    AUDIT_WITH
    + r""",
syms AS (SELECT DISTINCT 'C' || CAST(o_orderkey // 2 AS VARCHAR) AS symbol FROM orders)
SELECT symbol FROM syms
WHERE symbol NOT IN (SELECT symbol FROM classified WHERE status = 'clean')
ORDER BY symbol DESC
""",
)
def q_open_symbols(spark: SparkSession, d: str) -> DataFrame:
    classified = _classified(spark, d)
    clean = classified.where(F.col("status") == "clean")
    return audit.open_symbols(derive.symbol_list(spark, d), clean)


@register(
    "count_open",
    AUDIT_WITH
    + r""",
syms AS (SELECT DISTINCT 'C' || CAST(o_orderkey // 2 AS VARCHAR) AS symbol FROM orders)
SELECT count(DISTINCT symbol) AS n_open FROM syms
WHERE symbol NOT IN (SELECT symbol FROM classified WHERE status = 'clean')
""",
)
def q_count_open(spark: SparkSession, d: str) -> DataFrame:
    classified = _classified(spark, d)
    clean = classified.where(F.col("status") == "clean")
    return audit.count_open(derive.symbol_list(spark, d), clean)


# L4 cross-check ------------------------------------------------------------------
from filingflow.functions import text as _T  # noqa: E402
from filingflow.operators import crosscheck, mapping, quality  # noqa: E402


def _case_first(expr: str, pairs) -> str:
    whens = " ".join(f"WHEN contains({expr}, '{k}') THEN '{v}'" for k, v in pairs)
    return f"CASE {whens} END"


TITLES_CTE = r"""
titles AS (
  SELECT o_orderkey, o_custkey,
    'Báo cáo tài chính ' ||
    CASE o_orderkey % 6 WHEN 0 THEN 'hợp nhất' WHEN 1 THEN 'riêng' WHEN 2 THEN 'công ty mẹ'
                        WHEN 3 THEN 'Tổng hợp' WHEN 4 THEN '' ELSE 'riêng hợp nhất' END
    || ' ' ||
    CASE WHEN o_orderkey % 5 = 0 THEN (CASE WHEN o_orderkey % 3 = 0 THEN 'bán niên' ELSE '' END)
         WHEN o_orderkey % 11 = 0 THEN 'Quý ' ||
              (CASE o_orderkey % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' ELSE 'IV' END)
              || '/' || CAST(year(o_orderdate) AS VARCHAR)
         ELSE 'quý ' || CAST(o_orderkey % 4 + 1 AS VARCHAR) END
    || ' ' ||
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'năm ' || CAST(year(o_orderdate) AS VARCHAR) END AS title
    , o_orderstatus, o_orderdate, 'K' || CAST(o_custkey AS VARCHAR) AS symbol
  FROM orders
)"""
TAGGED_CTE = f"""
tagged AS (
  SELECT o_orderkey, o_custkey, symbol, o_orderdate, o_orderstatus, title,
         coalesce(nullif(regexp_extract(title, '([0-9]{{4}})', 1), ''), 'nan') AS year,
         {_case_first('lower(title)', _T.PERIOD_KEYWORDS)} AS range,
         coalesce({_case_first('lower(title)', _T.TYPE_KEYWORDS)}, 'Riêng') AS type
  FROM titles
),
keyed AS (SELECT *, year || '_' || range || '_' || type AS key FROM tagged),
truth AS (
  SELECT symbol, CAST(year(o_orderdate) AS VARCHAR) AS year, range, type,
         min(CASE WHEN o_orderstatus <> 'P' THEN lpad(CAST(o_custkey AS VARCHAR), 10, '0') END) AS tax_code
  FROM keyed GROUP BY 1, 2, 3, 4
),
truth_keyed AS (
  SELECT symbol, nullif(regexp_extract(year, '([0-9]{{4}})', 1), '') AS year, range, type, tax_code,
         nullif(regexp_extract(year, '([0-9]{{4}})', 1), '') || '_' || range || '_' || type AS key
  FROM truth
),
merged AS (
  SELECT k.o_orderkey, k.symbol, k.title, k.year AS year_src, k.range AS range_src,
         k.type AS type_src, k.key, t.year AS year_truth, t.range AS range_truth,
         t.type AS type_truth, t.tax_code
  FROM keyed k LEFT JOIN truth_keyed t ON k.symbol = t.symbol AND k.key IS NOT DISTINCT FROM t.key
)"""
CROSS_WITH = "WITH " + TITLES_CTE + "," + TAGGED_CTE

MERGED_COLS = [
    "o_orderkey", "symbol", "title", "year_src", "range_src", "type_src", "key",
    "year_truth", "range_truth", "type_truth", "tax_code",
]


def _merged(spark: SparkSession, d: str, truth: DataFrame | None = None) -> DataFrame:
    truth = derive.truth_table(spark, d) if truth is None else truth
    merged = crosscheck.map_source(
        derive.report_titles(spark, d), truth.withColumnRenamed("stock_code", "symbol"), by=["symbol"]
    )
    return merged.withColumnRenamed("Tên báo cáo", "title").select(*MERGED_COLS)


@register("map_source", CROSS_WITH + "\nSELECT * FROM merged")
def q_map_source(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d)


@register("mapped_reports", CROSS_WITH + "\nSELECT * FROM merged WHERE tax_code IS NOT NULL")
def q_mapped_reports(spark: SparkSession, d: str) -> DataFrame:
    return crosscheck.mapped_reports(_merged(spark, d))


@register(
    "map_counts",
    CROSS_WITH
    + """
SELECT (SELECT count(*) FROM merged) AS n_source, (SELECT count(*) FROM truth) AS n_truth,
       (SELECT count(*) FROM merged WHERE tax_code IS NOT NULL) AS n_mapped
""",
)
def q_map_counts(spark: SparkSession, d: str) -> DataFrame:
    return crosscheck.map_counts(_merged(spark, d), derive.truth_table(spark, d))


# Symbol → tax code ---------------------------------------------------------------
@register(
    "tax_code_mode",
    r"""
WITH codes AS (
  SELECT 'K' || CAST(o_custkey AS VARCHAR) AS symbol,
         coalesce(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END, 'nan') AS code
  FROM orders),
cnt AS (SELECT symbol, code, count(*) AS n FROM codes GROUP BY symbol, code),
best AS (
  SELECT symbol, code FROM (
    SELECT symbol, code, row_number() OVER (PARTITION BY symbol ORDER BY n DESC, code ASC) AS rn FROM cnt) r
  WHERE rn = 1)
SELECT 'K' || CAST(c_custkey AS VARCHAR) AS Symbol, b.code AS tax_code
FROM customer c LEFT JOIN best b ON 'K' || CAST(c.c_custkey AS VARCHAR) = b.symbol
""",
)
def q_tax_code_mode(spark: SparkSession, d: str) -> DataFrame:
    return mapping.tax_code_mode(derive.tax_index(spark, d), derive.tax_symbols(spark, d))


# Contamination marker ----------------------------------------------------------------
DOC_MARKER = " la "
MARKER_WITH = rf"""
WITH idx AS (
  SELECT lang AS symbol,
         CASE WHEN n_chars % 10 = 0 THEN NULL
              ELSE './crawl_table/' || lang || '/' || CAST(doc_id AS VARCHAR) END AS saving_path
  FROM documents),
lines AS (
  SELECT doc_id, lang, length(text) = 0 AS unreadable, unnest(string_split(text, chr(10))) AS line
  FROM documents),
flags AS (
  SELECT '/' || lang || '/' || CAST(doc_id AS VARCHAR) AS report_dir,
         bool_or(contains(split_part(line, ',', 1), '{DOC_MARKER}')) AS has_marker,
         bool_or(unreadable) AS unreadable
  FROM lines GROUP BY 1),
existing AS (
  SELECT i.symbol, f.has_marker, f.unreadable FROM idx i
  JOIN flags f ON regexp_replace(i.saving_path, '^\./crawl_table', '') = f.report_dir
  WHERE i.saving_path IS NOT NULL)
"""


def _marker_existing(spark: SparkSession, d: str) -> DataFrame:
    flags = quality.marker_flags(derive.document_cells(spark, d), DOC_MARKER)
    return quality.existing_index_rows(derive.document_index(spark, d), flags)


@register(
    "marker_rate",
    MARKER_WITH
    + """
SELECT symbol, count(*) AS total_files, count(*) FILTER (WHERE has_marker) AS error_files,
       count(*) FILTER (WHERE unreadable) AS unreadable_files,
       CASE WHEN count(*) > 0 THEN 100.0 * CAST(count(*) FILTER (WHERE has_marker) AS DOUBLE)
            / CAST(count(*) AS DOUBLE) ELSE 0.0 END AS error_rate
FROM existing GROUP BY symbol
""",
)
def q_marker_rate(spark: SparkSession, d: str) -> DataFrame:
    return quality.marker_rate(_marker_existing(spark, d), by=["symbol"])


@register(
    "marker_total",
    MARKER_WITH
    + """
SELECT count(*) AS total_files, count(*) FILTER (WHERE has_marker) AS error_files,
       count(*) FILTER (WHERE unreadable) AS unreadable_files,
       CASE WHEN count(*) > 0 THEN 100.0 * CAST(count(*) FILTER (WHERE has_marker) AS DOUBLE)
            / CAST(count(*) AS DOUBLE) ELSE 0.0 END AS error_rate
FROM existing
""",
)
def q_marker_total(spark: SparkSession, d: str) -> DataFrame:
    return quality.marker_rate(_marker_existing(spark, d))


# Duplicate statements ------------------------------------------------------------------
DUP_WITH = r"""
WITH st AS (
  SELECT l_orderkey,
         string_agg(l_returnflag || ',' || l_linestatus, '|'
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sig
  FROM lineitem GROUP BY l_orderkey),
rep AS (
  SELECT o_custkey, sig, count(*) AS c FROM st JOIN orders ON o_orderkey = l_orderkey
  GROUP BY o_custkey, sig),
per_symbol AS (
  SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(sum(c * (c - 1) // 2) AS BIGINT) AS dup_pairs
  FROM rep GROUP BY o_custkey)
"""


def _dup_per_symbol(spark: SparkSession, d: str) -> DataFrame:
    fps = quality.statement_fingerprints(derive.lineitem_cells(spark, d))
    return quality.duplicate_pairs(fps)


@register("duplicate_pairs", DUP_WITH + "SELECT symbol, dup_pairs FROM per_symbol")
def q_duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _dup_per_symbol(spark, d)


@register(
    "duplicate_total",
    DUP_WITH + "SELECT CAST(coalesce(sum(dup_pairs), 0) AS BIGINT) AS total_duplicates FROM per_symbol",
)
def q_duplicate_total(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_total(_dup_per_symbol(spark, d))


# Resume and checkpoints -----------------------------------------------------------------
from filingflow.operators import batches, listing, naming, reconcile, resume  # noqa: E402

EVENTS_WITH = r"""
WITH lst AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, event_id, event_type, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p
  FROM events),
l2 AS (SELECT symbol, event_id, event_type, ts, p // 15 + 1 AS page, p % 15 AS row_idx FROM lst),
cp AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, user_id % 5 + 1 AS current_page,
         CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 15 END AS last_row_index
  FROM events GROUP BY user_id
  HAVING count(*) FILTER (WHERE event_type = 'purchase') >= count(*) FILTER (WHERE event_type = 'view')),
res AS (
  SELECT l.* FROM l2 l LEFT JOIN cp c ON l.symbol = c.symbol
  WHERE l.page > coalesce(c.current_page, 1)
     OR (l.page = coalesce(c.current_page, 1) AND l.row_idx >= coalesce(c.last_row_index, 0)))
"""


def _resumed(spark: SparkSession, d: str) -> DataFrame:
    return resume.resume_rows(derive.event_listing(spark, d), derive.event_checkpoints(spark, d))


@register("resume_rows", EVENTS_WITH + "SELECT symbol, page, row_idx, event_id FROM res")
def q_resume_rows(spark: SparkSession, d: str) -> DataFrame:
    return _resumed(spark, d).select("symbol", "page", "row_idx", "event_id")


CUTOFF = "2024-01-16 00:00:00"


@register(
    "advance_checkpoint",
    EVENTS_WITH
    + f""",
proc AS (SELECT * FROM res WHERE ts < TIMESTAMP '{CUTOFF}'),
last AS (
  SELECT symbol, page, row_idx FROM (
    SELECT symbol, page, row_idx,
           row_number() OVER (PARTITION BY symbol ORDER BY page DESC, row_idx DESC) AS rn FROM proc) r
  WHERE rn = 1),
sizes AS (SELECT symbol, page, count(*) AS n_rows FROM l2 GROUP BY symbol, page),
new AS (
  SELECT t.symbol,
         CASE WHEN t.row_idx + 1 >= s.n_rows THEN t.page + 1 ELSE t.page END AS current_page,
         CASE WHEN t.row_idx + 1 >= s.n_rows THEN 0 ELSE t.row_idx + 1 END AS last_row_index
  FROM last t LEFT JOIN sizes s ON t.symbol = s.symbol AND t.page = s.page),
allcp AS (
  SELECT * FROM new
  UNION ALL SELECT symbol, current_page, last_row_index FROM cp WHERE symbol NOT IN (SELECT symbol FROM new)),
np AS (SELECT symbol, max(page) AS number_pages FROM l2 GROUP BY symbol)
SELECT a.symbol, a.current_page, a.last_row_index, a.current_page > np.number_pages AS complete
FROM allcp a LEFT JOIN np ON a.symbol = np.symbol
""",
)
def q_advance_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    lst = written(derive.event_listing(spark, d), "listing")  # numbered once, read three times
    cps = derive.event_checkpoints(spark, d)
    processed = resume.resume_rows(lst, cps).where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    sizes = lst.groupBy("symbol", "page").agg(F.count(F.lit(1)).alias("n_rows"))
    new = resume.advance_checkpoints(processed, sizes, cps)
    # Page count per symbol from the (symbol, page) sizes, not another pass
    # over the listing.
    pages = sizes.groupBy(F.col("symbol").alias("_np_symbol")).agg(F.max("page").alias("number_pages"))
    j = new.join(pages, new["symbol"] == pages["_np_symbol"], "left")
    return j.select(
        "symbol", "current_page", "last_row_index", resume.is_complete().alias("complete")
    )


@register(
    "reset_checkpoint",
    EVENTS_WITH
    + r""",
err AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events GROUP BY user_id
  HAVING count(*) FILTER (WHERE event_type = 'error') > count(*) FILTER (WHERE event_type = 'purchase'))
SELECT symbol, current_page, last_row_index FROM cp WHERE symbol NOT IN (SELECT symbol FROM err)
UNION ALL
SELECT symbol, 1 AS current_page, 0 AS last_row_index FROM err
""",
)
def q_reset_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    return resume.reset_checkpoints(derive.event_checkpoints(spark, d), derive.event_error_symbols(spark, d))


# Reconciliation ---------------------------------------------------------------------------
RECON_WITH = r"""
WITH pager AS (
  SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS symbol,
         CASE WHEN o_orderkey % 9 = 0 THEN 'Không có dữ liệu'
              ELSE '1-15 / ' || CAST(o_orderkey % 8 AS VARCHAR) END AS pager_text
  FROM orders),
nums AS (
  SELECT symbol, pager_text, regexp_extract_all(pager_text, '([0-9]+)', 1) AS n FROM pager),
pg AS (
  SELECT symbol,
         len(n) >= 3 AND coalesce(TRY_CAST(n[2] AS BIGINT) <> 0, false) AS paged,
         coalesce(TRY_CAST(n[3] AS BIGINT), 0) AS total,
         CASE WHEN len(n) >= 3 AND coalesce(TRY_CAST(n[2] AS BIGINT) <> 0, false)
              THEN CAST(ceil(TRY_CAST(n[3] AS BIGINT) / TRY_CAST(n[2] AS BIGINT)) AS BIGINT)
              ELSE 1 END AS number_pages
  FROM nums),
arrived AS (
  SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS symbol, count(*) AS a FROM lineitem
  GROUP BY l_orderkey),
expected AS (
  SELECT pg.symbol, CASE WHEN paged THEN total ELSE total + coalesce(a, 0) END AS expected, number_pages
  FROM pg LEFT JOIN arrived ON pg.symbol = arrived.symbol),
got AS (
  SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS symbol, count(DISTINCT l_linenumber) AS got
  FROM lineitem GROUP BY l_orderkey)
"""


@register(
    "reconcile_counts",
    RECON_WITH
    + r"""
SELECT e.symbol, coalesce(g.got, 0) AS got, e.expected,
       CASE WHEN coalesce(g.got, 0) = e.expected THEN 'success' ELSE 'warning' END AS status,
       CAST(coalesce(g.got, 0) AS VARCHAR) || '/' || CAST(e.expected AS VARCHAR) AS message
FROM expected e LEFT JOIN got g ON e.symbol = g.symbol
""",
)
def q_reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    expected = reconcile.expected_reports(derive.order_pager(spark, d), derive.order_arrivals(spark, d))
    got = reconcile.reports_per_symbol(derive.order_catalog(spark, d))
    return reconcile.reconcile(expected, got)


@register(
    "pager_pages",
    RECON_WITH + "SELECT symbol, paged, total, number_pages FROM pg",
)
def q_pager_pages(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.functions import text as T

    p = derive.order_pager(spark, d)
    return p.select(
        "symbol",
        T.pager_is_paged("pager_text").alias("paged"),
        T.pager_total("pager_text").alias("total"),
        T.pager_pages("pager_text").alias("number_pages"),
    )


# Report folders ---------------------------------------------------------------------------
PATH_MAX_TITLE = 50
PATH_MAX_LEN = 90


PATHS_SQL = rf"""
WITH lst AS (
  SELECT 'P' || CAST(page_id % 7 AS VARCHAR) AS symbol, page_id, url AS title,
         lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '/' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0')
           || '/2024 00:00:00' AS dt,
         CASE WHEN page_id % 9 = 0 THEN 'x' ELSE 'Báo cáo ' || CAST(page_id % 3 AS VARCHAR) END AS backup,
         page_id // 15 + 1 AS page, page_id % 15 AS row_idx
  FROM pages),
named AS (
  SELECT *, CASE WHEN title IS NULL OR length(translate(title, '<>:"/\|?*', '_________')) > {PATH_MAX_TITLE}
                      OR length(title) < 2
                 THEN translate(backup, '<>:"/\|?*', '_________')
                 ELSE translate(title, '<>:"/\|?*', '_________') END AS chosen
  FROM lst),
based AS (
  SELECT *, CASE WHEN length('./crawl_table/' || symbol || '/' || chosen || '_' || translate(dt, '<>:"/\|?*', '_________')) > {PATH_MAX_LEN}
                      OR backup IS NULL OR length(backup) < 2
                 THEN './crawl_table/' || symbol || '/NO_NAME'
                 ELSE './crawl_table/' || symbol || '/' || chosen || '_' || translate(dt, '<>:"/\|?*', '_________') END AS base
  FROM named),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, base ORDER BY page, row_idx) - 1 AS n FROM based)
SELECT symbol, page_id, base,
       CASE WHEN n = 0 THEN base ELSE base || '__' || CAST(n AS VARCHAR) END AS report_dir
FROM numbered
"""


@register("report_paths", PATHS_SQL)
def q_report_paths(spark: SparkSession, d: str) -> DataFrame:
    lst = naming.base_folders(
        derive.page_listing(spark, d), max_title=PATH_MAX_TITLE, max_path=PATH_MAX_LEN
    )
    return naming.assign_paths(lst).select("symbol", "page_id", "base", "report_dir")


# Search and submissions --------------------------------------------------------------------
@register(
    "search_listing",
    r"""
SELECT 'K' || CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey,
       strptime(strftime(o_orderdate, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS submitted_at
FROM orders
WHERE contains('K' || CAST(o_custkey AS VARCHAR), '12')
  AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""",
)
def q_search_listing(spark: SparkSession, d: str) -> DataFrame:
    return listing.search_listing(
        derive.order_submissions(spark, d), symbol_contains="12", date_from="1998-01-01", date_to="1998-12-31"
    )


@register(
    "search_symbol",
    r"""
SELECT 'K' || CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey,
       strptime(strftime(o_orderdate, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS submitted_at
FROM orders WHERE o_custkey = 100
""",
)
def q_search_symbol(spark: SparkSession, d: str) -> DataFrame:
    return listing.search_listing(derive.order_submissions(spark, d), symbol="K100")


SUBMIT_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
SUBMIT_SQL = r"""
SELECT symbol, submitted_at, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag FROM (
  SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS symbol, CAST(year(l_shipdate) AS BIGINT) AS submitted_at,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, year(l_shipdate)
                            ORDER BY l_linenumber {d}, l_partkey {d}, l_suppkey {d}, l_extendedprice {d}) AS rn
  FROM lineitem) r WHERE rn = 1
"""


@register("first_submission", SUBMIT_SQL.format(d="ASC"))
def q_first_submission(spark: SparkSession, d: str) -> DataFrame:
    return listing.first_submission(
        derive.lineitem_submissions(spark, d), ["symbol", "submitted_at"], SUBMIT_ORDER
    )


@register("last_write", SUBMIT_SQL.format(d="DESC"))
def q_last_write(spark: SparkSession, d: str) -> DataFrame:
    return listing.last_write(derive.lineitem_submissions(spark, d), ["symbol", "submitted_at"], SUBMIT_ORDER)


@register(
    "new_submissions",
    r"""
WITH s AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%d/%m/%Y %H:%M:%S') AS submitted_at,
         l_orderkey, l_linenumber, l_returnflag FROM lineitem)
SELECT symbol, submitted_at, l_orderkey, l_linenumber, l_returnflag FROM s
WHERE l_returnflag <> 'R'
  AND NOT EXISTS (SELECT 1 FROM s k WHERE k.l_returnflag = 'R' AND k.symbol = s.symbol
                  AND k.submitted_at = s.submitted_at)
""",
)
def q_new_submissions(spark: SparkSession, d: str) -> DataFrame:
    s = derive.supplier_submissions(spark, d)
    return listing.new_submissions(s.where(F.col("l_returnflag") != "R"), s.where(F.col("l_returnflag") == "R"))


@register(
    "work_batches",
    r"""
SELECT 'K' || CAST(c_custkey AS VARCHAR) AS symbol,
       CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 20 AS BIGINT) AS batch
FROM customer
""",
)
def q_work_batches(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.sources.tables import read_table

    c = read_table(spark, d, "customer").select("c_custkey")
    b = batches.assign_batches(c, ["c_custkey"])
    return b.select(F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("symbol"), "batch")


# Listing rows from row texts -----------------------------------------------------------------
@register(
    "listing_rows",
    r"""
WITH t AS (
  SELECT event_id,
    CAST(event_id AS VARCHAR) || chr(10) || chr(9) ||
    CASE WHEN event_type = 'signup' THEN 'Tên báo cáo'
         WHEN event_type = 'error' THEN 'Filter ' || CAST(event_id AS VARCHAR)
         ELSE event_type || ' report' END || chr(9) ||
    'Đơn vị ' || CAST(user_id AS VARCHAR) || chr(10) || props || chr(9) ||
    strftime(ts, '%d/%m/%Y %H:%M:%S') || chr(9) || chr(10) AS row_text
  FROM events),
c AS (
  SELECT event_id,
         string_split(regexp_replace(regexp_replace(row_text, '[\n\t]+', ',', 'g'), '^,+|,+$', '', 'g'), ',') AS cells
  FROM t)
SELECT event_id, coalesce(cells[1], '') AS row_no, coalesce(cells[2], '') AS report_name,
       coalesce(cells[3], '') AS unit, coalesce(cells[4], '') AS summary,
       coalesce(cells[5], '') AS submitted_text
FROM c
WHERE NOT (coalesce(cells[2], '') IN ('STT', 'Tên báo cáo', 'Đơn vị', 'Trích yếu', 'Thời gian gửi'))
  AND NOT contains(coalesce(cells[2], ''), 'Filter')
""",
)
def q_listing_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = listing.filter_listing_names(listing.listing_from_text(derive.event_row_texts(spark, d)))
    return rows.select(
        "event_id",
        F.col("STT").alias("row_no"),
        F.col("Tên báo cáo").alias("report_name"),
        F.col("Đơn vị").alias("unit"),
        F.col("Trích yếu").alias("summary"),
        F.col("Thời gian gửi").alias("submitted_text"),
    )


CLEAN_SQL = r"regexp_replace(regexp_replace(text, '[\n\t]+', ',', 'g'), '^,+|,+$', '', 'g')"


@register(
    "clean_row_text",
    rf"""
SELECT conv_id, turn, {CLEAN_SQL} AS cleaned, CAST(len(string_split({CLEAN_SQL}, ',')) AS BIGINT) AS n_cells
FROM conversations
""",
)
def q_clean_row_text(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.functions import text as T
    from filingflow.sources.tables import read_table

    c = read_table(spark, d, "conversations").select("conv_id", "turn", "text")
    cleaned = T.clean_row_text("text")
    return c.select("conv_id", "turn", cleaned.alias("cleaned"), F.size(T.split_cells(cleaned)).cast("bigint").alias("n_cells"))


@register(
    "listing_cells_filter",
    rf"""
SELECT conv_id, turn, CAST(len(cells) AS BIGINT) AS n_cells FROM (
  SELECT conv_id, turn, string_split({CLEAN_SQL}, ',') AS cells FROM conversations) c
WHERE len(cells) BETWEEN 5 AND 6 AND length(cells[4]) > 1
""",
)
def q_listing_cells_filter(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.functions import text as T
    from filingflow.sources.tables import read_table

    c = read_table(spark, d, "conversations").select("conv_id", "turn", "text")
    c = c.select("conv_id", "turn", T.split_cells(T.clean_row_text("text")).alias("cells"))
    return listing.filter_listing_cells(c).select("conv_id", "turn", F.size("cells").cast("bigint").alias("n_cells"))


# Extraction from captured pages ------------------------------------------------------------
from filingflow.operators import extract  # noqa: E402
from filingflow.sources.tables import read_table  # noqa: E402

PAGE_FLAT = {"header": "div.ad, article h1", "row": "nav li"}
PAGE_FIRM = {"code": "div.ad", "name": "title", "title": "article h1"}
PAGE_SPANS = {"table": "article", "header": "h1", "row": "p", "cell": "b"}
PAGE_RENDERED = {"table": "body", "header": "nav li", "row": "article p", "cell": "b"}


def _decode(x: str) -> str:
    """HTML character references in SQL.  The legacy names (amp, lt, gt,
    quot, copy) are also references without the closing semicolon, as an
    HTML parser reads them; ``&amp`` goes last so nothing is decoded twice."""
    out = x
    for ent, ch, legacy in [("quot", '"', True), ("#39", "''", False), ("lt", "<", True), ("gt", ">", True),
                            ("copy", "©", True), ("middot", "·", False), ("amp", "&", True)]:
        if legacy:
            out = f"regexp_replace({out}, '&{ent};?', '{ch}', 'g')"
        else:
            out = f"replace({out}, '&{ent};', '{ch}')"
    return out


LINKS_CTE = rf"""
lk AS (
  SELECT page_id, list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1),
                                 lambda x: trim({_decode('x')})) AS cells
  FROM pages),
lrows AS (
  SELECT page_id, i AS row_no, cells[2 * i + 1] AS cell_1, cells[2 * i + 2] AS cell_2
  FROM (SELECT page_id, cells, unnest(range(0, CAST(ceil(len(cells) / 2) AS BIGINT))) AS i FROM lk) c)"""
FIRM_CTE = rf"""
firm AS (
  SELECT page_id,
    CASE WHEN regexp_matches(html, '<div class="ad">') THEN trim({_decode("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")}) END AS code,
    CASE WHEN regexp_matches(html, '<title>') THEN trim({_decode("regexp_extract(html, '<title>([^<]*)</title>', 1)")}) END AS name,
    CASE WHEN regexp_matches(html, '<h1>') THEN trim({_decode("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) END AS title
  FROM pages)"""


def _page_link_rows(spark: SparkSession, d: str) -> DataFrame:
    pages = files.read_pages(spark, f"{d}/pages.parquet")
    return extract.table_rows(extract.extract_cells(pages, PAGE_FLAT, "flat"), "flat")


@register("page_links", "WITH " + LINKS_CTE + "\nSELECT page_id, row_no, cell_1, cell_2 FROM lrows")
def q_page_links(spark: SparkSession, d: str) -> DataFrame:
    rows = _page_link_rows(spark, d)
    return rows.select(
        "page_id",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.try_element_at("row", F.lit(1)).alias("cell_1"),
        F.try_element_at("row", F.lit(2)).alias("cell_2"),
    )


@register("page_title", "WITH " + FIRM_CTE + "\nSELECT page_id, code, name, title FROM firm")
def q_page_title(spark: SparkSession, d: str) -> DataFrame:
    return extract.firm_info(files.read_pages(spark, f"{d}/pages.parquet"), PAGE_FIRM)


@register(
    "assembled_report",
    "WITH paths AS (" + PATHS_SQL + ")," + LINKS_CTE + "," + FIRM_CTE
    + """
SELECT p.page_id, p.symbol, p.report_dir, f.code, f.name, f.title,
       CAST(coalesce(r.n, 0) AS BIGINT) AS n_rows, coalesce(r.table_text, '') AS table_text
FROM paths p LEFT JOIN firm f ON p.page_id = f.page_id
LEFT JOIN (SELECT page_id, count(*) AS n,
                  string_agg(cell_1 || coalesce('|' || cell_2, ''), chr(10) ORDER BY row_no) AS table_text
           FROM lrows GROUP BY page_id) r ON p.page_id = r.page_id
""",
)
def q_assembled_report(spark: SparkSession, d: str) -> DataFrame:
    lst = naming.assign_paths(
        naming.base_folders(derive.page_listing(spark, d), max_title=PATH_MAX_TITLE, max_path=PATH_MAX_LEN)
    ).select("page_id", "symbol", "report_dir")
    # One parse per page gives both the firm fields and the table.
    parsed = extract.parse_pages(files.read_pages(spark, f"{d}/pages.parquet"), PAGE_FLAT, PAGE_FIRM, "flat")
    out = extract.assemble_report(lst, extract.page_summary(parsed, "flat"))
    text = F.array_join(F.transform("table", lambda r: F.array_join(r, "|")), "\n")
    return out.select(
        "page_id", "symbol", "report_dir", "code", "name", "title", "n_rows", F.coalesce(text, F.lit("")).alias("table_text")
    )


@register("page_table")
def q_page_table(spark: SparkSession, d: str) -> DataFrame:
    ex = extract.extract_cells(files.read_pages(spark, f"{d}/pages.parquet"), PAGE_SPANS, "spans")
    rows = extract.table_rows(ex, "spans")
    return rows.select(
        "page_id",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.array_join("headers", "|").alias("header_text"),
        F.size("row").cast("bigint").alias("n_cells"),
        F.array_join("row", "|").alias("row_text"),
        "malformed",
    )


@register("page_hidden_spans")
def q_page_hidden_spans(spark: SparkSession, d: str) -> DataFrame:
    """The rows of ``page_table`` from pages whose cells are spans that hold, or stand
    beside, hidden ones: the hidden ones leave no trace."""
    html = F.replace("html", F.lit("<b>"), F.lit('<span style="DISPLAY: none;">no</span><span><span style="display:none">x<i>y</i></span>'))
    pages = files.read_pages(spark, f"{d}/pages.parquet").withColumn("html", F.replace(html, F.lit("</b>"), F.lit("</span>")))
    rows = extract.table_rows(extract.extract_cells(pages, PAGE_SPANS | {"cell": "span"}, "spans"), "spans")
    return rows.select(
        "page_id", F.col("row_no").cast("bigint").alias("row_no"), F.array_join("headers", "|").alias("header_text"),
        F.size("row").cast("bigint").alias("n_cells"), F.array_join("row", "|").alias("row_text"), "malformed",
    )


@register("page_rendered")
def q_page_rendered(spark: SparkSession, d: str) -> DataFrame:
    ex = extract.extract_cells(files.read_pages(spark, f"{d}/pages.parquet"), PAGE_RENDERED, "rendered")
    rows = extract.table_rows(ex, "rendered")
    return rows.select(
        "page_id",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.size("headers").cast("bigint").alias("n_headers"),
        F.array_join("headers", "|").alias("header_text"),
        F.size("row").cast("bigint").alias("n_cells"),
        F.array_join("row", "|").alias("row_text"),
        "malformed",
    )


@register(
    "page_link_pairs",
    r"""
WITH l AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS t
  FROM pages)
SELECT page_id, CAST(len(h) AS BIGINT) AS n_links,
       array_to_string(list_transform(range(1, len(h) + 1), lambda i: h[i] || '=' || t[i]), ';') AS links_text
FROM l
""",
)
def q_page_link_pairs(spark: SparkSession, d: str) -> DataFrame:
    lk = extract.links(files.read_pages(spark, f"{d}/pages.parquet"))
    return lk.select(
        "page_id",
        F.size("links").cast("bigint").alias("n_links"),
        F.array_join(F.transform("links", lambda x: F.concat(x["href"], F.lit("="), x["text"])), ";").alias("links_text"),
    )


# Array functions ----------------------------------------------------------------------------
from filingflow.functions import arrays as _A  # noqa: E402
from filingflow.operators.common import explode_positions  # noqa: E402


def _conv(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "conversations").select("conv_id", "turn", "text")


@register(
    "chunk_cells",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS cells, turn % 4 + 2 AS n FROM conversations),
c AS (SELECT conv_id, turn, n, cells, unnest(range(0, CAST(ceil(len(cells) / n) AS BIGINT))) AS i FROM w),
s AS (SELECT conv_id, turn, i, n, list_slice(cells, i * n + 1, i * n + n) AS chunk FROM c)
SELECT conv_id, turn, i AS chunk_no, array_to_string(chunk, '|') AS chunk_text,
       CAST(n - len(chunk) AS BIGINT) AS n_null, CAST(n AS BIGINT) AS chunk_size
FROM s
""",
)
def q_chunk_cells(spark: SparkSession, d: str) -> DataFrame:
    # The cell list is its own column: a lambda over an inline split would
    # split the text again for every chunk.
    c = _conv(spark, d).select("conv_id", "turn", F.split("text", " ").alias("cells"))
    c = c.select("conv_id", "turn", _A.chunk_cells("cells", (F.col("turn") % 4 + 2).cast("int")).alias("rows"))
    c = explode_positions(c, F.col("rows"), "chunk_no", "chunk", ["conv_id", "turn"])
    return c.select(
        "conv_id",
        "turn",
        F.col("chunk_no").cast("bigint").alias("chunk_no"),
        F.array_join(F.filter("chunk", lambda x: x.isNotNull()), "|").alias("chunk_text"),
        F.size(F.filter("chunk", lambda x: x.isNull())).cast("bigint").alias("n_null"),
        F.size("chunk").cast("bigint").alias("chunk_size"),
    )


@register(
    "pad_row",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS cells FROM conversations)
SELECT conv_id, turn,
       CAST(len(list_concat(cells, list_transform(range(greatest(12 - len(cells), 0)), lambda x: ''))) AS BIGINT) AS padded_size,
       array_to_string(list_concat(cells, list_transform(range(greatest(12 - len(cells), 0)), lambda x: '')), '|') AS padded_text,
       len(cells) > 12 AS malformed
FROM w
""",
)
def q_pad_row(spark: SparkSession, d: str) -> DataFrame:
    c = _conv(spark, d).select("conv_id", "turn", F.split("text", " ").alias("cells"))
    padded = _A.pad_row("cells", 12)
    return c.select(
        "conv_id",
        "turn",
        F.size(padded).cast("bigint").alias("padded_size"),
        F.array_join(padded, "|").alias("padded_text"),
        _A.row_too_long("cells", 12).alias("malformed"),
    )


@register(
    "dedupe_row",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS cells FROM conversations),
u AS (SELECT conv_id, turn, list_filter(cells, lambda x, i: list_position(cells, x) = i) AS d FROM w)
SELECT conv_id, turn, CAST(len(d) AS BIGINT) AS n_distinct, array_to_string(d, '|') AS row_text FROM u
""",
)
def q_dedupe_row(spark: SparkSession, d: str) -> DataFrame:
    dd = _A.dedupe_row(F.split("text", " "))
    return _conv(spark, d).select(
        "conv_id", "turn", F.size(dd).cast("bigint").alias("n_distinct"), F.array_join(dd, "|").alias("row_text")
    )


@register(
    "drop_empty_cells",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(regexp_replace(text, '[.,]', ' ', 'g'), ' ') AS cells FROM conversations),
u AS (SELECT conv_id, turn, cells, list_filter(cells, lambda x: x <> '') AS kept FROM w)
SELECT conv_id, turn, CAST(len(cells) AS BIGINT) AS n_cells, CAST(len(kept) AS BIGINT) AS n_kept,
       array_to_string(kept, '|') AS row_text
FROM u
""",
)
def q_drop_empty_cells(spark: SparkSession, d: str) -> DataFrame:
    cells = F.split(F.regexp_replace("text", "[.,]", " "), " ")
    kept = _A.drop_empty(cells)
    return _conv(spark, d).select(
        "conv_id",
        "turn",
        F.size(cells).cast("bigint").alias("n_cells"),
        F.size(kept).cast("bigint").alias("n_kept"),
        F.array_join(kept, "|").alias("row_text"),
    )


@register(
    "header_half",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS cells FROM conversations),
h AS (SELECT conv_id, turn, list_slice(cells, len(cells) // 2 + 1, len(cells)) AS half FROM w)
SELECT conv_id, turn, CAST(len(half) AS BIGINT) AS n_half, array_to_string(half, '|') AS half_text FROM h
""",
)
def q_header_half(spark: SparkSession, d: str) -> DataFrame:
    half = _A.second_half(F.split("text", " "))
    return _conv(spark, d).select(
        "conv_id", "turn", F.size(half).cast("bigint").alias("n_half"), F.array_join(half, "|").alias("half_text")
    )


@register(
    "row_pairs",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS cells FROM conversations),
hr AS (SELECT conv_id, turn, list_slice(cells, 1, 3) AS h,
              CASE WHEN len(cells) > 3 THEN list_slice(cells, 4, len(cells)) ELSE [] END AS r FROM w)
SELECT conv_id, turn,
       array_to_string(list_transform(range(1, len(h) + 1), lambda i: h[i] || '=' || coalesce(r[i], '~')), ';') AS pairs_text
FROM hr
""",
)
def q_row_pairs(spark: SparkSession, d: str) -> DataFrame:
    cells = F.split("text", " ")
    h = F.slice(cells, 1, 3)
    r = F.slice(cells, 4, F.greatest(F.size(cells) - 3, F.lit(0)))
    pairs = _A.row_to_pairs(h, r)
    text = F.array_join(
        F.transform(pairs, lambda p: F.concat(p["name"], F.lit("="), F.coalesce(p["value"], F.lit("~")))), ";"
    )
    return _conv(spark, d).select("conv_id", "turn", text.alias("pairs_text"))


@register(
    "aligned_truncate",
    r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS a, string_split(text, '.') AS b,
                  string_split(text, chr(10)) AS c FROM conversations)
SELECT conv_id, turn, CAST(least(len(a), len(b), len(c)) AS BIGINT) AS n_aligned,
       array_to_string(list_transform(range(1, least(len(a), len(b), len(c)) + 1),
                                      lambda i: a[i] || '#' || b[i] || '#' || c[i]), ';') AS triples_text
FROM w
""",
)
def q_aligned_truncate(spark: SparkSession, d: str) -> DataFrame:
    z = _A.align_truncate(F.split("text", " "), F.split("text", "[.]"), F.split("text", "\n"))
    c = _conv(spark, d).select("conv_id", "turn", z.alias("triples"))
    text = F.array_join(F.transform("triples", lambda t: F.concat_ws("#", t["0"], t["1"], t["2"])), ";")
    return c.select("conv_id", "turn", F.size("triples").cast("bigint").alias("n_aligned"), text.alias("triples_text"))


# Scalars, appends, drops -----------------------------------------------------------------------
@register(
    "scalar_bundle",
    r"""
SELECT o_orderkey,
       regexp_replace('./crawl_table/K' || CAST(o_custkey AS VARCHAR) || '/r' || CAST(o_orderkey AS VARCHAR),
                      '^\./crawl_table', '') AS rebased,
       CAST(length(o_orderpriority) AS BIGINT) AS priority_len,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS log_ts,
       o_orderkey % 9 > o_orderkey % 7 AS complete,
       'C' || CAST(o_orderkey // 2 AS VARCHAR) AS checkpoint_symbol
FROM orders
""",
)
def q_scalar_bundle(spark: SparkSession, d: str) -> DataFrame:
    from filingflow.functions import text as T

    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    path = F.concat(F.lit("./crawl_table/K"), F.col("o_custkey").cast("string"), F.lit("/r"), F.col("o_orderkey").cast("string"))
    line = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(",000 - INFO - x"))
    o = o.withColumn("_cur", F.col("o_orderkey") % 9).withColumn("_pages", F.col("o_orderkey") % 7)
    return o.select(
        "o_orderkey",
        T.rebase_path(path).alias("rebased"),
        T.text_length("o_orderpriority").alias("priority_len"),
        T.log_time(line).alias("log_ts"),
        resume.is_complete("_cur", "_pages").alias("complete"),
        T.symbol_from_file(
            F.concat(F.lit("checkpoint_C"), F.expr("o_orderkey div 2").cast("string"), F.lit(".json"))
        ).alias("checkpoint_symbol"),
    )


@register(
    "latest_log_file",
    "WITH " + LOG_CTE + "\nSELECT max(file) AS file FROM log",
)
def q_latest_log_file(spark: SparkSession, d: str) -> DataFrame:
    return audit.latest_log(derive.crawl_log(spark, d)).select("file").distinct()


@register(
    "first_row",
    """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1
""",
)
def q_first_row(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return audit.first_row(o, ["o_orderdate", "o_orderkey"])


@register(
    "append_results",
    """
SELECT o_orderkey, o_orderstatus, NULL::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_orderstatus, NULL::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'P'
""",
)
def q_append_results(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    f = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    oo = o.where(F.col("o_orderstatus") == "O")
    p = o.where(F.col("o_orderstatus") == "P").select("o_orderstatus", "o_orderkey")
    return listing.append_results(f, oo, p).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register(
    "drop_symbols",
    AUDIT_WITH + "\nSELECT symbol, STT FROM idx WHERE symbol NOT IN (SELECT symbol FROM classified WHERE status = 'error')",
)
def q_drop_symbols(spark: SparkSession, d: str) -> DataFrame:
    classified = _classified(spark, d)
    errors = classified.where(F.col("status") == "error")
    return resume.drop_symbols(derive.report_index(spark, d), errors)


@register(
    "existing_rows",
    r"""
SELECT o_orderkey, o_orderstatus, n_items
FROM orders JOIN (SELECT l_orderkey, count(*) AS n_items FROM lineitem GROUP BY l_orderkey) f
  ON regexp_replace('./crawl_table/O' || CAST(o_orderkey AS VARCHAR), '^\./crawl_table', '') = '/O' || CAST(l_orderkey AS VARCHAR)
WHERE o_orderstatus <> 'P'
""",
)
def q_existing_rows(spark: SparkSession, d: str) -> DataFrame:
    # Pending orders have no saved path; orders without line items have no file.
    index = read_table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("./crawl_table/O"), F.col("o_orderkey").cast("string"))).alias("Saving_path"),
    )
    held = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"))
    held = held.select(F.concat(F.lit("/O"), F.col("l_orderkey").cast("string")).alias("report_dir"), "n_items")
    return quality.existing_index_rows(index, held).select("o_orderkey", "o_orderstatus", "n_items")


# Re-scrape plan (M4) ---------------------------------------------------------------------------
from filingflow.plans import flows  # noqa: E402

RESCRAPE_WITH = AUDIT_WITH + r""",
syms AS (SELECT DISTINCT 'C' || CAST(o_orderkey // 2 AS VARCHAR) AS symbol FROM orders),
open_syms AS (SELECT symbol FROM syms WHERE symbol NOT IN (SELECT symbol FROM classified WHERE status = 'clean')),
cps AS (
  SELECT 'C' || CAST(k AS VARCHAR) AS symbol, k % 4 + 1 AS current_page, k % 3 AS last_row_index
  FROM (SELECT o_orderkey // 2 AS k, bool_or(o_orderstatus <> 'P') AS any_done FROM orders GROUP BY 1) o
  WHERE any_done)
"""


@register(
    "rescrape_plan",
    RESCRAPE_WITH
    + """
SELECT symbol, current_page, last_row_index FROM cps WHERE symbol NOT IN (SELECT symbol FROM open_syms)
UNION ALL
SELECT symbol, 1 AS current_page, 0 AS last_row_index FROM open_syms
""",
)
def q_rescrape_plan(spark: SparkSession, d: str) -> DataFrame:
    _, cp = flows.rescrape_plan(
        derive.crawl_log(spark, d), derive.report_index(spark, d), derive.symbol_list(spark, d),
        derive.symbol_checkpoints(spark, d), index_files=derive.index_files(spark, d),
    )
    return cp


@register(
    "rescrape_purge",
    RESCRAPE_WITH + "\nSELECT symbol, STT FROM idx WHERE symbol NOT IN (SELECT symbol FROM open_syms)",
)
def q_rescrape_purge(spark: SparkSession, d: str) -> DataFrame:
    open_syms, _ = flows.rescrape_plan(
        derive.crawl_log(spark, d), derive.report_index(spark, d), derive.symbol_list(spark, d),
        derive.symbol_checkpoints(spark, d), index_files=derive.index_files(spark, d),
    )
    return flows.purge_captured(derive.report_index(spark, d), open_syms)


# Sources and sinks through the shared work folder ------------------------------------------------
from filingflow.sources import buckets, search  # noqa: E402


@register(
    "purge_stored",
    RESCRAPE_WITH + "\nSELECT symbol, STT FROM idx WHERE symbol NOT IN (SELECT symbol FROM open_syms)",
)
def q_purge_stored(spark: SparkSession, d: str) -> DataFrame:
    """The captured rows as a stored table, from which the symbols to capture again are removed."""
    path = f"{new_work_dir(spark, 'captured')}/rows"
    buckets.write_captured(derive.report_index(spark, d).select("symbol", "STT"), path, buckets=32)
    open_syms, _ = flows.rescrape_plan(
        derive.crawl_log(spark, d), derive.report_index(spark, d), derive.symbol_list(spark, d),
        derive.symbol_checkpoints(spark, d), index_files=derive.index_files(spark, d),
    )
    buckets.purge_symbols(spark, path, open_syms, buckets=32)
    return buckets.read_captured(spark, path, buckets=32)


def _search_table(spark: SparkSession, d: str) -> str:
    path = new_work_dir(spark, "search")
    search.write_search_table(derive.order_submissions(spark, d), path, buckets=16)
    return path


@register("stored_search", ORACLE["search_listing"])
def q_stored_search(spark: SparkSession, d: str) -> DataFrame:
    """The substring search on the stored table: symbols from the grams, their buckets from the symbols."""
    return search.search_stored(spark, _search_table(spark, d), symbol_contains="12", date_from="1998-01-01", date_to="1998-12-31", buckets=16)


@register("stored_search_symbol", ORACLE["search_symbol"])
def q_stored_search_symbol(spark: SparkSession, d: str) -> DataFrame:
    return search.search_stored(spark, _search_table(spark, d), symbol="K100", buckets=16)


@register(
    "files_roundtrip_symbols",
    "SELECT DISTINCT 'C' || CAST(o_orderkey // 2 AS VARCHAR) AS symbol FROM orders",
)
def q_files_roundtrip_symbols(spark: SparkSession, d: str) -> DataFrame:
    base = new_work_dir(spark, "symbols")
    # S2 writes the list; a market listing names the column "ticker", which
    # S1 accepts as well.
    files.write_symbols(derive.symbol_list(spark, d), f"{base}/symbols")
    derive.symbol_list(spark, d).withColumnRenamed("symbol", "ticker").write.option("header", True).csv(
        f"{base}/listing"
    )
    a = files.read_symbols(spark, f"{base}/symbols")
    b = files.read_symbols(spark, f"{base}/listing")
    return a.join(b, "symbol", "inner")


@register(
    "files_roundtrip_checkpoints",
    EVENTS_WITH
    + r""",
err AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events GROUP BY user_id
  HAVING count(*) FILTER (WHERE event_type = 'error') > count(*) FILTER (WHERE event_type = 'purchase')),
latest AS (
  SELECT symbol, current_page, last_row_index FROM cp WHERE symbol NOT IN (SELECT symbol FROM err)
  UNION ALL SELECT symbol, 1, 0 FROM err),
users AS (SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events)
SELECT u.symbol, coalesce(l.current_page, 1) AS current_page, coalesce(l.last_row_index, 0) AS last_row_index
FROM users u LEFT JOIN latest l ON u.symbol = l.symbol
""",
)
def q_files_roundtrip_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    path = new_work_dir(spark, "checkpoints")
    cp = derive.event_checkpoints(spark, d)
    files.write_checkpoints(cp, path, version=1)
    reset = resume.reset_checkpoints(cp, derive.event_error_symbols(spark, d))
    files.write_checkpoints(reset.join(derive.event_error_symbols(spark, d), "symbol", "left_semi"), path, version=2)
    users = read_table(spark, d, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")
    )
    return files.read_checkpoints(spark, path, symbols=users)


@register(
    "files_roundtrip_index",
    r"""
SELECT 'C' || CAST(l_orderkey // 2 AS VARCHAR) AS symbol, CAST(l_linenumber AS BIGINT) AS STT,
       './crawl_table/C' || CAST(l_orderkey // 2 AS VARCHAR) || '/r' || CAST(l_linenumber AS VARCHAR) AS Saving_path,
       'success' AS status
FROM lineitem WHERE l_returnflag <> 'R'
""",
)
def q_files_roundtrip_index(spark: SparkSession, d: str) -> DataFrame:
    path = new_work_dir(spark, "index")
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    sym = F.concat(F.lit("C"), F.expr("l_orderkey div 2").cast("string"))
    rows = li.select(
        sym.alias("symbol"),
        F.col("l_linenumber").cast("bigint").alias("STT"),
        F.concat(F.lit("./crawl_table/"), sym, F.lit("/r"), F.col("l_linenumber").cast("string")).alias("Saving_path"),
        F.when(F.col("l_returnflag") == "R", "warning").otherwise("success").alias("status"),
    )
    files.write_report_index(rows, path)
    return files.read_report_index_table(spark, path, "success").select("symbol", "STT", "Saving_path", "status")


@register(
    "files_roundtrip_logs",
    "WITH " + LOG_CTE + rf"""
SELECT value,
       CAST(substr(value, 1, 19) AS TIMESTAMP) + to_milliseconds(CAST(substr(value, 21, 3) AS BIGINT)) AS ts,
       coalesce(nullif(regexp_extract(value, 'INFO - Scraping Successfully ({W}+):', 1), ''),
                nullif(regexp_extract(value, 'WARNING - Not enough reports ({W}+):', 1), '')) AS symbol
FROM log
""",
)
def q_files_roundtrip_logs(spark: SparkSession, d: str) -> DataFrame:
    path = new_work_dir(spark, "logs")
    files.write_log_lines(derive.crawl_log(spark, d), path)
    parsed = audit.parse_log(files.read_logs(spark, path, glob="*.txt"))
    return parsed.select("value", "ts", "symbol")


@register(
    "files_roundtrip_statements",
    r"""
SELECT '/r' || CAST(l_orderkey AS VARCHAR) AS report_dir,
       CASE l_orderkey % 4 WHEN 0 THEN 'BCDKT' WHEN 1 THEN 'KQKD' WHEN 2 THEN 'LCTT_TT' ELSE 'LCTT_GT' END AS statement,
       'C' || CAST(l_orderkey // 2 AS VARCHAR) AS symbol, CAST(l_linenumber AS BIGINT) AS row_idx,
       CAST(c AS BIGINT) AS col_idx, CASE c WHEN 0 THEN 'returnflag' ELSE 'linestatus' END AS col_name,
       CASE c WHEN 0 THEN l_returnflag ELSE l_linestatus END AS value, false AS unreadable
FROM lineitem, (VALUES (0), (1)) v(c)
""",
)
def q_files_roundtrip_statements(spark: SparkSession, d: str) -> DataFrame:
    path = new_work_dir(spark, "statements")
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    cells = li.select(
        F.concat(F.lit("C"), F.expr("l_orderkey div 2").cast("string")).alias("symbol"),
        F.concat(F.lit("/r"), F.col("l_orderkey").cast("string")).alias("report_dir"),
        F.element_at(
            F.array(*[F.lit(n) for n in files.STATEMENT_FILES]), (F.col("l_orderkey") % 4 + 1).cast("int")
        ).alias("statement"),
        F.col("l_linenumber").cast("bigint").alias("row_idx"),
        F.inline(F.array(
            F.struct(F.lit(0).cast("bigint").alias("col_idx"), F.lit("returnflag").alias("col_name"), F.col("l_returnflag").alias("value")),
            F.struct(F.lit(1).cast("bigint").alias("col_idx"), F.lit("linestatus").alias("col_name"), F.col("l_linestatus").alias("value")),
        )),
        F.lit(False).alias("unreadable"),
    )
    first = cells.where(F.expr("CAST(substring(report_dir, 3) AS BIGINT) % 2 = 0"))
    files.write_statements(first, path)
    # Second pass: every statement again; those already held are skipped.
    files.write_statements(cells, path, existing=files.read_statement_table(spark, path))
    return files.read_statement_table(spark, path)


@register(
    "files_roundtrip_truth",
    CROSS_WITH + "\nSELECT * FROM merged",
)
def q_files_roundtrip_truth(spark: SparkSession, d: str) -> DataFrame:
    path = new_work_dir(spark, "truth")
    derive.truth_table(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return _merged(spark, d, files.read_truth(spark, path))


def _page_tree(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Each page as a file, up to seven folders deep; names with a leading underscore,
    files without content and files of another kind occur."""
    root = new_work_dir(spark, "tree")
    p = files.read_pages(spark, f"{d}/pages.parquet")
    path = F.concat(
        F.lit("P"), (F.col("page_id") % 7).cast("string"), F.lit("/"),
        F.expr("repeat('_d/', CAST(page_id % 6 AS INT))"), F.col("page_id").cast("string"), F.lit(".csv"),
    )
    content = F.when(F.col("page_id") % 5 != 0, F.coalesce("html", F.lit(""))).otherwise(F.lit(""))
    other = F.struct(F.concat(path, F.lit(".txt")).alias("path"), F.col("url").alias("content"))
    both = F.array(F.struct(path.alias("path"), content.alias("content")), other)
    files.write_named_files(p.select(F.inline(both)), root)
    return root, files.file_catalog(spark, root)


TREE_WITH = """
WITH tree AS (
  SELECT 'P' || CAST(page_id % 7 AS VARCHAR) || '/' || repeat('_d/', page_id % 6) || CAST(page_id AS VARCHAR) || '.csv' AS path,
         CASE WHEN page_id % 5 = 0 THEN 0 ELSE CAST(coalesce(strlen(html), 0) AS BIGINT) END AS bytes
  FROM pages)
"""


@register("file_catalog", TREE_WITH + "SELECT path, bytes FROM tree")
def q_file_catalog(spark: SparkSession, d: str) -> DataFrame:
    root, found = _page_tree(spark, d)
    below = F.element_at(F.split("path", root.rsplit("/", 1)[-1] + "/"), -1)
    return found.select(below.alias("path"), "bytes")


@register("file_count", TREE_WITH + "SELECT count(*) AS n_files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS total_bytes FROM tree")
def q_file_count(spark: SparkSession, d: str) -> DataFrame:
    return files.count_files(_page_tree(spark, d)[1])


# The reference's own files, written as pandas writes them and read with the readers for them ----
@register(
    "reference_index",
    r"""
SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(event_id AS VARCHAR) AS stt,
       nullif(props, '') AS report_name, event_type || ', "' || event_type || '"' || chr(10) || 'x' AS summary,
       './crawl_table/U' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) AS saving_path
FROM events
""",
)
def q_reference_index(spark: SparkSession, d: str) -> DataFrame:
    root = new_work_dir(spark, "crawl-index")
    e = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "props")
    sym = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    rows = e.select(
        F.concat(sym, F.lit("/success.csv")).alias("path"),
        F.col("event_id").alias("STT"),
        F.col("props").alias("Tên báo cáo"),
        F.concat(F.col("event_type"), F.lit(', "'), F.col("event_type"), F.lit('"\nx')).alias("Trích yếu"),
        F.concat(F.lit(T.CRAWL_ROOT + "/"), sym, F.lit("/"), F.col("event_id").cast("string")).alias("Saving_path"),
    )
    columns = ["Saving_path", "STT", "Tên báo cáo", "Trích yếu"]
    files.write_named_files(files.csv_files(rows, "path", columns, ["STT"]), root)
    idx = files.read_report_index(spark, root)
    return idx.select(
        "symbol", F.col("STT").alias("stt"), F.col("Tên báo cáo").alias("report_name"),
        F.col("Trích yếu").alias("summary"), F.col("Saving_path").alias("saving_path"),
    )


# Users' index files by user_id % 6: 0 as written, 1 a header only, 2 without STT, 3 no
# content, 4 a row longer than its header, 5 STT that may repeat; no file at all for user_id % 11 = 0.
ODD_INDEX_WITH = r"""
WITH u AS (
  SELECT user_id, 'U' || CAST(user_id AS VARCHAR) AS symbol, user_id % 6 AS kind, count(*) AS n, count(DISTINCT event_id % 3) AS n3
  FROM events GROUP BY user_id),
inv AS (
  SELECT symbol, kind NOT IN (3, 4) AS readable, kind NOT IN (2, 3, 4) AS has_stt,
         CASE WHEN kind IN (3, 4) THEN NULL WHEN kind = 1 THEN 0 ELSE n END AS n_rows
  FROM u WHERE user_id % 11 <> 0)
"""


def _odd_index_tree(spark: SparkSession, d: str) -> str:
    root = new_work_dir(spark, "crawl-odd-index")
    e = read_table(spark, d, "events").select("event_id", "user_id").where(F.col("user_id") % 11 != 0)
    kind = F.col("user_id") % 6
    rows = e.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("/success.csv")).alias("path"),
        F.when(kind == 5, F.col("event_id") % 3).otherwise(F.col("event_id")).alias("STT"),
        F.col("event_id").alias("Saving_path"),
    )
    texts = files.csv_files(rows, "path", ["STT", "Saving_path"], ["Saving_path"])
    kind = F.regexp_extract("path", "U([0-9]+)/", 1).cast("bigint") % 6
    content = (
        F.when(kind == 1, F.lit("STT,Saving_path\n"))
        .when(kind == 2, F.regexp_replace("content", "^STT", "No"))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat("content", F.lit("1,2,3\n")))
        .otherwise(F.col("content"))
    )
    files.write_named_files(texts.select("path", content.alias("content")), root)
    return root


@register("index_inventory", ODD_INDEX_WITH + "SELECT symbol, readable, has_stt, n_rows FROM inv")
def q_index_inventory(spark: SparkSession, d: str) -> DataFrame:
    return files.index_inventory(spark, _odd_index_tree(spark, d)).select("symbol", "readable", "has_stt", "n_rows")


@register(
    "reference_audit",
    ODD_INDEX_WITH
    + """
SELECT u.symbol, CASE WHEN reason IS NULL THEN 'clean' ELSE 'error' END AS status, reason FROM (
  SELECT u.symbol, CASE WHEN u.user_id % 7 = 0 THEN 'warning_only'
                        WHEN NOT coalesce(i.has_stt, false) THEN 'no_index'
                        WHEN u.kind = 5 AND u.n3 <> u.n THEN 'duplicate_stt' END AS reason
  FROM u LEFT JOIN inv i ON u.symbol = i.symbol) u
""",
)
def q_reference_audit(spark: SparkSession, d: str) -> DataFrame:
    """Logs and index files, some of them unusable, classified as the reference does."""
    root = _odd_index_tree(spark, d)
    users = read_table(spark, d, "events").select("user_id").distinct()
    line = F.when(F.col("user_id") % 7 == 0, F.lit("WARNING - Not enough reports U")).otherwise(F.lit("INFO - Scraping Successfully U"))
    logs = users.select(F.concat(F.lit("2024-01-01 00:00:00,000 - "), line, F.col("user_id").cast("string"), F.lit(": 1/1")).alias("value"))
    return audit.audit_logs(logs, files.read_report_index(spark, root), index_files=files.index_symbols(spark, root))


@register(
    "reference_checkpoints",
    EVENTS_WITH
    + """,
users AS (SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS symbol FROM events)
SELECT u.symbol, coalesce(c.current_page, 1) AS current_page, coalesce(c.last_row_index, 0) AS last_row_index
FROM users u LEFT JOIN cp c ON u.symbol = c.symbol
""",
)
def q_reference_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    root = new_work_dir(spark, "crawl-checkpoints")
    cp = derive.event_checkpoints(spark, d)
    texts = cp.select(
        F.concat(F.lit("checkpoint_"), F.col("symbol"), F.lit(".json")).alias("path"),
        F.to_json(F.struct("current_page", "last_row_index")).alias("content"),
    )
    files.write_named_files(texts, root)
    users = read_table(spark, d, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"))
    return files.read_checkpoint_files(spark, root, symbols=users)


TURN_COLUMNS = ["turn", "role", "text"]
TURNS_WITH = """
WITH rows AS (
  SELECT 'V' || CAST(conv_id AS VARCHAR) AS symbol,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
         CAST(turn AS VARCHAR) AS c0, coalesce(role, '') AS c1, coalesce(text, '') AS c2
  FROM conversations WHERE conv_id IS NOT NULL),
named AS (
  SELECT symbol, i, j, CASE j WHEN 0 THEN 'turn' WHEN 1 THEN 'role' ELSE 'text' END AS name,
         CASE j WHEN 0 THEN c0 WHEN 1 THEN c1 ELSE c2 END AS value
  FROM rows, (VALUES (0), (1), (2)) v(j)),
heads AS (SELECT DISTINCT symbol, j, name FROM named)
"""


def _turn_files(spark: SparkSession, d: str, statement: str) -> str:
    """A conversation is a statement file, a turn a row (commas, quotes and line breaks in its text)."""
    root = new_work_dir(spark, "crawl-statements")
    c = read_table(spark, d, "conversations").select("conv_id", *TURN_COLUMNS).where(F.col("conv_id").isNotNull())
    rows = c.withColumn("path", F.concat(F.lit("V"), F.col("conv_id").cast("string"), F.lit(f"/_r 1/{statement}.csv")))
    files.write_named_files(files.csv_files(rows, "path", TURN_COLUMNS, TURN_COLUMNS), root)
    return root


def _turn_cells(cells: DataFrame) -> DataFrame:
    report = F.element_at(F.split("report_dir", "/"), -1)
    return cells.withColumn("report_dir", report)


@register(
    "reference_statements",
    TURNS_WITH
    + """
SELECT symbol, '_r 1' AS report_dir, 'KQKD' AS statement, CAST(i AS BIGINT) AS row_idx, CAST(j AS BIGINT) AS col_idx,
       name AS col_name, value, false AS unreadable FROM named
UNION ALL
SELECT symbol, '_r 1', 'KQKD', -1, CAST(j AS BIGINT), name, NULL, false FROM heads
""",
)
def q_reference_statements(spark: SparkSession, d: str) -> DataFrame:
    return _turn_cells(files.read_statements(spark, _turn_files(spark, d, "KQKD")))


@register(
    "reference_statements_headerless",
    TURNS_WITH
    + """
SELECT symbol, '_r 1' AS report_dir, 'KQKT' AS statement, CAST(i + 1 AS BIGINT) AS row_idx, CAST(j AS BIGINT) AS col_idx,
       CAST(j AS VARCHAR) AS col_name, value, false AS unreadable FROM named
UNION ALL
SELECT symbol, '_r 1', 'KQKT', 0, CAST(j AS BIGINT), CAST(j AS VARCHAR), name, false FROM heads
""",
)
def q_reference_statements_headerless(spark: SparkSession, d: str) -> DataFrame:
    root = _turn_files(spark, d, "KQKT")
    return _turn_cells(files.read_statements(spark, root, names=files.LEGACY_STATEMENT_FILES, header=False))


# Conversations' statement files by conv_id % 7: 3 no content, 4 a row longer than the first.
ODD_STATEMENTS_WITH = """
WITH conv AS (
  SELECT conv_id, conv_id % 7 IN (3, 4) AS unreadable, bool_or(contains(coalesce(role, ''), 'user')) AS marked, count(*) AS n
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id)
"""


def _odd_statement_tree(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    root = new_work_dir(spark, "crawl-contamination")
    c = read_table(spark, d, "conversations").select("conv_id", "role", "turn").where(F.col("conv_id").isNotNull())
    rows = c.withColumn("path", F.concat(F.lit("V"), F.col("conv_id").cast("string"), F.lit("/r/KQKD.csv")))
    texts = files.csv_files(rows, "path", ["role", "turn"], ["turn", "role"])
    kind = F.regexp_extract("path", "V(-?[0-9]+)/", 1).cast("bigint") % 7
    content = F.when(kind == 3, F.lit("")).when(kind == 4, F.concat("content", F.lit("a,b,c\n"))).otherwise(F.col("content"))
    files.write_named_files(texts.select("path", content.alias("content")), root)
    return root, c.select("conv_id").distinct()


@register(
    "reference_unreadable",
    ODD_STATEMENTS_WITH
    + """
SELECT 'V' || CAST(conv_id AS VARCHAR) AS symbol, 'KQKD' AS statement, unreadable, CASE WHEN unreadable THEN 0 ELSE 2 * n END AS n_cells FROM conv
""",
)
def q_reference_unreadable(spark: SparkSession, d: str) -> DataFrame:
    """Every statement file is in the cell table, also those that a CSV read refuses."""
    cells = files.read_statements(spark, _odd_statement_tree(spark, d)[0])
    return cells.groupBy("symbol", "statement").agg(
        F.bool_or("unreadable").alias("unreadable"), F.count_if(F.col("row_idx") >= 0).alias("n_cells")
    )


@register(
    "reference_contamination",
    ODD_STATEMENTS_WITH
    + """,
idx AS (  -- rows with a saved path whose file exists: some paths are listed twice
  SELECT c.* FROM conv c UNION ALL SELECT c.* FROM conv c WHERE conv_id % 5 = 0)
SELECT count(*) AS total_files, count(*) FILTER (WHERE marked AND NOT unreadable) AS error_files,
       count(*) FILTER (WHERE unreadable) AS unreadable_files,
       CASE WHEN count(*) > 0 THEN 100.0 * CAST(count(*) FILTER (WHERE marked AND NOT unreadable) AS DOUBLE)
            / CAST(count(*) AS DOUBLE) ELSE 0.0 END AS error_rate
FROM idx
""",
)
def q_reference_contamination(spark: SparkSession, d: str) -> DataFrame:
    """Index rows that repeat a path, have none, or name an absent file; files without content or unreadable."""
    root, convs = _odd_statement_tree(spark, d)
    symbol, k = F.concat(F.lit("V"), F.col("conv_id").cast("string")), F.col("conv_id")
    path = F.concat(F.lit(T.CRAWL_ROOT + "/"), symbol, F.lit("/r"))
    none = F.lit(None).cast("string")
    paths = F.array(path, F.when(k % 5 == 0, path), F.when(k % 8 == 0, F.concat(path, F.lit("-absent"))), none)
    index = convs.select(symbol.alias("symbol"), F.explode(paths).alias("Saving_path"))
    cells = files.read_statements(spark, root, header=False)
    return quality.contamination_rate(index, cells, statement="KQKD", marker="user", new_root=root)


# Streams ----------------------------------------------------------------------------------------
from filingflow.streaming import status as streams  # noqa: E402


@register("stream_status", "WITH " + LOG_CTE + "," + SETS_CTE + "\nSELECT symbol, in_success, in_warning FROM sets")
def q_stream_status(spark: SparkSession, d: str) -> DataFrame:
    base = new_work_dir(spark, "stream-status")
    src, out, ck = f"{base}/logs", f"{base}/out", f"{base}/checkpoint"
    derive.crawl_log(spark, d).select("value").repartition(4).write.text(src)
    q = streams.run_status(spark, src, out, ck, max_files_per_trigger=2)
    q.awaitTermination()
    return streams.read_status(spark, out)


@register(
    "stream_first_submission",
    r"""
SELECT symbol, submitted_at, l_orderkey, l_linenumber, l_returnflag FROM (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%d/%m/%Y %H:%M:%S') AS submitted_at,
         l_orderkey, l_linenumber, l_returnflag,
         row_number() OVER (PARTITION BY l_suppkey, strftime(l_shipdate, '%d/%m/%Y %H:%M:%S')
                            ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END,
                                     l_orderkey, l_linenumber) AS rn
  FROM lineitem) r WHERE rn = 1
""",
)
def q_stream_first_submission(spark: SparkSession, d: str) -> DataFrame:
    base = new_work_dir(spark, "stream-intake")
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    subs = derive.supplier_submissions(spark, d)
    # Three arrival waves (return flag R, then N, then A); after each wave the
    # intake runs incrementally from its checkpoint.  A key admitted in an
    # earlier wave keeps its row even when a later wave has a smaller
    # (orderkey, linenumber) for it.
    for flag in ("R", "N", "A"):
        subs.where(F.col("l_returnflag") == flag).write.mode("append").parquet(src)
        q = streams.run_first_submission(
            spark, src, subs.schema, out, ck, order=("l_orderkey", "l_linenumber"),
            max_files_per_trigger=None,
        )
        q.awaitTermination()
    return streams.read_admitted(spark, out).select("symbol", "submitted_at", "l_orderkey", "l_linenumber", "l_returnflag")


# SQL forms of the two HTML-table queries: the article split at each <p>
# (a <p> start closes the open paragraph, and the unclosed <b> with it).
ARTICLE_ROWS_CTE = rf"""
art AS (
  SELECT page_id,
         substr(html, strpos(html, '<article>'), strpos(html, '</article>') - strpos(html, '<article>')) AS a,
         len(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) AS n_li
  FROM pages),
parts AS (SELECT page_id, n_li, string_split(a, '<p>') AS ps FROM art),
prow AS (SELECT page_id, n_li, ps, unnest(range(len(ps) - 1)) AS row_no FROM parts),
chunk AS (
  SELECT page_id, n_li, row_no,
         CASE WHEN starts_with(ps[row_no + 2], '<b>')
              THEN array_to_string(list_transform(string_split_regex(substr(ps[row_no + 2], 4), '<[^>]*>'),
                                                  lambda x: trim({_decode('x')}, ' ' || chr(9) || chr(10) || chr(13))), '')
              ELSE '' END AS cell
  FROM prow)"""
ORACLE["page_table"] = "WITH " + ARTICLE_ROWS_CTE + "," + FIRM_CTE + """
SELECT c.page_id, row_no, coalesce(f.title, '') AS header_text, CAST(1 AS BIGINT) AS n_cells, cell AS row_text,
       false AS malformed
FROM chunk c JOIN firm f ON c.page_id = f.page_id
"""
ORACLE["page_hidden_spans"] = ORACLE["page_table"]
ORACLE["page_rendered"] = "WITH " + ARTICLE_ROWS_CTE + "," + LINKS_CTE + """
SELECT c.page_id, row_no, CAST(n_li - n_li // 2 AS BIGINT) AS n_headers,
       array_to_string(list_slice(lk.cells, n_li // 2 + 1, n_li), '|') AS header_text,
       cell || repeat('|', greatest(CASE WHEN cell = '' THEN 0 ELSE 1 END, n_li - n_li // 2, 1) - 1) AS row_text,
       CAST(greatest(CASE WHEN cell = '' THEN 0 ELSE 1 END, n_li - n_li // 2) AS BIGINT) AS n_cells,
       (CASE WHEN cell = '' THEN 0 ELSE 1 END) > n_li - n_li // 2 AS malformed
FROM chunk c JOIN lk ON c.page_id = lk.page_id
"""


@register(
    "status_log_lines",
    RECON_WITH
    + r"""
, st AS (
  SELECT e.symbol, coalesce(g.got, 0) AS got, e.expected,
         CASE WHEN coalesce(g.got, 0) = e.expected THEN 'success' ELSE 'warning' END AS status,
         CAST(coalesce(g.got, 0) AS VARCHAR) || '/' || CAST(e.expected AS VARCHAR) AS message
  FROM expected e LEFT JOIN got g ON e.symbol = g.symbol),
ts AS (SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS symbol, o_orderdate AS ts FROM orders)
SELECT strftime(ts.ts, '%Y-%m-%d %H:%M:%S') || ',000' ||
       CASE WHEN status = 'success' THEN ' - INFO - Scraping Successfully ' ELSE ' - WARNING - Not enough reports ' END
       || st.symbol || ': ' || message AS value
FROM st JOIN ts ON st.symbol = ts.symbol
""",
)
def q_status_log_lines(spark: SparkSession, d: str) -> DataFrame:
    expected = reconcile.expected_reports(derive.order_pager(spark, d), derive.order_arrivals(spark, d))
    status = reconcile.reconcile(expected, reconcile.reports_per_symbol(derive.order_catalog(spark, d)))
    o = read_table(spark, d, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("_ts_symbol"), F.col("o_orderdate").alias("ts")
    )
    status = status.join(o, status["symbol"] == o["_ts_symbol"], "inner")
    return reconcile.format_log_lines(status)


# L1 crawl pass ---------------------------------------------------------------------------------------
CRAWL_MAX_PATH = 200
CRAWL_WITH = EVENTS_WITH + rf""",
all_named AS (
  SELECT *, './crawl_table/' || symbol || '/' ||
         translate(event_type || ' ' || CAST(event_id AS VARCHAR), '<>:"/\|?*', '_________') || '_' ||
         translate(strftime(ts, '%d/%m/%Y %H:%M:%S'), '<>:"/\|?*', '_________') AS base
  FROM l2),
named AS (SELECT * FROM all_named WHERE event_id IN (SELECT event_id FROM res)),
held AS (SELECT symbol, base FROM all_named WHERE event_id NOT IN (SELECT event_id FROM res) AND event_type <> 'error'),
got AS (SELECT symbol, count(DISTINCT base) AS got FROM (SELECT symbol, base FROM named UNION ALL FROM held) b GROUP BY symbol),
expected AS (SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, count(*) AS expected FROM events GROUP BY user_id)
"""


def _crawl_pass(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return flows.crawl_pass(
        written(derive.event_listing_rows(spark, d), "listing"), derive.event_checkpoints(spark, d), derive.event_pager(spark, d),
        derive.event_folders(spark, d), max_path=CRAWL_MAX_PATH,
    )


@register(
    "crawl_pass",
    CRAWL_WITH
    + """
SELECT e.symbol, coalesce(g.got, 0) AS got, e.expected,
       CASE WHEN coalesce(g.got, 0) = e.expected THEN 'success' ELSE 'warning' END AS status,
       CAST(coalesce(g.got, 0) AS VARCHAR) || '/' || CAST(e.expected AS VARCHAR) AS message
FROM expected e LEFT JOIN got g ON e.symbol = g.symbol
""",
)
def q_crawl_pass(spark: SparkSession, d: str) -> DataFrame:
    return _crawl_pass(spark, d)["status"]


@register(
    "crawl_index",
    CRAWL_WITH
    + """
SELECT n.symbol, CASE WHEN coalesce(g.got, 0) = e.expected THEN 'success' ELSE 'warning' END AS status,
       CAST(n.event_id AS VARCHAR) AS stt, n.base AS saving_path
FROM named n JOIN expected e ON n.symbol = e.symbol LEFT JOIN got g ON n.symbol = g.symbol
""",
)
def q_crawl_index(spark: SparkSession, d: str) -> DataFrame:
    """The pass's index as success.csv or warning.csv of each symbol, written and read back."""
    out = _crawl_pass(spark, d)
    out["reports"] = out["reports"].withColumns({"STT": F.col("event_id"), "Saving_path": F.col("report_dir")})
    root = new_work_dir(spark, "crawl-pass")
    flows.write_pass(out, root, ["STT", "Tiêu đề", "Saving_path"], ["page", "row_idx"])
    index = files.read_report_index(spark, root).unionByName(files.read_report_index(spark, root, "warning"))
    return index.select("symbol", "status", F.col("STT").alias("stt"), F.col("Saving_path").alias("saving_path"))


@register("crawl_reports", CRAWL_WITH + "SELECT symbol, page, row_idx, event_id, base AS report_dir FROM named")
def q_crawl_reports(spark: SparkSession, d: str) -> DataFrame:
    return _crawl_pass(spark, d)["reports"].select("symbol", "page", "row_idx", "event_id", "report_dir")


@register(
    "crawl_checkpoints",
    CRAWL_WITH
    + """,
top AS (
  SELECT symbol, page, row_idx FROM (
    SELECT symbol, page, row_idx, row_number() OVER (PARTITION BY symbol ORDER BY page DESC, row_idx DESC) AS rn FROM res) r
  WHERE rn = 1)
SELECT symbol, page + 1 AS current_page, 0 AS last_row_index FROM top
UNION ALL
SELECT symbol, current_page, last_row_index FROM cp WHERE symbol NOT IN (SELECT symbol FROM top)
""",
)
def q_crawl_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    return _crawl_pass(spark, d)["checkpoints"]
