"""Column → Column string, number and date functions.

All of them are built-in expressions, so they run inside whole-stage codegen
and need no Python worker.  Spark 4 runs with ANSI mode on: every conversion
that can fail uses a ``try_`` variant and yields null instead of failing the
task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Report listing columns, in page order.
LISTING_COLUMNS = [
    "STT",
    "Tên báo cáo",
    "Đơn vị",
    "Trích yếu",
    "Thời gian gửi",
    "Mã doanh nghiệp",
    "Tên công ty",
    "Tiêu đề",
    "Saving_path",
]
# Characters that are replaced by "_" in file names.
UNSAFE_NAME_CHARS = '<>:"/\\|?*'
# Period keywords, first match wins, matched in lower case.
PERIOD_KEYWORDS = [
    ("quý 1", "Quý I"),
    ("quý i/", "Quý I"),
    ("quý 2", "Quý II"),
    ("quý ii/", "Quý II"),
    ("quý 3", "Quý III"),
    ("quý iii/", "Quý III"),
    ("quý 4", "Quý IV"),
    ("quý iv/", "Quý IV"),
    ("bán niên", "Bán niên"),
    ("năm", "Năm"),
]
# Statement type keywords, first match wins, matched in lower case.
TYPE_KEYWORDS = [
    ("riêng", "Riêng"),
    ("tổng hợp", "Tổng hợp"),
    ("mẹ", "Riêng"),
    ("hợp nhất", "Tổng hợp"),
]
DEFAULT_TYPE = "Riêng"
# Log line layout: "<asctime> - <LEVEL> - <message>".
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
SUCCESS_MESSAGE = "Scraping Successfully"
WARNING_MESSAGE = "Not enough reports"
# Marker of a balance sheet found in another statement.
BALANCE_SHEET_MARKER = "TÀI SẢN NGẮN HẠN"
# Prefix of a saved report path.
CRAWL_ROOT = "./crawl_table"
# ---------------------------------------------------------------------------

# Unicode word characters, the same set as Python's ``\w`` on text.
WORD = r"[\p{L}\p{N}_]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# H1 -------------------------------------------------------------------------
def clean_row_text(c: Column | str) -> Column:
    """Runs of newlines/tabs become one comma; commas at both ends removed."""
    once = F.regexp_replace(_col(c), r"[\n\t]+", ",")
    return F.regexp_replace(once, r"^,+|,+\z", "")


# H2 -------------------------------------------------------------------------
def split_cells(c: Column | str) -> Column:
    """Split a cleaned row text on commas (a comma inside a cell shifts it)."""
    return F.split(_col(c), ",")


# H3 -------------------------------------------------------------------------
def sanitize_name(c: Column | str) -> Column:
    """Every character of ``<>:"/\\|?*`` becomes ``_``."""
    return F.translate(_col(c), UNSAFE_NAME_CHARS, "_" * len(UNSAFE_NAME_CHARS))


# H4 -------------------------------------------------------------------------
def report_name(
    title: Column | str,
    date: Column | str,
    backup: Column | str,
    prefix: Column | str,
    max_title: int = 50,
    max_path: int = 20,
) -> Column:
    """Base folder of a saved report, before collision numbering.

    A title longer than ``max_title`` after sanitising, or shorter than two
    characters, is replaced by the backup (the summary).  When the whole path
    is longer than ``max_path`` or the backup is shorter than two characters
    the folder is ``<prefix>/NO_NAME``.
    """
    title, date, backup, prefix = map(_col, (title, date, backup, prefix))
    safe_title = sanitize_name(title)
    use_backup = (
        title.isNull() | (F.length(safe_title) > max_title) | (F.length(title) < 2)
    )
    chosen = F.when(use_backup, sanitize_name(backup)).otherwise(safe_title)
    base = F.concat(prefix, F.lit("/"), chosen, F.lit("_"), sanitize_name(date))
    no_name = (
        base.isNull()
        | (F.length(base) > max_path)
        | backup.isNull()
        | (F.length(backup) < 2)
    )
    return F.when(no_name, F.concat(prefix, F.lit("/NO_NAME"))).otherwise(base)


# H5, H6, H7, H9 ---------------------------------------------------------------
def _first_keyword(c: Column, keywords: list[tuple[str, str]]) -> Column:
    low = F.lower(c)
    out = None
    for key, value in keywords:
        cond = low.contains(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(None).cast("string"))


def period_of(c: Column | str) -> Column:
    """Quý I..IV, Bán niên or Năm by the first keyword found; else null."""
    return _first_keyword(_col(c), PERIOD_KEYWORDS)


def statement_type_of(c: Column | str, default: str | None = None) -> Column:
    """Riêng or Tổng hợp by the first keyword found; else ``default``."""
    out = _first_keyword(_col(c), TYPE_KEYWORDS)
    return out if default is None else F.coalesce(out, F.lit(default))


def year_of(c: Column | str, missing: str | None = None) -> Column:
    """First run of four digits; ``missing`` (e.g. ``'nan'``) when absent."""
    found = F.nullif(F.regexp_extract(_col(c).cast("string"), r"([0-9]{4})", 1), F.lit(""))
    return found if missing is None else F.coalesce(found, F.lit(missing))


def report_key(year: Column | str, period: Column | str, kind: Column | str) -> Column:
    """``year_period_type``; null when any part is null (``concat``)."""
    return F.concat(_col(year), F.lit("_"), _col(period), F.lit("_"), _col(kind))


# H8 -------------------------------------------------------------------------
def pager_numbers(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(r"([0-9]+)"), 1)


def pager_total(c: Column | str) -> Column:
    """Total reports: third integer of the pager text, 0 when absent."""
    nums = pager_numbers(c)
    return F.coalesce(F.try_element_at(nums, F.lit(3)).try_cast("bigint"), F.lit(0).cast("bigint"))


def pager_is_paged(c: Column | str) -> Column:
    """The pager was read: three integers and a non-zero page size."""
    nums = pager_numbers(c)
    size = F.try_element_at(nums, F.lit(2)).try_cast("bigint")
    return (F.size(nums) >= 3) & F.coalesce(size != 0, F.lit(False))


def pager_pages(c: Column | str) -> Column:
    """Pages = ceil(total / page size); 1 when the pager cannot be read."""
    nums = pager_numbers(c)
    total = F.try_element_at(nums, F.lit(3)).try_cast("bigint")
    size = F.try_element_at(nums, F.lit(2)).try_cast("bigint")
    pages = F.ceil(F.try_divide(total, size)).cast("bigint")
    return F.when(pager_is_paged(c), pages).otherwise(F.lit(1).cast("bigint"))


# H10, H11, H12, H23 -------------------------------------------------------------
def log_symbol(c: Column | str, kind: str) -> Column:
    """Symbol of a success (``'success'``) or warning line; null otherwise."""
    if kind == "success":
        pattern = rf"INFO - {SUCCESS_MESSAGE} ({WORD}+):"
    elif kind == "warning":
        pattern = rf"WARNING - {WARNING_MESSAGE} ({WORD}+):"
    else:
        raise ValueError(f"kind must be 'success' or 'warning', not {kind!r}")
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def log_tokens(c: Column | str) -> Column:
    """Whitespace tokens of a stripped log line."""
    return F.split(F.regexp_replace(_col(c), r"^\s+|\s+\z", ""), r"\s+")


def parse_log_tokens(c: Column | str) -> Column:
    """Positional parse: struct(kind, symbol, report_count).

    Success lines take tokens 7/8, warning lines 8/9 (0-based), with ``:``
    removed from the symbol.  Other lines give a null kind.
    """
    line = _col(c)
    toks = log_tokens(line)
    is_ok = line.contains(SUCCESS_MESSAGE)
    is_warn = ~is_ok & line.contains(WARNING_MESSAGE)
    pos = F.when(is_ok, F.lit(8)).when(is_warn, F.lit(9))
    sym = F.replace(F.try_element_at(toks, pos), F.lit(":"), F.lit(""))
    cnt = F.try_element_at(toks, pos + 1)
    kind = F.when(is_ok, F.lit("success")).when(is_warn, F.lit("warning"))
    return F.struct(kind.alias("kind"), sym.alias("symbol"), cnt.alias("report_count"))


def got_expected(c: Column | str) -> Column:
    """``'got/expected'`` → struct(got BIGINT, expected BIGINT)."""
    parts = F.split(_col(c), "/")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).try_cast("bigint").alias("got"),
        F.try_element_at(parts, F.lit(2)).try_cast("bigint").alias("expected"),
    )


def log_time(c: Column | str) -> Column:
    """Timestamp at the start of a log line (no zone)."""
    return F.try_to_timestamp(F.substring(_col(c), 1, 23), F.lit(LOG_TIME_FORMAT)).cast(
        "timestamp_ntz"
    )


def log_level(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"^.{23} - ([A-Z]+) - ", 1), F.lit(""))


def log_counts(c: Column | str) -> Column:
    """``got/expected`` at the end of a status message."""
    return got_expected(F.regexp_extract(_col(c), r":\s*([0-9]+/[0-9]+)\s*$", 1))


# H13, H14, H15, H16 -------------------------------------------------------------
def rebase_path(c: Column | str, old_prefix: str = CRAWL_ROOT, new_root: str = "") -> Column:
    """Replace a leading ``old_prefix`` of a saved path by ``new_root``."""
    import re

    return F.regexp_replace(_col(c), "^" + re.escape(old_prefix), new_root.replace("\\", "\\\\").replace("$", "\\$"))


def error_rate(errors: Column | str, total: Column | str) -> Column:
    """``100 * errors / total`` as double, 0.0 when total is 0."""
    e, t = _col(errors), _col(total)
    return F.when(t > 0, F.lit(100.0) * e.cast("double") / t.cast("double")).otherwise(F.lit(0.0))


def text_length(c: Column | str) -> Column:
    return F.length(_col(c)).cast("bigint")


def symbol_from_file(c: Column | str, pattern: str = r"checkpoint_(.+)\.json$") -> Column:
    """Symbol encoded in a file name (default: checkpoint files)."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def symbol_from_path(c: Column | str, depth_from_end: int = 2) -> Column:
    """Folder name ``depth_from_end`` levels above the file (``root/SYM/x.csv``)."""
    parts = F.split(_col(c), "/")
    return F.try_element_at(parts, F.lit(-depth_from_end))


def decode_path(c: Column | str) -> Column:
    """``_metadata.file_path`` is a URI (spaces as %20); make it a plain path."""
    return F.regexp_replace(
        F.regexp_replace(F.url_decode(F.regexp_replace(_col(c), r"\+", "%2B")), r"^file:(//)?", ""),
        r"^/+",
        "/",
    )
