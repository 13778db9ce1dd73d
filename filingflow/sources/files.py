"""Sources and sinks.

Two kinds of layout are handled:

* the reference's own files, for ingestion: a symbol CSV, one checkpoint
  JSON per symbol, ``root/SYM/success.csv`` report indexes, statement CSVs in
  ``root/SYM/REPORT/NAME.csv``, ``*.log`` files;
* the engine's tables, written by the sinks: Parquet with explicit schemas,
  partitioned where readers prune (index by ``status``, statements by
  ``statement``), append-only where the reference overwrote small files
  (checkpoints carry a version; readers take the newest per symbol).

Nothing is inferred: CSVs are read as strings and cast with ``try_cast``.
Folder trees are listed, and their files opened, by executors
(:mod:`filingflow.sources.tree`): Spark's file sources leave out empty files and
names that start with ``_`` (a sanitised title can).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.functions import text as T
from filingflow.operators.ordering import first_per_key
from filingflow.operators.quality import NA_TOKENS
from filingflow.session import give_back
from filingflow.sources import tree
from filingflow.sources.epochs import MERGE_EVERY, EpochTable

STATEMENT_FILES = ("BCDKT", "KQKD", "LCTT_TT", "LCTT_GT")
# Older trees name the same statements differently.
LEGACY_STATEMENT_FILES = ("BCDKT", "KQKT", "LCTT_TT1", "LCTT_TT2")

CHECKPOINT_SCHEMA = "current_page INT, last_row_index INT"
CELL_SCHEMA = (
    "symbol string, report_dir string, statement string, row_idx bigint, col_idx bigint, "
    "col_name string, value string, unreadable boolean"
)
TRUTH_COLUMNS = ("stock_code", "year", "range", "type", "tax_code")


def _pandas_csv(spark: SparkSession):
    """Reader of CSV files as pandas writes them: quotes are doubled, a cell may hold newlines."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True)


# S1, S2 ----------------------------------------------------------------------
def read_symbols(spark: SparkSession, path: str, column: str = "symbol", alias_of: str = "ticker") -> DataFrame:
    """Symbol list CSV → (symbol); an index column is ignored, ``ticker`` is
    accepted as the column name."""
    df = _pandas_csv(spark).csv(path)
    if column not in df.columns and alias_of in df.columns:
        df = df.withColumnRenamed(alias_of, column)
    return df.select(F.col(column).alias("symbol"))


def write_symbols(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("symbol").write.mode(mode).option("header", True).csv(path)


# S3, S4 ----------------------------------------------------------------------
def read_checkpoint_files(spark: SparkSession, folder: str, symbols: DataFrame | None = None) -> DataFrame:
    """``checkpoint_<SYMBOL>.json`` files → (symbol, current_page,
    last_row_index); listed symbols without a file get ``{1, 0}``."""
    cp = spark.read.schema(CHECKPOINT_SCHEMA).json(f"{folder.rstrip('/')}/checkpoint_*.json")
    cp = cp.select(
        T.symbol_from_file(F.col("_metadata.file_name")).alias("symbol"),
        F.col("current_page").cast("bigint").alias("current_page"),
        F.col("last_row_index").cast("bigint").alias("last_row_index"),
    )
    return _with_defaults(cp, symbols)


def _with_defaults(cp: DataFrame, symbols: DataFrame | None) -> DataFrame:
    if symbols is None:
        return cp
    s = symbols.select(F.col("symbol").alias("symbol")).distinct()
    j = s.join(cp, "symbol", "left")
    return j.select(
        "symbol",
        F.coalesce("current_page", F.lit(1)).cast("bigint").alias("current_page"),
        F.coalesce("last_row_index", F.lit(0)).cast("bigint").alias("last_row_index"),
    )


def checkpoint_table(spark: SparkSession, path: str, every: int = MERGE_EVERY) -> EpochTable:
    """The versions written to ``path``; merged, the newest row of each symbol is left."""
    return EpochTable(spark, path, lambda rows: first_per_key(rows, ["symbol"], ["epoch_id"], descending=True), every)


def write_checkpoints(df: DataFrame, path: str, version: int, every: int = MERGE_EVERY) -> None:
    """Write checkpoint rows as a version (the same one again replaces it); after
    ``every`` versions the earlier ones are merged.  See :func:`read_checkpoints`."""
    rows = df.select(
        "symbol",
        F.col("current_page").cast("bigint").alias("current_page"),
        F.col("last_row_index").cast("bigint").alias("last_row_index"),
    )
    checkpoint_table(df.sparkSession, path, every).write(rows, version)


def read_checkpoints(spark: SparkSession, path: str, symbols: DataFrame | None = None) -> DataFrame:
    """Newest checkpoint per symbol from the checkpoint table (merged base and later
    versions, groups limited before the shuffle), with ``{1, 0}`` defaults for ``symbols``."""
    return _with_defaults(checkpoint_table(spark, path).rows().drop("epoch_id"), symbols)


# S5, S6 ----------------------------------------------------------------------
def read_report_index(
    spark: SparkSession, root: str, status: str = "success", pandas_na: bool = True
) -> DataFrame:
    """``root/SYM/<status>.csv`` files (reference layout) → index rows with
    ``symbol`` (from the folder) and ``status``; all strings.

    With ``pandas_na`` the missing-value words a pandas CSV read recognises
    (``NA``, ``null``, ``nan``, …) are missing here as well, as in the
    reference's reads; empty fields are missing either way.
    """
    rows = _parsed_index(spark, root, status).where("row >= 0")
    cols = [
        F.when((F.col(f"`{c}`") == "") | (F.col(f"`{c}`").isin(NA_TOKENS) if pandas_na else F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.col(f"`{c}`")).alias(c)
        for c in T.LISTING_COLUMNS
    ]
    return rows.select(*cols, "symbol", F.lit(status).alias("status"))


def index_inventory(spark: SparkSession, root: str, status: str = "success") -> DataFrame:
    """One row per index file ``root/SYM/<status>.csv``: (symbol, path, header,
    n_rows, readable, has_stt, error).

    ``readable`` is what a plain read of the file as a CSV gives: not for a file
    without content, with a row longer than its header, or with bytes that are no
    UTF-8.  A file with a header and no rows is readable.  ``has_stt``: it is
    readable and has the column ``STT``."""
    seen = _parsed_index(spark, root, status).where("row < 0")
    path = F.concat(F.lit(tree.plain(tree.qualified(spark, root)) + "/"), "symbol", F.lit(f"/{status}.csv"))
    has_stt = F.col("error").isNull() & F.array_contains(F.coalesce("header", F.array().cast("array<string>")), "STT")
    return seen.select("symbol", path.alias("path"), "header", "n_rows", F.col("error").isNull().alias("readable"), has_stt.alias("has_stt"), "error")


def index_symbols(spark: SparkSession, root: str, status: str = "success") -> DataFrame:
    """(symbol, has_stt) of the index files present, for :func:`filingflow.operators.audit.classify_symbols`."""
    return index_inventory(spark, root, status).select("symbol", "has_stt")


_INDEX_COLUMNS = ["symbol", "row", "header", "n_rows", "error", *T.LISTING_COLUMNS]
_INDEX_SCHEMA = "symbol string, row bigint, header array<string>, n_rows bigint, error string, " + ", ".join(f"`{c}` string" for c in T.LISTING_COLUMNS)


def _parsed_index(spark: SparkSession, root: str, status: str) -> DataFrame:
    """A row -1 for each index file with what is known of it, then its rows from 0."""
    symbols = tree.list_tree(spark, root, levels=1).where("is_dir").select(F.col("name").alias("rel"))
    dealt = symbols.repartition(4 * spark.sparkContext.defaultParallelism, "rel")
    return dealt.mapInArrow(_parse_index(tree.qualified(spark, root), status), _INDEX_SCHEMA)


#: Rows of a file that are held before the rest is known to be readable.
ROWS_PER_CHUNK = 20_000
#: Rows, and characters in them, that a parser holds before it yields them.
ROWS_PER_YIELD = 10_000
CHARS_PER_YIELD = 4 << 20


def _read_chunks(store, name: str, header: int | None) -> Iterator[pd.DataFrame]:
    """A CSV file as strings, in chunks; raises what a plain read of it raises."""
    with store.open_input_stream(name) as f, pd.read_csv(
        f, header=header, dtype=str, keep_default_na=False, na_filter=False, chunksize=ROWS_PER_CHUNK, encoding="utf-8"
    ) as chunks:
        yield from chunks


def _csv_error(e: Exception) -> str:
    return f"{type(e).__name__}: {str(e).strip()}"[:200]


CSV_ERRORS = (pd.errors.EmptyDataError, pd.errors.ParserError, UnicodeError, ValueError)


def _whole_csv(store, name: str, header: int | None) -> tuple[list[str], int, Iterator[pd.DataFrame]]:
    """(labels, rows, chunks) of a readable file.  The first chunk is held; a file of
    more is read to its end before any row is given, and then again."""
    chunks = _read_chunks(store, name, header)
    first = next(chunks)
    labels, rows = [str(c) for c in first.columns], len(first)
    rest = 0
    for chunk in chunks:
        rest += len(chunk)
    return labels, rows + rest, _read_chunks(store, name, header) if rest else iter([first])


class _Rows:
    """Rows of one file or many, held as columns until they are worth an Arrow batch: a
    table for each small file costs more than reading it."""

    def __init__(self, columns: Sequence[str], types: dict[str, pa.DataType]):
        self.columns, self.types = columns, types
        self._clear()

    def _clear(self) -> None:
        self.held: dict[str, list] = {c: [] for c in self.columns}
        self.n = self.chars = 0

    def add(self, n: int, chars: int = 0, **values) -> None:
        """``n`` rows; a value that is no list stands for all of them, an absent one is missing."""
        for c, held in self.held.items():
            v = values.get(c)
            held.extend(v if isinstance(v, list) else [v] * n)
        self.n, self.chars = self.n + n, self.chars + chars

    def full(self) -> bool:
        return self.n >= ROWS_PER_YIELD or self.chars >= CHARS_PER_YIELD

    def batch(self) -> pa.RecordBatch:
        made = [pa.array(held, self.types.get(c, pa.string()), from_pandas=True) for c, held in self.held.items()]
        self._clear()
        return pa.RecordBatch.from_arrays(made, list(self.columns))


def _n_chars(values: list) -> int:
    return sum(len(v) for v in values if isinstance(v, str))


def _parse_index(uri: str, status: str):
    """Columns are found by each file's own header."""
    types = {"row": pa.int64(), "header": pa.list_(pa.string()), "n_rows": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = tree.open_store(uri)
        rows = _Rows(_INDEX_COLUMNS, types)
        for batch in batches:
            for symbol in batch.column(0).to_pylist():
                name = f"{base}/{symbol}/{status}.csv"
                if not store.get_file_info(name).is_file:
                    continue
                try:
                    labels, n, chunks = _whole_csv(store, name, 0)
                except CSV_ERRORS as e:
                    rows.add(1, symbol=symbol, row=-1, error=_csv_error(e))
                    continue
                rows.add(1, symbol=symbol, row=-1, header=[labels], n_rows=n)
                row = 0
                for chunk in chunks:
                    for at in range(0, len(chunk), ROWS_PER_YIELD):
                        part = chunk.iloc[at : at + ROWS_PER_YIELD]
                        cells = {c: part[c].tolist() for c in T.LISTING_COLUMNS if c in part}
                        rows.add(len(part), sum(map(_n_chars, cells.values())), symbol=symbol, row=list(range(row, row + len(part))), **cells)
                        row += len(part)
                        if rows.full():
                            yield rows.batch()
            if rows.n:
                yield rows.batch()
                give_back()

    return run


def write_report_index(df: DataFrame, path: str, mode: str = "append") -> None:
    """Index rows as a table partitioned by ``status``, each status in files of
    the advised partition size (a hot one is split)."""
    df.hint("rebalance", "status").write.mode(mode).partitionBy("status").parquet(path)


def read_report_index_table(spark: SparkSession, path: str, status: str | None = "success") -> DataFrame:
    df = spark.read.parquet(path)
    return df if status is None else df.where(F.col("status") == status)


# S7, S8, F11, U6 -------------------------------------------------------------------
_CELL_COLUMNS = ["symbol", "report_dir", "statement", "row_idx", "col_idx", "col_name", "value", "unreadable"]


def _file_cells(store, name: str, header: bool) -> Iterator[dict]:
    """Cells of some rows of a statement file at a time; with ``header`` its labels are
    row -1, so header-only tables keep them.  A file that cannot be read is one row."""
    try:
        labels, _, chunks = _whole_csv(store, name, 0 if header else None)
    except CSV_ERRORS:
        yield {"n": 1, "row_idx": -1, "col_idx": -1, "unreadable": True}
        return
    width = len(labels)
    places = list(range(width))
    if header:
        yield {"n": width, "row_idx": -1, "col_idx": places, "col_name": labels, "unreadable": False}
    first, step = 0, max(1, ROWS_PER_YIELD // width)
    for chunk in chunks:
        for at in range(0, len(chunk), step):
            part = chunk.iloc[at : at + step]
            n, values = len(part), part.to_numpy(dtype=object).ravel().tolist()
            numbers = np.repeat(np.arange(first + at, first + at + n), width).tolist()
            yield {"n": n * width, "chars": _n_chars(values), "row_idx": numbers, "col_idx": places * n, "col_name": labels * n, "value": values, "unreadable": False}
        first += len(chunk)


def _parse_statements(uri: str, header: bool):
    """A yield holds cells of one file or many."""
    types = {"row_idx": pa.int64(), "col_idx": pa.int64(), "unreadable": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = tree.open_store(uri)
        rows = _Rows(_CELL_COLUMNS, types)
        for batch in batches:
            for rel in batch.column(0).to_pylist():
                parts = f"{tree.plain(uri)}/{rel}".split("/")
                place = {"symbol": parts[-3], "report_dir": "/".join(parts[:-1]), "statement": parts[-1].rsplit(".", 1)[0]}
                for cells in _file_cells(store, f"{base}/{rel}", header):
                    rows.add(**cells, **place)
                    if rows.full():
                        yield rows.batch()
                        give_back()
            if rows.n:
                yield rows.batch()
                give_back()

    return run


def read_statements(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = STATEMENT_FILES,
    header: bool = True,
) -> DataFrame:
    """Statement CSVs of a crawl tree → the long cell table (one row per cell).

    The files come from a listing of the tree by executors, dealt by their bytes and
    opened by the tasks that parse them.  ``header=False`` counts the header line as
    row 0.  A file that a plain CSV read refuses (no content, a row longer than the
    first, bytes that are no UTF-8) gives one row with ``unreadable`` true, so every
    file is in the table.  All reports of all symbols end up in one table (U6).
    """
    entries = tree.list_tree(spark, root, levels=3).where((F.col("level") == 2) & F.col("name").isin([f"{n}.csv" for n in names]))
    found = tree.files_of(spark, root, entries).select("rel", "bytes")
    return tree.dealt_by_bytes(found).mapInArrow(_parse_statements(tree.qualified(spark, root), header), CELL_SCHEMA)


def write_statements(cells: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """Append statements, skipping (report, statement) pairs already held —
    the reference does not overwrite an existing file."""
    new = cells
    if existing is not None:
        keys = existing.select(
            F.col("report_dir").alias("_e_rep"), F.col("statement").alias("_e_st")
        ).distinct()
        new = cells.join(
            keys, (cells["report_dir"] == keys["_e_rep"]) & (cells["statement"] == keys["_e_st"]), "left_anti"
        )
    new.hint("rebalance", "statement").write.mode("append").partitionBy("statement").parquet(path)


def read_statement_table(spark: SparkSession, path: str, statement: str | None = None) -> DataFrame:
    """The cell table, typed by its schema (no partition type inference)."""
    df = spark.read.schema(CELL_SCHEMA).parquet(path)
    return df if statement is None else df.where(F.col("statement") == statement)


# The reference's own layout: one named file per symbol, report or checkpoint ---------
def csv_line(*cells: Column) -> Column:
    """One CSV line as pandas writes it: quotes only where needed, doubled inside; nulls empty."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in cells]
    quoted = [F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c) for c in text]
    return F.concat_ws(",", *quoted)


def csv_files(rows: DataFrame, path: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(path, content): the rows of each path as one CSV file with a header,
    in ``order``.  A file of that layout is one value and is built as one."""
    line = csv_line(*[F.col(f"`{c}`") for c in columns])
    keyed = rows.select(F.col(path).alias("path"), F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)], line.alias("line")).alias("_r"))
    head = csv_line(*[F.lit(c) for c in columns])
    lines = F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["line"])
    return keyed.groupBy("path").agg(F.concat(F.array_join(F.concat(F.array(head), lines), "\n"), F.lit("\n")).alias("content"))


def write_csv_files(rows: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], root: str) -> None:
    """The rows of each value of ``path`` as one CSV file with a header below ``root``, in
    ``order``; all files or none (:func:`filingflow.sources.tree.commit_staged`).  A file
    is written line by line as its sorted rows come, so its size is not a task's memory."""
    line = csv_line(*[F.col(f"`{c}`") for c in columns])
    keys = [f"_k{i}" for i in range(len(order))]
    lines = rows.select(F.col(path).alias("path"), *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=True)], line.alias("line"))
    lines = lines.repartition("path").sortWithinPartitions("path", *keys).select("path", "line")
    header = rows.sparkSession.range(1).select(csv_line(*[F.lit(c) for c in columns])).first()[0]
    tree.write_lines(lines, root, header)


def write_named_files(texts: DataFrame, root: str) -> None:
    """(path, content) rows as UTF-8 files ``root/path``: staged and renamed under a
    commit, see :func:`filingflow.sources.tree.write_files`."""
    tree.write_files(texts, root)


# S10, S12 ----------------------------------------------------------------------
def read_logs(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """Log files → (value, file): one row per line."""
    df = spark.read.option("pathGlobFilter", glob).text(path)
    return df.select("value", F.col("_metadata.file_name").alias("file"))


def read_latest_log(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """S11 on a log folder: only the file greatest by name is scanned.

    The newest name comes from a listing of the folder (no line of an older log is
    read); the one name is the only value that reaches the driver.  A log may be a
    folder of parts, as Spark writes one; an empty newest log has no lines."""
    entries = tree.list_tree(spark, path, levels=1).where(tree.matches(F.col("name"), glob))
    newest = entries.agg(F.max("name")).first()[0]
    if newest is None:
        return spark.createDataFrame([], "value string, file string")
    return spark.read.text(f"{path.rstrip('/')}/{newest}").select("value", F.lit(newest).alias("file"))


def write_log_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("append").text(path)


# S13, A2 ------------------------------------------------------------------------
def file_catalog(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Listing of matching files in folders of any depth, as a table (path, bytes,
    mtime); empty files and any folder names count, contents are not read."""
    entries = tree.list_tree(spark, root)
    return tree.files_of(spark, root, entries.where(tree.matches(F.col("name"), glob))).drop("rel")


def count_files(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"))


# S14, S15 ------------------------------------------------------------------------
def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """External check CSV, all columns as strings; the columns the
    cross-check uses must be present (``stock_code`` only selects rows)."""
    df = _pandas_csv(spark).csv(path)
    missing = [c for c in TRUTH_COLUMNS if c != "stock_code" and c not in df.columns]
    if missing:
        raise ValueError(f"truth table lacks columns {missing}")
    return df
