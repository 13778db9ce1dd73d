"""Folder trees on a shared file system: listed, read and written by executors.

Spark's own file sources leave out files of zero bytes and folders, hide names
that start with ``_`` or ``.``, and find files on the driver.  Here a tree is
walked level by level: the folders of a level are rows, dealt over the executors,
which list them and write the level's entries as a table; only the number of
folders of a level comes back to the driver.  Files are opened by the executors
that parse them, through the file system of the root, so a file that is empty or
broken is seen like any other.

A root without a scheme belongs to the cluster's default file system (Hadoop's
``fs.defaultFS``), never to an executor's own disk.
"""

from __future__ import annotations

import fnmatch
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.session import new_work_dir

ENTRY_SCHEMA = "level int, parent string, name string, is_dir boolean, bytes bigint, mtime timestamp"
#: Files that a write keeps aside until it is committed; no reader sees them.
STAGING = ".filingflow-staging-"
ROWS_PER_BATCH = 10_000


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme of the file system that it belongs to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString().rstrip("/")


def plain(uri: str) -> str:
    """A local URI as a path, as the readers give it; others stay URIs."""
    return "/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri


def open_store(uri: str):
    """(file system, base path) of a qualified root, on an executor."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), plain(uri)
    store, base = fs.FileSystem.from_uri(uri)
    return store, base.rstrip("/")


def _list_folders(uri: str, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = open_store(uri)
        local = isinstance(store, fs.LocalFileSystem)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                where = f"{base}/{folder}" if folder else base
                found = store.get_file_info(fs.FileSelector(where, allow_not_found=True))
                for at in range(0, len(found), ROWS_PER_BATCH):
                    part = [i for i in found[at : at + ROWS_PER_BATCH] if level or not i.base_name.startswith(STAGING)]
                    # A link to a folder may lead back up: it is an entry, but not walked.
                    kinds = [i.type == fs.FileType.Directory and not (local and os.path.islink(i.path)) for i in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([level] * len(part), pa.int32()), pa.array([folder] * len(part), pa.string()),
                            pa.array([i.base_name for i in part], pa.string()), pa.array(kinds, pa.bool_()),
                            pa.array([i.size if i.is_file else None for i in part], pa.int64()),
                            pa.array([i.mtime for i in part], pa.timestamp("us", "UTC")),
                        ],
                        ["level", "parent", "name", "is_dir", "bytes", "mtime"],
                    )

    return run


def list_tree(spark: SparkSession, root: str, levels: int | None = None) -> DataFrame:
    """Every entry below ``root``: ``level`` (0: in the root), ``parent`` (folder
    relative to the root, empty for the root), ``name``, ``is_dir``, ``bytes`` (null
    for folders), ``mtime`` — files of zero bytes, empty folders and any name included.

    ``levels`` bounds the walk to so many levels of entries.  A missing root is an
    empty tree.  A folder is listed by one call, as file systems do."""
    uri = qualified(spark, root)
    cores = spark.sparkContext.defaultParallelism
    folders, n, level, found = spark.createDataFrame([("",)], "parent string"), 1, 0, None
    while n and (levels is None or level < levels):
        path = new_work_dir(spark, "tree")
        dealt = folders.repartition(min(n, 4 * cores))
        dealt.mapInArrow(_list_folders(uri, level), ENTRY_SCHEMA).write.mode("overwrite").parquet(path)
        entries = spark.read.schema(ENTRY_SCHEMA).parquet(path)
        found = entries if found is None else found.unionByName(entries)
        folders = entries.where("is_dir").select(relative(F.col("parent"), F.col("name")).alias("parent"))
        n, level = folders.count(), level + 1
    return found if found is not None else spark.createDataFrame([], ENTRY_SCHEMA)


def relative(parent: Column, name: Column) -> Column:
    """Path of an entry below the root."""
    return F.when(parent == "", name).otherwise(F.concat(parent, F.lit("/"), name))


def matches(name: Column, glob: str) -> Column:
    """Does a name match a shell pattern?"""
    pattern = fnmatch.translate(glob)
    return name.rlike("^" + pattern[: -len(r"\Z")] + r"\z")


def files_of(spark: SparkSession, root: str, entries: DataFrame) -> DataFrame:
    """(path, rel, bytes, mtime) of the files among the entries of a tree."""
    rel = relative(F.col("parent"), F.col("name"))
    files = entries.where(~F.col("is_dir") & F.col("bytes").isNotNull())
    return files.select(F.concat(F.lit(plain(qualified(spark, root)) + "/"), rel).alias("path"), rel.alias("rel"), "bytes", "mtime")


def report_folders(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, report_dir): the folders below each symbol's folder, with or without files."""
    entries = list_tree(spark, root, levels=2).where("is_dir AND level = 1")
    base = F.lit(plain(qualified(spark, root)) + "/")
    return entries.select(F.col("parent").alias("symbol"), F.concat(base, "parent", F.lit("/"), "name").alias("report_dir"))


def dealt_by_bytes(files: DataFrame) -> DataFrame:
    """``files`` in as many partitions as their bytes need (AQE would see only the
    few bytes of the listing and put them into one)."""
    spark = files.sparkSession
    share = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    wanted = max(spark.sparkContext.defaultParallelism, -(-size // share))
    return files.repartition(max(1, min(n, wanted)))


# Named files, written as one --------------------------------------------------------------
def write_files(texts: DataFrame, root: str) -> None:
    """(path, content) rows as UTF-8 files ``root/path``, all or none.

    1. Tasks write the files into a staging folder, each attempt under names of its
       own, and report them as rows of a table; Spark keeps the rows of the attempts
       that succeeded, so a task that is killed or run twice adds nothing.
    2. A marker that names the table is put into the staging folder: the commit.
    3. Tasks rename the files to their places.  A rename replaces the whole file, and
       one that was done before is skipped, so this step may be repeated at will.

    If the job ends before the commit, the tree is as it was; if it ends after,
    :func:`finish_writes` (called by the next write) does the rest."""
    spark = texts.sparkSession
    finish_writes(spark, root)
    uri, staging = qualified(spark, root), new_staging()

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(uri)
        attempt, made = uuid.uuid4().hex, 0
        store.create_dir(f"{base}/{staging}/{attempt}", recursive=True)
        for batch in batches:
            names = []
            for content in batch.column(1).to_pylist():
                names.append(f"{staging}/{attempt}/{made}")
                made += 1
                with store.open_output_stream(f"{base}/{names[-1]}") as f:
                    f.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], ["path", "staged"])

    commit_staged(texts.select("path", "content").mapInArrow(stage, "path string, staged string"), root, staging)


def write_lines(lines: DataFrame, root: str, header: str) -> None:
    """(path, line) rows, those of a path next to each other in one partition, as files
    ``root/path`` with a first line; all or none, as :func:`write_files`."""
    spark = lines.sparkSession
    finish_writes(spark, root)
    uri, staging = qualified(spark, root), new_staging()

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(uri)
        folder, now, out, made = f"{staging}/{uuid.uuid4().hex}", None, None, []
        store.create_dir(f"{base}/{folder}", recursive=True)
        for batch in batches:
            for path, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != now:
                    if out is not None:
                        out.close()
                    now = path
                    made.append((path, f"{folder}/{len(made)}"))
                    out = store.open_output_stream(f"{base}/{made[-1][1]}")
                    out.write(f"{header}\n".encode())
                out.write(f"{line}\n".encode())
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made, strict=True)], ["path", "staged"])

    commit_staged(lines.where("path IS NOT NULL").mapInArrow(stage, "path string, staged string"), root, staging)


def new_staging() -> str:
    """Name of a staging folder in a root."""
    return f"{STAGING}{uuid.uuid4().hex}"


def commit_staged(staged: DataFrame, root: str, staging: str, index: str | None = None) -> None:
    """Runs ``staged``, whose tasks write files into the staging folder and report each
    as ``path`` (its place below the root) and ``staged``, and puts them in place.  The
    reported rows, with any columns more, are kept as a table at ``index``."""
    spark = staged.sparkSession
    uri = qualified(spark, root)
    table = f"{uri}/{staging}/table"
    staged.write.parquet(table)
    if index is not None:
        spark.read.schema(staged.schema).parquet(table).drop("staged").write.mode("overwrite").parquet(index)
    put_marker(spark, f"{uri}/{staging}/committed")
    _move(spark, root, staging)


def _move(spark: SparkSession, root: str, staging: str) -> None:
    uri = qualified(spark, root)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(uri)
        for batch in batches:
            for path, staged in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if store.get_file_info(f"{base}/{staged}").is_file:
                    store.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                    store.move(f"{base}/{staged}", f"{base}/{path}")
            yield batch.slice(0, 0)

    table = spark.read.schema("path string, staged string").parquet(f"{uri}/{staging}/table")
    table.mapInArrow(move, "path string, staged string").write.format("noop").mode("overwrite").save()
    remove(spark, f"{uri}/{staging}")


def finish_writes(spark: SparkSession, root: str) -> None:
    """Ends writes that were committed but not moved.  One that was not committed is
    left alone: it may be another job's, still running; :func:`drop_unfinished` removes it."""
    for staging, committed in _stagings(spark, root):
        if committed:
            _move(spark, root, staging)


def drop_unfinished(spark: SparkSession, root: str) -> int:
    """Removes what writes without a commit have staged; for when no write is running."""
    uri, gone = qualified(spark, root), 0
    for staging, committed in _stagings(spark, root):
        if not committed:
            remove(spark, f"{uri}/{staging}")
            gone += 1
    return gone


def _stagings(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """Staging folders of a root, one for each unfinished write, and whether it is committed."""
    names = [p.rsplit("/", 1)[1] for p in glob(spark, f"{qualified(spark, root)}/{STAGING}*")]
    return [(n, bool(glob(spark, f"{qualified(spark, root)}/{n}/committed"))) for n in names]


def delete_folders(spark: SparkSession, root: str, folders: DataFrame) -> None:
    """Removes the folders ``root/name`` of the first column, by executors; a name that
    is none, or leads out of the root, is left alone.  May be repeated at will."""
    uri = qualified(spark, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = open_store(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                safe = name and not name.startswith("/") and not {"..", "."} & set(name.split("/"))
                if safe and store.get_file_info(f"{base}/{name}").type == fs.FileType.Directory:
                    store.delete_dir(f"{base}/{name}")
            yield batch.slice(0, 0)

    names = folders.select(F.col(folders.columns[0]).cast("string").alias("name")).distinct()
    names.repartition(4 * spark.sparkContext.defaultParallelism, "name").mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


# Small steps of the driver -----------------------------------------------------------------
def _hadoop(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(path) or ())


def put_marker(spark: SparkSession, uri: str) -> None:
    fs, path = _hadoop(spark, uri)
    fs.create(path, True).close()


def remove(spark: SparkSession, uri: str) -> None:
    fs, path = _hadoop(spark, uri)
    fs.delete(path, True)
