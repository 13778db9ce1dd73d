"""Helpers shared by the operators: written tables, connected components,
forests inside one task."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.session import give_back, new_work_dir


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared work folder and read it back.

    Cuts the lineage (a lost executor re-reads files) and makes a table that
    several branches use computed once."""
    path = new_work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_work_table(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a table that :func:`work_table` wrote."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of ``rows`` rows at most for this session: a batch of
    Spark's default 10,000 texts is held several times by executor and worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > rows:
        spark.conf.set(name, str(rows))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *shared) -> Callable:
    """``run`` for ``mapInArrow``, leaving little behind: a Python worker outlives its
    task and waits beside the next stages.  Arrow takes its memory from the C library;
    at the end the values of the ``shared`` broadcasts are dropped (a later task loads
    them again) and freed memory goes back to the system."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            for value in shared:
                value.__dict__.pop("_value", None)
            gc.collect()
            give_back()

    return wrapped


def salted(rows: DataFrame, small: DataFrame, *spread: str, salts: int = 32) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``_ff_salt`` more: a hash of the
    ``spread`` columns of ``rows``, every value of it in ``small``.  Joined on
    it too, the rows of one hot key go to ``salts`` tasks."""
    salt = F.pmod(F.xxhash64(F.lit("salt"), *spread), F.lit(salts)).cast("int")
    return rows.withColumn("_ff_salt", salt), small.withColumn("_ff_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def join_spread(rows: DataFrame, table: DataFrame, by: list[str], n: str, parts: int = 4096) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per value of ``by``, none
    null; its column ``n`` counts the value's rows and is dropped).

    A value with more than a ``parts``-th of all rows is dealt over tasks by a
    hash of the row.  At most ``parts`` values can have that share: their list
    is broadcast, and ``table`` gets at most twice ``parts`` rows more."""
    share = (table.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0] // parts) + 1
    hot = table.where(F.col(n) > share).select(*by, F.ceil(F.col(n) / share).cast("int").alias("_ff_deal"))
    salt = F.pmod(F.xxhash64(F.lit("deal"), *[c for c in rows.columns if c not in by]), F.coalesce("_ff_deal", F.lit(1))).cast("int")
    left = rows.join(F.broadcast(hot), by, "left").withColumn("_ff_salt", salt).drop("_ff_deal")
    deals = F.when(F.col(n) > share, F.ceil(F.col(n) / share).cast("int")).otherwise(1)
    right = table.withColumn("_ff_salt", F.explode(F.sequence(F.lit(0), deals - 1))).drop(n)
    return left.join(right, [*by, "_ff_salt"]).drop("_ff_salt")


def repeated(df: DataFrame, times: str, chunk: int = 4096) -> DataFrame:
    """Every row of ``df`` as often as its column ``times`` says; the column
    becomes the number of the copy (from 0).  More than ``chunk`` copies of a
    row are made by several tasks."""
    few = df.where(F.col(times) <= chunk).withColumn(times, F.explode(F.expr(f"sequence(0L, {times} - 1)")))
    many = df.where(F.col(times) > chunk).withColumn("_ff_chunk", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {chunk})")))
    many = many.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_ff_chunk", *[c for c in df.columns if c != times])
    many = many.withColumn(times, F.explode(F.expr(f"sequence(_ff_chunk * {chunk}, least({times}, (_ff_chunk + 1) * {chunk}) - 1)")))
    return few.unionByName(many.drop("_ff_chunk"))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process."""
    return sys.__dict__.setdefault("_filingflow_worker_cache", {}).setdefault(name, {})


def star_forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes under links ``u``-``v``."""
    label = np.arange(n)
    while len(u):
        lu, lv = label[u], label[v]
        open_ = lu != lv
        if not open_.any():
            break
        u, v, lu, lv = u[open_], v[open_], lu[open_], lv[open_]
        low = np.minimum(lu, lv)
        np.minimum.at(label, lu, low)
        np.minimum.at(label, lv, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable over the links.

    Alternating large-star / small-star rounds: every node's neighbours are
    re-attached to the smallest one until nothing changes, which takes
    O(log² n) rounds also on long chains.  Each round is two partial
    ``min`` aggregations and two joins on the node (AQE splits a hub's rows),
    written to the shared folder; only two numbers per round (row count and a
    checksum) reach the driver.  Nodes without a link are not returned."""
    spark = edges.sparkSession
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    table = work_table(links, "components")
    state = None
    while True:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = work_table(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "components")
        now = step.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        drop_work_table(spark, table)
        table = step
        if now == state:
            return table.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now
