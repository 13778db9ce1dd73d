"""Captured rows held in buckets of symbols, so that a symbol's rows can be removed (M3).

The table is partitioned by ``bucket``, a hash of the symbol.  A purge reads and
rewrites only the buckets that hold rows of the given symbols (dynamic partition
overwrite); all other files stay as they are.  The rows that stay are first written
aside and committed by a marker, and the rewrite from there may be repeated, so a
purge that ends half-way is completed by the next call and loses nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.sources import tree

BUCKETS = 256
_PURGE = "_purge-"


def bucket(symbol: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def write_captured(rows: DataFrame, path: str, mode: str = "append", buckets: int = BUCKETS) -> None:
    """Rows with a ``symbol`` into the bucketed table; a bucket of many rows is split
    into files of the advised size, sorted by symbol so that readers skip row groups."""
    dealt = rows.withColumn("bucket", bucket("symbol", buckets)).hint("rebalance", "bucket")
    dealt.sortWithinPartitions("bucket", "symbol").write.mode(mode).partitionBy("bucket").parquet(path)


def read_captured(spark: SparkSession, path: str, symbols: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The captured rows; with ``symbols`` only theirs: other buckets are not read."""
    finish_purges(spark, path)
    rows = spark.read.parquet(path)
    if symbols is not None:
        of = spark.createDataFrame([(s,) for s in symbols], "symbol string").select(bucket("symbol", buckets)).distinct()
        rows = rows.where(F.col("bucket").isin([r[0] for r in of.collect()]) & F.col("symbol").isin(symbols))
    return rows.drop("bucket")


def purge_symbols(spark: SparkSession, path: str, symbols: DataFrame, buckets: int = BUCKETS) -> int:
    """Removes the rows of ``symbols`` (column ``symbol``) from the stored table; the
    number of buckets rewritten.  Bucket numbers, at most ``buckets``, reach the driver."""
    finish_purges(spark, path)
    gone = symbols.select(F.col("symbol").alias("_gone")).where("_gone IS NOT NULL").distinct()
    candidates = [r[0] for r in gone.select(bucket("_gone", buckets).alias("b")).distinct().collect()]
    held = spark.read.parquet(path).where(F.col("bucket").isin(candidates))
    touched = [r[0] for r in held.join(gone, F.col("symbol") == F.col("_gone"), "left_semi").select("bucket").distinct().collect()]
    if not touched:
        return 0
    kept = held.where(F.col("bucket").isin(touched)).join(gone, F.col("symbol") == F.col("_gone"), "left_anti")
    aside = f"{path.rstrip('/')}/{_PURGE}{uuid.uuid4().hex}"
    kept.write.parquet(f"{aside}/kept")
    spark.createDataFrame([(b,) for b in touched], "bucket int").write.parquet(f"{aside}/touched")
    tree.put_marker(spark, f"{aside}/committed")
    _apply(spark, path, aside)
    return len(touched)


def finish_purges(spark: SparkSession, path: str) -> None:
    """Ends purges that were committed but not applied."""
    for aside in tree.glob(spark, f"{path.rstrip('/')}/{_PURGE}*"):
        if tree.glob(spark, f"{aside}/committed"):
            _apply(spark, path, aside)


def _apply(spark: SparkSession, path: str, aside: str) -> None:
    kept = spark.read.parquet(f"{aside}/kept")
    dealt = kept.hint("rebalance", "bucket").sortWithinPartitions("bucket", "symbol")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    # A bucket without any row left is not among those written: its folder goes.
    left = {r[0] for r in kept.select("bucket").distinct().collect()}
    for b in (r[0] for r in spark.read.parquet(f"{aside}/touched").collect()):
        if b not in left:
            tree.remove(spark, f"{path.rstrip('/')}/bucket={b}")
    tree.remove(spark, aside)
