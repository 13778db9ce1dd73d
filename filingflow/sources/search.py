"""Stored submissions that a search reads only in part.

``rows`` holds the submissions with typed columns, partitioned by a hash of the
symbol and sorted by symbol and time inside the files, with a Parquet bloom filter on
the symbol.  ``grams`` holds, for every distinct symbol, its substrings of one to three
characters, partitioned by a hash of the substring.

* One symbol: its bucket is a partition filter; symbol and time are pushed to the
  Parquet scan, which skips row groups by their statistics and bloom filters.
* A part of a symbol: the symbols that hold all its three-character parts come from
  the grams' buckets, are compared with the text itself, and meet the rows by bucket
  and symbol, so that Spark prunes the rows' partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.operators.listing import search_listing
from filingflow.sources.buckets import BUCKETS, bucket

GRAM = 3


def grams(c: Column | str, longest: int = GRAM) -> Column:
    """Distinct substrings of one to ``longest`` characters."""
    c = F.col(c) if isinstance(c, str) else c
    of = lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, F.lit(n))))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(of(n), none) for n in range(1, longest + 1)]))


def _write(rows: DataFrame, path: str, key: str, order: list[str], mode: str) -> None:
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order)
    dealt.write.mode(mode).partitionBy("bucket").option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)


def write_search_table(rows: DataFrame, path: str, symbol: str = "symbol", time: str = "submitted_at", mode: str = "append", buckets: int = BUCKETS) -> None:
    """Submissions into the stored form.  Symbols that were held before may be in the
    grams twice; searches count each once."""
    held = rows.withColumn("bucket", bucket(symbol, buckets))
    _write(held, f"{path}/rows", symbol, [symbol, time], mode)
    parts = rows.select(F.col(symbol).alias("symbol")).distinct().select("symbol", F.explode(grams("symbol")).alias("gram"))
    _write(parts.withColumn("bucket", bucket("gram", buckets)), f"{path}/grams", "gram", ["gram", "symbol"], mode)


def symbols_containing(spark: SparkSession, path: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(symbol) of the stored symbols that contain a text of one character or more."""
    wanted = sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)} or {text})
    of = spark.range(1).select(*[bucket(F.lit(g), buckets) for g in wanted]).first()
    found = spark.read.parquet(f"{path}/grams").where(F.col("bucket").isin([*set(of)]) & F.col("gram").isin(wanted))
    found = found.groupBy("symbol").agg(F.count_distinct("gram").alias("n"))
    return found.where((F.col("n") == len(wanted)) & F.col("symbol").contains(text)).select("symbol")


def search_stored(
    spark: SparkSession,
    path: str,
    symbol: str | None = None,
    symbol_contains: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    symbol_col: str = "symbol",
    time_col: str = "submitted_at",
    buckets: int = BUCKETS,
) -> DataFrame:
    """:func:`filingflow.operators.listing.search_listing` on the stored table."""
    rows = spark.read.parquet(f"{path}/rows")
    if symbol is not None:
        of = spark.range(1).select(bucket(F.lit(symbol), buckets)).first()[0]
        rows = rows.where(F.col("bucket") == of)
    if symbol_contains:
        found = symbols_containing(spark, path, symbol_contains, buckets)
        found = found.select(F.col("symbol").alias(symbol_col), bucket("symbol", buckets).alias("bucket"))
        rows = rows.join(found, ["bucket", symbol_col], "left_semi")
    return search_listing(rows, symbol, symbol_contains, date_from, date_to, symbol_col, time_col).drop("bucket")
