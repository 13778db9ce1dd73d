"""Fixed-size work batches in list order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingflow.operators.ordering import ordered_index, range_index

BATCH_SIZE = 20
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def assign_batches(df: DataFrame, order: Sequence[str], size: int = BATCH_SIZE, bucket: Column | None = None) -> DataFrame:
    """``batch`` = floor(position / size) under a total ``order``.

    Rows are numbered range by range, never by one task.  A first key of an integer
    type is cut into ranges of 10,000 values; for any other the ranges come from a
    sample of the list itself (names that share their first characters, as URLs do,
    still give many ranges).  ``bucket`` names the ranges explicitly."""
    if bucket is None and dict(df.dtypes)[order[0]] not in INTEGERS:
        numbered = range_index(df, list(order), "_w2_rn")
    else:
        bucket = F.floor(F.col(order[0]) / 10_000) if bucket is None else bucket
        numbered = ordered_index(df, [], list(order), "_w2_rn", bucket=bucket)
    return numbered.withColumn("batch", F.floor((F.col("_w2_rn") - 1) / size).cast("bigint")).drop("_w2_rn")
