"""Positions of rows inside groups without putting a group into one task.

``row_number().over(Window.partitionBy(g).orderBy(o))`` moves every row of a
group into one task.  When one symbol owns a third of all rows that task is
the whole job.  :func:`ordered_index` numbers in two steps instead, the same
for every size of data:

1. rows are counted per (group, bucket), where ``bucket`` is a coarse value
   that never falls along the order (the page of a listing, the day of a
   time, a range of a key); the counts are combined map-side and a running sum
   over that small table gives the rows before each bucket;
2. ``row_number`` runs inside one (group, bucket), and the offset is joined on.

No job runs while the plan is built, nothing is written, and the largest task
is the largest bucket.  The order must be total (ties make the numbering
depend on the shuffle's arrival order), which every caller guarantees by
adding key columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_index(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rn",
    bucket: Column | str | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of the row in its ``by`` group.

    Without ``bucket`` a group is numbered by one task: only for groups that
    are small by their key (the lines of an order)."""
    by = list(by)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if bucket is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order_cols)).cast("bigint"))
    rows = df.withColumn("_ff_b", F.col(bucket) if isinstance(bucket, str) else bucket)
    before = Window.partitionBy(*by).orderBy(F.asc_nulls_first("_ff_b")).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*by, "_ff_b").agg(F.count(F.lit(1)).alias("_ff_cnt"))
    counts = counts.select(
        *[F.col(c).alias(f"_ff_s_{i}") for i, c in enumerate(by)],
        F.col("_ff_b").alias("_ff_sb"),
        F.coalesce(F.sum("_ff_cnt").over(before), F.lit(0)).alias("_ff_off"),
    )
    inside = Window.partitionBy(*by, "_ff_b").orderBy(*order_cols)
    cond = F.col("_ff_b").eqNullSafe(F.col("_ff_sb"))
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_ff_s_{i}"))
    joined = rows.withColumn("_ff_rn", F.row_number().over(inside)).join(counts, cond, "inner")
    out = joined.withColumn(name, (F.col("_ff_rn") + F.col("_ff_off")).cast("bigint"))
    return out.drop("_ff_b", "_ff_sb", "_ff_rn", "_ff_off", *[f"_ff_s_{i}" for i in range(len(by))])


def range_index(df: DataFrame, order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """Add ``name`` = 1-based position of the row in a total ``order`` of any types.

    Spark samples the order's values and deals the rows by ranges of about equal size
    (:meth:`DataFrame.repartitionByRange`), whatever the values look like; each range
    is sorted by one task.  The ranges are written, so that the rows before each range,
    a running sum over one number per range, belong to the same ranges."""
    from filingflow.session import new_work_dir

    spark = df.sparkSession
    keys = [F.asc_nulls_first(o) if isinstance(o, str) else o for o in order]
    path = new_work_dir(spark, "ranges")
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_ff_id", F.monotonically_increasing_id())
    dealt.write.mode("overwrite").parquet(path)
    ranges = spark.read.schema(dealt.schema).parquet(path).withColumn("_ff_part", F.shiftright("_ff_id", 33))
    counts = ranges.groupBy("_ff_part").agg(F.count(F.lit(1)).alias("_ff_cnt"), F.min("_ff_id").alias("_ff_first"))
    before = Window.orderBy("_ff_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_ff_part", (F.coalesce(F.sum("_ff_cnt").over(before), F.lit(0)) - F.col("_ff_first") + 1).alias("_ff_shift"))
    out = ranges.join(shift, "_ff_part").withColumn(name, F.col("_ff_id") + F.col("_ff_shift"))
    return out.drop("_ff_id", "_ff_part", "_ff_shift")


def first_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str], descending: bool = False
) -> DataFrame:
    """One row per key: the first (or last) under a total order.

    A row number of 1: Spark limits every group before the shuffle, so a hot
    key sends one row from each task.  Nulls are smallest either way.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    place = Window.partitionBy(*key).orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in order])
    ranked = df.withColumn("_ff_rn", F.row_number().over(place)).where(F.col("_ff_rn") == 1)
    return ranked.select(*key, *rest)
