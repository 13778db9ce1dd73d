"""Sharding by proportional stratified interleaving (operator 1).

Rows are shuffled by a seeded hash inside their source, a row's fractional
rank is ``(rank + u) / rows of the source``, all rows are ordered by
fractional rank and the order is cut into equal counts: every shard holds
every source in the mixture's proportion, and shard sizes differ by at most
one row.  The offset ``u`` is a source's own fractional rank, in seeded order,
among the sources with as many rows up to a factor of two: sources of a long
tail spread evenly over all shards, and one that is alone has 0.5.

Ranks never need one task for a source or for the table.  A hash is uniform,
so ``floor(hash * buckets of the source)`` deals the rows of any source, a hot
one too, into ordered buckets of about ``bucket_rows``; a bucket's offset is a
running sum over the small table of bucket counts and the rank inside a bucket
a window over one bucket.  The fractional rank is uniform in the same way, so
the second ordering is done alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import repeated, salted, work_table


def _offsets(buckets: DataFrame, by: Sequence[str], bucket: str, name: str) -> DataFrame:
    """Rows before each bucket, from the table of bucket counts."""
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = buckets.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("_ff_rows"))
    return counts.select(*by, bucket, F.coalesce(F.sum("_ff_rows").over(before), F.lit(0)).alias(name))


def _source_offsets(sources: DataFrame, seed: int, bucket_rows: int) -> DataFrame:
    """``sources`` (``_ff_src, _ff_n``) with the offset ``_ff_at`` in (0, 1).

    Sources of one size class (``_ff_n`` in binary digits) are dealt by a
    seeded hash into ordered buckets, as the rows of a source are."""
    rows = sources.withColumn("_ff_class", F.length(F.bin("_ff_n")))
    rows = rows.withColumn("_ff_h", F.xxhash64(F.lit(seed), F.lit("source"), "_ff_src").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    classes = rows.groupBy("_ff_class").agg(F.count(F.lit(1)).alias("_ff_m"))
    rows, classes = salted(rows, classes, "_ff_src")
    rows = rows.join(classes, ["_ff_class", "_ff_salt"]).drop("_ff_salt")
    rows = rows.withColumn("_ff_b", F.floor(F.col("_ff_h") * F.ceil(F.col("_ff_m") / bucket_rows)))
    offsets = _offsets(rows.select("_ff_class", "_ff_b"), ["_ff_class"], "_ff_b", "_ff_off")
    inside = Window.partitionBy("_ff_class", "_ff_b").orderBy("_ff_h", "_ff_src")
    ranked = rows.withColumn("_ff_r", F.row_number().over(inside)).join(offsets, ["_ff_class", "_ff_b"])
    return ranked.select("_ff_src", "_ff_n", ((F.col("_ff_off") + F.col("_ff_r") - 0.5) / F.col("_ff_m")).alias("_ff_at"))


def interleave_shards(
    df: DataFrame,
    shards: int = 16,
    seed: int = 17,
    key: Sequence[str] = ("doc_id",),
    source: str = "source",
    bucket_rows: int = 4096,
) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in a shard).

    Only the columns of ``df`` travel; pass sizes and checksums rather than
    texts when an assignment table is enough.  A null source is a source of
    its own, a null key is an ordinary value, rows that tie in every column are
    interchangeable, an empty table gives an empty result, and input columns
    named like the two results are replaced.  Names starting with ``_ff_`` are
    reserved.

    The hash is of the ``key``, the other columns and the number of the row
    among equal ones, so that rows of one key spread as others do."""
    df = df.drop("shard", "slot")
    own = df.columns
    rows = repeated(df.groupBy(*own).agg(F.count(F.lit(1)).alias("_ff_copy")), "_ff_copy", bucket_rows)
    rows = rows.withColumn("_ff_src", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
    whole = [*key, *[c for c in own if c not in key], "_ff_copy"]
    rows = rows.withColumn("_ff_u", F.xxhash64(F.lit(seed), *whole).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    rows = work_table(rows, "shards")
    sources = work_table(rows.groupBy("_ff_src").agg(F.count(F.lit(1)).alias("_ff_n")), "shards")
    sources = _source_offsets(sources, seed, bucket_rows)
    rows, sources = salted(rows, sources, *whole)
    rows = rows.join(sources, ["_ff_src", "_ff_salt"])
    rows = rows.withColumn("_ff_b", F.floor(F.col("_ff_u") * F.ceil(F.col("_ff_n") / bucket_rows)))

    # The counting branch reads the hash and the source only.
    offsets = _offsets(rows.select("_ff_src", "_ff_b"), ["_ff_src"], "_ff_b", "_ff_off")
    inside = Window.partitionBy("_ff_src", "_ff_b").orderBy("_ff_u", *[c for c in own])
    ranked = rows.withColumn("_ff_r", F.row_number().over(inside)).join(offsets, ["_ff_src", "_ff_b"])
    ranked = ranked.withColumn("_ff_frac", (F.col("_ff_off") + F.col("_ff_r") - 1 + F.col("_ff_at")) / F.col("_ff_n"))
    ranked = work_table(ranked.select(*own, "_ff_src", "_ff_frac"), "shards")

    # A scalar subquery over per-source counts, not a job of its own.
    total: Column = ranked.agg(F.count(F.lit(1))).scalar()
    ranked = ranked.withColumn("_ff_n", total)
    ranked = ranked.withColumn("_ff_g", F.floor(F.col("_ff_frac") * F.ceil(F.col("_ff_n") / bucket_rows)))
    offsets = _offsets(ranked.select("_ff_g"), [], "_ff_g", "_ff_off")
    inside = Window.partitionBy("_ff_g").orderBy("_ff_frac", "_ff_src")
    placed = ranked.withColumn("_ff_r", F.row_number().over(inside)).join(offsets, "_ff_g")
    placed = placed.withColumn("_ff_pos", F.col("_ff_off") + F.col("_ff_r") - 1)
    placed = placed.withColumn("shard", F.expr(f"_ff_pos * {shards} div _ff_n").cast("int"))
    return placed.select(
        *own, "shard", F.expr(f"_ff_pos - (shard * _ff_n + {shards - 1}) div {shards}").cast("bigint").alias("slot")
    )
