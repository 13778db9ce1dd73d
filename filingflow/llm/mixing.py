"""Mixing sources to target weights by temperature (operator 3).

A source's weight is its token share to the power ``alpha``, normalised.
``alpha`` is found by bisection so that the weights meet a target entropy, or
so that no source is repeated more than a limit.  The weights then become
token quotas of a budget, and each quota a run of block permutations: one
seeded shuffle of the whole source per pass, the last one cut where the quota
ends.

The table of sources stays in Spark: a round of the bisection is one
aggregation for many exponents at once, and only its sums reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import repeated, salted, work_table


@dataclass
class Temperature:
    alpha: float
    normaliser: float  #: sum of share ** alpha
    total: int  #: tokens of all sources
    budget: float  #: tokens to hand out


def solve(
    sources: DataFrame, entropy: float | None = None, repetition_limit: float | None = None, budget: float | None = None,
    points: int = 32, tolerance: float = 1e-9,
) -> Temperature | None:
    """Exponent for ``sources`` (column ``tokens``, positive), null for an empty table.

    ``entropy`` in nats (clipped to what exponents between 0 and 1 reach), or
    ``repetition_limit``: the smallest exponent whose most repeated source is
    passed at most that often; with neither, 1.  ``budget`` null: the smallest
    one that passes every source at least once."""
    first = sources.agg(F.sum("tokens").alias("t"), F.min("tokens").alias("a"), F.max("tokens").alias("b")).first()
    if first["t"] is None:
        return None
    total, small, large = int(first["t"]), first["a"] / first["t"], first["b"] / first["t"]
    share = F.col("tokens") / F.lit(float(total))

    def sums(alphas: list[float]) -> list[tuple[float, float]]:
        powers = [F.pow(share, F.lit(a)) for a in alphas]
        row = sources.agg(*[F.sum(p) for p in powers], *[F.sum(p * F.log(share)) for p in powers]).first()
        return list(zip(row[: len(alphas)], row[len(alphas) :], strict=True))

    def tokens(alpha: float, z: float) -> float:
        return budget if budget is not None else total * large ** (1 - alpha) * z

    def reached(alpha: float, z: float, s: float) -> bool:
        """Whether the goal still allows this exponent or asks for a smaller one."""
        if entropy is not None:
            return math.log(z) - alpha * s / z <= entropy
        return tokens(alpha, z) / total * small ** (alpha - 1) / z <= repetition_limit

    low, high = 0.0, 1.0
    if entropy is not None or repetition_limit is not None:
        if reached(0.0, *sums([0.0])[0]):
            high = 0.0
        while high - low > tolerance:
            grid = [low + (high - low) * i / points for i in range(1, points)]
            ok = [reached(a, z, s) for a, (z, s) in zip(grid, sums(grid), strict=True)]
            k = ok.index(True) if True in ok else len(grid)
            low, high = (grid[k - 1] if k else low), (grid[k] if k < len(grid) else high)
    z = sums([high])[0][0]
    return Temperature(high, z, total, tokens(high, z))


def word_tokens(text: Column) -> Column:
    """Words of a text and one token for its end; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\s]+")), F.lit(0)).cast("bigint") + 1


def mix(
    units: DataFrame, entropy: float | None = None, repetition_limit: float | None = None, budget: float | None = None,
    seed: int = 5, key: str = "doc_id", source: str = "source", tokens: str = "tokens", bucket_rows: int = 4096,
) -> DataFrame:
    """The mixture as rows ``key, source, tokens, weight, epoch, position, progress``.

    ``epoch`` numbers a source's passes, ``position`` a row's place in the
    pass (gapless from 0), ``progress`` is the share of the source's quota
    reached with it: sorted by progress, every stretch holds the weights.  The
    last pass takes rows of its permutation while they fit the quota.

    Rows of one key and source are one unit (their tokens add up), a null key
    or source is a value of its own, tokens must be positive, an empty table
    gives an empty mixture, and other columns of ``units`` are ignored.  No
    window holds a source: a pass is dealt into hash buckets of about
    ``bucket_rows`` and the running sums before a bucket are added."""
    rows = units.select(F.col(key).alias("_ff_key"), F.col(source).alias("_ff_source"), F.col(tokens).cast("bigint").alias("_ff_tokens"))
    rows = work_table(rows.groupBy("_ff_key", "_ff_source").agg(F.sum("_ff_tokens").alias("_ff_tokens")), "mixing")
    sources = rows.groupBy("_ff_source").agg(F.sum("_ff_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sources = work_table(sources, "mixing")
    t = solve(sources, entropy, repetition_limit, budget) or Temperature(1.0, 1.0, 1, 1.0)

    weight = F.pow(F.col("tokens") / F.lit(float(t.total)), F.lit(t.alpha)) / F.lit(t.normaliser)
    # A quota within a millionth of a token of a whole number is that number.
    quota = F.floor(F.col("weight") * F.lit(t.budget) + 1e-6)
    if budget is None:  # every source is passed once, also where the product falls short by rounding
        quota = F.greatest(F.col("tokens"), quota)
    quotas = sources.withColumn("weight", weight).withColumn("quota", quota)
    quotas = quotas.select(
        F.col("_ff_source").alias("_ff_s"), "weight", "quota", F.col("tokens").alias("_ff_total"),
        F.expr("quota div tokens").alias("passes"), F.expr("quota % tokens").alias("rest"), F.ceil(F.col("rows") / bucket_rows).alias("buckets"),
    )
    rows, quotas = salted(rows, quotas, "_ff_key")
    joined = rows.join(quotas.withColumnRenamed("_ff_salt", "_ff_q"), F.col("_ff_source").eqNullSafe(F.col("_ff_s")) & (F.col("_ff_salt") == F.col("_ff_q")))
    last = F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)
    passes = repeated(joined.withColumn("epoch", last + 1).where("epoch > 0"), "epoch")
    passes = passes.withColumn("draw", _draw(seed, "epoch", "_ff_key")).withColumn("bucket", F.floor(F.col("draw") * F.col("buckets")))

    group = ["_ff_source", "epoch"]
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = passes.groupBy(*group, "bucket").agg(F.sum("_ff_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    sums = sums.select(
        F.col("_ff_source").alias("o_source"), F.col("epoch").alias("o_epoch"), F.col("bucket").alias("o_bucket"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("o_tokens"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o_rows"),
    )
    inside = Window.partitionBy(*group, "bucket").orderBy("draw", "_ff_key")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = passes.withColumns({"own_tokens": F.sum("_ff_tokens").over(so_far), "own_rows": F.row_number().over(inside)})
    same = F.col("_ff_source").eqNullSafe(F.col("o_source")) & (F.col("epoch") == F.col("o_epoch")) & (F.col("bucket") == F.col("o_bucket"))
    placed = placed.join(sums, same).withColumn("reached", F.col("o_tokens") + F.col("own_tokens"))
    placed = placed.where((F.col("epoch") < F.col("passes")) | (F.col("reached") <= F.col("rest")))
    return placed.select(
        F.col("_ff_key").alias(key), F.col("_ff_source").alias(source), F.col("_ff_tokens").alias(tokens), "weight", "epoch",
        (F.col("o_rows") + F.col("own_rows") - 1).cast("bigint").alias("position"),
        ((F.col("epoch") * F.col("_ff_total") + F.col("reached")) / F.col("quota")).alias("progress"),
    )


def _draw(seed: int, epoch: str, key: str) -> Column:
    """Place of a key in a pass, in [0, 1)."""
    return F.xxhash64(F.lit(seed), F.col(epoch), F.col(key)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def realise(docs: DataFrame, mixture: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 5) -> DataFrame:
    """``docs`` with every row as often as the mixture holds its key and source.

    A source's passes before the last are whole, and the last one takes the rows up
    to a place in its permutation.  So one row for each source, its last pass and the
    place reached, says how often a document comes: no text is shuffled by its key.
    ``seed`` is that of :func:`mix`; sources that the mixture lacks have no rows."""
    held = mixture.select(F.col(source).alias("_ff_s"), F.col("epoch").alias("_ff_epoch"), F.col(key).alias("_ff_key"))
    place = F.struct("_ff_epoch", _draw(seed, "_ff_epoch", "_ff_key").alias("_ff_draw"), "_ff_key")
    reached = work_table(held.groupBy("_ff_s").agg(F.max(place).alias("_ff_last")), "mixing").select("_ff_s", "_ff_last", "_ff_last._ff_epoch")
    rows, reached = salted(docs, reached, key)
    same = F.col(source).eqNullSafe(F.col("_ff_s")) & (rows["_ff_salt"] == F.col("_ff_q"))
    rows = rows.join(reached.withColumnRenamed("_ff_salt", "_ff_q"), same)
    own = F.struct("_ff_epoch", _draw(seed, "_ff_epoch", key), F.col(key))
    rows = rows.withColumn("_ff_times", F.col("_ff_epoch") + (own <= F.col("_ff_last")).cast("bigint"))
    return repeated(rows.where("_ff_times > 0"), "_ff_times").select(docs.columns)
