"""Row helpers that keep expensive derived columns computed once.

Catalyst pushes filters below the projections that feed them and, for
``explode``/``inline`` generators, infers a ``size(array) > 0`` filter and
pushes that down too.  In both cases the derivation of the filtered column
(regex clean-up, split, a higher-order function over the split) is inlined
into the predicate and evaluated again.  The ``_outer`` generators get no
inferred filter, and a predicate on a generator's output is never pushed
through the generator; these helpers use both facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARK = "_ff_kept"


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """``df.where(cond)`` evaluated above the projection that derives its
    inputs: each row becomes a 0/1-element array that is exploded."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns], F.lit(True).alias(_MARK))
    out = df.select(F.inline_outer(F.filter(F.array(row), lambda _: cond)))
    return out.where(F.col(_MARK).isNotNull()).drop(_MARK)


def explode_positions(df: DataFrame, array: Column, pos: str, value: str, keep: list[str]) -> DataFrame:
    """``posexplode`` without the inferred (and pushed-down) size filter; rows
    of empty or null arrays produce nothing, as with ``posexplode``."""
    out = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return out.where(F.col(pos).isNotNull())
