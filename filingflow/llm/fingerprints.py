"""Document fingerprints by consistent weighted sampling (operator 4).

A text is a bag of words weighted by their counts.  Each of the ``samples``
draws gives every term two Gamma(2, 1) variables ``r`` and ``c`` and a uniform
``b``, all functions of the term and the draw only; with weight ``w``,
``t = floor(ln w / r + b)`` and the term with the least
``c * exp(-r * (t - b + 1))`` is drawn together with its ``t``.  Two texts
agree in a draw with probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones.

Everything is DataFrame code.  A draw's minimum is one hash aggregation over
longs: the upper half of a long is the ordered logarithm of the value, the
lower half a hash of (term, t), which is the draw's entry in the fingerprint.
Documents are dealt by ranges of their key, once; counting words, drawing, and
looking at the next document all stay inside that partitioning, and only the
first document of each range is sent to the range before.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import repeated, work_table

_LOW = (1 << 32) - 1


def _uniform(bits: Column) -> Column:
    """A number in (0, 1] from the lower 32 bits."""
    return (bits.bitwiseAND(F.lit(_LOW)) + 1) / F.lit(float(1 << 32))


def draw_key(term: Column, log_weight: Column, d: int) -> Column:
    one, two, three = (F.xxhash64(term, F.lit(3 * d + i)) for i in range(3))
    # the smallest of the variables is kept above zero: -ln(1) would be 0
    r = F.lit(1e-9) - F.log(_uniform(one) * _uniform(F.shiftrightunsigned(one, 32)))
    c = F.lit(1e-9) - F.log(_uniform(two) * _uniform(F.shiftrightunsigned(two, 32)))
    b = _uniform(three)
    t = F.floor(log_weight / r + b)
    order = F.floor((F.log(c) - r * (t - b + 1.0) + F.lit(2048.0)) * F.lit(float(1 << 19)))
    entry = F.xxhash64(term, t, F.lit(d)).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(F.greatest(F.least(order, F.lit((1 << 31) - 1)), F.lit(0)), 32).bitwiseOR(entry)


def signatures(texts: DataFrame, by: list[str], text: str = "text", samples: int = 32) -> DataFrame:
    """``by`` and ``signature`` (array of longs below 2**32, one per draw) of
    the rows whose text has a word; ``by`` must name each row.

    Partitioned by a subset of ``by``, the rows are not shuffled."""
    words = texts.select(*by, F.explode(F.split(F.col(text), r"[\x20\x09-\x0D]+")).alias("_ff_word"))
    words = words.where("_ff_word <> ''").select(*by, F.xxhash64("_ff_word").alias("_ff_term"))
    bags = words.groupBy(*by, "_ff_term").agg(F.log(F.count(F.lit(1)).cast("double")).alias("_ff_w"))
    least = [F.min(draw_key(F.col("_ff_term"), F.col("_ff_w"), d)).alias(f"_ff_d{d}") for d in range(samples)]
    entries = [F.col(f"_ff_d{d}").bitwiseAND(F.lit(_LOW)) for d in range(samples)]
    return bags.groupBy(*by).agg(*least).select(*by, F.array(*entries).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; two texts without words are alike, one alone is
    unlike any other."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal).cast("double")


def to_string(signature: Column, samples: int) -> Column:
    """Eight hex digits per draw; a text without words has blanks of 'f'."""
    digits = F.transform(signature, lambda e: F.lpad(F.lower(F.hex(e)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit("f" * 8 * samples))


def half_replaced(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by as many, or all, of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(
    docs: DataFrame, edit: Callable[[Column, Column], Column] = half_replaced, samples: int = 32, key: str = "doc_id",
    text: str = "text", range_rows: int = 500,
) -> DataFrame:
    """One row per document: ``key, n_chars, edited_sha256, signature,
    edited_signature, next_signature`` (null without words).

    ``edit`` makes a second text of a document's and the next one's, in
    descending order of the key (after the last comes the first; null keys are
    last, rows with equal keys follow the hashes of their texts, equal rows are
    interchangeable).  A null text is empty; an empty table gives an empty
    result; other columns are ignored.  A document that is alone follows
    itself.

    A key of more than ``range_rows`` rows has ranges of its own, by the hash
    of the text; more copies of a row than that are two rows, of which the
    first stands for all but the last."""
    rows = docs.select(F.col(key).alias("_ff_key"), F.coalesce(text, F.lit("")).alias("_ff_text")).withColumn("_ff_th", F.xxhash64("_ff_text"))
    many = rows.groupBy("_ff_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > range_rows)
    many = {r["_ff_key"]: r["n"] for r in many.collect()}
    times = F.lit(1).cast("bigint").alias("_ff_times")
    if many:
        copies = rows.groupBy(F.col("_ff_key").alias("c_key"), F.col("_ff_th").alias("c_th")).agg(F.count(F.lit(1)).alias("n"))
        copies = work_table(copies.where(F.col("n") > range_rows), "copies")
        same = F.col("_ff_key").eqNullSafe(F.col("c_key")) & (F.col("_ff_th") == F.col("c_th"))
        two = rows.join(F.broadcast(copies), same).groupBy("_ff_key", "_ff_th", "n").agg(F.min("_ff_text").alias("_ff_text"))
        two = two.select("_ff_key", "_ff_text", "_ff_th", F.explode(F.array(F.col("n") - 1, F.lit(1).cast("bigint"))).alias("_ff_times"))
        rows = rows.join(F.broadcast(copies), same, "left_anti").withColumn("_ff_times", times).unionByName(two)
    else:
        rows = rows.withColumn("_ff_times", times)
    parts = {k: -(-n // range_rows) for k, n in many.items()}
    bounds = sorted({*_key_bounds(rows.select("_ff_key"), range_rows), *(k for k in parts if k is not None)}, reverse=True)
    rows = rows.withColumn("_ff_range", _place(F.col("_ff_key"), bounds, F.col("_ff_th"), parts))

    # The first document of every range; the range's largest key is one row per range.
    order = [F.desc_nulls_last("_ff_key"), F.col("_ff_th"), F.col("_ff_text"), F.desc("_ff_times")]
    tops = rows.groupBy("_ff_range").agg(F.max("_ff_key").alias("t_key")).withColumnRenamed("_ff_range", "t_range")
    top = (F.col("_ff_range") == F.col("t_range")) & F.col("_ff_key").eqNullSafe(F.col("t_key"))
    first = rows.join(F.broadcast(tops), top).groupBy("_ff_range").agg(F.min(F.struct("_ff_th", "_ff_text"))["_ff_text"].alias("h_text"))
    first = work_table(first, "heads")
    first = first.join(signatures(first, ["_ff_range"], "h_text", samples), "_ff_range", "left")
    # Range numbers only go through one window; the last range is followed by the first.
    follows = Window.orderBy("_ff_range")
    whole = follows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("_ff_range").over(follows), F.min("_ff_range").over(whole))
    heads = first.select("_ff_range").withColumn("h_range", after).join(
        first.select(F.col("_ff_range").alias("h_range"), "h_text", F.col("signature").alias("h_signature")), "h_range"
    )
    heads = work_table(heads.drop("h_range"), "heads")

    # Two ranges to a partition: its bags of words fit in the memory of a task.
    ranges = len(bounds) + sum(parts.values())
    inside = Window.partitionBy("_ff_range").orderBy(*order)
    numbered = rows.repartition(ranges // 2 + 1, "_ff_range")
    numbered = numbered.withColumns({"_ff_row": F.row_number().over(inside), "_ff_next": F.lead("_ff_text").over(inside)})
    numbered = numbered.join(heads.select("_ff_range", "h_text"), "_ff_range")
    following = F.coalesce("_ff_next", "h_text")
    edited = numbered.withColumn("_ff_edited", edit(F.col("_ff_text"), following))
    both = edited.select("_ff_range", "_ff_row", F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("_ff_text").alias("s")), F.struct(F.lit(1).alias("v"), F.col("_ff_edited").alias("s")))).alias("x"))
    both = both.select("_ff_range", "_ff_row", F.col("x.v").alias("_ff_v"), F.col("x.s").alias("_ff_s"))
    drawn = signatures(both, ["_ff_range", "_ff_row", "_ff_v"], "_ff_s", samples)
    facts = edited.select("_ff_range", "_ff_row", F.lit(2).alias("_ff_v"), "_ff_times", F.col("_ff_key").alias(key), F.length("_ff_text").cast("long").alias("n_chars"), F.sha2("_ff_edited", 256).alias("edited_sha256"))
    # One job for both: the texts are shuffled once.
    found = work_table(drawn.unionByName(facts, allowMissingColumns=True), "signatures")
    keys = ["_ff_range", "_ff_row"]
    facts = found.where("_ff_v = 2").select(*keys, "_ff_times", key, "n_chars", "edited_sha256")
    own = found.where("_ff_v = 0").select(*keys, "signature")
    other = found.where("_ff_v = 1").select(*keys, F.col("signature").alias("edited_signature"))
    joined = facts.join(own, keys, "left").join(other, keys, "left").join(heads.select("_ff_range", "h_signature"), "_ff_range")
    following = Window.partitionBy("_ff_range").orderBy("_ff_row")
    is_last = F.lead("_ff_row").over(following).isNull()
    after = F.when(is_last, F.col("h_signature")).otherwise(F.lead("signature").over(following))
    names = [key, "n_chars", "edited_sha256", "signature", "edited_signature"]
    result = joined.select(*names, after.alias("next_signature"), "_ff_times")
    return (repeated(work_table(result, "signatures"), "_ff_times") if many else result).drop("_ff_times")


def _key_bounds(keys: DataFrame, range_rows: int) -> list:
    """Descending keys that cut the table into ranges of about ``range_rows``
    rows, a million at most, from a sample of a million keys.  They balance the
    work; results do not depend on them."""
    n = keys.agg(F.count("_ff_key")).first()[0]
    parts = min(1_000_000, -(-n // range_rows))
    if parts < 2:
        return []
    sample = keys.where("_ff_key IS NOT NULL").sample(min(1.0, 1e6 / n), 1)
    found = sample.agg(F.percentile_approx("_ff_key", [i / parts for i in range(1, parts)], 100_000)).first()[0]
    return sorted(set(found or []), reverse=True)


def _place(key: Column, bounds: list, text_hash: Column, parts: dict) -> Column:
    """Number of the range: that of descending ``bounds`` above the key, null
    keys last, and behind it the number of the part by ``text_hash`` for the
    keys of ``parts``, which are bounds or null."""
    place = _above(key, bounds)
    if not parts:
        return place
    step = math.isqrt(len(bounds)) + 1

    def at(values: list, kind: str) -> Column:
        chunks = F.array(*[F.array(*map(F.lit, values[i : i + step])) for i in range(0, len(values), step)])
        return F.get(F.get(chunks, F.floor(place / step).cast("int")), (place % step).cast("int")).cast(kind)

    n = F.when(key.isNull(), parts.get(None, 0))
    if bounds:
        n = n.when(at(bounds, "string") == key.cast("string"), at([parts.get(b, 0) for b in bounds], "int"))
    part = F.floor((text_hash / F.lit(float(1 << 64)) + 0.5) * n) + 1
    return F.shiftleft(place.cast("bigint"), 32) + F.when(n > 0, part).otherwise(0)


def _above(key: Column, bounds: list) -> Column:
    """Number of descending ``bounds`` above the key, looked up in two steps;
    null keys come last."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    above = lambda values: F.size(F.filter(values, lambda b: b > key))
    chunk = above(F.array(*[F.lit(c[0]) for c in chunks])) - 1
    inside = F.array(*[F.array(*map(F.lit, c)) for c in chunks])[F.greatest(chunk, F.lit(0))]
    place = F.when(chunk < 0, 0).otherwise(chunk * step + above(inside))
    return F.when(key.isNull(), len(bounds)).otherwise(place).cast("int")
