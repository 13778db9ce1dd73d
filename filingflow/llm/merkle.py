"""Merkle dataset manifest with incremental witnesses (operator 12).

Rows are leaves.  In every group they are ordered by a key and hashed upwards in
runs of ``ARITY`` consecutive nodes until one node is left, the group's subroot;
the subroots, ordered by group, are hashed the same way into the root.

The leaves of a group are cut into aligned blocks of ``ARITY ** BLOCK_LEVELS``.
A task appends a block's leaves one after the other: every open subtree holds the
partial witnesses of its leaves, and when a run of siblings is complete, each
member's witnesses are extended by its siblings.  The roots of the blocks are then
the appends of the next round, and so on, so that a group of any size takes
log(size) / log(block) rounds and no task holds more than one block.  A leaf's
whole witness is its part in the block followed by its block's witness.

Defined results: a null value is hashed as ``-``; a null group is a group of its
own and the first one; rows with a null key come first in their group; rows with
equal group and key are ordered by their leaf; equal rows are leaves of their own
and share everything but the place; an empty table gives an empty result; a table
of one row has that leaf as root and the digest of nothing as proof.  Columns
beside the named ones are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import drop_work_table, work_table

#: Nodes of a run that are hashed together.
ARITY = 3
#: Levels of a block: 3 ** 8 = 6,561 leaves, about 3 MB of partial witnesses in a task.
BLOCK_LEVELS = 8
BLOCK = ARITY**BLOCK_LEVELS
DIGEST = 32


def leaf_digest(*columns: str) -> Column:
    """Lower-case hex SHA-256 of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def node(children: Sequence[bytes]) -> bytes:
    """Digest of a run: SHA-256 of the children's digests as hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


class Block:
    """Streaming append of up to ``BLOCK`` leaves, with a witness for each."""

    def __init__(self) -> None:
        self.witness: list[bytearray] = []
        #: Open subtrees of each level, oldest first: digest, first leaf, end.
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(BLOCK_LEVELS + 1)]

    def append(self, digest: bytes) -> None:
        self.open[0].append((digest, len(self.witness), len(self.witness) + 1))
        self.witness.append(bytearray())
        level = 0
        while level < BLOCK_LEVELS and len(self.open[level]) == ARITY:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        run = self.open[level]
        for k, (_, first, end) in enumerate(run):
            siblings = b"".join(d for j, (d, _, _) in enumerate(run) if j != k)
            if siblings:
                for i in range(first, end):
                    self.witness[i] += siblings
        self.open[level] = []
        self.open[level + 1].append((node([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def close(self, levels: int) -> bytes:
        """Completes the runs that have fewer members; the root ``levels`` above the leaves."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def height(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


def fold(leaf: bytes, witness: bytes, places: Sequence[tuple[int, int]]) -> tuple[bytes, int]:
    """(root, siblings used) from a leaf, its siblings level by level, and (place, number) in each tree."""
    at = 0
    for place, total in places:
        while total > 1:
            start = place - place % ARITY
            others = min(ARITY, total - start) - 1
            run = [witness[at + DIGEST * i : at + DIGEST * (i + 1)] for i in range(others)]
            run.insert(place - start, leaf)
            leaf, at = node(run), at + DIGEST * others
            place, total = place // ARITY, -(-total // ARITY)
    return leaf, at // DIGEST


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``_ff_pos`` (place in the group from 0) and ``_ff_total`` (size of the group).

    Rows are dealt by ranges of (group, order, number of the row), so that neither a
    large group nor many equal rows land in one task, and written; the places before
    a range come from a running sum over one row per range and group."""
    sorted_rows = rows.withColumn("_ff_tie", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first(c) for c in (group, *order, "_ff_tie")]
    sorted_rows = sorted_rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_ff_tie")
    table = work_table(sorted_rows.withColumn("_ff_id", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_ff_id", 33)
    counts = table.groupBy(group, part.alias("_ff_part")).agg(F.min("_ff_id").alias("_ff_first"), F.count(F.lit(1)).alias("_ff_n"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("_ff_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "_ff_part", (F.coalesce(F.sum("_ff_n").over(before), F.lit(0)) - F.col("_ff_first")).alias("_ff_shift"), F.sum("_ff_n").over(of_group).alias("_ff_total")
    )
    placed = table.withColumn("_ff_part", part).join(counts, [group, "_ff_part"])
    return placed.withColumn("_ff_pos", F.col("_ff_id") + F.col("_ff_shift")).drop("_ff_id", "_ff_part", "_ff_shift")


def _append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, place, total last) in order of group and place → the same with
    witness, and the block's root beside its last leaf."""
    block, held = Block(), []
    for batch in batches:
        first = 0
        pos, total = batch.column("_ff_pos").to_pylist(), batch.column("_ff_total").to_pylist()
        for i, digest in enumerate(batch.column("_ff_digest").to_pylist()):
            block.append(digest)
            if pos[i] + 1 == total[i] or (pos[i] + 1) % BLOCK == 0:
                root = block.close(height(total[i]) if total[i] <= BLOCK else BLOCK_LEVELS)
                rows = pa.Table.from_batches([*held, batch.slice(first, i + 1 - first)])
                n = rows.num_rows
                rows = rows.append_column("_ff_witness", pa.array([bytes(w) for w in block.witness], pa.binary()))
                rows = rows.append_column("_ff_root", pa.array([None] * (n - 1) + [root], pa.binary()))
                yield from rows.to_batches()
                block, held, first = Block(), [], i + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))


def _round(nodes: DataFrame, name: str) -> DataFrame:
    """One round of appends; the nodes of a block meet in one task, in order."""
    dealt = nodes.withColumn("_ff_block", F.expr(f"_ff_pos div {BLOCK}"))
    dealt = dealt.repartition("_ff_group", "_ff_block").sortWithinPartitions("_ff_group", "_ff_pos")
    schema = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes) + ", _ff_witness binary, _ff_root binary"
    return work_table(dealt.mapInArrow(_append, schema), name)


def _tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with their witness up to the group's root, group and root) of nodes
    with ``_ff_group, _ff_pos, _ff_total, _ff_digest`` and more columns."""
    most = nodes.agg(F.max("_ff_total")).first()[0] or 0
    rounds = [_round(nodes, "merkle-leaves")]
    while most > BLOCK:
        most = -(-most // BLOCK)
        roots = rounds[-1].where("_ff_root IS NOT NULL")
        total = F.expr(f"(_ff_total + {BLOCK - 1}) div {BLOCK}")
        roots = roots.select("_ff_group", F.col("_ff_block").alias("_ff_pos"), total.alias("_ff_total"), F.col("_ff_root").alias("_ff_digest"))
        rounds.append(_round(roots, "merkle-blocks"))
    last = rounds[-1].where("_ff_root IS NOT NULL").select("_ff_group", F.col("_ff_root").alias("_ff_subroot"))
    upper = rounds.pop()
    while rounds:
        above = upper.select("_ff_group", F.col("_ff_pos").alias("_ff_block"), F.col("_ff_witness").alias("_ff_above"))
        upper = rounds.pop().join(above, ["_ff_group", "_ff_block"])
        upper = upper.withColumn("_ff_witness", F.concat("_ff_witness", "_ff_above")).drop("_ff_above")
    return upper.drop("_ff_root", "_ff_block"), last


def manifest(rows: DataFrame, group: str, key: str, leaf: str, keep: Sequence[str] = ()) -> DataFrame:
    """Witness of every row of ``rows``, whose column ``leaf`` holds hex digests.

    Returns ``key``, the columns of ``keep``, ``leaf, subroot, root`` (lower-case hex),
    ``witness`` (binary: the siblings' digests level by level, leaf to root, left to
    right) and the leaf's ``place`` of ``group_rows`` and its group's ``group_place`` of
    ``groups``, from which :func:`verify` knows each level's run."""
    spark = rows.sparkSession
    # No group is null: a mark precedes the value, and the null group's empty text comes first.
    group_key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    keep = [c for c in keep if c != key]
    leaves = rows.select(group_key.alias("_ff_group"), F.col(key).alias("_ff_key"), F.unhex(leaf).alias("_ff_digest"), *[F.col(c).alias(f"_ff_k_{c}") for c in keep])
    leaves = work_table(leaves, "merkle-digests")
    order = ["_ff_key", "_ff_digest", *[f"_ff_k_{c}" for c in keep]]
    witnessed, subroots = _tree(numbered(leaves, "_ff_group", order))
    tops = subroots.select(F.lit("").alias("_ff_group"), F.col("_ff_group").alias("_ff_of"), F.col("_ff_subroot").alias("_ff_digest"))
    tops, root = _tree(numbered(tops, "_ff_group", ["_ff_of"]))
    root = root.first()
    tops = tops.select(
        F.col("_ff_of").alias("_ff_group"),
        F.col("_ff_digest").alias("_ff_subroot"),
        F.col("_ff_witness").alias("_ff_above"),
        F.col("_ff_pos").alias("_ff_group_place"),
        F.col("_ff_total").alias("_ff_groups"),
    )
    drop_work_table(spark, leaves)
    return witnessed.join(tops, "_ff_group").select(
        F.col("_ff_key").alias(key),
        *[F.col(f"_ff_k_{c}").alias(c) for c in keep],
        F.lower(F.hex("_ff_digest")).alias("leaf"),
        F.lower(F.hex("_ff_subroot")).alias("subroot"),
        F.lit(root["_ff_subroot"].hex() if root else None).cast("string").alias("root"),
        F.concat("_ff_witness", "_ff_above").alias("witness"),
        F.col("_ff_pos").alias("place"),
        F.col("_ff_total").alias("group_rows"),
        F.col("_ff_group_place").alias("group_place"),
        F.col("_ff_groups").alias("groups"),
    )


def verify(found: DataFrame, claimed: str = "leaf") -> DataFrame:
    """Rows of :func:`manifest` without their witness, with ``proof_sha256`` (of the
    siblings as hex text), ``folded_root`` (from the digest in column ``claimed``
    and the siblings) and ``verified`` (it equals ``root``)."""
    kept = [c for c in found.columns if c != "witness"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, roots = [], []
            cols = [batch.column(c).to_pylist() for c in (claimed, "witness", "place", "group_rows", "group_place", "groups")]
            for leaf, witness, place, total, group_place, groups in zip(*cols, strict=True):
                proofs.append(hashlib.sha256(witness.hex().encode()).hexdigest())
                folded, _ = fold(bytes.fromhex(leaf), witness, [(place, total), (group_place, groups)])
                roots.append(folded.hex())
            same = [a == b for a, b in zip(roots, batch.column("root").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(proofs, pa.string()), pa.array(roots, pa.string()), pa.array(same, pa.bool_())], names)

    names = [*kept, "proof_sha256", "folded_root", "verified"]
    kinds = dict(found.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", proof_sha256 string, folded_root string, verified boolean"
    return found.mapInArrow(run, schema)
