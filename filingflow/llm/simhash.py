"""SimHash near-dedup with BK-trees (operator 6).

Fingerprints that differ in at most ``d`` bits agree in at least two of
``d + 2`` blocks of bits, so every link lies inside a shard of fingerprints
that agree in two blocks.  A shard's BK-tree (children keyed by the integer
Hamming distance to their parent) is built in the task that holds the shard
and searched with the shard's fingerprints, following only edges within the
radius.  The trees together hold all fingerprints, so they have no size bound
and are not broadcast: trees and queries meet by a shuffle on the shard.  A
shard of more than ``shard_rows`` fingerprints is cut into parts, and every
pair of parts is a tree and its queries in a task of its own.  A task returns
a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import connected_components, lean, star_forest, text_batches, work_table

_BITS = 64


def text_fingerprint(data: bytes, words_per_shingle: int) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number."""
    words = data.lower().split()  # bytes: A-Z only, and blanks 0x20, 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        first = [0, *ends[: -words_per_shingle].tolist()]
        last = (ends[words_per_shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last, strict=True)), np.uint64, len(first))
    ones = np.zeros(_BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_id, fp): the SimHash of every whole text (``text_id``: a hash
    that names the text); null texts have no words."""

    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = [text_fingerprint(t.as_py() or b"", words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], [key, "text_id", "fp"])

    rows = docs.select(key, _text_id(text).alias("text_id"), text)
    return rows.mapInArrow(lean(run), f"`{key}` {dict(docs.dtypes)[key]}, text_id long, fp long")


def _text_id(text: str) -> Column:
    return F.xxhash64(F.col(text))


def block_edges(max_bits: int) -> list[tuple[int, int]]:
    """Bit ranges of the ``max_bits + 2`` blocks."""
    cut = [round(i * _BITS / (max_bits + 2)) for i in range(max_bits + 3)]
    return list(zip(cut, cut[1:]))


def shard_keys(fp: Column, max_bits: int) -> Column:
    """For every pair of blocks: the pair's number and the two blocks' bits."""
    blocks = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in block_edges(max_bits)]
    pairs = list(combinations(range(max_bits + 2), 2))
    return F.array(*[F.struct(F.lit(k).alias("pair"), F.shiftleft(blocks[i], 32).bitwiseOR(blocks[j]).alias("bits")) for k, (i, j) in enumerate(pairs)])


class BKForest:
    """BK-trees of several groups at once, as arrays; all steps are vectorised
    over the nodes or the (query, node) pairs of a level."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        _, root, group = np.unique(group, return_index=True, return_inverse=True)
        self.root = root  # node of each group
        at = root[group]  # where each node stands on its way down
        todo = np.flatnonzero(at != np.arange(len(fps)))
        edges, child = [], []
        while len(todo):
            # a node goes to the child at its distance; the first to come becomes that child
            key = at[todo] * (_BITS + 1) + np.bitwise_count(fps[todo] ^ fps[at[todo]])
            slot, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            edges.append(slot)
            child.append(todo[first])
            at[todo] = todo[first][inverse]
            todo = todo[at[todo] != todo]
        self.edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.child = np.concatenate(child) if child else np.empty(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.child = self.edges[order], self.child[order]

    def search(self, queries: np.ndarray, start: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, node) pairs within the radius, level by level;
        ``start`` is each query's root."""
        q, node = np.arange(len(queries)), start
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            low = np.searchsorted(self.edges, node * (_BITS + 1) + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.edges, node * (_BITS + 1) + np.minimum(d + radius, _BITS), "right")
            n = high - low
            q = np.repeat(q, n)
            node = self.child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(q))]


def _shard_links(shard: np.ndarray, fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest (fp, fp) of the links in whole shards; side 0: tree and queries, 1: tree only, 2: queries only."""
    tree, ask = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    fps = fp.view(np.uint64)
    forest = BKForest(fps[tree], shard[tree])
    groups = np.unique(shard[tree])
    ask = ask[np.isin(shard[ask], groups)]
    values, name = np.unique(fp, return_inverse=True)
    label = np.arange(len(values))
    # Shards of one tree have all its nodes as queries; a chunk bounds the pairs that are open at once.
    for at in range(0, len(ask), 2048):
        part = ask[at : at + 2048]
        start = forest.root[np.searchsorted(groups, shard[part])]
        for q, node in forest.search(fps[part], start, radius):
            u, v = label[name[part[q]]], label[name[tree[node]]]
            label = star_forest(len(values), u, v)[label]
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def fingerprint_links(fps: DataFrame, max_bits: int = 4, shard_rows: int = 8192) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (column ``fp``,
    distinct) which a chain of pairs with ``max_bits`` or fewer differing bits
    connects."""
    rows = fps.select("fp", F.explode(shard_keys(F.col("fp"), max_bits)).alias("_s")).select("fp", "_s.pair", "_s.bits")
    sizes = rows.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["pair", "bits"]).withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int"))
    rows = rows.withColumn("part", F.expr("int(pmod(xxhash64(fp), parts))"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    rows = rows.select(
        F.xxhash64("pair", "bits", F.least("part", "other"), F.greatest("part", "other")).alias("shard"),
        "fp",
        F.expr("int(CASE WHEN part = other THEN 0 WHEN part < other THEN 1 ELSE 2 END)").alias("side"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty((3, 0), np.int64)]

        def links(rows: np.ndarray) -> pa.RecordBatch:
            a, b = _shard_links(rows[0], np.ascontiguousarray(rows[1]), rows[2], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(h.shape[1] for h in held) >= 100_000:
                rows = np.concatenate(held, axis=1)
                whole = np.searchsorted(rows[0], rows[0, -1])  # the last shard may go on
                if whole:
                    yield links(rows[:, :whole])
                held = [rows[:, whole:]]
        yield links(np.concatenate(held, axis=1))

    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(lean(run), "a long, b long")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, text_id, fp, component, component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; ``component_id`` is the smallest key that links reach, the
    document's own included, and ``component`` the smallest fingerprint, which
    names the group also where keys are null or repeat.  A null key takes part
    and never is a component's name unless no member has a key (then null);
    null texts and texts without words have fingerprint 0 and are linked like
    others; an empty table gives an empty result; repeated rows stay rows."""
    rows = work_table(fingerprints(docs, words_per_shingle, key, text), "simhash")
    distinct = work_table(rows.groupBy("fp").agg(F.min(key).alias("first")), "simhash")
    found = connected_components(fingerprint_links(distinct, max_bits), "a", "b")
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.select("fp", "component").join(names, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp").select(key, "text_id", "fp", "component", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, components: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for every component of :func:`near_duplicates`: the
    one with the key that names it; among rows that share this key (or have
    none, in a component without keys) the text with the smallest hash.  The
    columns of ``docs`` are unchanged."""
    named = components.where(F.col(key).eqNullSafe(F.col("component_id")))
    kept = named.groupBy("component").agg(F.min(F.struct(key, "text_id")).alias("_ff"))
    kept = kept.select(F.col(f"_ff.{key}").alias("_ff_key"), F.col("_ff.text_id").alias("_ff_text"))
    rows = docs.withColumn("_ff_id", _text_id(text))
    joined = rows.join(kept, F.col(key).eqNullSafe(F.col("_ff_key")) & (F.col("_ff_id") == F.col("_ff_text")), "inner")
    # Rows that repeat key and text; the limited row number prunes them before the shuffle.
    once = Window.partitionBy("_ff_key", "_ff_text").orderBy("_ff_id")
    return joined.withColumn("_ff_rn", F.row_number().over(once)).where("_ff_rn = 1").select(docs.columns)
