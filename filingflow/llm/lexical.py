"""Ranked lexical search by an exact sparse ball tree (operator 13).

Documents and items are sparse integer vectors over the items' terms, and a
document's score for an item is their inner product.  One pass over the texts
counts terms and keeps the frequencies of the terms that any item holds (other
coordinates add nothing to a product).  Every task then builds ball trees over
blocks of the documents it reads: a ball holds the centroid of its documents and
the radius that covers them, one for each band of terms of like weight, so that

    item . document  <=  item . centroid + |item| * radius, summed over the bands.

For each item the balls are visited best bound first.  A subtree goes when its
bound, rounded up, is below the least score of the item's best documents so far;
leaves are scored in 64-bit integers.  A task's best documents of an item are the
start for its next block, and only they are shuffled, so no row is sent by key.

Items are taken in blocks of at most ``ITEMS`` rows and ``ITEM_BYTES`` bytes of
text (one row at least), which bounds the vectors that every task receives; each
block reads the term counts again.

Defined results: a null or empty text has no terms; an item without terms, or
whose documents all score 0, has no rows; every item row is an item of its own,
also when ids repeat or are null; document rows with equal ids are ranked one by
one, null ids before others at equal scores; empty tables give an empty result.
Columns beside the named ones are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingflow.llm.common import drop_work_table, text_batches, work_table

#: Bounds of a block of items.
ITEMS, ITEM_BYTES = 1000, 1 << 20
#: Bounds of the documents under one tree, and of those in a leaf.
TREE_ROWS, TREE_TERMS, LEAF_ROWS = 4096, 2_000_000, 16
#: Bands of terms with a radius of their own.
BANDS = 1024
#: Bytes of a text whose terms are counted at a time.
CHUNK = 4 << 20
#: Relative slack of a bound: float sums over a vector's terms err by far less.
SLACK = 1e-9

#: ASCII letters and digits belong to terms (A-Z as a-z), other ASCII parts them; bytes of other characters stay.
_TERM_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of about ``CHUNK`` bytes."""
    text, first = text.translate(_TERM_BYTES), 0
    while first < len(text):
        end = text.find(b" ", first + CHUNK)
        end = len(text) if end < 0 else end
        yield text[first:end].split()
        first = end


def count_terms(text: bytes) -> tuple[int, Counter]:
    """(number of terms, occurrences of each)."""
    found: Counter = Counter()
    for part in terms(text):
        found.update(part)
    return found.total(), found


def _utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def term_counts(docs: DataFrame, number: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``_ff_key``, ``n`` (terms), ``ids`` and ``tfs`` (terms with a number in ``number``, ascending, and
    their occurrences) of every row with at least one term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, ends, ids, tfs = [], [], [0], [], []
            for i, t in enumerate(_utf8(batch.column(1))):
                n, found = count_terms(t or b"")
                if n:
                    row = sorted((number[w], tf) for w, tf in found.items() if w in number)
                    kept.append(i)
                    sizes.append(n)
                    ids += [w for w, _ in row]
                    tfs += [tf for _, tf in row]
                    ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ],
                ["_ff_key", "n", "ids", "tfs"],
            )

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("_ff_key"), F.col(text)).mapInArrow(run, f"_ff_key {kind}, n long, ids array<int>, tfs array<long>")


def weight(documents: int, holding: int) -> int:
    """A term's weight: floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def saturated(tf: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """A document's coordinates: occurrences damped by its length against the mean, in integers."""
    if int(n.max(initial=0)) * 25 * documents < 1 << 62:
        m = 75 + 25 * n * documents // all_terms
    else:  # the product alone passes 64 bits
        m = np.array([75 + 25 * int(x) * documents // all_terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Item:
    """An item as a sparse vector: its terms' numbers, occurrences times weight, and its norm in each of its bands."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, width: int):
        self.ids, self.values = ids, values
        self.bands, of = np.unique(band(ids, width), return_inverse=True)
        self.norms = np.sqrt(np.bincount(of, values.astype(float) ** 2, len(self.bands))) * (1 + SLACK)


def band(ids: np.ndarray, width: int) -> np.ndarray:
    """Terms are numbered by weight; each band holds terms of like weight."""
    return ids if width <= BANDS else ids.astype(np.int64) * BANDS // width


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each of the sizes, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class BallTree:
    """Sparse rows (``ends``, ``ids``, ``values``; no row is empty) under balls of at
    most ``LEAF_ROWS`` rows at the leaves.  A ball has a centroid and, for each band
    of terms, the radius that covers its rows in that band's space:

        item . row  <=  sum over bands of  item . centroid + |item| * radius

    One radius for all terms says nothing in a space of thousands of terms."""

    def __init__(self, ends: np.ndarray, ids: np.ndarray, values: np.ndarray, width: int):
        self.dense, self.bands = np.zeros(width), min(width, BANDS)
        self.ends, self.ids, self.values, self.width = ends, ids, values, width
        self.squares = np.add.reduceat(values.astype(float) ** 2, ends[:-1])
        self.rows = self._like_rows_together()
        #: Rows of a ball in tree order, and its two parts (0: none).
        self.first, self.end, self.parts = [], [], []
        self.radius: list[np.ndarray] = []
        centres: list[tuple[np.ndarray, np.ndarray]] = []
        self._build(0, len(self.rows), centres)
        self.radius = np.array(self.radius, np.float32)
        # Centroids by term: which balls hold it, and with what value.
        terms = np.concatenate([t for t, _ in centres])
        order = np.argsort(terms, kind="stable")
        self.term_starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=width))])
        self.ball_of = np.repeat(np.arange(len(centres), dtype=np.int32), [len(t) for t, _ in centres])[order]
        self.centre = np.concatenate([v for _, v in centres])[order]
        at = _ranges(self.ends[self.rows], self.ends[self.rows + 1] - self.ends[self.rows])
        sizes = self.ends[self.rows + 1] - self.ends[self.rows]
        self.ends, self.ids, self.values = np.concatenate([[0], np.cumsum(sizes)]), self.ids[at], self.values[at]

    def _like_rows_together(self) -> np.ndarray:
        """Rows ordered by two least hashes of their terms, which copies share: the
        order that rows at equal distances from both pivots keep when a ball is parted."""
        mixed = np.random.default_rng(13).permutation(self.width).astype(np.int32)
        return np.lexsort([np.minimum.reduceat(h[self.ids], self.ends[:-1]) for h in (mixed[::-1], mixed)])

    def _build(self, first: int, end: int, centres: list) -> int:
        ball, rows = len(self.first), self.rows[first:end]
        self.first.append(first)
        self.end.append(end)
        self.parts.append((0, 0))
        sizes = self.ends[rows + 1] - self.ends[rows]
        at, starts = _ranges(self.ends[rows], sizes), np.cumsum(sizes) - sizes
        ids, values = self.ids[at], self.values[at].astype(float)
        total = np.bincount(ids, values, self.width) / len(rows)
        terms = np.flatnonzero(total)
        centres.append((terms, total[terms]))
        self.radius.append(self._radii(ids, values, total, starts))
        if len(rows) > LEAF_ROWS:
            # Two far rows: the farthest from the centroid, and the farthest from that; halves by the nearer one.
            around = self.squares[rows] - 2 * np.add.reduceat(total[ids] * values, starts)
            one = self._far(rows, rows[int(around.argmax())], ids, values, starts)
            two = self._far(rows, rows[int(one.argmax())], ids, values, starts)
            self.rows[first:end] = rows[np.argsort(one - two, kind="stable")]
            half = (first + end) // 2
            self.parts[ball] = self._build(first, half, centres), self._build(half, end, centres)
        return ball

    def _radii(self, ids: np.ndarray, values: np.ndarray, total: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Radius of each band, rounded up."""
        centre = np.bincount(band(np.arange(self.width), self.width), total**2, self.bands)
        # A row's terms ascend, so those of one band lie together; a row without any in a band is |centroid| away.
        of = band(ids, self.width)
        new = np.concatenate([[True], of[1:] != of[:-1]])
        new[starts] = True
        cuts = np.flatnonzero(new)
        apart, square = np.zeros(self.bands), np.zeros(self.bands)
        np.maximum.at(apart, of[cuts], np.add.reduceat(values * (values - 2 * total[ids]), cuts))
        np.maximum.at(square, of[cuts], np.add.reduceat(values**2, cuts))
        # The difference of large squares errs by their last digits: added before the root.
        radius = np.sqrt(centre + apart + SLACK * (centre + square))
        return np.nextafter(radius.astype(np.float32), np.float32(np.inf), where=radius > 0, out=np.zeros(self.bands, np.float32))

    def _far(self, rows: np.ndarray, pivot: int, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Squared distance of each row from a row."""
        own = slice(self.ends[pivot], self.ends[pivot + 1])
        self.dense[self.ids[own]] = self.values[own]
        products = np.add.reduceat(self.dense[ids] * values, starts)
        self.dense[self.ids[own]] = 0
        return self.squares[rows] - 2 * products + self.squares[pivot]

    def bounds(self, item: Item) -> np.ndarray:
        """No row of a ball scores more than its bound: all numbers are positive, so the slack covers the rounding."""
        sizes = self.term_starts[item.ids + 1] - self.term_starts[item.ids]
        at = _ranges(self.term_starts[item.ids], sizes)
        centre = np.bincount(self.ball_of[at], self.centre[at] * np.repeat(item.values, sizes), len(self.first))
        return (centre + self.radius[:, item.bands] @ item.norms) * (1 + SLACK)

    def search(self, item: Item, scratch: np.ndarray, best: Best) -> int:
        """Adds the tree's documents to the item's best; the number of rows scored."""
        bounds, scored = self.bounds(item).tolist(), 0
        heap = [(-bounds[0], 0)]
        scratch[item.ids] = item.values
        while heap and -heap[0][0] >= best.least:
            _, ball = heapq.heappop(heap)
            if self.parts[ball][0]:
                for part in self.parts[ball]:
                    if bounds[part] >= best.least:
                        heapq.heappush(heap, (-bounds[part], part))
                continue
            first, end = self.first[ball], self.end[ball]
            a, b = self.ends[first], self.ends[end]
            best.add(np.add.reduceat(scratch[self.ids[a:b]] * self.values[a:b], self.ends[first:end] - a), self.rows[first:end])
            scored += end - first
        scratch[item.ids] = 0
        return scored


class Best:
    """The ``top`` best (score, key) of an item: highest score, then least key, null first."""

    def __init__(self, top: int):
        self.top, self.rows, self.least, self.keys = top, [], 1, []

    def add(self, scores: np.ndarray, rows: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            found = [(-int(scores[i]), (key := self.keys[rows[i]].as_py()) is not None, key) for i in good.tolist()]
            # Equal ids and nulls are not compared with each other's key.
            self.rows = sorted(self.rows + found, key=lambda r: (r[0], r[1], r[2]) if r[1] else (r[0], r[1]))[: self.top]
            if len(self.rows) == self.top:
                self.least = max(1, -self.rows[-1][0])


def _trees(batches: Iterator[pa.RecordBatch], by_weight: np.ndarray, documents: int, all_terms: int) -> Iterator[tuple[pa.Array, BallTree]]:
    """Trees over the documents in the order they come, with their keys."""
    held, rows, size = [], 0, 0
    for batch in batches:
        first = 0
        ends = batch.column("ids").offsets.to_numpy() if batch.num_rows else np.zeros(1, int)
        for i in range(batch.num_rows):
            rows, size = rows + 1, size + int(ends[i + 1] - ends[i])
            if rows >= TREE_ROWS or size >= TREE_TERMS:
                yield _tree([*held, batch.slice(first, i + 1 - first)], by_weight, documents, all_terms)
                held, rows, size, first = [], 0, 0, i + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield _tree(held, by_weight, documents, all_terms)


def _tree(batches: list[pa.RecordBatch], by_weight: np.ndarray, documents: int, all_terms: int) -> tuple[pa.Array, BallTree]:
    table = pa.Table.from_batches(batches).combine_chunks()
    sizes = np.array(table["ids"].combine_chunks().value_lengths(), np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = by_weight[np.array(table["ids"].combine_chunks().flatten(), np.int32)]
    tfs = np.array(table["tfs"].combine_chunks().flatten(), np.int64)
    order = np.lexsort((ids, np.repeat(np.arange(len(sizes)), sizes)))
    n = np.repeat(np.array(table["n"], np.int64), sizes)
    return table["_ff_key"].combine_chunks(), BallTree(ends, ids[order], saturated(tfs[order], n, documents, all_terms), len(by_weight))


def _search_block(counts: DataFrame, items: list[tuple[int, Counter]], facts: tuple[int, int], number: dict[bytes, int], top: int) -> DataFrame:
    """The tasks' best documents of the items: ``_ff_item``, ``_ff_key``, ``score``."""
    documents, all_terms = facts
    holding = np.zeros(len(number), np.int64)
    for row in counts.select(F.explode("ids").alias("t")).groupBy("t").count().toLocalIterator():
        holding[row["t"]] = row["count"]
    weights = np.array([weight(documents, int(df)) for df in holding], np.int64)
    by_weight = np.argsort(np.argsort(weights, kind="stable"), kind="stable").astype(np.int32)
    vectors = []
    for _, found in items:
        vector = sorted((by_weight[number[w]], tf * weights[number[w]]) for w, tf in found.items())
        vectors.append(Item(*(np.array([v[k] for v in vector], np.int64) for k in (0, 1)), len(weights)))
    names = [n for n, _ in items]
    sent = counts.sparkSession.sparkContext.broadcast((vectors, by_weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, by_weight = sent.value
        best, scratch = [Best(top) for _ in vectors], np.zeros(len(by_weight), np.int64)
        kind = None
        for keys, tree in _trees(batches, by_weight, documents, all_terms):
            kind = keys.type
            for item, found in zip(vectors, best, strict=True):
                found.keys = keys
                tree.search(item, scratch, found)
        rows = [(names[i], key, -score) for i, found in enumerate(best) for score, _, key in found.rows]
        if rows:
            item, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())], ["_ff_item", "_ff_key", "score"])

    return counts.where("size(ids) > 0").mapInArrow(run, f"_ff_item long, _ff_key {dict(counts.dtypes)['_ff_key']}, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Items' numbers and terms, in blocks within ``ITEMS`` and ``ITEM_BYTES``."""
    block, size = [], 0
    for row in items.select("_ff_item", F.col("_ff_text").cast("binary").alias("text")).toLocalIterator():
        text = bytes(row["text"] or b"")
        if block and (len(block) >= ITEMS or size + len(text) > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append((row["_ff_item"], count_terms(text)[1]))
        size += len(text)
    if block:
        yield block


def _best(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    place = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("_ff_key"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_key, rank, key, score``: each item's ``top`` documents of the highest score above 0."""
    spark = docs.sparkSession
    text_batches(spark)
    numbered = items.select(F.col(item_key).alias("_ff_id"), F.col(item_text).alias("_ff_text"), F.monotonically_increasing_id().alias("_ff_item"))
    numbered = work_table(numbered, "search-items")
    found, facts = [], None
    for block in _blocks(numbered):
        number = {w: i for i, w in enumerate(sorted(set().union(*(c for _, c in block))))}
        counts = work_table(term_counts(docs, number, key, text), "search-counts")
        facts = facts or tuple(counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first())
        if facts[0] and number:
            found.append(work_table(_search_block(counts, block, facts, number, top), "search-found"))
        drop_work_table(spark, counts)
    kind = dict(docs.dtypes)[key]
    rows = spark.createDataFrame([], f"_ff_item long, _ff_key {kind}, score long")
    for part in found:
        rows = rows.unionByName(part)
    # Two steps, so that an item's candidates of very many tasks do not meet at once.
    rows = _best(rows.withColumn("_ff_salt", F.pmod(F.xxhash64("_ff_key", "score"), F.lit(256))), ["_ff_item", "_ff_salt"], top)
    ranked = _best(rows.drop("rank"), ["_ff_item"], top)
    names = numbered.select("_ff_item", F.col("_ff_id").alias("_ff_name"))
    return ranked.join(names, "_ff_item").select(F.col("_ff_name").alias(item_key), "rank", F.col("_ff_key").alias(key), "score")
