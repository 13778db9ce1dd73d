"""Suffix-array dedup by a depth-limited radix sort (operator 5).

Wanted are the strings of ``window`` bytes that start at two places at least.
Suffixes are grouped from the most significant digit on, only as deep as the
window, and a suffix that is alone in its group drops out of the next pass:

1. The first digit is the least (by hash) of the ``gram``-byte strings in a
   suffix's first ``window`` bytes, the leftmost of equal ones.  Equal windows
   have the same one at the same offset, and neighbouring suffixes share it, so
   a run of suffixes is one row: about ``2 / (window - gram + 2)`` rows a byte
   instead of one.  Grams that occur once are dropped here.
2. The second digit is the whole context of such a run (the bytes of all its
   windows).  Equal contexts are repeated windows throughout, without looking
   at a text again; that settles the inside of copies.
3. Runs in a group with a context that occurs once, the edges of copies, are
   sorted through the last digit, the window itself: their contexts are sent
   to the task of the gram, or, when a gram has more than ``group_rows``
   contexts, each window is a row that is counted by its content.

Digits are 64-bit hashes; the decision that two windows are equal rests on the
gram's hash and on the context's or the window's, 128 bits together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.llm.common import drop_work_table, repeated, work_table, worker_cache

_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 20
_U = np.uint64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept by the worker."""
    cache = worker_cache("suffix_powers")
    if "p" not in cache or len(cache["p"][0]) < n:
        both = []
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, 3 * _SLICE), factor, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        cache["p"] = tuple(both)
    return cache["p"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Hashes:
    """Hash of any range of a buffer in constant time."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * powers[: len(data)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Of the range from every position."""
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))


def runs_of_suffixes(data: np.ndarray, ends: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring suffixes with the same first digit in a buffer of
    texts that end at ``ends``: first and last start, gram position, the hashes
    of gram and context, and ``stop``, where the last window ends.  Neighbours
    with equal digits (periodic text) are one run with a later ``stop``."""
    h = Hashes(data)
    n = window - gram + 1
    grams = h.all(gram)
    low = _U((1 << 23) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # the position breaks ties to the left
    blocks = np.concatenate([keys, np.full(-len(keys) % n, ~_U(0))]).reshape(-1, n)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    least = np.minimum(ahead[: len(keys) - n + 1], behind[n - 1 : len(keys)])
    anchor = (least & low).astype(np.int64)
    start = np.arange(len(anchor))
    inside = start + window <= np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(anchor)]
    start, anchor = start[inside], anchor[inside]
    if not len(start):
        return {k: np.empty(0, np.int64) for k in ("lo", "hi", "pos", "stop", "h", "c")}
    opens = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(opens)
    lo, hi, pos = start[first], start[np.concatenate([first[1:] - 1, [len(start) - 1]])], anchor[first]
    digit, context = grams[pos], h.ranges(lo, hi + window) + _mix((pos - lo).astype(np.uint64))
    same = np.concatenate([[True], (digit[1:] != digit[:-1]) | (context[1:] != context[:-1]) | (lo[1:] != hi[:-1] + 1)])
    keep = np.flatnonzero(same)
    last = np.concatenate([keep[1:] - 1, [len(lo) - 1]])
    return {"lo": lo[keep], "hi": hi[keep], "pos": pos[keep], "stop": hi[last] + window, "h": digit[keep], "c": context[keep]}


def _text_slices(texts: list[bytes], window: int) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Buffers of about a million suffixes: (text number and offset per part,
    bytes, part ends).  A long text is cut between suffixes."""
    parts: list[tuple[int, int]] = []
    held: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - window + 1, 0), _SLICE):
            parts.append((i, at))
            held.append(t[at : at + _SLICE + window - 1])
            size += len(held[-1])
            if size >= _SLICE:
                yield parts, np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(b) for b in held])
                parts, held, size = [], [], 0
    if parts:
        yield parts, np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(b) for b in held])


def first_digits(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs of suffixes of every document (columns ``id``, ``th``, ``text``):
    (id, th, h, c, lo, meta); ``meta`` packs stop - lo, hi - lo and pos - lo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(2).cast(pa.binary())]
            for parts, data, ends in _text_slices(texts, window):
                r = runs_of_suffixes(data, ends, window, gram)
                part = np.searchsorted(ends, r["lo"], "right")
                row = pa.array(np.array([p[0] for p in parts])[part], pa.int64())
                begin = np.concatenate([[0], ends[:-1]]) - np.array([p[1] for p in parts])
                meta = (r["stop"] - r["lo"] << 16) | (r["hi"] - r["lo"] << 8) | (r["pos"] - r["lo"])
                cols = [batch.column(0).take(row), batch.column(1).take(row), r["h"].view(np.int64), r["c"].view(np.int64), r["lo"] - begin[part], meta]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "th", "h", "c", "lo", "meta"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, th long, h long, c long, lo long, meta long")


def _window_keys(rows: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start of the window in its context, key) of all windows of the rows' contexts."""
    texts = rows.column("context").to_pylist()
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size) - size
    n = size - window + 1
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    where = begin[row] + at
    h = Hashes(np.frombuffer(b"".join(texts), np.uint8))
    gram = rows.column("h").to_numpy().view(np.uint64)[row]
    offset = rows.column("pos").to_numpy()[row] - at
    return row, at, _mix(h.ranges(where, where + window) ^ _mix(gram + offset.astype(np.uint64)))


def _sorted_groups(window: int):
    """Repeated windows among the contexts of a gram; input sorted by ``h``."""

    def settle(rows: pa.RecordBatch) -> pa.RecordBatch:
        row, at, key = _window_keys(rows, window)
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:]] |= equal
        again[order[:-1]] |= equal
        again &= rows.column("open").to_numpy(zero_copy_only=False)[row]
        found = np.flatnonzero(again)
        opens = np.concatenate([[True], (row[found][1:] != row[found][:-1]) | (found[1:] != found[:-1] + 1)]) if len(found) else np.zeros(0, bool)
        first = found[opens]
        last = found[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(found) - 1]])] if len(found) else first
        lo = rows.column("lo").to_numpy()
        pick = pa.array(row[first])
        spans = [pa.array(lo[row[first]] + at[first]), pa.array(lo[row[first]] + at[last] + window)]
        return pa.RecordBatch.from_arrays([rows.column("id").take(pick), rows.column("th").take(pick), *spans], ["id", "th", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                held.append(batch.slice(at, 5000))
                rows = pa.Table.from_batches(held).combine_chunks()
                grams = rows.column("h").to_numpy()
                whole = int(np.flatnonzero(grams == grams[-1])[0])  # the last gram may go on
                if whole:
                    yield settle(rows.slice(0, whole).combine_chunks().to_batches()[0])
                held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield settle(held[0])

    return run


def repeated_spans(docs: DataFrame, window: int = 200, gram: int = 64, group_rows: int = 8192) -> DataFrame:
    """(id, th, start, stop): byte ranges that together are exactly the bytes of
    ``docs`` (columns ``id``, ``th``, ``text``) in windows that start elsewhere too."""
    kind = dict(docs.dtypes)["id"]
    runs = work_table(first_digits(docs, window, gram), "suffixes")
    # A merged run stands for two equal ones at least.
    twice = F.expr(f"CASE WHEN shiftright(meta, 16) > (shiftright(meta, 8) & 255) + {window} THEN 2 ELSE 1 END")
    groups = runs.groupBy("h").agg(F.sum(twice).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1")
    shared = work_table(runs.join(groups.select("h", (F.col("c0") == F.col("c1")).alias("alike")), "h"), "suffixes")
    drop_work_table(docs.sparkSession, runs)

    span = [F.col("lo").alias("start"), F.expr("lo + shiftright(meta, 16)").alias("stop")]
    settled = shared.where("alike").select("id", "th", *span)
    mixed = shared.where("NOT alike")
    contexts = mixed.groupBy("h", "c").agg(F.sum(twice).alias("n"), F.min(F.struct("id", "th", "lo", "meta")).alias("one"))
    contexts = work_table(contexts, "suffixes")
    settled = settled.unionByName(mixed.join(contexts.where("n > 1").select("h", "c"), ["h", "c"]).select("id", "th", *span))

    unsettled = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least")).where("size > 1 AND least = 1")
    members = contexts.join(unsettled.select("h", "size"), "h").select("h", (F.col("n") == 1).alias("open"), "size", "one.*")
    by_doc = members.groupBy(F.col("id").alias("m_id"), F.col("th").alias("m_th")).agg(
        F.collect_list(F.struct("h", "open", (F.col("size") > group_rows).alias("hot"), "lo", "meta")).alias("members")
    )
    packed = _packed(docs).join(by_doc, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th"))).select("id", "th", "packed", "members")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "h", "open", "hot", "lo", "pos", "context"]
        for batch in batches:
            for i in range(batch.num_rows):
                text = zstandard.decompress(batch.column(2)[i].as_py())
                rows = pa.RecordBatch.from_struct_array(batch.column(3)[i].values)
                lo, meta = rows.column("lo").to_numpy(), rows.column("meta").to_numpy()
                context = [text[a : a + (m >> 8 & 255) + window] for a, m in zip(lo.tolist(), meta.tolist(), strict=True)]
                same = [pa.repeat(batch.column(k)[i], len(lo)) for k in (0, 1)]
                cols = [*same, rows.column("h"), rows.column("open"), rows.column("hot"), rows.column("lo"), pa.array(meta & 255), pa.array(context, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {kind}, th long, h long, open boolean, hot boolean, lo long, pos long, context binary"
    edges = work_table(packed.mapInArrow(cut, schema), "suffixes")
    cold = edges.where("NOT hot").repartition("h").sortWithinPartitions("h")
    found = cold.mapInArrow(_sorted_groups(window), f"id {kind}, th long, start long, stop long")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                row, first, key = _window_keys(rows, window)
                take = pa.array(row)
                cols = [rows.column("id").take(take), rows.column("th").take(take), rows.column("open").take(take)]
                cols += [pa.array(rows.column("lo").to_numpy()[row] + first), pa.array(key.view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "th", "open", "start", "key"])

    each = edges.where("hot").mapInArrow(explode, f"id {kind}, th long, open boolean, start long, key long")
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    hot = each.where("open").join(often, "key", "left_semi").select("id", "th", "start", (F.col("start") + window).alias("stop"))
    return settled.unionByName(found).unionByName(hot)


def _packed(docs: DataFrame) -> DataFrame:
    """(id, th, packed): texts compressed for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            packed = pa.array([squeeze.compress(t.as_py() or b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["id", "th", "packed"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, th long, packed binary")


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges; ranges that touch are one."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    opens = np.concatenate([[True], start[1:] > stop[:-1]])
    return start[opens], stop[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(stop) - 1]])]


def remove_repeats(docs: DataFrame, window: int = 200, gram: int = 64, group_rows: int = 8192, key: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
    """One row per document: ``key, n_bytes, n_removed, n_spans, kept_sha256``,
    with ``texts`` also ``kept`` (binary), without the bytes that a ``window``-byte
    string covers which also starts elsewhere, in the same document or another.

    Strings are judged on the input.  A null text is empty; a text shorter than
    the window keeps all bytes; rows that repeat a document are copies of each
    other; a null key is a value of its own; an empty table gives an empty
    result; other columns are ignored.  ``gram`` must be at least ``window -
    255`` and below ``window``."""
    docs = docs.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), F.col(text).alias("text"))
    copies = work_table(docs.groupBy("id", "th").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "suffixes")
    some = not copies.isEmpty()
    if some:
        # One row for all copies of a row; a string of it starts elsewhere, in the next copy.
        copies = copies.select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), "times")
        same = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th"))
        one = docs.join(copies, same, "left_semi").groupBy("id", "th").agg(F.min("text").alias("text"))
        docs = docs.join(copies, same, "left_anti").unionByName(one)
        whole = one.where(F.octet_length("text") >= window).select("id", "th", F.lit(0).cast("bigint").alias("start"), F.octet_length("text").cast("bigint").alias("stop"))
    spans = repeated_spans(docs, window, gram, group_rows)
    spans = (spans.unionByName(whole) if some else spans).groupBy(F.col("id").alias("s_id"), F.col("th").alias("s_th"))
    spans = spans.agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    joined = _packed(docs).join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")), "left")
    names = ["id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                data = zstandard.decompress(batch.column(2)[i].as_py())
                kept, removed, n = data, 0, 0
                if batch.column(3)[i].is_valid:
                    start, stop = merge_spans(batch.column(3)[i].values.to_numpy(), batch.column(4)[i].values.to_numpy())
                    kept = b"".join(data[a:b] for a, b in zip([0, *stop.tolist()], [*start.tolist(), len(data)], strict=True))
                    removed, n = int((stop - start).sum()), len(start)
                rows.append([len(data), removed, n, hashlib.sha256(kept).hexdigest()] + [kept] * texts)
                size += len(kept) * texts
                if size > 8 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, len(rows)) for k in (0, 1)), *map(pa.array, zip(*rows, strict=True))], names)
                    first, size, rows = i + 1, 0, []

    schema = f"id {dict(docs.dtypes)['id']}, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    found = joined.select("id", "th", "packed", "starts", "stops").mapInArrow(run, schema)
    if some:
        found = found.join(copies, same, "left").drop("c_id", "c_th")
        found = repeated(work_table(found.withColumn("times", F.coalesce("times", F.lit(1))), "suffixes"), "times")
    return found.select(F.col("id").alias(key), *names[2:])
