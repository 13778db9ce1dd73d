"""Byte-level BPE encoding and decoding by contiguous rank arrays (operator 11).

A text is parted at the tokenizer's added tokens and cut by its pattern.  A word
starts as single bytes: one contiguous array holds its parts (their ids, in the order
of their boundaries), a second one the rank of each two neighbouring parts.  The
minimum of the ranks is looked for again and again, leftmost first; the boundary
between its two parts is deleted, and the ranks on both sides are looked up anew,
until no pair has a rank.  New words of a batch that are of like length are rows of
one matrix, so each step is one array operation over all of them.

That scan is quadratic, so it is for short words, as the method says.  A word of
more than ``SCAN_BYTES`` bytes (whitespace and letters without end in odd texts)
deletes the same boundaries in the same order from a heap of ranked pairs over
linked parts, in time n log n; ``tests/llm/test_rank_bpe.py`` holds both against
each other and the public library.

Decoding looks up each id's bytes.  Words seen before come from a cache of the worker
process, which is begun anew when it holds ``CACHE_BYTES``.  A task holds the words of
at most ``HELD_WORDS`` places at a time, also within one text.

Defined results: a null text is an empty one (no ids, digests of nothing); rows with
equal ids or texts stay rows of their own; an empty table gives an empty result.
Columns beside key and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from filingflow.llm.common import text_batches, worker_cache

#: Longest word, in bytes, whose ranks are scanned.
SCAN_BYTES = 256
#: Estimated memory of a worker's cache of words.
CACHE_BYTES = 96 << 20
#: Word places whose ids are laid out together.
HELD_WORDS = 200_000
#: Cells of a matrix of words.
CELLS = 1 << 20
#: Rank of a pair that no merge joins.
NONE = np.iinfo(np.int32).max

#: How the byte-level tokenizer cuts text (fixed value of the public format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it is
    printable, else the next letter from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class RankTokenizer:
    """Ranks, vocabulary and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        to_byte = {c: b for b, c in enumerate(letters)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.width = max(texts) + 1
        #: Bytes of every id, and its decimal form with a comma.
        self.bytes_of = pa.array([texts.get(i, b"") for i in range(self.width)], pa.large_binary())
        self.digits_of = pa.array([b"%d," % i for i in range(self.width)], pa.large_binary())
        #: Id of each byte; the merges' pairs of ids in ascending order with their ranks; the id that a rank makes.
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.rank = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.byte_ranks = self.ranks_of(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        self.cut = regex.compile(PATTERN)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.part = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._forget()

    def _forget(self) -> None:
        """An empty cache: word → number, and the numbers' ids end to end.  An added token is known by its id."""
        self.known: dict[str | int, int] = {}
        self.flat, self.ends, self.size = array("i"), array("q", [0]), 0
        self._learn(list(self.added.values()), np.array(list(self.added.values()), np.int32), np.ones(len(self.added), np.int64))

    def _learn(self, words: list[str | int], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.ends) - 1, len(self.ends) - 1 + len(words)), strict=True))
        self.ends.frombytes((np.cumsum(sizes) + self.ends[-1]).astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.int32).tobytes())
        self.size += 170 * len(words) + 4 * len(ids)

    def words(self, text: str) -> Iterator[list[str | int]]:
        """The text's words in order, in lists; an added token as its id."""
        for piece in self.part.splititer(text) if self.part else [text]:
            if piece in self.added:
                yield [self.added[piece]]
            elif len(piece) <= 1 << 20:
                yield self.cut.findall(piece)
            else:
                found = (m.group() for m in self.cut.finditer(piece))
                while some := list(islice(found, HELD_WORDS)):
                    yield some

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; a right side below 0 is no part."""
        wanted = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == wanted) & (right >= 0), self.key_ranks[at], NONE)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and the number of each word's: the scanned rank arrays."""
        sizes = np.array([len(w) for w in words], np.int64)
        width = int(sizes.max(initial=1))
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        parts = self.byte_ids[data]
        parts[np.arange(width) >= sizes[:, None]] = -1
        ranks = self.byte_ranks[data[:, :-1], data[:, 1:]]
        ranks[parts[:, 1:] < 0] = NONE
        at, ended = np.arange(len(words)), []
        while True:
            least = ranks.min(axis=1, initial=NONE)
            open_ = least < NONE
            if not open_.all():
                ended.append((at[~open_], parts[~open_]))
                at, parts, ranks, least = at[open_], parts[open_], ranks[open_], least[open_]
            if not len(at):
                break
            rows, i = np.arange(len(at)), ranks.argmin(axis=1)
            parts[rows, i] = self.made[least]
            parts, ranks = _without(parts, rows, i + 1), _without(ranks, rows, i)
            back = np.flatnonzero(i > 0)
            ranks[back, i[back] - 1] = self.ranks_of(parts[back, i[back] - 1], parts[back, i[back]])
            ahead = np.flatnonzero(i < ranks.shape[1])
            ranks[ahead, i[ahead]] = self.ranks_of(parts[ahead, i[ahead]], parts[ahead, i[ahead] + 1])
        counts = np.zeros(len(words), np.int64)
        for rows, parts in ended:
            counts[rows] = (parts >= 0).sum(axis=1)
        flat, starts = np.empty(int(counts.sum()), np.int32), np.cumsum(counts) - counts
        for rows, parts in ended:
            there = parts >= 0
            flat[(starts[rows][:, None] + np.arange(parts.shape[1]))[there]] = parts[there]
        return flat, counts

    def linked(self, word: bytes) -> list[int]:
        """Ids of a long word: the same merges, least rank, then leftmost, from a heap."""
        n, rank, width = len(word), self.rank.get, self.width
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j == n or ids[i] != left or ids[j] != right:
                continue  # one of the two parts has grown since
            alive[j], ids[i], after[i] = 0, int(self.made[found]), after[j]
            if after[i] < n:
                before[after[i]] = i
            for start in (before[i], i):
                if start >= 0 and after[start] < n and (r := rank(ids[start] * width + ids[after[start]])) is not None:
                    heapq.heappush(heap, (r, start, ids[start], ids[after[start]]))
        return [t for t, a in zip(ids, alive, strict=True) if a]

    def encode_new(self, words: list[str]) -> None:
        """Puts distinct words into the cache."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(b) for b in raw])
        order = np.argsort(sizes, kind="stable")  # words of like length together
        sizes, first = sizes[order], 0
        short = int(np.searchsorted(sizes, SCAN_BYTES, "right"))
        while first < short:
            limit = min(max(16, 2 * int(sizes[first])), SCAN_BYTES)
            end = min(int(np.searchsorted(sizes, limit, "right")), first + CELLS // limit)
            part = order[first:end].tolist()
            self._learn([words[i] for i in part], *self.scan([raw[i] for i in part]))
            first = end
        for i in order[short:].tolist():
            ids = self.linked(raw[i])
            self._learn([words[i]], np.array(ids, np.int32), np.array([len(ids)]))

    def encode_words(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and the offset of each word's."""
        if self.size > CACHE_BYTES:
            self._forget()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0).tolist()
        if new:
            self.encode_new(list(dict.fromkeys(words[i] for i in new)))
            numbers[new] = [self.known[words[i]] for i in new]
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.int32)
        sizes = ends[numbers + 1] - ends[numbers]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        return flat[np.arange(offsets[-1]) + np.repeat(ends[numbers] - offsets[:-1], sizes)], offsets

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return [i for words in self.words(text) for i in self.encode_words(words)[0].tolist()]


def _without(matrix: np.ndarray, rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix without one cell of each row."""
    keep = np.ones(matrix.shape, bool)
    keep[rows, column] = False
    return matrix[keep].reshape(len(matrix), matrix.shape[1] - 1)


def _laid_out(values: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The values of the ids end to end, and the offset of each."""
    taken = values.take(pa.array(ids, pa.int32()))
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
    return memoryview(data or b""), at


class _Document:
    """Digests of one text, fed with its words' ids as they come."""

    __slots__ = ("count", "decoded", "first", "held", "ids")

    def __init__(self) -> None:
        self.count, self.first, self.held = 0, True, []
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def feed(self, digits: memoryview, text: memoryview, count: int) -> None:
        if count:  # each id is followed by a comma; the last one's is held back
            if not self.first:
                self.ids.update(b",")
            self.ids.update(digits[:-1])
            self.first = False
            self.decoded.update(text)
            self.count += count


def tokenizer(path: str) -> RankTokenizer:
    """One tokenizer per worker process and file."""
    cache = worker_cache("rank_bpe")
    if path not in cache:
        cache[path] = RankTokenizer(path)
    return cache[path]


def _encoded(tok: RankTokenizer, texts: list[str | None], ids: bool) -> Iterator[tuple[int, str, str, list]]:
    """(number of ids, digest of ids, digest of decoded bytes, ids) of each text."""
    open_ = [_Document() for _ in texts]
    held: list[str | int] = []
    parts: list[tuple[int, int]] = []  # text and end of its words in ``held``

    def feed() -> None:
        nonlocal held, parts
        found, offsets = tok.encode_words(held)
        digits, digits_at = _laid_out(tok.digits_of, found)
        decoded, decoded_at = _laid_out(tok.bytes_of, found)
        first = 0
        for k, end in parts:
            a, b = int(offsets[first]), int(offsets[end])
            open_[k].feed(digits[digits_at[a] : digits_at[b]], decoded[decoded_at[a] : decoded_at[b]], b - a)
            if ids:
                open_[k].held.append(found[a:b])
            first = end
        held, parts = [], []

    for k, text in enumerate(texts):
        for words in tok.words(text or ""):
            held += words
            parts.append((k, len(held)))
            if len(held) >= HELD_WORDS:
                feed()
    feed()
    for doc in open_:
        yield doc.count, doc.ids.hexdigest(), doc.decoded.hexdigest(), doc.held


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """One row per document: ``key, n_tokens, ids_sha256`` (decimal ids joined by
    commas), ``decoded_sha256`` (of the bytes that the ids decode to) and, with
    ``ids``, the token ids (``array<int>``).  ``path`` must be readable on executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                rows = list(_encoded(tok, part.column(1).to_pylist(), ids))
                cols = [part.column(0), pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)]]
                if ids:
                    ends = np.concatenate([[0], np.cumsum([r[0] for r in rows])]).astype(np.int32)
                    flat = [x for r in rows for x in r[3]]
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat) if flat else [], pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names)
        pa.default_memory_pool().release_unused()

    text_batches(docs.sparkSession)
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(key, text).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded``: the text of each row's token ids (null: empty); bytes that
    are no UTF-8 become U+FFFD, an id without token nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                texts = []
                for row in part.column(1).to_pylist():
                    known = [i for i in row or [] if i is not None and 0 <= i < len(tok.bytes_of)]
                    texts.append(bytes(_laid_out(tok.bytes_of, known)[0]).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [key, "decoded"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {dict(encoded.dtypes)[key]}, decoded string")
