"""Byte-level BPE encoding and decoding with DuckDB inside each partition (operator 9).

A text is cut by the tokenizer's pattern; every distinct piece of a batch goes
through one recursive DuckDB query: each round unnests the pieces into
token-position rows, joins neighbouring tokens to the merge table, finds every
piece's leftmost pair of minimum rank and contracts it, until no piece has a
pair left.  Decoding joins token ids to the vocabulary and concatenates their
bytes by an ordered aggregation.  Pieces seen before come from a cache of the
worker process; a generation of ``CACHE_BYTES`` is dropped when the next is full.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from filingflow.llm.common import lean, text_batches, worker_cache
from filingflow.session import give_back

#: Estimated memory of each of the two generations of pieces that a worker process remembers.
CACHE_BYTES = 48 << 20
#: Characters of the texts of a batch, and distinct pieces that go through the rounds together.
BATCH_CHARS = 3 << 20
PIECES_PER_ROUND = 20_000
#: Characters of the texts whose pieces are Python strings at once.
STRING_CHARS = 256 << 10
#: Pieces up to this many bytes keep all rounds of the recursion until it ends; longer ones only the last.
SHORT_PIECE = 48

_NEXT_ROUND = """
    SELECT s.w, list_concat(list_append(s.toks[1 : b.best % 4294967296 - 1], CAST(b.best // 4294967296 AS INTEGER)), s.toks[b.best % 4294967296 + 2 :]) AS toks, s.step + 1 AS step
    FROM {state} s JOIN (
        SELECT w, min(CAST(m AS BIGINT) * 4294967296 + pos) AS best
        FROM (SELECT w, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, unnest(range(1, len(toks))) AS pos FROM {state}) JOIN merges USING (l, r)
        GROUP BY w
    ) b USING (w)
"""
_ENCODE = f"""
    WITH RECURSIVE state AS (
        SELECT w, list(tok ORDER BY pos) AS toks, 0 AS step FROM start GROUP BY w
        UNION ALL
        {_NEXT_ROUND.format(state="state")}
    )
    SELECT w, arg_max(toks, step) AS toks FROM state GROUP BY w
"""
# A long piece contracts all occurrences of its minimum-rank pair in one round
# where that is the same as one after the other: if no pair that holds the
# merged token has a lower rank (``steady``), the same pair stays the minimum
# until its last occurrence is gone.  Otherwise only the leftmost is contracted.
_LONG_PICKS = """
    WITH pairs AS (
        SELECT w, pos, tok AS l, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS r, lead(pos) OVER (PARTITION BY w ORDER BY pos) AS next FROM now
    ),
    found AS (SELECT w, pos, next, m, steady FROM pairs JOIN merges USING (l, r)),
    lowest AS (SELECT *, min(m) OVER (PARTITION BY w) AS best FROM found),
    runs AS (
        SELECT *, lag(next) OVER (PARTITION BY w ORDER BY pos) IS NOT DISTINCT FROM pos AS touches,
               row_number() OVER (PARTITION BY w ORDER BY pos) AS k
        FROM lowest WHERE m = best
    ),
    dealt AS (SELECT *, k - max(CASE WHEN touches THEN 0 ELSE k END) OVER (PARTITION BY w ORDER BY k) AS place FROM runs)
    SELECT w, pos, next, m FROM dealt WHERE k = 1 OR (steady AND place % 2 = 0)
"""
_LONG_ROUND = """
    SELECT n.w, n.pos, coalesce(p.m, n.tok) AS tok
    FROM (FROM now SEMI JOIN picked USING (w)) n
    LEFT JOIN picked p ON p.w = n.w AND p.pos = n.pos ANTI JOIN picked g ON g.w = n.w AND g.next = n.pos
"""
_DECODE = """
    SELECT f.w, unhex(string_agg(v.hex, '' ORDER BY f.pos)) AS text
    FROM (SELECT w, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM fixpoint) f JOIN vocabulary v ON v.id = f.tok GROUP BY f.w
"""
_COLLECT = f"SELECT w, array_to_string(toks, ' ') || ' ' AS ids, text FROM fixpoint JOIN ({_DECODE}) USING (w)"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank of a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Tokenizer:
    """The vocabulary as DuckDB tables and the recursive queries over them."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.bytes_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        left, right, merged = (pa.array(c, pa.int32()) for c in zip(*pairs, strict=True))
        self.con.register("pairs", pa.table({"l": left, "r": right, "m": merged}))
        self.con.register("tokens", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.con.execute("""
            CREATE TABLE merges AS
            WITH around AS (SELECT part, min(m) AS least FROM (SELECT l AS part, m FROM pairs UNION ALL SELECT r, m FROM pairs) GROUP BY part)
            SELECT l, r, m, coalesce(least > m, true) AS steady FROM pairs LEFT JOIN around ON part = m;
            CREATE TABLE vocabulary AS FROM tokens
        """)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.size = 0

    def _start(self, pieces: list[bytes]) -> pa.Table:
        size = np.array([len(p) for p in pieces])
        first = np.repeat(np.cumsum(size) - size, size)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        return pa.table({"w": w, "pos": np.arange(len(data)) - first, "tok": self.bytes_id[data]})

    def _fixpoint(self, pieces: list[bytes]) -> pa.Table:
        self.con.register("start", self._start(pieces))
        if max(map(len, pieces)) <= SHORT_PIECE:
            return self.con.sql(_ENCODE).to_arrow_table()
        # Long pieces: rounds as a loop, so that only the last state is held.
        self.con.execute("CREATE OR REPLACE TEMP TABLE now AS SELECT w, CAST(pos AS INTEGER) AS pos, tok FROM start")
        done = []
        while True:
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE picked AS {_LONG_PICKS}")
            done.append(self.con.sql("SELECT w, list(tok ORDER BY pos) AS toks FROM now ANTI JOIN picked USING (w) GROUP BY w").to_arrow_table())
            if not self.con.sql("SELECT count(*) FROM picked").fetchall()[0][0]:
                return pa.concat_tables(done)
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE later AS {_LONG_ROUND}")
            self.con.execute("CREATE OR REPLACE TEMP TABLE now AS FROM later")

    def learn(self, pieces: list[str]) -> None:
        """Encode and decode distinct pieces into the cache."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        whole = [self.ranks.get(b) for b in raw]
        # A piece that is a token needs no merges; its bytes come from the vocabulary like any other's.
        tokens = [i for i, r in enumerate(whole) if r is not None]
        for part in _parts(tokens):
            toks = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32), pa.array([whole[i] for i in part], pa.int32()))
            self._collect(pa.table({"w": np.arange(len(part), dtype=np.int32), "toks": toks}), [pieces[i] for i in part])
        rest = [i for i, r in enumerate(whole) if r is None]
        short = [i for i in rest if len(raw[i]) <= SHORT_PIECE]
        for part in [*_parts(short), [i for i in rest if len(raw[i]) > SHORT_PIECE]]:
            if not part:
                continue
            self._collect(self._fixpoint([raw[i] for i in part]), [pieces[i] for i in part])
        self.size += sum(map(len, raw)) * 3 + 260 * len(raw)

    def _collect(self, fixpoint: pa.Table, pieces: list[str]) -> None:
        """Cache the ids of each piece and the bytes that they decode to."""
        self.con.register("fixpoint", fixpoint)
        for w, ids, text in zip(*(c.to_pylist() for c in self.con.sql(_COLLECT).to_arrow_table().columns), strict=True):
            self.known[pieces[w]] = (ids.encode(), text)

    def encode_batch(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """(number of ids, ids joined by one blank, decoded bytes) per text."""
        # A piece as a Python string takes 15 times its bytes: those of a few texts at a time are.
        cut, counts, first, size = [], [], 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= STRING_CHARS or i == len(texts) - 1:
                found = [self.pattern.findall(t) for t in texts[first : i + 1]]
                counts += map(len, found)
                cut.append(pa.array(chain.from_iterable(found), pa.large_string(), size=sum(counts[first:])))
                first, size = i + 1, 0
        found, ends = None, np.cumsum(counts)
        pieces = pa.concat_arrays(cut).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        new = []
        for p in distinct:
            if p not in self.known:
                if p in self.older:
                    self.known[p] = self.older[p]
                    self.size += 3 * len(p) + 260
                else:
                    new.append(p)
        if new:
            self.learn(new)
        rows = [self.known[p] for p in distinct]
        if self.size > CACHE_BYTES:  # pieces that the next batches do not ask for go with the older half
            self.known, self.older, self.size = {}, self.known, 0
        # One gather lays the pieces' results end to end; a text's are a slice.
        ids, ids_at = _gather([r[0] for r in rows], pieces.indices)
        decoded, decoded_at = _gather([r[1] for r in rows], pieces.indices)
        out, first = [], 0
        for end in ends.tolist():
            joined = bytes(ids[ids_at[first] : ids_at[end]])[:-1]
            out.append((joined.count(b" ") + (end > first), joined, bytes(decoded[decoded_at[first] : decoded_at[end]])))
            first = end
        return out

    def decode_batch(self, ids: list[list[int]]) -> list[bytes]:
        """Bytes of each id list, by an ordered aggregation."""
        self.con.register("fixpoint", pa.table({"w": np.arange(len(ids)), "toks": pa.array(ids, pa.list_(pa.int32()))}))
        got = dict(self.con.sql(_DECODE).fetchall())
        return [got.get(i, b"") for i in range(len(ids))]


def _parts(places: list[int]) -> list[list[int]]:
    return [places[k : k + PIECES_PER_ROUND] for k in range(0, len(places), PIECES_PER_ROUND)]


def _gather(values: list[bytes], indices: pa.Array) -> tuple[memoryview, np.ndarray]:
    """Bytes of the indexed values end to end, and the offset of each."""
    taken = pa.array(values, pa.large_binary()).take(indices)
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64, len(taken) + 1) if offsets else np.zeros(1, np.int64)
    return memoryview(data or b""), at


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One tokenizer per worker process and vocabulary."""
    cache = worker_cache("bpe")
    if (path, pattern) not in cache:
        cache[path, pattern] = Tokenizer(path, pattern)
        give_back()
    return cache[path, pattern]


def _held(batches: Iterator[pa.RecordBatch], limit: int = BATCH_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of whole rows with about ``limit`` characters together,
    across Arrow batches: DuckDB's rounds cost the same for few pieces."""
    keys, texts, size = [], [], 0
    for batch in batches:
        first = 0
        for i, t in enumerate(batch.column(1)):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= limit:
                yield pa.concat_arrays([*keys, batch.column(0).slice(first, i + 1 - first)]), texts
                keys, texts, size, first = [], [], 0, i + 1
        if first < batch.num_rows:
            keys.append(batch.column(0).slice(first))
    if texts:
        yield pa.concat_arrays(keys), texts


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """One row per document: ``key, n_tokens, ids_sha256, decoded_sha256`` and,
    with ``ids``, the token ids (``array<int>``).

    A null text is an empty one (no ids); repeated rows and ids stay rows of
    their own; no row of a large text is cut, a batch holds at most one text
    more than 3 million characters.  ``path`` must be readable on executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for keys, texts in _held(batches):
            rows = tok.encode_batch(texts)
            cols = [
                keys,
                pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for _, i, _ in rows], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for _, _, d in rows], pa.string()),
            ]
            if ids:
                cols.append(pa.array([np.fromstring(i.decode(), np.int32, sep=" ") for _, i, _ in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)
            rows = cols = None
            give_back()

    text_batches(docs.sparkSession)
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(key, text).mapInArrow(lean(run), schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded``: the bytes of each row's token ids (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                decoded = tok.decode_batch([i or [] for i in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(decoded, pa.binary())], [key, "decoded"])

    return encoded.select(key, ids).mapInArrow(lean(run), f"`{key}` {dict(encoded.dtypes)[key]}, decoded binary")
