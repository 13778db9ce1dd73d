"""Language ID by interpolated Kneser-Ney character models (operator 7).

One model per language over normalised text (lower case, runs of non-letters
become one blank): n-gram counts of a bounded sample of labelled documents are
summed by Spark; absolute discounting, continuation counts for the lower
orders and interpolation down to a uniform distribution follow Kneser and Ney.
The n-grams of all languages are stored in one sorted array of 64-bit hashes
with a row of log-probabilities per n-gram, so that scoring is one binary
search per character; an n-gram that no language has seen is computed from the
lower orders.  The language with the lowest cross-entropy per character wins;
a text whose cross-entropy lies outside what held-back sample documents of
that language show is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.llm.common import lean, text_batches

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.random.default_rng(2024).integers(1 << 62, 1 << 63, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SLICE = 1 << 19


def normalise(text: str) -> str:
    clean = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return clean if any(map(str.isalpha, clean)) else ""  # fractions and superscripts alone are no letters


def gram_hash(grams: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of n-grams given as one array per position."""
    h = np.full(len(grams[0]), len(grams), np.uint64)
    for codes, m in zip(grams, _MULTIPLIERS, strict=False):
        h += (codes.astype(np.uint64) + np.uint64(1)) * m
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _distinct(grams: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams, one array per position, and how often each occurs."""
    if not len(grams[0]):
        return grams, np.empty(0, np.int64)
    order = np.lexsort(grams[::-1])
    grams = [g[order] for g in grams]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([g[1:] != g[:-1] for g in grams])
    first = np.flatnonzero(new)
    return [g[first] for g in grams], np.diff(np.append(first, len(order)))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class _Order:
    """Counts of one order of one language, in sorted hash arrays."""

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    types: np.ndarray
    discount: float

    @classmethod
    def of(cls, grams: list[np.ndarray], counts: np.ndarray) -> _Order:
        keys = gram_hash(grams)
        order = np.argsort(keys)
        contexts, inverse = np.unique(gram_hash(grams[:-1]) if len(grams) > 1 else np.zeros(len(keys), np.uint64), return_inverse=True)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        return cls(keys[order], counts[order], contexts, np.bincount(inverse, counts), np.bincount(inverse), discount)


class KneserNey:
    """Interpolated Kneser-Ney model of one language."""

    def __init__(self, grams: list[np.ndarray], counts: np.ndarray, alphabet: int):
        """``grams``: the distinct n-grams, one array of code points per position."""
        self.uniform = 1.0 / alphabet
        self.orders = [_Order.of(grams, counts.astype(float))]
        while len(grams) > 1:
            # A lower-order count is the number of different left neighbours.
            grams, neighbours = _distinct(grams[1:])
            self.orders.insert(0, _Order.of(grams, neighbours.astype(float)))

    def probability(self, grams: list[np.ndarray]) -> np.ndarray:
        """p(last | those before) for n-grams of up to the model's order."""
        p = np.full(len(grams[-1]), self.uniform)
        for k in range(1, len(grams) + 1):
            o, tail = self.orders[k - 1], grams[-k:]
            at, seen = _lookup(o.keys, gram_hash(tail))
            count = np.where(seen, o.counts[at], 0.0)
            at, known = _lookup(o.contexts, gram_hash(tail[:-1]) if k > 1 else np.zeros(len(p), np.uint64))
            mixed = (np.maximum(count - o.discount, 0) + o.discount * o.types[at] * p) / o.total[at]
            p = np.where(known, mixed, p)
        return p


@dataclass
class Model:
    """All languages' models and the merged table of log-probabilities."""

    order: int
    languages: list[str]
    models: list[KneserNey]
    keys: np.ndarray
    logp: np.ndarray
    #: Per language: highest cross-entropy accepted for a long text, and how much a text of n characters adds over sqrt(n).
    limit: np.ndarray = field(default_factory=lambda: np.empty(0))
    spread: np.ndarray = field(default_factory=lambda: np.empty(0))

    @classmethod
    def build(cls, counts, order: int) -> Model:
        """``counts``: a pandas table with columns lang, c0 .. c{order-1}, n."""
        names = [f"c{i}" for i in range(order)]
        languages = sorted(counts["lang"].unique())
        alphabet = counts[names[-1]].nunique() + 1
        models = []
        for lang in languages:
            own = counts[counts["lang"] == lang]
            models.append(KneserNey([own[c].to_numpy() for c in names], own["n"].to_numpy(), alphabet))
        merged = counts[names].drop_duplicates()
        grams = [merged[c].to_numpy() for c in names]
        keys = gram_hash(grams) if len(merged) else np.empty(0, np.uint64)
        at = np.argsort(keys)
        logp = np.stack([-np.log(m.probability(grams)) for m in models], axis=1)[at] if models else np.empty((0, 0))
        return cls(order, languages, models, keys[at], logp.astype(np.float32))

    def costs(self, grams: list[np.ndarray]) -> np.ndarray:
        """-ln p per n-gram and language."""
        hashes = gram_hash(grams)
        at, seen = _lookup(self.keys, hashes)
        out = self.logp[at]
        if not seen.all():
            miss = np.flatnonzero(~seen)
            _, first, inverse = np.unique(hashes[miss], return_index=True, return_inverse=True)
            rare = [g[miss[first]] for g in grams]
            out[miss] = np.stack([-np.log(m.probability(rare)) for m in self.models], axis=1).astype(np.float32)[inverse]
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(characters, mean cost per language, mean squared cost) of normalised texts."""
        pad = self.order - 1
        codes = np.frombuffer("".join(" " * pad + t + " " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) + 1 for t in texts])
        start = np.cumsum(size + pad) - size  # first scored character of each text
        owner = np.repeat(np.arange(len(texts)), size)
        where = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
        total, square = np.zeros((len(texts), len(self.languages))), np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(where), _SLICE):
            w, o = where[at : at + _SLICE], owner[at : at + _SLICE]
            cost = self.costs([codes[w - pad + i] for i in range(self.order)])
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(o, cost[:, k], len(texts))
                square[:, k] += np.bincount(o, cost[:, k] ** 2, len(texts))
        return size, total / size[:, None], square / size[:, None]

    def predict(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """lang_pred, score, cross_entropy, deviation (of a character's cost), chars, rejected."""
        clean = [normalise(t or "") for t in texts]
        n = len(clean)
        out = {
            "lang_pred": np.full(n, UNDETERMINED, object), "score": np.zeros(n), "cross_entropy": np.full(n, np.nan),
            "deviation": np.full(n, np.nan), "chars": np.array([len(t) for t in clean], np.int64), "rejected": np.ones(n, bool),
        }
        some = np.flatnonzero(out["chars"])
        if not len(some) or not self.languages:
            return out
        size, cost, square = self.cross_entropies([clean[i] for i in some])
        best = cost.argmin(axis=1)
        rows = np.arange(len(some))
        lowest = cost[rows, best]
        gap = (cost - lowest[:, None]) * np.minimum(size, 40)[:, None]
        out["lang_pred"][some] = np.array(self.languages, object)[best]
        out["score"][some] = 1.0 / np.exp(-gap).sum(axis=1)
        out["cross_entropy"][some] = lowest
        out["deviation"][some] = np.sqrt(np.maximum(square[rows, best] - lowest**2, 0))
        if len(self.limit):
            out["rejected"][some] = lowest > self.limit[best] + self.spread[best] / np.sqrt(size)
        return out


def _groups(texts: list, limit: int = 1 << 19) -> Iterator[list]:
    group: list = []
    size = 0
    for t in texts:
        if group and size + len(t or "") > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t or "")
    if group:
        yield group


_FIT_SLICE = 1 << 18


def _gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, c0 .., n): counts of the sample's n-grams."""
    names = [f"c{i}" for i in range(order)]
    text_batches(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(normalise(text))
            for lang, texts in by_lang.items():
                pad = " " * (order - 1)
                # Slices overlap by order - 1 characters: every n-gram ends in one of them.
                slices = [(pad + t + " ")[a : a + _FIT_SLICE + order - 1] for t in texts if t for a in range(0, len(t) + 1, _FIT_SLICE)]
                for group in _groups(slices):
                    codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)
                    keep = np.ones(len(codes), bool)
                    size = np.array([len(t) for t in group], int)
                    first = np.cumsum(size) - size
                    for i in range(order - 1):
                        keep[first + i] = False
                    at = np.flatnonzero(keep)
                    if len(at):
                        grams, n = _distinct([codes[at - (order - 1) + i].astype(np.int32) for i in range(order)])
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *map(pa.array, grams), pa.array(n, pa.int64())], ["lang", *names, "n"])

    schema = "lang string, " + ", ".join(f"{n} int" for n in names) + ", n long"
    return sample.select("lang", "text").mapInArrow(lean(run), schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def fit(
    labelled: DataFrame, key: str = "doc_id", order: int = 4, docs_per_language: int = 1500, max_languages: int = 200,
    max_chars: int = 200_000, seed: int = 11, strictness: float = 6.0,
) -> Model:
    """Model from ``labelled`` (key, text, lang).

    Every language is learned.  The bound on what is learned from: of each
    about ``docs_per_language`` documents, whole, and ``max_chars`` characters
    for each of these on average, in proportion less for more than
    ``max_languages`` languages, but one document at least, chosen by a seeded
    hash of the key.  Of a language with ten chosen documents a tenth is held
    back to calibrate the rejection; others reject nothing.  Rows without
    language or text are left out; without any row nothing is learned and
    every prediction is ``und``."""
    draw = F.coalesce(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / 1e6, F.lit(0.0))
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", draw.alias("draw"))
    chars = F.sum(F.greatest(F.length("text"), F.lit(1)).cast("bigint"))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), chars.alias("chars"), F.min("draw").alias("least")).collect()
    spark = labelled.sparkSession
    most = docs_per_language * min(1.0, max_languages / max(len(sizes), 1))
    shares = [(r["lang"], min(1.0, most / r["n"], most * max_chars / r["chars"]), r["least"], r["n"]) for r in sizes]
    shares = spark.createDataFrame(shares, "lang string, share double, least double, n long")
    sample = usable.join(F.broadcast(shares), "lang").where((F.col("draw") < F.col("share")) | (F.col("draw") == F.col("least")))
    held_back = (F.col("draw") >= 0.9 * F.col("share")) & (F.col("draw") > F.col("least")) & (F.col("n") * F.col("share") >= 10)
    counts = _gram_counts(sample.where(~held_back), order).toPandas()
    model = Model.build(counts, order)

    scored = predict(sample.where(held_back).select(F.col("lang").alias("doc_id"), "text"), model)
    right = scored.where("doc_id = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", [0.5, 0.84], 1000).alias("q"), F.percentile_approx("deviation", 0.5).alias("s")
    )
    found = {r["lang_pred"]: r for r in right.collect()}
    n = len(model.languages)
    model.limit, model.spread = np.full(n, np.inf), np.zeros(n)
    for k, lang in enumerate(model.languages):
        if lang in found:
            (middle, high), s = found[lang]["q"], found[lang]["s"]
            # a nat of slack at least: a rejected text is unlike the language, not a little off
            model.limit[k] = middle + max(strictness * (high - middle), 1.0)
            model.spread[k] = strictness * s
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, lang_pred, score, cross_entropy, rejected``.

    ``lang_pred`` is the best language, also of a rejected text; a null text
    and one without a letter are ``und``, score 0, rejected.  Whole texts are
    scored, in slices of bounded memory; repeated rows stay rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fit's sample
    text_batches(docs.sparkSession)
    names = [key, "lang_pred", "score", "cross_entropy", "deviation", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1).to_pylist()):
                found = shared.value.predict(group)
                arrays = [batch.column(0).slice(at, len(group)), *(pa.array(found[n], from_pandas=True) for n in names[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names)
                at += len(group)

    schema = f"`{key}` {dict(docs.dtypes)[key]}, lang_pred string, score double, cross_entropy double, deviation double, rejected boolean"
    return docs.select(key, text).mapInArrow(lean(run, shared), schema)


def held_out(key) -> F.Column:
    """Fold of the documents that are never learned from (null keys too)."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def keep_accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text the model does not reject;
    scored where they are read, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(batch.column(place).to_pylist()):
                keep = ~shared.value.predict(group)["rejected"]
                yield batch.slice(at, len(group)).filter(pa.array(keep))
                at += len(group)

    return docs.mapInArrow(lean(run, shared), docs.schema)
