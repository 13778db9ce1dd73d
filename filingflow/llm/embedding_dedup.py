"""Embedding near-dedup with randomised-rotation binary codes (operator 2).

Every unit vector ``o`` is rotated by a random orthogonal matrix; its code is
the sign of each rotated component, and ``a = <code / sqrt(D), o>`` is stored
as correction factor.  For another unit vector ``q``,
``<code / sqrt(D), q> / a`` estimates the cosine ``c`` without bias: its error
is ``u * sqrt(1 - a*a) / a * sqrt(1 - c*c)`` with ``u`` the cosine of a random
direction, so ``|u| <= width`` bounds it.  ``width = e / sqrt(D - 1)`` gives a
confidence interval; the default width 1 is the certain bound, so no link is
lost.  Pairs whose bound reaches the threshold are recomputed exactly in double
precision; all others are dropped on the code alone.

Equal vectors of a label are one class, with a number of its own, a count and its
smallest key; keys may repeat.  Classes of a label are dealt into blocks of
``block_rows`` (fewer for long vectors, so that a block has at most ``BLOCK_BYTES``),
and each pair of blocks is a task with two blocks in memory, however many rows a label
holds.  A task returns per class a link count and a spanning forest of the links,
never the pairs; for that it needs the vectors beside the codes, which are sent as
they are stored (4 bytes a component for floats) once for every block of their label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingflow.llm.common import connected_components, star_forest, work_table


#: Bound of a block's vectors in double precision.
BLOCK_BYTES = 32 << 20


def rotation(dim: int, seed: int) -> np.ndarray:
    """Random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits, correction factors) of unit rows."""
    turned = vectors @ rotation(vectors.shape[1], seed).T
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimates(codes: np.ndarray, factor: np.ndarray, queries: np.ndarray, seed: int) -> np.ndarray:
    """Unbiased cosine estimates, rows: codes, columns: unit query vectors."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (queries @ rotation(dim, seed).T).astype(np.float32)
    return (signs @ turned.T) / (np.sqrt(dim) * factor[:, None].astype(np.float32))


def candidates(codes: np.ndarray, factor: np.ndarray, queries: np.ndarray, threshold: float, seed: int, width: float) -> np.ndarray:
    """Pairs whose confidence bound reaches the threshold (boolean matrix)."""
    slack = np.sqrt(np.maximum(1 - factor**2, 0)) / factor * np.sqrt(1 - threshold**2) * width
    return estimates(codes, factor, queries, seed) >= (threshold - slack - 1e-4)[:, None].astype(np.float32)


def _block_links(part: pd.DataFrame, low: int, high: int, threshold: float, seed: int, width: float, kind: type) -> pd.DataFrame:
    vectors = unit_rows(np.frombuffer(b"".join(part["raw"]), kind).reshape(len(part), -1).astype(np.float64))
    codes = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1)
    factor, node, copies = part["factor"].to_numpy(), part["node"].to_numpy(), part["copies"].to_numpy()
    a = np.flatnonzero(part["blk"].to_numpy() == low)
    b = a if low == high else np.flatnonzero(part["blk"].to_numpy() == high)
    links = np.zeros(len(part), np.int64)
    label = np.arange(len(part))
    for at in range(0, len(a), 512):  # bounds the open pairs
        rows = a[at : at + 512]
        near = candidates(codes[rows], factor[rows], vectors[b], threshold, seed, width)
        i, j = np.nonzero(near)
        i, j = rows[i], b[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 17):
            x, y = i[k : k + (1 << 17)], j[k : k + (1 << 17)]
            linked = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
            x, y = x[linked], y[linked]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            label = star_forest(len(part), label[x], label[y])[label]
    counted, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(part)))
    return pd.DataFrame(
        {
            "a": np.concatenate([node[counted], node[moved]]),
            "links": np.concatenate([links[counted], np.zeros(len(moved), np.int64)]),
            "b": pd.array(np.concatenate([node[counted], node[label[moved]]]), "Int64"),
        }
    )


def near_duplicates(
    embeddings: DataFrame, threshold: float = 0.93, seed: int = 7, width: float = 1.0, block_rows: int = 8192,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per vector: ``key, n_links, component_id, kept``.

    Vectors of one label (not null) and one length link at cosine >=
    ``threshold``.  A vector that is null, empty or zero, holds null or
    non-finite components, or has no key links with nothing: no links, its own
    component, kept.  Repeated rows are vectors of their own and link with each
    other, also where one key has different vectors; an empty table gives an empty
    result."""
    kind = np.float32 if dict(embeddings.dtypes)[vector] == "array<float>" else np.float64
    vec = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(key).alias("key"), F.col(label).alias("label"), vec.alias("vec"))
    sound = (
        F.col("key").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    rows = rows.withColumn("vec", F.when(F.coalesce(sound, F.lit(False)), F.col("vec")))
    classes = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = work_table(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")

    in_block = F.greatest(F.lit(1), F.least(F.lit(block_rows), F.expr(f"int({BLOCK_BYTES} div (8 * dim))")))
    parts = classes.groupBy("label", F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("label", "dim", F.ceil(F.col("n") / in_block).cast("int").alias("parts"))
    dealt = classes.withColumn("dim", F.size("vec")).join(parts, ["label", "dim"])
    dealt = dealt.withColumn("blk", F.expr("int(pmod(xxhash64(vec), parts))"))

    def with_codes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby("dim"):
                unit = unit_rows(np.stack(part["vec"].to_numpy()))
                codes, factor = encode(unit, seed)
                out = part.drop(columns="vec").assign(factor=factor)
                out["code"] = [c.tobytes() for c in codes]
                out["raw"] = [np.asarray(v, kind).tobytes() for v in part["vec"]]
                yield out

    coded = dealt.select("label", "dim", "blk", "parts", "node", "copies", "vec").mapInPandas(
        with_codes, f"label {dict(rows.dtypes)['label']}, dim int, blk int, parts int, node long, copies long, factor double, code binary, raw binary"
    )
    pairs = coded.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    pairs = pairs.withColumns({"low": F.least("blk", "other"), "high": F.greatest("blk", "other")}).drop("other", "parts")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        return _block_links(part, part["low"].iloc[0], part["high"].iloc[0], threshold, seed, width, kind)

    found = work_table(pairs.groupBy("label", "dim", "low", "high").applyInPandas(compare, "a long, links long, b long"), "vectors")
    counts = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("far"))
    components = connected_components(found.where("links = 0"), "a", "b")
    nodes = classes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(smallest, "component").join(counts, "node", "left").select(
        F.col("label").alias("c_label"), F.col("vec").alias("c_vec"), (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), "component_id"
    )
    joined = rows.join(nodes, (F.col("label") == F.col("c_label")) & (F.col("vec") == F.col("c_vec")), "left")
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
