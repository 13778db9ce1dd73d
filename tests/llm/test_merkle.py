"""Manifest and witnesses against a plain tree in Python."""

import hashlib
import random

import pytest

from filingflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int, `_ff_pos` string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(data):
    return hashlib.sha256(data.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)])
    return levels


def plain_path(levels, i):
    found = []
    for level in levels[:-1]:
        start = i - i % 3
        found.append((i - start, [h for k, h in enumerate(level[start : start + 3]) if start + k != i]))
        i //= 3
    return found


def plain_fold(leaf, path):
    for place, siblings in path:
        leaf = sha("".join([*siblings[:place], leaf, *siblings[place:]]))
    return leaf


def plain_manifest(rows, change):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = members, plain_levels([plain_leaf(r) for r in members])
    top = plain_levels([trees[g][1][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        members, levels = trees[g]
        for i, r in enumerate(members):
            path = plain_path(levels, i) + plain_path(top, k)
            folded = plain_fold(plain_leaf(change(r)), path)
            proof = sha("".join(h for _, siblings in path for h in siblings))
            out.append((r[0], plain_leaf(r), levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def cut(row):
    tampered = row[0] is not None and row[0] % 2 == 0
    return (*row[:4], row[4].replace("\n", "") if tampered and row[4] is not None else row[4])


def own_manifest(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    docs = docs.select(*FIELDS, merkle.leaf_digest(*FIELDS).alias("leaf"), "root", "_ff_pos")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    docs = docs.withColumn("claimed", merkle.leaf_digest(*FIELDS))
    found = merkle.verify(merkle.manifest(docs, "source", "doc_id", "leaf", keep=["claimed"]), claimed="claimed")
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in found.collect()]


def sample(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for g, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "é\n" * rng.randrange(1, 4), "w " * 20_000])
            rows.append((rng.choice([None, *range(-5, 400)]), g, rng.choice([None, "en"]), rng.choice([None, 3]), text))
    return rows + rows[: len(rows) // 3]  # repeated rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_in_plain_python(spark, seed):
    sizes = {None: 4, "": 1, "a": 2, "b": 3, "é": 28, "Z": 80, "z": 82, "hot": 200}
    rows = sample(seed, sizes)
    assert sorted(map(repr, own_manifest(spark, rows))) == sorted(map(repr, plain_manifest(rows, cut)))


def test_many_rounds_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = sample(3, {f"s{i}": n for i, n in enumerate([1, 8, 9, 10, 27, 28, 80, 81, 82, 245])} | {f"t{i}": 1 for i in range(12)})
    assert sorted(map(repr, own_manifest(spark, rows))) == sorted(map(repr, plain_manifest(rows, cut)))


def test_one_row_and_no_row(spark):
    row = (7, "s", "en", 1, "x")
    assert own_manifest(spark, [row]) == plain_manifest([row], cut)
    assert own_manifest(spark, [row])[0][3] == plain_leaf(row)
    assert own_manifest(spark, []) == []


def test_append_extends_open_witnesses():
    digests = [bytes([i]) * 32 for i in range(5)]
    block = merkle.Block()
    for d in digests[:2]:
        block.append(d)
    assert [bytes(w) for w in block.witness] == [b"", b""]  # their run is open
    block.append(digests[2])
    assert bytes(block.witness[0]) == digests[1] + digests[2]
    for d in digests[3:]:
        block.append(d)
    root = block.close(merkle.height(5))
    low, high = merkle.node(digests[:3]), merkle.node(digests[3:])
    assert root == merkle.node([low, high])
    assert bytes(block.witness[4]) == digests[3] + low
    assert merkle.fold(digests[4], bytes(block.witness[4]), [(4, 5)]) == (root, 2)


def test_any_change_of_a_leaf_fails(spark):
    from pyspark.sql import functions as F

    rows = sample(9, {"a": 30})
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).withColumn("leaf", merkle.leaf_digest(*FIELDS))
    docs = docs.withColumn("other", F.sha2(F.concat(F.lit("other"), "leaf"), 256))
    found = merkle.manifest(docs, "source", "doc_id", "leaf", keep=["other"])
    assert merkle.verify(found).where("verified").count() == len(rows)
    assert merkle.verify(found, claimed="other").where("NOT verified").count() == len(rows)
