"""Ball-tree search against scores of all documents in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from filingflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_search(docs, items, top):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counts]
    n_docs, all_terms = sum(n > 0 for n in sizes), sum(sizes)
    holding = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for (i, c), n in zip(counts, sizes, strict=True):
            score = 0
            for w, times in Counter(plain_terms(text)).items():
                if c[w]:
                    m = 100 - 25 + (25 * n * n_docs) // all_terms
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def sample(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "d4", "Été", "naïve", "日本", "x y", "the", "of", "K"] + [f"w{k}" for k in range(60)]
    text = lambda: rng.choice([" ", "-", "\n", "_"]).join(rng.choices(words, k=rng.randrange(1, 40)))
    docs = [(i, text()) for i in range(n)]
    copy = "the of w1 w2 w3 w4"
    docs += [(n + i, copy) for i in range(n // 2)] + [(3, text()), (None, copy), (None, copy), (n * 3, None), (n * 3 + 1, ""), (n * 3 + 2, "?!"), (n * 3 + 3, "w5 " * 5000)]
    items = [(i, text()) for i in range(12)] + [(1, copy), (None, "w5 w5 w6"), (50, None), (51, ""), (52, "nowhere"), (53, "the of the")]
    rng.shuffle(docs)
    return docs, items


def frames(spark, docs, items):
    made = spark.createDataFrame([(i, t, "k", 1, 2.0) for i, t in docs], "doc_id long, text string, item_id string, rank int, score double")
    return made.repartition(3), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("seed", [1, 2])
def test_as_in_plain_python(spark, seed):
    docs, items = sample(seed, 300)
    got = lexical.search(*frames(spark, docs, items), top=20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_search(docs, items, 20)))


def test_small_blocks_and_trees(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 4)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 200)
    monkeypatch.setattr(lexical, "CHUNK", 11)
    docs, items = sample(4, 120)
    got = lexical.search(*frames(spark, docs, items), top=3).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_search(docs, items, 3)))


def test_empty_tables(spark):
    docs, items = sample(5, 10)
    for d, i in ((docs, []), ([], items), ([(1, None)], items)):
        assert lexical.search(*frames(spark, d, i)).count() == 0


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one two two")], "item_id string, text string")
    assert [r["doc_id"] for r in lexical.search(docs, items).orderBy("rank").collect()] == ["a", "b", None]


def test_terms_in_pieces(monkeypatch):
    text = "Ab-cdÉ x9_y z " * 50 + "\x7f{end}"
    whole = [w.encode() for w in plain_terms(text)]
    for chunk in (1, 7, 1 << 20):
        monkeypatch.setattr(lexical, "CHUNK", chunk)
        assert [w for part in lexical.terms(text.encode()) for w in part] == whole


def random_tree(rng, rows, width, per_row):
    sizes = rng.integers(1, per_row, rows)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([np.sort(rng.choice(width, n, replace=False)) for n in sizes] + [np.zeros(0)]).astype(np.int32)
    return lexical.BallTree(ends, ids, rng.integers(1, 1_000_000, len(ids)), width)


@pytest.mark.parametrize("bands", [1, 7, 1024])
def test_bounds_hold_for_every_ball(monkeypatch, bands):
    monkeypatch.setattr(lexical, "BANDS", bands)
    rng = np.random.default_rng(3)
    tree = random_tree(rng, 400, 80, 30)
    assert sorted(tree.rows.tolist()) == list(range(400))
    for _ in range(20):
        ids = np.sort(rng.choice(80, 6, replace=False))
        item = lexical.Item(ids, rng.integers(1, 20_000, 6), 80)
        weights = dict(zip(ids.tolist(), item.values.tolist(), strict=True))
        scores = [sum(weights.get(int(t), 0) * int(v) for t, v in zip(tree.ids[a:b], tree.values[a:b], strict=True)) for a, b in zip(tree.ends, tree.ends[1:])]
        for bound, first, end in zip(tree.bounds(item), tree.first, tree.end, strict=True):
            assert max(scores[first:end]) <= bound


def test_subtrees_are_pruned():
    """Groups of like documents: only the item's own group is scored."""
    rng = np.random.default_rng(8)
    groups, each, width = 32, 32, 32 * 10
    ids = np.concatenate([np.arange(10) + 10 * (r % groups) for r in range(groups * each)]).astype(np.int32)
    tree = lexical.BallTree(np.arange(0, len(ids) + 1, 10), ids, 400_000 + rng.integers(0, 1000, len(ids)), width)
    best, scratch = lexical.Best(20), np.zeros(width, np.int64)
    best.keys = pa.array(range(groups * each))
    scored = tree.search(lexical.Item(np.arange(50, 60), np.full(10, 9000), width), scratch, best)
    assert scored <= 2 * each and len(best.rows) == 20 and all(k % groups == 5 for _, _, k in best.rows)
    assert not scratch.any()
