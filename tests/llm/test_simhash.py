import random
import re

import xxhash

from filingflow.llm import simhash


def brute_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    comp = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    return comp


def test_documents_match_brute_force(make_docs):
    rng = random.Random(5)
    vocab = ["Ab", "cD", "é", "ÉA", "x y", "1", "the", "of", "zz", "q"]
    texts = [None, "", " \t\n", "one two", "one two three four", "A\x0bB\x1cC d e F g"]
    for _ in range(40):
        base = [rng.choice(vocab) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 120))]
        texts.append(" ".join(base))
        for _ in range(2):
            edited = list(base)
            edited[rng.randrange(len(base))] = "changed"
            texts.append("  ".join(edited))
    texts += ["w " * 70_000]
    docs = make_docs([(10 * i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, 4, 6).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    comp = brute_components(fps, 6)
    for i, fp in enumerate(fps):
        assert got[10 * i]["fp"] % 2**64 == fp
        assert got[10 * i]["component_id"] == 10 * comp[i]


def test_links_in_split_shards(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 9))))
    chain = rng.getrandbits(64)
    for b in range(0, 60, 3):
        chain ^= 7 << b
        fps.add(chain)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    comp = brute_components(fps, 4)
    groups = {}
    for f, c in zip(signed, comp):
        groups.setdefault(c, set()).add(f)
    expect = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    from filingflow.llm.common import connected_components

    for rows in (8192, 7):
        found = connected_components(simhash.fingerprint_links(df, 4, shard_rows=rows), "a", "b").collect()
        got = {}
        for r in found:
            got.setdefault(r["component"], set()).add(r["node"])
        assert sorted(sorted(g) for g in got.values()) == expect


def test_edges(spark, make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    docs = make_docs([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (2, None), (None, "only this has no key at all here")])
    got = sorted(map(tuple, simhash.near_duplicates(docs).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (2, 2), (None, None)], key=repr)
    clash = docs.selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS first")
    kept = simhash.keep_one(clash, simhash.near_duplicates(clash))
    assert kept.columns == clash.columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=repr) == [2, 4, None]


def test_one_of_each_group_stays_when_keys_are_null_or_repeat(make_docs):
    a, b, c = "alpha beta gamma delta epsilon", "quite another text of some words", "a third one that is like neither"
    docs = make_docs([(None, a), (None, a), (None, b), (5, b), (7, c), (7, "and seven once more with its own text"), (None, c), (None, "no key and no copy")])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs)).collect()
    got = sorted([(r["doc_id"], r["text"]) for r in kept], key=repr)
    expect = [(None, a), (5, b), (7, c), (7, "and seven once more with its own text"), (None, "no key and no copy")]
    assert got == sorted(expect, key=repr)


def test_very_long_texts(make_docs):
    rng = random.Random(21)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(300_000)]
    near = words[:150_000] + ["changed"] + words[150_001:]
    docs = make_docs([(1, " ".join(words)), (2, " \t".join(words).upper()), (3, " ".join(near)), (4, " ".join(words[:200]))])
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs, words_per_shingle=4, max_bits=4).collect()}
    assert got[1] == got[2] and got[3][1] == 1 and got[4][1] == 4
