import math
from dataclasses import replace

import pytest

from filingflow.llm import mixing


def sources(spark, tokens):
    return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(tokens)], "source string, tokens long")


def weights(tokens, alpha):
    w = [(t / sum(tokens)) ** alpha for t in tokens]
    return [x / sum(w) for x in w]


def test_bisection_meets_the_goal(spark):
    tokens = [1000, 300, 40, 7]
    df = sources(spark, tokens)
    target = 1.1
    t = mixing.solve(df, entropy=target)
    assert -sum(w * math.log(w) for w in weights(tokens, t.alpha)) == pytest.approx(target, abs=1e-6)
    t = mixing.solve(df, repetition_limit=3.0, budget=2000)
    epochs = [w * 2000 / n for w, n in zip(weights(tokens, t.alpha), tokens)]
    assert max(epochs) == pytest.approx(3.0, abs=1e-6)
    t = mixing.solve(df, repetition_limit=2.0)
    epochs = [w * t.budget / n for w, n in zip(weights(tokens, t.alpha), tokens)]
    assert max(epochs) == pytest.approx(2.0, abs=1e-6) and min(epochs) == pytest.approx(1.0, abs=1e-6)
    assert mixing.solve(df, entropy=5.0).alpha == 0.0 and mixing.solve(df).alpha == 1.0
    assert mixing.solve(df.limit(0)) is None


def brute_quotas(tokens, t):
    return [math.floor(w * t.budget + 1e-6) for w in weights(tokens, t.alpha)]


def test_quotas_are_filled_by_block_permutations(spark):
    units = [(i, "hot" if i % 2 else f"s{i % 6}", 1 + i * 37 % 11) for i in range(400)] + [(9000, None, 5), (None, "s0", 4), (9001, "s0", 3), (9001, "s0", 2)]
    df = spark.createDataFrame(units, "doc_id long, source string, tokens long")
    for bucket_rows in (4096, 16):
        rows = mixing.mix(df, repetition_limit=2.5, bucket_rows=bucket_rows).collect()
        by_source = {}
        for _, s, n in units:
            by_source[s] = by_source.get(s, 0) + n
        names = sorted(by_source, key=str)
        t = mixing.solve(sources(spark, [by_source[s] for s in names]), repetition_limit=2.5)
        for s, quota in zip(names, brute_quotas([by_source[s] for s in names], t)):
            own = [r for r in rows if r["source"] == s]
            members = {u[0] for u in units if u[1] == s}
            largest = max(r["tokens"] for r in own)
            assert quota - largest < sum(r["tokens"] for r in own) <= quota
            for e in range(quota // by_source[s]):
                one_pass = [r for r in own if r["epoch"] == e]
                assert len(one_pass) == len(members) and {r["doc_id"] for r in one_pass} == members
                assert sorted(r["position"] for r in one_pass) == list(range(len(members)))
            last = sorted((r for r in own if r["epoch"] == quota // by_source[s]), key=lambda r: r["position"])
            assert [r["position"] for r in last] == list(range(len(last)))
            progress = [r["progress"] for r in sorted(own, key=lambda r: (r["epoch"], r["position"]))]
            assert progress == sorted(progress) and progress[-1] <= 1
        assert {(r["doc_id"], r["source"]) for r in rows} == {(u[0], u[1]) for u in units}
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df.repartition(5), repetition_limit=2.5).collect()))


def test_realised_rows_and_edges(spark, make_docs):
    docs = make_docs([(i, "w " * (i % 5 + 1), "en", "a" if i < 40 else None) for i in range(50)] + [(None, None, None, None), (3, "w", "en", "a")])
    units = docs.select("doc_id", "source", mixing.word_tokens(docs["text"]).alias("tokens"))
    mixture = mixing.mix(units, repetition_limit=2.0)
    out = mixing.realise(docs.withColumn("_x", docs["text"]), mixture)
    assert out.columns == docs.columns + ["_x"]
    times = {(r["doc_id"], r["source"]): 0 for r in docs.collect()}
    for r in mixture.collect():
        times[r["doc_id"], r["source"]] += 1
    assert min(times.values()) == 1 and max(times.values()) == 2
    assert out.count() == sum(times[r["doc_id"], r["source"]] for r in docs.collect())
    empty = make_docs([]).selectExpr("doc_id", "source", "1L AS tokens")
    assert mixing.mix(empty, repetition_limit=2.0).count() == 0


def test_rounding_of_a_large_budget_drops_no_document(spark, monkeypatch):
    solve = mixing.solve

    def short(*args):
        """As ``solve``, the budget a few units of its last place lower."""
        t = solve(*args)
        return replace(t, budget=t.budget - 8 * math.ulp(t.budget))

    monkeypatch.setattr(mixing, "solve", short)
    tokens = [20_000_000_003, 7_000_000_001, 300_000_007]
    units = [(f"s{i}-{k}", f"s{i}", part) for i, n in enumerate(tokens) for k, part in enumerate((n // 3, n - n // 3))]
    rows = mixing.mix(spark.createDataFrame(units, "doc_id string, source string, tokens long"), repetition_limit=2.0).collect()
    assert {r["doc_id"] for r in rows} == {u[0] for u in units}


def test_very_long_texts_are_counted_whole(make_docs):
    docs = make_docs([(1, "é \t" * 1_000_000, "en", "a"), (2, "w" * 3_000_000, "en", "a"), (3, None, "en", "b")])
    got = {r["doc_id"]: r["t"] for r in docs.select("doc_id", mixing.word_tokens(docs["text"]).alias("t")).collect()}
    assert got == {1: 1_000_001, 2: 2, 3: 1}


def test_realised_last_pass_is_cut_where_the_mixture_is(spark, make_docs):
    """Every (key, source) comes as often as the mixture holds it, whatever the passes."""
    docs = make_docs([(i, "w " * (i % 7 + 1), "en", ["a", "b", None][min(i % 20, 2)]) for i in range(200)] + [(None, "w w", "en", "a"), (None, "w w", "en", "a")])
    units = docs.select("doc_id", "source", mixing.word_tokens(docs["text"]).alias("tokens"))
    for kw in ({"repetition_limit": 3.7}, {"budget": 400.0}, {"entropy": 1.09, "budget": 2500.0}):
        mixture = mixing.mix(units, **kw)
        times = {}
        for r in mixture.collect():
            times[r["doc_id"], r["source"]] = times.get((r["doc_id"], r["source"]), 0) + 1
        out = {}
        for r in mixing.realise(docs, mixture).collect():
            out[r["doc_id"], r["source"]] = out.get((r["doc_id"], r["source"]), 0) + 1
        rows = {}
        for r in docs.collect():
            rows[r["doc_id"], r["source"]] = rows.get((r["doc_id"], r["source"]), 0) + 1
        assert out == {k: n * rows[k] for k, n in times.items()}
