import random

from pyspark.sql import functions as F

from filingflow.llm import line_dedup


def brute(rows, min_words):
    """Lines of every run (any length) with enough words that occurs earlier, found by comparing all runs."""
    docs = [(key, (text or "").split("\n")) for key, text in rows]
    runs, gone = {}, [set() for _ in docs]
    order = sorted(range(len(docs)), key=lambda d: (docs[d][0] is not None, docs[d][0] or 0))
    for d in order:
        lines = [x.strip(" ") for x in docs[d][1]] if rows[d][1] is not None else []
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = tuple(lines[i : j + 1])
                first = runs.setdefault(run, (d, i))
                words = sum(max(1, len(x.split())) for x in run)
                if words >= min_words and first != (d, i) and (first[0] != d or i - first[1] >= len(run)):
                    gone[d].update(range(i, j + 1))
    out = []
    for (key, lines), g, (_, text) in zip(docs, gone, rows):
        kept = "\n".join(x for i, x in enumerate(lines) if i not in g)
        starts = sum(1 for i in g if i - 1 not in g)
        out.append((key, kept if text is not None else None, 0 if text is None else len(lines), len(g), starts))
    return sorted(out, key=repr)


def got(df, min_words):
    out = line_dedup.dedup_lines(df, min_words=min_words).select("doc_id", "text", "n_lines", "n_removed", "n_runs")
    return sorted(map(tuple, out.collect()), key=repr)


def test_against_all_runs(make_docs):
    for seed, min_words in ((1, 5), (2, 1), (3, 12)):
        rng = random.Random(seed)
        lines = ["", "a", "b c", "d e f", "g h i j", "  a ", "k l m n o p", "q"]
        rows = [(i, "\n".join(rng.choice(lines) if rng.random() < 0.8 else f"only {rng.random()}" for _ in range(rng.randrange(1, 14)))) for i in range(25)]
        rows += [(100, None), (101, ""), (102, "a\na\na\na\na\na\na\na"), (103, rows[4][1]), (104, rows[4][1])]
        assert got(make_docs(rows), min_words) == brute(rows, min_words)


def test_edges(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0
    long = "one two three four five\n" * 3 + "x " * 50_000
    rows = [(None, long), (1, long), (2, "head\n" + long), (2, "head\n" + long), (3, "tail\n\n")]
    out = got(make_docs(rows).selectExpr("*", "'c' AS pos", "1 AS run", "2 AS n_lines"), 10)
    # one two three .. repeats inside the first copy too: lines 1-2 overlap the run they repeat
    assert [r for r in out if r[0] == 1] == [(1, "", 4, 4, 1)]
    assert [r[1] for r in out if r[0] == 2] == ["head", "head"]
    assert [r for r in out if r[0] == 3] == [(3, "tail\n\n", 3, 0, 0)]
    assert len(out) == 5
    kept = line_dedup.dedup_lines(make_docs(rows), 10)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_removed", "n_runs"]


def test_ranks_follow_the_order_of_suffixes(spark, make_docs):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(20))) for i in range(12)]
    lines = line_dedup.repeated_lines(make_docs(rows), 1)
    ranks = line_dedup.suffix_ranks(lines, 9).collect()
    first = {r["_ff_id"]: {} for r in ranks}
    for r in ranks:
        if r["k"] == 0:
            first[r["_ff_id"]][r["pos"]] = r["rank"]
    for k in range(4):
        windows = {}
        for key, at in first.items():
            for pos in at:
                if all(pos + j in at for j in range(1 << k)):
                    windows[key, pos] = tuple(at[pos + j] for j in range(1 << k))
        got = {(r["_ff_id"], r["pos"]): r["rank"] for r in ranks if r["k"] == k}
        values = list(windows.values())
        assert set(got) == {place for place, w in windows.items() if values.count(w) > 1}
        assert len(set(got.values())) == len({windows[p] for p in got})
        by_rank = sorted(got, key=lambda p: (got[p], windows[p]))
        assert [windows[p] for p in by_rank] == sorted(windows[p] for p in got)


def test_join_spread_deals_hot_values(spark):
    rows = spark.range(3000).selectExpr("id", "if(id < 2000, 0, id) AS a", "if(id < 2000, 'x', 'y') AS b")
    table = rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for parts in (1, 4, 4096):
        joined = line_dedup.join_spread(rows, table, ["a", "b"], "n", parts)
        assert joined.columns == ["a", "b", "id", "top"]
        assert sorted((r["id"], r["top"]) for r in joined.collect()) == [(i, 1999 if i < 2000 else i) for i in range(3000)]
    assert line_dedup.join_spread(rows.limit(0), table.limit(0), ["a", "b"], "n").count() == 0
