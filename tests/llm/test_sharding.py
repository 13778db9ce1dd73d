from collections import Counter

from filingflow.llm.sharding import interleave_shards


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r["shard"], r["slot"]))


def test_every_shard_holds_the_mixture(make_docs):
    docs = make_docs([(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(1000)] + [(5000, None, None, None)])
    placed = rows_of(interleave_shards(docs, shards=16, bucket_rows=20))
    sizes = Counter(r["shard"] for r in placed)
    assert len(placed) == 1001 and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(16):
        assert [r["slot"] for r in placed if r["shard"] == shard] == list(range(sizes[shard]))
    share = Counter(r["source"] for r in placed)
    for source, n in share.items():
        per = [sum(1 for r in placed if r["shard"] == s and r["source"] == source) for s in range(16)]
        assert max(per) - min(per) <= 2, (source, n, per)


def test_order_is_by_fractional_rank_in_the_source(make_docs):
    docs = make_docs([(i, "x", "en", "a" if i < 30 else "b") for i in range(40)])
    placed = rows_of(interleave_shards(docs, shards=1, bucket_rows=4))
    seen, frac = Counter(), []
    for r in placed:
        frac.append((seen[r["source"]] + 0.5) / {"a": 30, "b": 10}[r["source"]])
        seen[r["source"]] += 1
    assert frac == sorted(frac)


def test_seed_bucket_size_and_edges(spark, make_docs):
    docs = make_docs([(i, "x", "en", f"s{i % 3}") for i in range(200)])
    a = rows_of(interleave_shards(docs, bucket_rows=8))
    assert a == rows_of(interleave_shards(docs.repartition(7), bucket_rows=4096))
    assert a != rows_of(interleave_shards(docs, seed=18))
    assert interleave_shards(make_docs([])).count() == 0
    same = make_docs([(1, "x")] * 5 + [(None, None, None, None)] * 3)
    clash = same.withColumn("shard", same["doc_id"]).withColumn("slot", same["text"])
    out = rows_of(interleave_shards(clash, shards=4))
    assert Counter(r["shard"] for r in out) == {0: 2, 1: 2, 2: 2, 3: 2} and out[0]["slot"] == 0


def test_a_long_tail_of_small_sources_is_in_every_shard(spark):
    rows = [(i, "a") for i in range(2000)] + [(2000 + i, f"one{i}") for i in range(1000)] + [(3000 + i, f"two{i // 2}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    placed = rows_of(interleave_shards(docs, shards=16, bucket_rows=64))
    assert sorted((r["doc_id"], r["source"]) for r in placed) == sorted(rows)
    for tail, n in (("a", 2000), ("one", 1000), ("two", 600)):
        per = Counter(r["shard"] for r in placed if r["source"].startswith(tail))
        assert all(abs(per[s] - n / 16) <= 4 for s in range(16)), (tail, per)
    shards_of = {}
    for r in placed:
        if r["source"].startswith("two"):
            shards_of.setdefault(r["source"], []).append(r["shard"])
    assert all(abs(a - b) >= 7 for a, b in shards_of.values())


def test_rows_of_one_key_are_in_every_shard(spark):
    rows = [(i, "a", i) for i in range(320)] + [(7000, "a", i) for i in range(160)] + [(None, "a", i) for i in range(160)] + [(9000, "a", 1)] * 160
    docs = spark.createDataFrame(rows, "doc_id long, source string, size int")
    placed = rows_of(interleave_shards(docs, shards=8, bucket_rows=32))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in placed) == Counter(rows)
    for key in (7000, None, 9000):
        per = Counter(r["shard"] for r in placed if r["doc_id"] == key)
        assert min(per[s] for s in range(8)) >= 6, (key, per)


def test_very_long_texts_are_sized_whole(spark, make_docs):
    from pyspark.sql import functions as F

    long = "é " * 2_000_000
    docs = make_docs([(i, long if i == 3 else f"text {i}", "en", f"s{i % 2}") for i in range(64)])
    rows = docs.select("doc_id", "source", F.octet_length("text").alias("size"))
    placed = interleave_shards(rows, shards=4, seed=1).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(64))
    assert max(r["size"] for r in placed) == len(long.encode())
    counts = [sum(r["shard"] == s for r in placed) for s in range(4)]
    assert max(counts) - min(counts) <= 1
