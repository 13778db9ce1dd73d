"""Merged epochs and bucketed tables: content, files touched, ends half-way."""

import os
import random

import pytest

from filingflow.sources import buckets, files, tree
from filingflow.sources.epochs import EpochTable
from filingflow.streaming import status as streams


def rows_of(table):
    return sorted(tuple(r)[:-1] for r in table.rows().collect())


def test_status_after_a_thousand_epochs_touches_the_base_and_what_is_newer(spark, tmp_path):
    table = streams.status_table(spark, str(tmp_path), every=50)
    rng, seen = random.Random(1), {}
    schema = "symbol string, in_success boolean, in_warning boolean"
    for epoch in range(1000):
        s, ok, warn = f"S{rng.randrange(40)}", rng.random() < 0.5, rng.random() < 0.5
        seen[s] = tuple(a or b for a, b in zip(seen.get(s, (False, False)), (ok, warn), strict=True))
        if epoch % 50 in (0, 49) or epoch > 990:
            table.write(spark.createDataFrame([(s, ok, warn)], schema).coalesce(1), epoch)
        else:  # the same folder without a Spark job for each
            import pyarrow as pa
            import pyarrow.parquet as pq

            os.makedirs(tmp_path / f"epoch_id={epoch}")
            pq.write_table(pa.table({"symbol": [s], "in_success": [ok], "in_warning": [warn]}), tmp_path / f"epoch_id={epoch}" / "p.parquet")
    assert len(table.paths()) <= 52 and len([n for n in os.listdir(tmp_path) if n.startswith("epoch_id=")]) <= 102
    assert {r[0]: r[1:] for r in rows_of(table)} == seen
    assert {r["symbol"]: (r["in_success"], r["in_warning"]) for r in streams.read_status(spark, str(tmp_path)).collect()} == seen


def checkpoint(spark, pairs):
    return spark.createDataFrame([(s, p, 0) for s, p in pairs], "symbol string, current_page long, last_row_index long")


def test_versions_merge_and_may_be_written_again(spark, tmp_path):
    path, newest = str(tmp_path / "cp"), {}
    for version in range(7):
        pairs = [(f"S{(version * k) % 5}", version * 10 + k) for k in range(1, 3)]
        pairs = list(dict(pairs).items())
        for _ in range(2):  # a write that is repeated replaces itself
            files.write_checkpoints(checkpoint(spark, pairs), path, version, every=3)
        newest |= dict(pairs)
        assert {r["symbol"]: r["current_page"] for r in files.read_checkpoints(spark, path).collect()} == newest
    table = files.checkpoint_table(spark, path)
    assert table.state()["merged"] == 5 and len(table.paths()) == 2
    with pytest.raises(ValueError):
        files.write_checkpoints(checkpoint(spark, [("S0", 1)]), path, 4)
    table.compact()
    assert table.paths() == [f"{path}/_base/{table.state()['base']}"]
    assert {r["symbol"]: r["current_page"] for r in files.read_checkpoints(spark, path).collect()} == newest
    assert not files.checkpoint_table(spark, str(tmp_path / "none")).paths()


def test_a_merge_that_ends_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    table = files.checkpoint_table(spark, str(tmp_path))
    for v in range(4):
        files.write_checkpoints(checkpoint(spark, [("A", v), (f"B{v}", v)]), str(tmp_path), v)
    before = rows_of(table)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(EpochTable, "_commit", lost)
        with pytest.raises(RuntimeError):
            table.compact()
    assert table.state() == {"base": None, "merged": None} and rows_of(table) == before
    table.compact()
    assert rows_of(table) == before and table.epochs() == [0, 1, 2, 3]  # readers of the older state still find them
    files.write_checkpoints(checkpoint(spark, [("A", 9)]), str(tmp_path), 4)
    table.compact()
    assert table.epochs() == [4] and [r[1] for r in rows_of(table) if r[0] == "A"] == [9]
    # The unfinished merge's folder went too; the base before is kept for its readers.
    assert len(os.listdir(tmp_path / "_base")) == 2


def test_a_stream_merges_its_epochs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("logs", "out", "ck"))
    os.makedirs(src)
    for i in range(7):
        kind = "INFO - Scraping Successfully" if i % 2 else "WARNING - Not enough reports"
        with open(f"{src}/{i}.log", "w") as f:
            f.write(f"2024-11-12 11:37:0{i},123 - {kind} S{i % 3}: 2/2\n")
    streams.run_status(spark, src, out, ck, max_files_per_trigger=1, merge_every=2).awaitTermination()
    got = {r["symbol"]: (r["in_success"], r["in_warning"]) for r in streams.read_status(spark, out).collect()}
    assert got == {"S0": (True, True), "S1": (True, True), "S2": (True, True)}
    assert streams.status_table(spark, out).state()["merged"] >= 3


def captured(spark):
    return spark.range(4000).selectExpr("IF(id % 3 = 0, 'HOT', concat('S', id % 60)) AS symbol", "id AS STT", "concat('p', id) AS path").unionByName(
        spark.createDataFrame([(None, -1, "n")], "symbol string, STT long, path string")
    )


def mtimes(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_purge_rewrites_only_the_buckets_touched(spark, tmp_path):
    path = str(tmp_path / "held")
    buckets.write_captured(captured(spark), path, buckets=16)
    gone = spark.createDataFrame([("HOT",), ("S7",), ("S7",), ("nowhere",), (None,)], "symbol string")
    of = lambda *s: {r[0] for r in spark.createDataFrame([(x,) for x in s], "s string").select(buckets.bucket("s", 16)).collect()}
    before = mtimes(path)
    assert buckets.purge_symbols(spark, path, gone, buckets=16) == len(of("HOT", "S7"))
    after = mtimes(path)
    same = {f for f in before if int(f.split("/")[0].removeprefix("bucket=")) not in of("HOT", "S7")}
    assert same and all(after[f] == before[f] for f in same) and not (set(before) - same) & set(after)
    left = captured(spark).where("symbol IS NULL OR symbol NOT IN ('HOT', 'S7')")
    got = buckets.read_captured(spark, path, buckets=16)
    assert got.exceptAll(left).count() == left.exceptAll(got).count() == 0
    assert buckets.purge_symbols(spark, path, gone, buckets=16) == 0
    one = buckets.read_captured(spark, path, ["S8"], buckets=16)
    assert one.count() == captured(spark).where("symbol = 'S8'").count()
    assert "PartitionFilters: [isnotnull" in (plan := one._jdf.queryExecution().toString()) or "bucket" in plan.split("PartitionFilters")[1][:80]


def test_a_bucket_that_is_emptied_goes(spark, tmp_path):
    path = str(tmp_path / "held")
    buckets.write_captured(spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, STT long"), path, buckets=1000)
    assert buckets.purge_symbols(spark, path, spark.createDataFrame([("A",)], "symbol string"), buckets=1000) == 1
    assert [tuple(r) for r in buckets.read_captured(spark, path).collect()] == [("B", 2)]
    assert len([n for n in os.listdir(path) if n.startswith("bucket=")]) == 1


def test_a_purge_that_ends_half_way_is_completed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "held")
    buckets.write_captured(captured(spark), path, buckets=4)
    gone = spark.createDataFrame([("HOT",)], "symbol string")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_apply", lost)
        with pytest.raises(RuntimeError):
            buckets.purge_symbols(spark, path, gone, buckets=4)
    assert spark.read.parquet(path).where("symbol = 'HOT'").count() > 0
    assert buckets.read_captured(spark, path).where("symbol = 'HOT'").count() == 0
    assert buckets.read_captured(spark, path).count() == captured(spark).where("symbol IS NULL OR symbol <> 'HOT'").count()
    assert not tree.glob(spark, f"{path}/_purge-*")
