"""Search on the stored table: same rows as the listing's filter, and what is read."""

import pytest

from filingflow.operators import listing
from filingflow.sources import search


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 'HOT', IF(id % 7 = 0, concat('Công ', id % 50), concat('K', id % 400))) AS symbol",
        "CAST(timestamp_seconds(1600000000 + id * 40000) AS TIMESTAMP_NTZ) AS submitted_at", "id",
    ).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS symbol, TIMESTAMP_NTZ '2021-01-01 00:00:00' AS submitted_at, -1L AS id"))
    path = str(tmp_path_factory.mktemp("search"))
    search.write_search_table(rows.where("id % 2 = 0"), path, buckets=8)
    search.write_search_table(rows.where("id % 2 <> 0"), path, buckets=8)  # symbols are held twice in the grams
    return rows, path


@pytest.mark.parametrize(
    "asked",
    [
        {"symbol": "K100"}, {"symbol": "HOT", "date_from": "2021-01-01", "date_to": "2021-02-01"}, {"symbol": "none"}, {"date_from": "2023-06-01"},
        *[{"symbol_contains": t} for t in ("1", "K1", "K39", "ông 4", "ng 12", "OT", "HOTT", "", "zz", "K1 ")],
        {"symbol_contains": "K3", "date_from": "2021-01-01", "date_to": "2022-01-01"}, {"symbol": "K100", "symbol_contains": "10"},
    ],
)
def test_as_the_filter_of_the_whole_listing(spark, table, asked):
    rows, path = table
    got = search.search_stored(spark, path, **asked, buckets=8)
    expect = listing.search_listing(rows, **asked)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in expect.collect())
    assert got.columns == expect.columns


def test_a_search_reads_a_part(spark, table):
    _, path = table
    one = search.search_stored(spark, path, symbol="K100", date_from="2021-01-01", buckets=8)._jdf.queryExecution().executedPlan().toString()
    filters = one.split("PartitionFilters: ")[1].split("ReadSchema")[0]
    assert "bucket" in filters.split("PushedFilters")[0]
    assert "EqualTo(symbol,K100)" in filters and "GreaterThanOrEqual(submitted_a" in filters
    part = search.search_stored(spark, path, symbol_contains="K39", buckets=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" in part.lower()
    grams = search.symbols_containing(spark, path, "K39", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in grams.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "gram" in grams.split("PushedFilters: ")[1].split("ReadSchema")[0]


def test_grams(spark):
    got = spark.createDataFrame([("abab",), ("é",), ("",), (None,)], "s string").select(search.grams("s")).collect()
    assert [None if r[0] is None else sorted(r[0]) for r in got] == [["a", "ab", "aba", "b", "ba", "bab"], ["é"], [], []]
