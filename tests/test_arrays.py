"""Array functions (H17-H22, A12) against FIXTURES §2 and a round trip."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingflow.functions import arrays as A


def ev(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_chunk(spark):
    assert ev(spark, A.chunk_cells("a", 2), ["1", "2", "3", "4", "5"], "a array<string>") == [
        ["1", "2"], ["3", "4"], ["5", None]
    ]
    assert ev(spark, A.chunk_cells("a", 0), ["1"], "a array<string>") is None
    assert ev(spark, A.chunk_cells("a", 3), [], "a array<string>") == []


def test_pad_and_malformed(spark):
    assert ev(spark, A.pad_row("a", 3), ["a"], "a array<string>") == ["a", "", ""]
    assert ev(spark, A.row_too_long("a", 2), ["a", "b", "c"], "a array<string>") is True


def test_dedupe_drop_half(spark):
    assert ev(spark, A.dedupe_row("a"), ["5", "7", "5"], "a array<string>") == ["5", "7"]
    assert ev(spark, A.drop_empty("a"), ["a", "", "b"], "a array<string>") == ["a", "b"]
    assert ev(spark, A.second_half("a"), ["h1", "h2", "h1", "h2"], "a array<string>") == ["h1", "h2"]
    assert ev(spark, A.second_half("a"), ["x", "h1", "h2"], "a array<string>") == ["h1", "h2"]


def test_align_and_pairs(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["x"])], "a array<string>, b array<string>")
    z = df.select(A.align_truncate("a", "b").alias("z")).first()["z"]
    assert [tuple(p) for p in z] == [("a", "x")]
    df = spark.createDataFrame([(["h1", "h2", "h1"], ["1"])], "h array<string>, r array<string>")
    pairs = df.select(A.row_to_pairs("h", "r").alias("p")).first()["p"]
    assert [(p["name"], p["value"]) for p in pairs] == [("h1", "1"), ("h2", None), ("h1", None)]


@settings(max_examples=15, deadline=None)
@given(cells=st.lists(st.text(alphabet="abc", min_size=1, max_size=3), max_size=12), width=st.integers(1, 5))
def test_chunk_round_trip(spark, cells, width):
    df = spark.createDataFrame([(cells,)], "a array<string>")
    rows = df.select(A.chunk_cells("a", width).alias("r")).first()["r"]
    assert all(len(r) == width for r in rows)
    back = df.select(A.flatten_rows(A.chunk_cells("a", width)).alias("f")).first()["f"]
    assert back == cells
