import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from filingflow.llm import bpe
from filingflow.llm.common import connected_components
from filingflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    start = Counter(r["doc_id"] for r in docs.collect())
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.work_table(stage(spark, docs, SF), name)
        sizes.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == columns
            assert set(r["doc_id"] for r in docs.collect()) <= set(start)
    assert sizes[0] >= 198 and sizes[1] == sizes[0] and sizes[2] < sizes[1] < sizes[3] + 50 and sizes[4] == sizes[3]
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_rows_of_the_run_as_in_plain_python(spark, tmp_path):
    """Line dedup against its SQL, mixing and encoding in plain Python."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs, stages = spark.read.parquet(f"{SF}/documents.parquet"), dict(corpus_pipeline.STAGES)
    stages["language_id"](spark, docs, SF).write.parquet(f"{tmp_path}/accepted")
    accepted = spark.read.parquet(f"{tmp_path}/accepted")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{tmp_path}/accepted/*.parquet')")
    sql = con.sql(ORACLE["op8_line_dedup"])
    kept = Counter((r[sql.columns.index("doc_id")], r[sql.columns.index("kept_sha256")]) for r in sql.fetchall())
    stages["line_dedup"](spark, accepted, SF).write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    assert kept == Counter((r["doc_id"], sha((r["text"] or "").encode())) for r in lines.collect())

    single = stages["simhash_near_dedup"](spark, lines, SF).collect()
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    expect = set()
    for r in single:
        ids = enc.encode_ordinary(r["text"] or "")
        expect.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    corpus_pipeline.run(spark, SF).write.parquet(f"{tmp_path}/encoded")
    encoded = spark.read.parquet(f"{tmp_path}/encoded").collect()
    rows = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded)
    for r in encoded:  # the written ids are those of the digests, and decode to the text
        assert (len(r["ids"]), sha(" ".join(map(str, r["ids"])).encode()), sha(enc.decode_bytes(r["ids"]))) == (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
    # Nothing is dropped or changed by mixing; the rarest source is passed at most twice.
    assert set(rows) == expect and max(rows.values()) <= 2


def test_stages_on_odd_tables(spark, make_docs):
    odd = make_docs([(None, None, None, None), (1, "", None, None), (1, "", None, None), (2, "the same words", "en", None), (2, "the same words", "en", None)])
    for docs in (odd, make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.work_table(stage(spark, docs, SF), name)
            docs.count()


def test_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF}/{t}.parquet')")
    sql = con.sql(ORACLE[name])
    order = sorted(sql.columns)
    rows = QUERIES[name](spark, SF).select(*order).collect()
    at = [sql.columns.index(c) for c in order]
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr(tuple(r[i] for i in at)) for r in sql.fetchall())


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 120)] + [(1000 + i, 1000) for i in range(1, 60)] + [(7000, 7000), (8001, 8000)] * 2
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    expect = {i: 0 for i in range(121)} | {1000 + i: 1000 for i in range(60)} | {8000: 8000, 8001: 8000}
    assert found == expect
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
