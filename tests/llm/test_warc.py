import hashlib

from filingflow.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_round_trip_and_revisits(spark, tmp_path):
    big, tricky = "<p>" + "é" * 80, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9
    rows = [
        (7, "http://a/7", big), (3, "http://a/3", big), (9, None, big), (3, "http://a/3", big),
        (1, "http://a/1\r\nX: y", "short"), (2, "u", "short"), (4, "", None), (5, "u", ""), (6, "u", tricky), (8, "u", tricky),
        (None, "u", big), (None, None, "n" * 200), (None, None, "n" * 200), (10, "u", "z" * 300_000),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("url", "url")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, max_bytes=1500)
    records = warc.read_archives(spark, path)
    got = warc.resolve_read(records).collect()
    assert len(got) == len(rows)
    firsts = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            firsts[h] = min(i, firsts.get(h, i))
    expect = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = firsts.get(h)
        revisit = first is not None and i != first
        expect.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expect))
    stored = [r for r in records.collect() if r["record_type"] == "response"]
    assert all(r["declared_digest"] == r["payload_digest"] for r in stored)
    assert sorted(r["html"] for r in stored if r["page_id"] == 6) == [tricky]
    assert sum(r["html"] == "z" * 300_000 for r in stored) == 1


def test_members_rolls_and_parts(spark, tmp_path):
    """Archives roll by bytes, also under records that exceed the roll; each record is a member that a reader can seek to."""
    import gzip
    import random

    rng = random.Random(4)
    noise = lambda n: "".join(map(chr, rng.choices(range(33, 127), k=n)))
    rows = [(i, f"http://a/{i}", noise(rng.choice([50, 2_000, 30_000]))) for i in range(60)] + [(60 + i, "u", "c" * 500) for i in range(20)]
    path = str(tmp_path / "w")
    for _ in range(2):  # a second write replaces the first
        warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), path, max_bytes=20_000)
    index = {r["path"]: r for r in spark.read.parquet(f"{path}/_index").collect()}
    archives = sorted(p.name for p in (tmp_path / "w").iterdir() if p.name.endswith(".warc.gz"))
    assert archives == sorted(index) and len(archives) > 20 and sum(len(r["starts"]) for r in index.values()) == len(rows)
    for name, r in index.items():
        data = (tmp_path / "w" / name).read_bytes()
        assert len(data) == r["bytes"] and (r["bytes"] <= 20_000 or len(r["starts"]) == 1)
        for a, b in zip(r["starts"], [*r["starts"][1:], r["bytes"]], strict=True):
            member = gzip.decompress(data[a:b])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
    whole = {r["page_id"]: r["html"] for r in warc.read_archives(spark, path).collect()}
    parts = warc.archive_parts(spark, path, split_bytes=4_000)
    assert parts.count() > len(archives)
    split = {r["page_id"]: r["html"] for r in warc.read_archives(spark, path, split_bytes=4_000).collect()}
    assert whole == split and {i: h for i, _, h in rows if i <= 60} == {i: h for i, h in whole.items() if i <= 60}
    assert sum(h is None for h in whole.values()) == 19


def test_ids_of_other_types(spark, tmp_path):
    rows = [("b/\u00e9 1\r\nX: y", "u", "x" * 200), ("a", "u", "x" * 200), ("a%20+", "u", "y"), (None, "u", "x" * 200)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, html string"), path)
    got = warc.resolve_read(warc.read_archives(spark, path, page_id="string")).collect()
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in got} == {
        ("b/\u00e9 1\r\nX: y", "revisit", "a"), ("a", "response", None), ("a%20+", "response", None), (None, "revisit", "a"),
    }


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.resolve_read(warc.read_archives(spark, path)).count() == 0


def test_extra_columns_with_clashing_names(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 200, "p", 3)], SCHEMA + ", payload string, first_id int")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.resolve_read(warc.read_archives(spark, str(tmp_path / "w"))).first()["payload_bytes"] == 200


def test_other_archives_are_read(spark, tmp_path):
    """One gzip member for each record, other record types, other spellings of header names."""
    import gzip

    def record(kind, body, extra=""):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + body
        head = f"WARC/1.1\r\nwarc-type:{kind}\r\n{extra}CONTENT-LENGTH: {len(block)}\r\n\r\n"
        return gzip.compress(head.encode() + block + b"\r\n\r\n")

    bodies = [b"x" * 5_000_000, b"", "\u00e9 page".encode(), b"\r\n\r\nWARC/1.1\r\n\r\n"]
    members = [record("warcinfo", b"software: s")] + [record("response", b, f"X-Page-Id:{i}\r\n") for i, b in enumerate(bodies)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["declared_digest"]) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {i: (len(b), hashlib.sha256(b).hexdigest(), None) for i, b in enumerate(bodies)}


def test_pieces_may_cut_a_record_anywhere():
    import gzip

    import pytest

    plain = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"b" * n) for n in (0, 1, 40, 3))
    whole = [(h["content-length"], b) for h, b in warc.parse_records([plain])]
    assert [int(n) for n, _ in whole] == [0, 1, 40, 3]
    assert [(h["content-length"], b) for h, b in warc.parse_records(plain[i : i + 1] for i in range(len(plain)))] == whole
    zipped = gzip.compress(plain) * 3
    for step in (1, 7, 64, 1 << 20):
        assert b"".join(warc._inflated(zipped, step)) == plain * 3
    with pytest.raises(EOFError):
        list(warc._inflated(zipped[:-12]))
    with pytest.raises(ValueError):
        list(warc.parse_records([plain[:-60]]))
