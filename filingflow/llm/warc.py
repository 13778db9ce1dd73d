"""WARC archives with revisit resolution (operator 10).

``write_archives`` shuffles payload digests to find the first page of every
payload, joins each page to it and writes one record per page with fresh
headers: a ``response`` with the payload, or a ``revisit`` that names the
response.  ``read_archives`` parses the files back and joins every revisit to
its original response by payload digest.

Every record is a gzip member of its own, so readers can seek to it.  A task rolls to a
new archive before a record would take it over ``max_bytes`` and reports each archive
with the places of its records; those rows are the commit of the write (staged files are
renamed, see :func:`filingflow.sources.tree.commit_staged`) and stay as the archives'
index in ``_index``.  With it, an archive is read in parts of about ``split_bytes`` by
several tasks; archives of others, without an index, are streamed by one task each.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.llm.common import text_batches, work_table
from filingflow.sources import tree

# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def resolve_revisits(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """One header row per page: ``page_id, url, payload, payload_bytes,
    payload_digest, record_type, refers_to``.

    Among equal payloads of ``min_payload`` bytes or more the smallest page_id
    is the response (rows that repeat it are responses too) and the others
    revisit it; pages without a page_id never are an original, and stay
    responses when their payload has no page with one.  A null html is an
    empty payload.  Only digests that occur twice are joined back; a hot
    digest is pre-aggregated, and AQE splits it in the join."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256)})
    headers = rows.where(F.col("payload_bytes") >= min_payload).groupBy("payload_digest")
    firsts = headers.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1 AND first_id IS NOT NULL")
    joined = rows.join(firsts.drop("copies"), "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _record_id(page_id, digest):
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def write_archives(pages: DataFrame, path: str, min_payload: int = 100, date: str = "2024-01-01T00:00:00Z", max_bytes: int = 256 << 20) -> None:
    """Write gzip-compressed WARC 1.1 files under ``path``, in place of what it holds.
    An archive has at most ``max_bytes`` compressed bytes, or one record."""
    spark = pages.sparkSession
    text_batches(spark)
    rows = resolve_revisits(pages, min_payload)
    is_revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("payload_digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]+", " ")),  # null: left out
        F.concat(F.lit("X-Page-Id: "), F.url_encode(F.col("page_id").cast("string"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to"), F.col("payload_digest")))),
        F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    )
    records = rows.withColumn("block", block).select(F.concat(head, F.lit("\r\n\r\n"), F.col("block")).alias("value"))
    tree.remove(spark, path)
    uri, staging = tree.qualified(spark, path), tree.new_staging()
    staged = records.mapInArrow(_write_files(uri, staging, max_bytes), "path string, staged string, bytes long, starts array<long>")
    tree.commit_staged(staged, path, staging, index=f"{path}/_index")


def _write_files(uri: str, staging: str, max_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = tree.open_store(uri)
        attempt, number = uuid.uuid4().hex, 0
        store.create_dir(f"{base}/{staging}/{attempt}", recursive=True)
        out, at, starts = None, 0, []

        def close() -> pa.RecordBatch:
            out.close()
            cols = [pa.array([f"{attempt}-{number}.warc.gz"]), pa.array([f"{staging}/{attempt}/{number}"]), pa.array([at], pa.int64()), pa.array([starts], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(cols, ["path", "staged", "bytes", "starts"])

        for batch in batches:
            for value in batch.column(0).cast(pa.large_binary()):
                member = gzip.compress(value.as_py() + b"\r\n\r\n", 6, mtime=0)
                if out is not None and at + len(member) > max_bytes:
                    yield close()
                    out, at, starts, number = None, 0, [], number + 1
                if out is None:
                    out = store.open_output_stream(f"{base}/{staging}/{attempt}/{number}")
                out.write(member)
                starts.append(at)
                at += len(member)
        if out is not None:
            yield close()

    return run


class _Part:
    """Bytes ``start`` to ``end`` (none: the last) of an open file, as gzip reads them."""

    def __init__(self, file, start: int, end: int | None):
        file.seek(start)
        self.file, self.left = file, (file.size() if end is None else end) - start

    def read(self, n: int = -1) -> bytes:
        piece = self.file.read(self.left if n < 0 else min(n, self.left))
        self.left -= len(piece)
        return piece


def _inflated(source, step: int = 1 << 20) -> Iterator[bytes]:
    """Plain bytes of gzip data (bytes or a file), piece by piece, over all its members."""
    with gzip.GzipFile(fileobj=io.BytesIO(source) if isinstance(source, bytes) else source) as file:
        while piece := file.read(step):
            yield piece


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record in one archive; the
    blocks are cut by Content-Length, so a payload may hold any byte sequence.
    One record and one piece are held at a time."""
    pieces, held = iter(pieces), bytearray()

    def fill(enough: Callable[[], bool]) -> None:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                raise ValueError("the archive ends inside a record")
            held.extend(piece)

    while True:
        while not held.strip(b"\r\n"):
            piece = next(pieces, None)
            if piece is None:
                return
            held.extend(piece)
        del held[: len(held) - len(held.lstrip(b"\r\n"))]
        fill(lambda: b"\r\n\r\n" in held)
        head, _, _ = held.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start, length = len(head) + 4, int(headers["content-length"])
        fill(lambda: len(held) >= start + length)
        block = bytes(held[start : start + length])
        del held[: start + length]
        yield headers, block


_NAMES = ["page_id", "url", "record_type", "declared_digest", "payload_bytes", "payload_digest", "html"]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]


def _parse_parts(uri: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of parts of archives: (file, start, end)."""

    def packed(cols: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = tree.open_store(uri)
        for batch in batches:
            for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cols: list[list] = [[] for _ in _NAMES]
                size = 0
                with store.open_input_file(f"{base}/{name}") as file:
                    for headers, block in parse_records(_inflated(_Part(file, start, end))):
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        page, revisit = headers.get("x-page-id"), headers["warc-type"] == "revisit"
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = headers.get("warc-payload-digest")
                        row = (
                            None if page is None else unquote_plus(page),
                            headers.get("warc-target-uri"),
                            headers["warc-type"],
                            None if digest is None else digest.removeprefix("sha256:"),
                            None if revisit else len(payload),
                            None if revisit else hashlib.sha256(payload).hexdigest(),
                            None if revisit else payload.decode("utf-8", "replace"),
                        )
                        for col, value in zip(cols, row, strict=True):
                            col.append(value)
                        size += len(payload) + 500
                        if size > 4 << 20:  # bounded batches go back
                            yield packed(cols)
                            cols, size = [[] for _ in _NAMES], 0
                yield packed(cols)

    return run


def archive_parts(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """(rel, first, last, bytes): the parts in which the archives under ``path`` are read."""
    if tree.glob(spark, f"{path}/_index"):
        index = spark.read.schema("path string, bytes long, starts array<long>").parquet(f"{path}/_index")
        each = index.select(F.col("path").alias("rel"), "bytes", F.col("starts"), F.posexplode("starts").alias("i", "start"))
        each = each.withColumn("stop", F.coalesce(F.try_element_at("starts", F.col("i") + 2), F.col("bytes")))
        parts = each.groupBy("rel", F.expr(f"start div {split_bytes}").alias("part")).agg(F.min("start").alias("first"), F.max("stop").alias("last"))
        return parts.select("rel", "first", "last", (F.col("last") - F.col("first")).alias("bytes"))
    found = tree.files_of(spark, path, tree.list_tree(spark, path, levels=1).where(F.col("name").endswith(".gz")))
    return found.select("rel", F.lit(0).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), "bytes")


def read_archives(spark: SparkSession, path: str, page_id: str = "long", split_bytes: int = 64 << 20) -> DataFrame:
    """Records of the archives under ``path``: ``page_id, url, record_type,
    declared_digest, payload_bytes, payload_digest, html`` (the last three are
    recomputed from the stored payload; null for revisits).  ``page_id`` names the
    type of the pages' ids; an id that is not of that type is null.  Archives may hold
    one gzip member or one for each record; records of other types are passed over.
    One record and one piece of a file are held at a time."""
    parts = tree.dealt_by_bytes(work_table(archive_parts(spark, path, split_bytes), "warc_parts"))
    schema = "page_id string, url string, record_type string, declared_digest string, payload_bytes long, payload_digest string, html string"
    records = parts.select("rel", "first", "last").mapInArrow(_parse_parts(tree.qualified(spark, path)), schema)
    return records.withColumn("page_id", F.col("page_id").try_cast(page_id))


def resolve_read(records: DataFrame) -> DataFrame:
    """Every record with the payload figures of its original response:
    revisits are joined to responses by payload digest.  The headers are
    written once, so that the archives are parsed once."""
    rows = records.select("page_id", "record_type", F.col("declared_digest").alias("digest"), "payload_bytes", "payload_digest")
    rows = work_table(rows, "warc_headers")
    originals = rows.where("record_type = 'response' AND page_id IS NOT NULL").groupBy("digest").agg(
        F.min("page_id").alias("o_id"), F.max("payload_bytes").alias("o_bytes"), F.max("payload_digest").alias("o_digest")
    )
    revisits = rows.where("record_type = 'revisit'").join(originals, "digest", "left").select(
        "page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type", F.col("o_id").alias("refers_to")
    )
    responses = rows.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(dict(rows.dtypes)["page_id"]).alias("refers_to")
    )
    return responses.unionByName(revisits)
