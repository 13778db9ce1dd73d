"""Structured Streaming forms of the audit (R1) and the report intake (R2).

R1 keeps one row of state per symbol (has a success line, has a warning
line) over log files as they arrive; its result after draining equals
:func:`filingflow.operators.audit.log_sets` on the same files.  No watermark:
the reference never forgets a symbol, and the state grows with the number of
symbols, not with the log volume.

R2 admits each (symbol, submission time) once: the first arrival wins, and
inside one micro-batch the smallest arrival order.  Admitted keys are state
of a streaming aggregation; the sink writes one folder per epoch (a retried
epoch overwrites its own folder, so the sink is idempotent) and merges them now
and then (:mod:`filingflow.sources.epochs`).  File sources
treat files as immutable, so logs must be rotated (complete) before they are
picked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filingflow.operators import audit
from filingflow.operators.ordering import first_per_key
from filingflow.sources.epochs import MERGE_EVERY, EpochTable


def stream_status(
    spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Streaming DataFrame of (symbol, in_success, in_warning) from text files under ``log_dir`` (``glob`` e.g. ``"*.log"``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(log_dir)
    return audit.log_sets(lines)


def status_table(spark: SparkSession, out_dir: str, every: int = MERGE_EVERY) -> EpochTable:
    """The epochs of :func:`run_status`; a flag once set stays set, so they merge by symbol."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("symbol").agg(
            F.bool_or("in_success").alias("in_success"), F.bool_or("in_warning").alias("in_warning"), F.max("epoch_id").alias("epoch_id")
        )

    return EpochTable(spark, out_dir, merge, every)


def run_status(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str,
               max_files_per_trigger: int | None = None, glob: str | None = None, merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Drain the available logs into a Parquet table: update mode, each epoch
    writes the symbols it changed to its own folder (a retried epoch replaces
    only its output), and after ``merge_every`` epochs the earlier ones become a
    new base.  :func:`read_status` gives the present status."""
    table = status_table(spark, out_dir, merge_every)
    q = (
        stream_status(spark, log_dir, max_files_per_trigger, glob)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(table.write)
        .trigger(availableNow=True)
        .start()
    )
    return q


def read_status(spark: SparkSession, out_dir: str) -> DataFrame:
    """(symbol, in_success, in_warning): the base and the epochs after it."""
    return status_table(spark, out_dir).rows().drop("epoch_id")


def run_first_submission(
    spark: SparkSession,
    source_dir: str,
    schema,
    out_dir: str,
    checkpoint_dir: str,
    key: Sequence[str] = ("symbol", "submitted_at"),
    order: Sequence[str] = ("page", "row_idx"),
    max_files_per_trigger: int | None = 1,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """R2: admit the first arrival of each key into the table at ``out_dir``.

    A streaming aggregation keeps, per key, the row with the smallest
    ``(batch time, arrival order)``; ``current_timestamp()`` is fixed for a
    micro-batch and grows from one to the next, so a key admitted once keeps
    its row.  The state lives in the state store (keyed lookups per batch,
    nothing rescanned), and the aggregation combines map-side, so a key
    repeated many times in one batch is reduced before its shuffle.  Update
    mode re-emits keys touched again with the same row; each epoch is
    written to its own folder (a retried epoch replaces only its output), and
    after ``merge_every`` epochs the earlier ones become a new base with one row
    per key; :func:`read_admitted` keeps one row per key.
    """
    key, order = list(key), list(order)
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    rest = [c for c in stream.columns if c not in key]
    # The batch time is a projected column: aggregate arguments must be
    # deterministic expressions of the input.
    stream = stream.withColumn("_arrival", F.current_timestamp())
    first = stream.groupBy(*key).agg(
        F.min_by(
            F.struct(*[F.col(c) for c in rest]),
            F.struct(F.col("_arrival"), *[F.col(c) for c in order]),
        ).alias("_row")
    )
    admitted = first.select(*key, *[F.col("_row")[c].alias(c) for c in rest])

    table = admitted_table(spark, out_dir, key, merge_every)
    return (
        admitted.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(table.write)
        .trigger(availableNow=True)
        .start()
    )


def admitted_table(
    spark: SparkSession, out_dir: str, key: Sequence[str] = ("symbol", "submitted_at"), every: int = MERGE_EVERY
) -> EpochTable:
    """The epochs of :func:`run_first_submission`; merged, the earliest row of each key is left."""
    return EpochTable(spark, out_dir, lambda rows: first_per_key(rows, list(key), ["epoch_id"]), every)


def read_admitted(spark: SparkSession, out_dir: str, key: Sequence[str] = ("symbol", "submitted_at")) -> DataFrame:
    """The admitted rows, one per key (the earliest epoch that wrote it)."""
    return admitted_table(spark, out_dir, key).rows().drop("epoch_id")
