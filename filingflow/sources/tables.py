"""Parquet tables of a data directory (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan ``<data_dir>/<name>.parquet``; callers select columns so that the
    scan's ReadSchema holds only what the query needs."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared work folder: computed once for all that read it,
    and not again when an executor is lost."""
    from filingflow.session import new_work_dir

    path = new_work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
