"""Shared helpers of the training-data operators: reading tables, tables
written to shared storage, and the ASCII-only normalisation of texts."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts the lineage, survives lost executors, and gives later joins a
    plain scan, so adaptive execution can split their skewed partitions."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null counts as empty. Pure ASCII texts take
    the fast path of ``lower``."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(t) == F.length(t), F.lower(t))
            .otherwise(F.translate(t, UPPER, LOWER)))


def bucket_of(column: str, n: int) -> Column:
    """crc32 of a column's text, modulo n (the split rule of labelled rows); null
    counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


@contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Within the block, tasks get their rows in Arrow batches of at most ``n``:
    for tables whose rows are large, so that a batch of them isn't."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)
