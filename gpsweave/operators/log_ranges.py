"""The event log kept by arrival range, so that reading its newest
messages touches only the last ranges.

``append_log`` adds the messages of a micro-batch (or of a whole table) under
``batch_id=<b>/arrival_range=<r>`` and one row per range with its number of
messages to a manifest. Writing again under the same batch id replaces what that
batch wrote, so a replayed micro-batch changes nothing. Messages that arrive in
a later batch lie in the range of their own arrival.

``newest_messages`` adds up the manifest from the last range backwards until n
messages are covered and reads from that range on: partitions before it are
pruned, and no global sort is left, only the n largest of each task. A range is
read as a whole; its files are as many as its messages ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.num import idiv

NEWEST_FIRST = ("arrival_key", "event_id", "sub")


def append_log(events: DataFrame, batch_id: int, path: str, width: int) -> None:
    """``width`` arrival keys make a range. Messages without an arrival key have
    no range and count as the oldest."""
    rows = events.withColumns({"arrival_range": idiv(F.col("arrival_key"), width), "batch_id": F.lit(batch_id).cast("long")})
    counts = rows.groupBy("arrival_range", "batch_id").agg(F.count(F.lit(1)).alias("messages"))
    # messages first: a reader that meets them without their manifest rows reads a range too many
    _write_messages(rows.drop("batch_id"), f"{path}/messages/batch_id={batch_id}")
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/manifest"))


def _write_messages(rows: DataFrame, folder: str) -> None:
    """A folder per range. Only a batch that is written again replaces them one
    by one, which the driver does: a new one is committed a task at a time."""
    spark = rows.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    again = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    (rows.hint("rebalance", "arrival_range").write.mode("overwrite").partitionBy("arrival_range")
     .option("partitionOverwriteMode", "dynamic" if again else "static").parquet(folder))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log."""
    return spark.read.parquet(f"{path}/messages")


def first_range_of_newest(spark: SparkSession, path: str, n: int) -> int | None:
    """The range from which on the log holds n messages; None for the whole log.
    Every range of the manifest holds a message, so n of its rows suffice."""
    manifest = (spark.read.parquet(f"{path}/manifest").filter(F.col("arrival_range").isNotNull())
                .groupBy("arrival_range").agg(F.sum("messages").alias("messages")))
    seen = 0
    for r in manifest.orderBy(F.desc("arrival_range")).limit(n).collect():
        seen += r.messages
        if seen >= n:
            return r.arrival_range
    return None


def newest_messages(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The last n messages, newest first (arrival key, event id, place within the ping)."""
    first = first_range_of_newest(spark, path, n) if n > 0 else None
    log = read_log(spark, path)
    if first is not None:
        log = log.filter(F.col("arrival_range") >= first)
    return log.drop("arrival_range", "batch_id").orderBy(*[F.desc_nulls_last(c) for c in NEWEST_FIRST]).limit(max(n, 0))
