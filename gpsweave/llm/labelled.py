"""Training rows of the two classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of

SAMPLE_ROWS = 20_000


def training_labels(labels: DataFrame, label: str, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id and label of every labelled document whose crc32(doc_id as text)
    modulo ``modulus`` is not ``held``. Rows without an id or a label are left out."""
    return (labels.select("doc_id", F.col(label).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (bucket_of("doc_id", modulus) != held))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE_ROWS,
                  modulus: int = 5, held: int = 0) -> DataFrame:
    """text and label of about ``sample`` labelled documents at most, taken by a
    hash of the id from those whose crc32(doc_id as text) modulo ``modulus`` is
    not ``held``. Rows without an id or a label are left out. The sampled labels
    are at most about ``sample`` small rows, so they are broadcast."""
    usable = training_labels(labels, label, modulus, held)
    share = min(1.0, sample / max(1, usable.count()))
    picked = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label")
