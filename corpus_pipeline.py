"""The corpus pipeline: five stages over documents, each by one operator of the
training-data subpackage. Every stage is written as Parquet and read again as
the next one's documents; all but the last return the columns of documents.

Rows whose doc_id is null can be matched by no decision and stay. Documents
that share a doc_id go or stay together in the stages that decide by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gpsweave.llm import queries as _queries
from gpsweave.llm.common import read_table, written
from gpsweave.llm.decontaminate import contamination
from gpsweave.llm.exact_dedup import exact_dedup
from gpsweave.llm.partenum import jaccard_components
from gpsweave.llm.piece_fst import encode_documents
from gpsweave.llm.quality import quality_texts

def _without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The rows whose id isn't among the dropped ones, a written table."""
    gone = written(dropped.select(F.col("doc_id").alias("gone")).distinct(), name)
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose quality score reaches the threshold."""
    longer = "_" * max(len(c) for c in docs.columns)   # no column of documents has these names
    score, decision = f"score{longer}", f"decision{longer}"
    scored = quality_texts(docs, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), names=(score, decision))
    return scored.filter(F.col(decision) == 1).drop(score, decision)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the row with the largest doc_id."""
    return _without(docs, exact_dedup(docs).filter("not kept"), "copies")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group linked by shingle similarity the smallest doc_id."""
    return _without(docs, jaccard_components(docs).filter("component_id <> doc_id"), "near")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return _without(docs, contamination(docs, read_table(spark, sf_dir, "benchmark")), "leaks")


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, token_ids, decoded_sha256, round_trip of
    every document that is left, and the text its ids decode to."""
    return encode_documents(docs, _queries.PIECE_MODEL, keep_text=True).withColumnRenamed("decoded", "text")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_passages),
    ("sentencepiece", piece_encoding),
]

# The classifier and the encoder have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
