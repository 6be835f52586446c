"""Exact dedup by progressive refinement: length, then prefix hash, then the
hash of the full text. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

PREFIX_CHARS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of equal texts; equal: identical once A-Z is lower-cased.

    Returns one row per input row: the id, ``keep_id`` (largest id of the
    group), ``group_size`` (rows), ``kept``, ``text_sha256`` (hex, of the
    normalised text). Other input columns are ignored.

    One scan reads the texts and keeps 60 bytes a row: byte length, a hash of
    the first characters, the full digest. (The result holds every row's
    digest, and moving a text to spare its hash would cost more than the hash.)
    Each refinement step then takes only what survived the step before: rows
    whose length is not unique, of those the rows whose length and prefix hash
    are not unique, and only their digests are grouped. Every grouping combines
    on the map side, and every join reads written tables, so adaptive execution
    splits a hot length or a hot group of copies.

    Null text counts as empty, so null and empty texts are one group. Rows that
    repeat an id within a group are the same document: all stay or all go. Rows
    with a null id go if their group has any other id. An empty table gives an
    empty result.
    """
    keys = written(
        docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("t"))
        .select("id", F.octet_length("t").cast("long").alias("n_bytes"),
                F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix"),
                F.unhex(F.sha2("t", 256)).alias("digest")), "keys")

    def repeated(rows: DataFrame, *by: str) -> DataFrame:
        groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*by)
        return written(rows.join(written(groups, "groups"), list(by), "left_semi"), "survivors")

    by_length = repeated(keys.select("id", "n_bytes", "prefix", "digest"), "n_bytes")
    by_prefix = repeated(by_length, "n_bytes", "prefix")
    groups = written(by_prefix.groupBy("digest")
                     .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
                     .filter("n > 1"), "equal")
    return (keys.join(groups, "digest", "left")
            .select(F.col("id").alias(id_col),
                    F.coalesce("keep", "id").alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    F.col("id").eqNullSafe(F.coalesce("keep", "id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
