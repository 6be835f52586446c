"""Small tables with the awkward cases every operator must take: nulls in any
column, empty and long texts, ties, repeated rows, extra columns whose names
clash with the operators' own."""

import random
import re

from pyspark.sql import functions as F

CLASHING = ["h", "id", "t", "n", "words", "label", "score", "cls", "text_hash", "digest", "prefix", "gone", "labels",
            "predicted", "component_id", "keep_id", "bucket", "block", "kind", "root", "quality stage score"]

BASE = "The quick brown fox jumps over the lazy dog while seven small birds sing in the old oak tree by the river"

ROWS = [
    (1, BASE), (2, BASE.upper()), (3, BASE + " today"), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"),
    (8, "One  two"), (9, "Released under the MIT License. " + BASE), (10, "é" * 50 + " ünï çödé 日本語 🎉"),
    (11, "word " * 30_000), (12, "x" * 5000), (12, "x" * 5000), (13, BASE), (None, BASE), (None, None),
    (14, "All rights reserved. CC BY cc-by general  PUBLIC-license"), (15, "\u2581 tab\there \\ ### </turn>"),
]


def documents(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame([(d, t, "en", None if d == 3 else "s", len(t or "")) for d, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for c in CLASHING if clash else []:
        df = df.withColumn(c, F.lit("clash"))
    return df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("label", F.lit(7)).withColumn("text", F.lit("clash"))


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def key(row):
    return tuple((x is None, str(x)) for x in row)


def near_copies(seed, groups=25, shared=60):
    """Groups of near copies of many sizes, and documents that only share a passage."""
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(voc) for _ in range(rng.choice([3, 5, 6, 8, 9, 10, 12, 20, 40, 100, 300]))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                k, i = rng.random(), rng.randrange(len(w) + 1)
                if k < 0.4:
                    w.insert(i, rng.choice(voc))
                elif k < 0.8 and len(w) > 1:
                    w.pop(min(i, len(w) - 1))
                else:
                    w.append(rng.choice(voc))
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    passage = [rng.choice(voc) for _ in range(60)]
    for _ in range(shared):
        own = [[rng.choice(voc) for _ in range(rng.randint(5, 60))] for _ in range(2)]
        rows.append((len(rows), " ".join(own[0] + passage + own[1])))
    return rows
