"""The filter audit against brute force over all orders, and its popcounts."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from cases import BASE, CLASHING, ROWS, documents, key
from gpsweave.llm.filter_audit import filter_audit, positional_popcount


def brute(rows, labels):
    good, toxic = ({d for d, *l in labels if l[i] == 1 and d is not None} for i in (0, 1))
    texts = [t or "" for _, t, _ in rows]
    first = {}
    for (d, _, _), t in zip(rows, texts):
        if d is not None:
            first[t] = min(first.get(t, d), d)
    docs = []
    for (d, _, lang), t in zip(rows, texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, x in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search(r"[#$%&*|]", t), d is not None and d > first[t])) if x}
        docs.append((lang or "", fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [x for x in docs if x[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                out[part, order, step] = [len(left) - len(removed), len(removed), sum(f in x[1] for x in gone),
                                          sum(x[1] == {f} for x in docs if x[0] == part),
                                          sum(x[2] for x in removed), sum(x[3] for x in removed)]
                shapley[part, f] += len(removed)
                gone += removed
                left = [x for x in left if f not in x[1]]
    return sorted(((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()), key=key)


LONG = " ".join(f"w{i}" for i in range(250))
MORE = [(20, LONG, "en"), (21, LONG, "fr"), (22, LONG + " Über 100%", None), (23, "A B C D " * 60, ""), (24, LONG, "en"),
        (24, LONG, "en"), (20, LONG, "en"), (25, LONG + " #", "fr"), (None, LONG, "fr"), (26, None, None), (27, "\x0b\x0c", "en")]


def test_filter_audit(spark):
    rows = [(d, t, "en" if (d or 0) % 2 else None) for d, t in ROWS] + MORE
    labels = [(1, 1, 0), (1, 0, 1), (20, 1, 1), (21, 1, None), (24, None, 1), (None, 1, 1), (999, 1, 1), (23, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)).withColumn("text", F.lit("x"))
    got = sorted((tuple(r) for r in filter_audit(docs, marks).collect()), key=key)
    assert got == brute(rows, labels)
    assert filter_audit(docs.filter("false"), marks).count() == 0
    assert filter_audit(docs, marks.filter("false")).filter("good_lost + toxic_lost > 0").count() == 0
    none = documents(spark, [(1, None), (2, BASE)])
    assert filter_audit(none, marks).count() == 600


def test_positional_popcount():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 4, 10, 1000, 4097):
        w = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        assert positional_popcount(w).tolist() == [int((w >> np.uint32(i) & np.uint32(1)).sum()) for i in range(32)]
