"""SimHash components against brute force over all pairs of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cases import ROWS, documents, key, low, near_copies
from conftest import SF001
from gpsweave.llm.simhash import fingerprint, fingerprint_links, simhash_components, spanning_links


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not w:
        return 0
    n = min(4, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, j in linked:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def pairs(values, same=lambda i, j: True):
    v = np.array(values, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 4) + i + 1:
            if same(i, j):
                yield i, int(j)


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root, least = components(prints, pairs(prints)), {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((d, f"{f:016x}", least.get(r)) for (d, _), f, r in zip(rows, prints, root)), key=key)


def got(df, **kw):
    return sorted((tuple(r) for r in simhash_components(df, **kw).collect()), key=key)


def test_cases(spark):
    assert got(documents(spark)) == brute(ROWS)
    assert simhash_components(documents(spark).filter("false")).count() == 0
    assert got(documents(spark, [(None, "a b c d"), (None, "a b c d")])) == brute([(None, "a b c d")] * 2)


@pytest.mark.parametrize("limit", [1 << 16, 30])
def test_near_copies_and_refined_buckets(spark, limit):
    rows = near_copies(7)
    rng = random.Random(3)
    base = [f"v{i}" for i in range(800)]
    for d in range(1000, 1060):    # many different texts a few words apart: their fingerprints share nearly all bits
        w = list(base)
        for _ in range(rng.randint(1, 12)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        rows.append((d, " ".join(w)))
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows)
    assert got(documents(spark, rows), bucket_limit=limit) == want


def test_documents_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_links_of_close_fingerprints(spark):
    """A dense ball of fingerprints: buckets are refined down to a few, and every link is kept."""
    rng = random.Random(11)
    ball = {0x0123456789ABCDEF ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(300)}
    values = sorted(ball | {rng.getrandbits(64) for _ in range(300)})
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    number = {v: i for i, v in enumerate(values)}
    want = components(values, pairs(values))
    for limit in (4096, 100):
        links = [(number[r.a % 2**64], number[r.b % 2**64]) for r in fingerprint_links(df, limit).select(
            F.col("a").cast("decimal(20,0)").cast("long"), F.col("b")).collect()]
        assert components(values, links) == want


def test_bit_sliced_groups_of_many_sizes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 20, dtype=np.uint64)
    values, group = [], []
    for k in range(120):
        for _ in range(int(rng.choice([1, 2, 3, 7, 60, 150], p=[.3, .3, .2, .1, .05, .05]))):
            v = int(base[rng.integers(20)])
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                v ^= 1 << int(b)
            values.append(v)
            group.append(k)
    a, b = spanning_links(np.array(values, np.uint64), np.array(group))
    assert components(values, zip(a.tolist(), b.tolist())) == components(values, pairs(values, lambda i, j: group[i] == group[j]))
    assert len(a) < len(values)
    assert all(len(x) == 0 for x in spanning_links(np.zeros(0, np.uint64), np.zeros(0, int)))


def test_fingerprint_of_texts():
    for t in (None, "", " \n", "a", "A b\tC", "É é  ÉÉ \x0b x y z", "word " * 200_000, "a b c d e f g h i j k l m n"):
        assert fingerprint(t) == brute_print(t)
