"""SimHash near-dedup with bit-sliced comparison.

Fingerprints that differ in at most ``RADIUS`` of 64 bits are linked. The bits
are cut into RADIUS + 2 segments; of two linked fingerprints at least two
segments are equal, so both lie in one *bucket* (a pair of segments and its
bits) of one of the 15 pairs. Within a bucket nothing is compared pair by pair:
bit b of 64 fingerprints is one machine word of bit plane b, the planes are
XORed with themselves shifted by s places (every fingerprint against the one s
places on), and the distances of all 64 are added up by carry-save adders, plane
by plane. A word whose lanes have all passed the radius is abandoned.

A bucket above ``BUCKET`` fingerprints is refined: its bits not yet equal are
cut the same way, and its members meet in the smaller buckets, until a bucket is
small enough or so few bits are left that no more fingerprints exist. So no task
compares an unbounded group and no link is missed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import written
from .components import components

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
FREE_BITS = 16       # a bucket whose members differ in no more bits holds at most 2 ** FREE_BITS
BUCKET = 1 << FREE_BITS   # fingerprints compared within one bucket
SPACE = b" \t\n\x0b\x0c\r"
PLANES_AT_ONCE = 4   # planes added between two looks at what is abandoned
CHUNK = 1 << 16      # shingles hashed at once
LANES = 1 << 16      # fingerprints whose bit planes are held at once
WORDS = 1 << 14      # words of 64 comparisons run together


# ------------------------------------------------------------- fingerprints
def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()   # bytes: lower-cases A-Z, splits at space and 0x09-0x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        counts += _bit_counts(np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])),
                                          np.uint64, min(CHUNK, n - i)))
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64))


def _fingerprints(batches):
    for batch in batches:
        fp = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


# -------------------------------------------------------------- bit slices
def planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes of the fingerprints: word w of plane b holds bit b of the fingerprints 64 w to 64 w + 63."""
    n = -(-len(fp) // 64) * 64
    bits = np.unpackbits(np.append(fp, np.zeros(n - len(fp), np.uint64)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _above(counter: list, radius: int) -> np.ndarray:
    """Lanes whose bitwise counter (lowest bit first, the last entry sticky) exceeds the radius."""
    over, equal = counter[-1].copy(), ~counter[-1]
    for i in reversed(range(len(counter) - 1)):
        if radius >> i & 1:
            equal &= counter[i]
        else:
            over |= equal & counter[i]
            equal &= ~counter[i]
    return over


def near(p: np.ndarray, at: np.ndarray, shift: np.ndarray, live: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Lanes i and j = i + shift whose fingerprints are at most ``radius`` apart.
    Many comparisons run together, each of the 64 lanes of word ``at`` with those
    ``shift`` places on, where ``live`` has a bit; p ends in words of padding."""
    words, low = shift // 64, (shift % 64).astype(np.uint64)
    high = np.uint64(64) - low
    # counter bits up to the radius and the carry beyond it, which is sticky
    counter = [np.zeros(len(at), np.uint64) for _ in range(radius.bit_length() + 1)]
    for b in range(0, BITS, PLANES_AT_ONCE):
        ones = [counter[0]]
        for x in range(b, b + PLANES_AT_ONCE):
            there = p[x, at + words] >> low
            there |= np.where(low > 0, p[x, at + words + 1] << (high & np.uint64(63)), np.uint64(0))
            ones.append(p[x, at] ^ there)
        for level in range(len(counter) - 1):     # carry-save: three words of a weight to one, and one of the next weight
            carries = []
            while len(ones) > 1:
                x, y, z = ones.pop(), ones.pop(), ones.pop() if ones else None
                half = x ^ y
                carries.append(x & y if z is None else (x & y) | (half & z))
                ones.append(half if z is None else half ^ z)
            counter[level] = ones[0]
            ones = [counter[level + 1], *carries]
        for x in ones[1:]:
            ones[0] = ones[0] | x
        counter[-1] = ones[0]
        live = live & ~_above(counter, radius)
        stay = np.flatnonzero(live)
        if len(stay) < len(at):                   # abandoned: all lanes beyond the radius
            at, live, words, low, high, shift = (v[stay] for v in (at, live, words, low, high, shift))
            counter = [c[stay] for c in counter]
        if not len(at):
            break
    row, lane = np.nonzero(np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    i = at[row] * 64 + lane
    return i, i + shift[row]


class Links:
    """A growing forest over positions: each link joins two trees."""

    def __init__(self, n: int):
        self.parent, self.found = np.arange(n), []

    def root(self, i: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[i]
            over = self.parent[up]
            if np.array_equal(up, over):
                return up
            self.parent[i] = over

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root(i), self.root(j)
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            high, one = np.unique(np.maximum(a, b), return_index=True)   # each root is hung below a smaller one, once
            self.parent[high] = np.minimum(a, b)[one]
            self.found.append((i[one], j[one]))


def spanning_links(fp: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that connect what lies within the radius of each other
    within a group; equal groups lie together. At most one link fewer than
    fingerprints: a pair already connected by links found before gives none."""
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(group)))
    forest, band = Links(len(fp)), 2
    while len(size) and band <= size.max():        # groups of band .. 2 * band - 1 together
        use = (size >= band) & (size < 2 * band)
        lanes = np.flatnonzero(np.repeat(use, size))
        band *= 2
        for x in range(0, len(lanes), LANES):      # a group cut here goes on in the lanes behind it
            most = int(size[use].max())
            own = lanes[x:x + LANES + most - 1]
            p = np.concatenate([planes(fp[own]), np.zeros((BITS, most // 64 + 2), np.uint64)], axis=1)
            # lanes of the same group behind each lane
            rest = np.zeros(-(-len(own) // 64) * 64, np.int64)
            rest[:len(own)] = (np.repeat(heads + size, size) - np.arange(len(fp)) - 1)[own]
            rest[LANES:] = 0
            width = len(rest) // 64
            for s in range(1, most, max(1, WORDS // width)):
                shifts = np.arange(s, min(most, s + max(1, WORDS // width)))
                live = np.packbits(rest >= shifts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
                used = np.flatnonzero(live)
                i, j = near(p, used % width, shifts[used // width], live[used])
                forest.add(own[i], own[j])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip((none, none), *forest.found))


# ----------------------------------------------------------------- buckets
def _segments(free: int) -> list[int]:
    """The bits of ``free``, cut into RADIUS + 2 masks of about equal size."""
    bits = [b for b in range(BITS) if free >> b & 1]
    cuts = [len(bits) * i // (RADIUS + 2) for i in range(RADIUS + 3)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])]


def _keys(fp: np.ndarray, mask: np.ndarray):
    """(index of the row, mask of the bits equal in the bucket, bucket) of every
    bucket a row goes to next; ``mask`` are the bits equal in its present one."""
    rows, masks, keys = [], [], []
    for m in np.unique(mask).tolist():
        own = np.flatnonzero(mask == m)
        for x, y in combinations(_segments(~m & (2**64 - 1)), 2):
            to = np.uint64(m | x | y)
            rows.append(own)
            masks.append(np.full(len(own), to))
            keys.append(tk.mix((fp[own] & to) ^ tk.mix(np.array([to]))))
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(masks or [empty]), np.concatenate(keys or [empty]))


def _to_buckets(batches):
    """Rows (fp, mask) to rows (fp, mask, bucket)."""
    for batch in batches:
        fp, mask = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        for i in range(0, len(fp), 1 << 14):
            f, m = fp[i:i + (1 << 14)], mask[i:i + (1 << 14)]
            row, to, key = _keys(f, m)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (f[row], to, key)], ["fp", "mask", "bucket"])


def _compared(batches):
    """Links between the fingerprints of whole buckets, from rows (bucket, mask, fp) sorted by bucket."""
    held = []

    def links(rows):
        bucket, mask, fp = rows
        by = np.lexsort((fp, mask, bucket))      # two buckets with equal hashes are told apart by mask and equal bits
        fp, mask, bucket = fp[by].view(np.uint64), mask[by].view(np.uint64), bucket[by]
        change = (bucket[1:] != bucket[:-1]) | (mask[1:] != mask[:-1]) | ((fp[1:] & mask[1:]) != (fp[:-1] & mask[1:]))
        a, b = spanning_links(fp, np.concatenate([[0], np.cumsum(change)]))
        return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(3)]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1]))     # the last bucket may go on
        if last:
            whole = [np.concatenate([*(h[i] for h in held), c[:last]]) for i, c in enumerate(cols)]
            held = []
            yield links(whole)
        held.append([c[last:] for c in cols])
    if held:
        yield links([np.concatenate([h[i] for h in held]) for i in range(3)])


def fingerprint_links(prints: DataFrame, bucket_limit: int = BUCKET) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp, distinct) that
    connect every pair within the radius, directly or through other links.

    Bucket sizes come from an aggregate before any bucket is put into one task;
    rows alone in their bucket aren't sent on, and larger buckets are refined."""
    spark = prints.sparkSession
    rows, links = prints.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        rows = written(rows.mapInArrow(_to_buckets, "fp long, mask long, bucket long"), "buckets")
        sizes = written(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.first("mask").alias("equal")).filter("n > 1"), "sizes")
        large = F.expr(f"n > {bucket_limit} AND {BITS} - bit_count(equal) > {FREE_BITS}")
        met = rows.join(sizes.filter(~large).select("bucket"), "bucket", "left_semi").select("bucket", "mask", "fp")
        new = written(met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tk.gives_back(_compared), "a long, b long"), "links")
        links = new if links is None else links.unionByName(new)
        over = written(sizes.filter(large).select("bucket"), "large")
        if over.isEmpty():
            return links
        rows = written(rows.join(over, "bucket", "left_semi").select("fp", "mask").distinct(), "refined")


def simhash_components(docs: DataFrame, bucket_limit: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    reachable by links, itself included) of every document.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased; a
    text of one to three words is one shingle. Null, empty and wordless texts
    have fingerprint zero and are linked like any other. Rows that repeat an id
    keep one row each. Null ids count for no smallest id; where all ids of a
    component are null, so is component_id. An empty table gives no rows. Other
    columns are ignored.

    Copies are one fingerprint, whatever their number: candidates are searched
    among different fingerprints, and documents meet them by an aggregate that
    combines on the map side and a join of written tables.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    of = written(docs.mapInArrow(tk.gives_back(_fingerprints), "doc_id long, fp long"), "fingerprints")
    least = written(of.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    root = components(fingerprint_links(least.select("fp"), bucket_limit))
    rooted = written(least.join(root.withColumnRenamed("node", "fp"), "fp", "left"), "rooted")
    best = rooted.filter("root is not null").groupBy("root").agg(F.min("least").alias("best"))
    # fingerprints of one document without links need no join
    known = written(rooted.join(best, "root", "left").filter("root is not null OR n > 1")
                    .select("fp", F.coalesce("best", "least").alias("component_id")), "known")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return (of.join(known.withColumn("held", F.lit(True)), "fp", "left")
            .select("doc_id", digits.alias("fingerprint"),
                    F.when(F.col("held"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
