"""Benchmark decontamination: short test items found inside long documents by
size-partitioned MinHash containment search, verified by exact shingle
containment.

Items are partitioned by the size of their shingle set. An item's sketch is its
k smallest shingle hashes, k set by the partition's upper size bound so that a
document that holds the share ``threshold`` of the item's shingles lacks fewer
than k of them: it must hold at least one sketch value, so the search misses
nothing. Documents are read once; their shingles are looked up in the sketches
and only documents with a hit are compared with the item's full set.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

ITEM_BLOCK_BYTES = 8 << 20
SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def _sketch_size(size: int, threshold: float) -> int:
    upper = 2 ** int(size).bit_length() - 1  # sizes 2^j .. 2^(j+1) - 1 are one partition
    return min(size, upper - ceil(threshold * upper - 1e-9) + 1)


def _index(ids: list, texts: pa.Array, threshold: float, n: int) -> dict:
    """For each gram length: sorted sketch values, the item of each, and the items' sets."""
    hasher, out = tk.Hasher(tk.alphanumeric_words()), {}
    data, offs = tk.utf8(texts)
    h, first, _, _ = hasher.words(data, offs)
    for i, item in enumerate(ids):
        own = h[first[i]:first[i + 1]]
        if item is None or not len(own):
            continue
        length = min(n, len(own))
        grams = np.unique(tk.grams(own, np.array([0, len(own)]), length)[0])
        entry = out.setdefault(length, {"values": [], "owner": [], "items": []})
        k = _sketch_size(len(grams), threshold)
        entry["values"].append(grams[:k])
        entry["owner"].append(np.full(k, len(entry["items"])))
        entry["items"].append((item, grams))
    for e in out.values():
        values, owner = np.concatenate(e["values"]), np.concatenate(e["owner"])
        by = np.argsort(values, kind="stable")
        e["values"], e["owner"] = values[by], owner[by]
        e["front"] = np.zeros(1 << 20, bool)  # first test: the top 20 bits
        e["front"][values >> np.uint64(44)] = True
    return out


def _search(index, threshold: float):
    def run(batches):
        hasher, found = tk.Hasher(tk.alphanumeric_words()), index.value
        for batch in batches:
            ids, (data, offs) = batch.column(0), tk.utf8(batch.column(1))
            rows = []
            for r0, d, o in tk.blocks(data, offs):
                h, first, _, _ = hasher.words(d, o)
                for length, e in found.items():
                    g, at = tk.grams(h, first, length)
                    hit = np.flatnonzero(e["front"][g >> np.uint64(44)])
                    lo, hi = np.searchsorted(e["values"], g[hit], "left"), np.searchsorted(e["values"], g[hit], "right")
                    hit, lo, hi = hit[hi > lo], lo[hi > lo], hi[hi > lo]
                    row = np.searchsorted(at, hit, "right") - 1
                    wanted = {}
                    for r, a, b in zip(row.tolist(), lo.tolist(), hi.tolist()):
                        wanted.setdefault(r, set()).update(e["owner"][a:b].tolist())
                    for r, items in wanted.items():
                        own = np.unique(g[at[r]:at[r + 1]])
                        for item, grams in (e["items"][i] for i in sorted(items)):
                            shared = int(np.isin(grams, own, assume_unique=True).sum())
                            if shared >= ceil(threshold * len(grams) - 1e-9):
                                rows.append((ids[r0 + r].as_py(), item, len(grams), shared, shared / len(grams)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.float64(),))],
                    ["doc_id", "item_id", "n_item", "n_shared", "containment"])
    return run


def contamination(docs: DataFrame, items: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """One row per document and item with at least the share ``threshold`` of
    the item's distinct n-word shingles in the document.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased;
    an item of fewer than n words is one shingle of its own length. Null or
    wordless texts match nothing, items without an id are left out; rows that
    repeat a document or an item give repeated rows. Items are searched in
    blocks of a bounded number of bytes, each sent to the executors once, so any
    number of items is covered. Only the two named columns of each table are read.
    """
    spark = docs.sparkSession
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = ceil(total / ITEM_BLOCK_BYTES) or 1
    parts = []
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).toArrow()
        index = spark.sparkContext.broadcast(
            _index(block.column(0).to_pylist(), block.column(1), threshold, n))
        parts.append(docs.mapInArrow(tk.gives_back(_search(index, threshold)), SCHEMA))
    return reduce(DataFrame.union, parts)
