"""Filter interaction audit: what each of five filters removes in every order.

A document fails some of the filters A-E. Its truth table over the 32 subsets of
filters is one 32-bit word: bit s is set if the document survives all filters of
subset s. Bit counts by position over the words of a part give the survivors of
every subset at once; they are added up by carry-save adders, three words to a
sum and a carry, so a bit position is only looked at once a word is the last of
its weight. Every figure of every order is a difference of such counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# failing filter f rules out the subsets that hold f
TRUTH = {f: sum(1 << s for s in range(SUBSETS) if s >> i & 1) for i, f in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set."""
    counts, weight, places = np.zeros(32, np.int64), 1, np.arange(32, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) >= 3:
            k = len(words) // 3
            a, b, c = words[:k], words[k:2 * k], words[2 * k:3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * k:]])
        for w in words:
            counts += weight * ((w >> places) & 1).astype(np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def _survivors(batches):
    """(part, subset, n, good, toxic) of each part met by a task, from rows (part, word, good, toxic)."""
    totals = {}

    def rows():
        parts = list(totals)
        table = np.concatenate([totals[p] for p in parts], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(parts, object), SUBSETS), pa.string()),
             pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(parts))), *(pa.array(t) for t in table)],
            ["part", "subset", "n", "good", "toxic"])
        totals.clear()

    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        code = codes.indices.to_numpy()
        word = batch.column(1).to_numpy().view(np.uint32)
        good, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        by = np.argsort(code, kind="stable")
        names = codes.dictionary.to_pylist()
        edges = np.searchsorted(code[by], np.arange(len(names) + 1))
        for i, name in enumerate(names):
            own = by[edges[i]:edges[i + 1]]
            w = word[own]
            t = np.stack([positional_popcount(x) for x in (w, w[good[own]], w[toxic[own]])])
            totals[name] = totals[name] + t if name in totals else t
        if len(totals) > 10_000:  # many parts: what is counted so far goes on to the sums
            yield from rows()
    if totals:
        yield from rows()


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and whether it fails A, B, C and D, written once."""
    t = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                    F.coalesce("text", F.lit("")).alias("t"))
    t = t.withColumn("w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    t = t.withColumns({"n_words": F.size("w"), "n_distinct": F.size(F.array_distinct("w")), "n_chars": F.length("t")})
    capitals = F.col("n_chars") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return written(t.select(
        "doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"),
        (F.col("n_words") < MIN_WORDS).alias("A"),
        (100 * F.col("n_distinct").cast("long") < MIN_DISTINCT_PERCENT * F.col("n_words").cast("long")).alias("B"),
        (100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.col("n_chars").cast("long")).alias("C"),
        F.col("t").rlike(SYMBOLS).alias("D")), "failures")


def _word() -> Column:
    ruled_out = F.lit(0)
    for f in FILTERS:
        t = TRUTH[f]
        ruled_out = ruled_out.bitwiseOR(F.when(F.col(f), F.lit(t - (1 << 32) if t >> 31 else t)).otherwise(F.lit(0)))
    return F.bitwise_not(ruled_out)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang; null: the empty string), order of the filters and
    step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null text is empty: it fails A and, if another document with an empty text
    has a smaller id, E. E compares ids: of rows that share the smallest id of
    their text none fails it, and a null id neither fails it nor makes another
    fail. A document is good (toxic) if any of its label rows says 1; without a
    label it is neither. An empty table gives no rows. Other columns are ignored.

    Shuffled are digests, ids and flags, no texts: copies are found by an
    aggregate that combines on the map side, and the groups of two and more are
    joined back from a written table, so adaptive execution can split a large one.
    """
    rows = failures(docs)
    first = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("digest", "first_id"), "first")
    marks = (labels.filter("quality = 1 OR toxic = 1").groupBy("doc_id")
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    rows = (rows.join(first, "digest", "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))
            .join(written(marks, "marks"), "doc_id", "left"))
    counts = (rows.select("part", _word().alias("word"), F.coalesce("good", F.lit(False)).alias("good"),
                          F.coalesce("toxic", F.lit(False)).alias("toxic"))
              .mapInArrow(_survivors, "part string, subset int, n long, good long, toxic long")
              .groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic"))))
    # 32 rows a part, as one array ordered by subset
    tables = counts.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("s"))
    return _orders(tables)


def _orders(tables: DataFrame) -> DataFrame:
    """The figures of all orders and steps from each part's survivors by subset."""
    steps = (tables.select("part", "s", F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order"))
             .select("part", "s", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")))
    bit = "shiftleft(1, ascii(substring(filter_order, {0}, 1)) - 65)".format
    steps = steps.withColumns({
        "bit": F.expr(bit("step")),
        "before": F.expr(f"aggregate(sequence(1, {len(FILTERS)}), 0, (m, i) -> m | if(i < step, {bit('i')}, 0))")})
    steps = steps.withColumn("after", F.expr("before | bit"))
    # a filter's removals over all orders: those in which exactly subset x comes before it number |x|! (4 - |x|)!
    shapley = (f"aggregate(sequence(0, {SUBSETS - 1}), 0L, (total, x) -> total + if((x & bit) = 0, "
               "array(24, 6, 4, 6, 24)[bit_count(x)] * (s[x].n - s[x | bit].n), 0L))")
    out = {"kept": "s[after].n", "removed": "s[before].n - s[after].n",
           "redundant": "(s[0].n - s[bit].n) - (s[before].n - s[after].n)",
           "unique_fails": f"s[{SUBSETS - 1} - bit].n - s[{SUBSETS - 1}].n",
           "good_lost": "s[before].good - s[after].good", "toxic_lost": "s[before].toxic - s[after].toxic", "shapley": shapley}
    return steps.select("part", "filter_order", "step", *(F.expr(e).alias(c) for c, e in out.items()))
