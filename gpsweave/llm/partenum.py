"""N-gram Jaccard join by PartEnum signatures.

A text's set is its distinct 5-word shingles; sets with Jaccard similarity of
at least 0.8 are linked. Equal sets are one class. Classes fall into size bands
whose bounds grow by 1.25, so linked sets lie in the same or in neighbouring
bands. For each band pair the feature domain is split into n1 random
partitions; linked sets differ in at most k features, so at least n1 - k
partitions hold the same features of both. A signature is the hash of a class's
features in one partition (PartEnum with second-level size one: every subset
that its first level leaves to enumerate is a single partition).

With n1 > k + 1 linked classes share not one but many signatures: all of the
n1 - k equal partitions that aren't empty. So a class is a candidate only if it
shares at least T = (its non-empty partitions) - k signatures, and it suffices
to compare classes that share one of a class's signatures but the T - 1 most
frequent ones (prefix filtering over signatures): passages that many documents
hold are dropped there without losing a link. Where chance leaves a class so
many empty partitions that T isn't positive, all its signatures count, and its
single features serve as signatures too; two such classes meet there.

Signatures are handled as packed arrays: each task sends one array per
signature range, each range's task sends back the shared ones, and only those
that survive both filters become rows. A signature that one task sees often
(``HOT``) isn't sent entry by entry: a marker goes to its range, so a range
never holds more than ``HOT`` entries of one signature per task."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import rows_per_batch, written
from .components import components

N = 5
HOT = 64
FLUSH = 1_500_000
NO_CLASS = np.uint32(0xFFFFFFFF)
MARGIN = 0.3  # partitions beyond k, as a share of k


def _bands(limit: int = 1 << 40):
    bounds, k, n1 = [1], [], []
    while bounds[-1] < limit:
        bounds.append(bounds[-1] * 5 // 4 + 1)
        k.append((bounds[-1] - 1) // 4)  # hamming distance <= (1/4) * size of the smaller set
        n1.append(k[-1] + 1 + max(2, ceil(MARGIN * k[-1])))
    return np.array(bounds), np.array(k), np.array(n1)


BOUNDS, K_MAX, PARTS = _bands()


def linked(shared, a, b):
    """100 * intersection >= 80 * union."""
    return 100 * shared >= 80 * (a + b - shared)


def shingle_sets(data, offs, hasher):
    """(row of each feature, features sorted within rows, set sizes, class hashes) of a block."""
    rows = len(offs) - 1
    h, first, _, _ = hasher.words(data, offs)
    g, at = tk.shingles(h, first, N)
    row = np.repeat(np.arange(rows), np.diff(at))
    by = np.argsort(g)
    by = by[np.argsort(row[by].astype(np.uint16 if rows < 65536 else np.int64), kind="stable")]
    g, row = g[by], row[by]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    size = np.bincount(row, minlength=rows)
    return row, g, size, tk.mix(_sums(row, tk.mix(g ^ np.uint64(0x7F4A7C159E3779B9)), rows) ^ size.astype(np.uint64))


def _sums(key, values, n):
    """Sums of 64-bit values by key, modulo 2**64 (exact: 32-bit halves in doubles)."""
    low = np.bincount(key, (values & np.uint64(0xFFFFFFFF)).astype(float), n).astype(np.uint64)
    high = np.bincount(key, (values >> np.uint64(32)).astype(float), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def _classes(batches):
    hasher = tk.Hasher(tk.white_space_words())
    for batch in batches:
        data, offs = tk.utf8(batch.column(1))
        for r0, d, o in tk.blocks(data, offs):
            _, _, size, cls = shingle_sets(d, o, hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(r0, len(size)), batch.column(2).slice(r0, len(size)), pa.array(size, pa.int64()),
                 pa.array(cls.view(np.int64), mask=size == 0)], ["doc_id", "h", "n_shingles", "cls"])


def signatures(row, g, size):
    """(row, instance, signature) of a block's sets and T of each row and
    instance: 0 and 1 are the band pairs with the band above and below, 2 the
    single features."""
    rows = len(size)
    band = np.searchsorted(BOUNDS, size, "right") - 1
    t = np.full((rows, 3), 1 << 30, np.int64)
    out_row, out_sig, out_inst = [], [], []
    weak = np.zeros(rows, bool)
    value = tk.mix(g ^ np.uint64(0x2545F4914F6CDD1D))
    for inst in (0, 1):
        pair = band - inst
        k = np.where((size > 0) & (pair >= 0), K_MAX[np.maximum(pair, 0)], 0)
        on = k > 0  # else only equal sets are linked
        n1 = np.where(on, PARTS[np.maximum(pair, 0)], 0)
        base = np.cumsum(n1) - n1
        use = on[row]
        r, v = row[use], value[use]
        seed = tk.mix(pair.astype(np.int64).view(np.uint64) + np.uint64(0x51ED270B))
        part = tk.mix(g[use] + seed[r]) % n1[r].astype(np.uint64)
        key = base[r] + part.astype(np.int64)
        total = int(n1.sum())
        held = np.flatnonzero(np.bincount(key, minlength=total)) if total else np.zeros(0, np.int64)
        if not len(held):
            continue
        owner = np.searchsorted(base + n1, held, "right")
        sums = _sums(key, v, total)[held]
        sig = tk.mix(sums ^ tk.mix((held - base[owner]).astype(np.uint64) + seed[owner]))
        n_sig = np.bincount(owner, minlength=rows)
        t[on, inst] = (n_sig - k)[on]
        weak |= on & (n_sig <= k)
        out_row.append(owner)
        out_sig.append(sig)
        out_inst.append(np.full(len(owner), inst))
    if weak.any():
        use = weak[row]
        out_row.append(row[use])
        out_sig.append(tk.mix(g[use] + np.uint64(0x9D39247E33776D41)))
        out_inst.append(np.full(int(use.sum()), 2))
        t[weak, 2] = -(-size[weak] * 4 // 5)
    if not out_row:
        z = np.zeros(0, np.int64)
        return z, z, z.view(np.uint64), t
    return np.concatenate(out_row), np.concatenate(out_inst), np.concatenate(out_sig), t


PACKED = "bucket long, block long, kind byte, a binary, b binary, c binary"


def _packed(rows):
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int8()),
         *(pa.array(c, pa.binary()) for c in cols[3:])], ["bucket", "block", "kind", "a", "b", "c"])


def _bucket(sig, n):
    return ((sig >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


LOW40 = np.uint64((1 << 40) - 1)


def _send(n_buckets):
    def run(batches):
        hasher = tk.Hasher(tk.white_space_words())
        part, flushed = TaskContext.get().partitionId(), 0
        seen, cls, ts, sets, sigs, keys, size = set(), [], [], [], [], [], 0

        def flush():
            """Arrays for each signature range (kind 0), the class table (1), hot entries (2)."""
            nonlocal flushed
            block = (part << 20) + flushed
            flushed += 1
            sig, key = np.concatenate(sigs), np.concatenate(keys)
            by = np.argsort(sig)
            sig, key = sig[by], key[by]
            heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            run_size = np.diff(np.append(heads, len(sig)))
            hot = np.repeat(run_size >= HOT, run_size)
            out = []
            home = block % n_buckets
            out.append((home, block, 1, np.concatenate(cls).tobytes(), np.concatenate(ts).astype(np.int32).tobytes(),
                        np.concatenate(sets).astype(np.int64).tobytes()))
            if hot.any():
                b = _bucket(sig[hot], n_buckets).astype(np.uint64)
                out.append((home, block, 2, ((b << np.uint64(40)) | (sig[hot] & LOW40)).tobytes(), key[hot].tobytes(), np.full(int(hot.sum()), 255, np.uint8).tobytes()))
            keep = ~hot
            keep[heads[run_size >= HOT]] = True
            key = np.where(hot, NO_CLASS, key)
            sig, key = sig[keep], key[keep]
            b = _bucket(sig, n_buckets)
            edges = np.searchsorted(b, np.arange(n_buckets + 1))
            for j in np.flatnonzero(np.diff(edges)).tolist():
                s, k = sig[edges[j]:edges[j + 1]], key[edges[j]:edges[j + 1]]
                narrow = k.max() < 65536
                out.append((j, block, 0, (s & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                            ((s >> np.uint64(32)) & np.uint64(255)).astype(np.uint8).tobytes(), k.astype(np.uint16 if narrow else np.uint32).tobytes()))
            for i in range(0, len(out), 256):
                yield _packed(out[i:i + 256])

        count = 0
        for batch in batches:
            data, offs = tk.utf8(batch.column(0))
            for _, d, o in tk.blocks(data, offs):
                row, g, n, c = shingle_sets(d, o, hasher)
                fresh = np.zeros(len(n), bool)
                for i, x in enumerate(c.tolist()):  # equal sets of a block are sent once
                    if n[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                use = fresh[row]
                number = np.cumsum(fresh) - 1
                row, inst, sig, t = signatures(number[row[use]], g[use], n[fresh])
                cls.append(c[fresh])
                ts.append(t)
                sets.append(n[fresh])
                sigs.append(sig)
                keys.append(((row + count) * 4 + inst).astype(np.uint32))
                count += int(fresh.sum())
                size += len(sig)
                if size > FLUSH:
                    yield from flush()
                    seen, cls, ts, sets, sigs, keys, size, count = set(), [], [], [], [], [], 0, 0
        if size:
            yield from flush()
    return run


def _shared(key, table):
    """The entries of a signature range whose signature occurs more than once,
    by the block they came from; class tables and hot entries pass through."""
    bucket = key[0].as_py()
    out = [(0, r["block"], r["kind"], r["a"], r["b"], r["c"]) for r in table.filter(pa.compute.not_equal(table["kind"], 0)).to_pylist()]
    own = table.filter(pa.compute.equal(table["kind"], 0))
    if own.num_rows:
        sigs, keys, blocks = [], [], []
        for block, a, b, c in zip(*(own[x].to_pylist() for x in ("block", "a", "b", "c"))):
            s = np.frombuffer(a, np.uint32).astype(np.uint64) | (np.frombuffer(b, np.uint8).astype(np.uint64) << np.uint64(32))
            k = np.frombuffer(c, np.uint16 if len(c) == 2 * len(s) else np.uint32).astype(np.uint32)
            sigs.append(s)
            keys.append(k)
            blocks.append(np.full(len(s), block, np.int64))
        sig, k, block = np.concatenate(sigs), np.concatenate(keys), np.concatenate(blocks)
        by = np.argsort(sig)
        sig, k, block = sig[by], k[by], block[by]
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        n = np.diff(np.append(heads, len(sig)))
        marked = np.add.reduceat((k == NO_CLASS).astype(np.int64), heads) > 0
        weight = np.where(marked, 255, np.minimum(254, 8 * np.log2(n))).astype(np.uint8)
        use = np.repeat((n > 1) | marked, n) & (k != NO_CLASS)
        weight = np.repeat(weight, n)[use]
        sig, k, block = (sig[use] | (np.uint64(bucket) << np.uint64(40))), k[use], block[use]
        by = np.argsort(block, kind="stable")
        sig, k, block, weight = sig[by], k[by], block[by], weight[by]
        heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else []
        for x, y in zip(heads, np.append(heads[1:], len(block)) if len(block) else []):
            out.append((0, int(block[x]), 2, sig[x:y].tobytes(), k[x:y].tobytes(), weight[x:y].tobytes()))
    if not out:
        return pa.Table.from_batches([_packed([(0, 0, 9, b"", b"", b"")]).slice(0, 0)])
    return pa.Table.from_batches([_packed(out)])


def _candidates(key, table):
    """(sig, cls, size) of a block's classes that pass the count filter, without
    their T - 1 most frequent signatures."""
    kinds = table["kind"].to_pylist()
    a, b, c = (table[x].to_pylist() for x in ("a", "b", "c"))
    one = kinds.index(1)
    cls, t, sets = np.frombuffer(a[one], np.int64), np.frombuffer(b[one], np.int32), np.frombuffer(c[one], np.int64)
    mine = [i for i, x in enumerate(kinds) if x == 2]
    if not mine:
        return pa.table({x: pa.array([], pa.int64()) for x in ("sig", "cls", "size")})
    sig = np.concatenate([np.frombuffer(a[i], np.uint64) for i in mine])
    k = np.concatenate([np.frombuffer(b[i], np.uint32) for i in mine])
    weight = np.concatenate([np.frombuffer(c[i], np.uint8) for i in mine])
    by = np.lexsort((sig, weight, k))
    sig, k = sig[by], k[by]
    heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    n = np.diff(np.append(heads, len(k)))
    need = t.reshape(-1, 3)[k[heads] >> 2, k[heads] & 3].astype(np.int64)
    keep = np.where(n < need, 0, n - np.maximum(need - 1, 0))
    place = np.arange(len(k)) - np.repeat(heads, n)
    use = place < np.repeat(keep, n)
    return pa.table({"sig": sig[use].view(np.int64), "cls": cls[k[use] >> 2], "size": sets[k[use] >> 2]})


PAIRS_AT_ONCE = 256      # pairs of whole texts in a batch
KEPT_FEATURES = 1 << 20  # of texts held for the pairs to come: 8 MB


def _verified(batches):
    """Of rows (a, b, text_a, text_b): those whose sets are linked."""
    hasher, kept, held = tk.Hasher(tk.white_space_words()), {}, 0

    def one(cls, text):
        nonlocal held
        if cls not in kept:
            data, offs = tk.utf8(pa.array([text]))
            g = shingle_sets(data, offs, hasher)[1]
            if held + len(g) > KEPT_FEATURES:
                kept.clear()
                held = 0
            kept[cls] = g
            held += len(g)
        return kept[cls]

    for batch in batches:
        for r in range(0, batch.num_rows, 256):
            part = batch.slice(r, 256)
            data, offs = tk.utf8(part.column(3))
            ok = []
            firsts = part.column(0).to_pylist()
            for r0, d, o in tk.blocks(data, offs):
                row, g, size, _ = shingle_sets(d, o, hasher)
                at = np.concatenate([[0], np.cumsum(size)])
                for i in range(len(size)):
                    x, y = one(firsts[r0 + i], part.column(2)[r0 + i].as_py()), g[at[i]:at[i + 1]]
                    ok.append(bool(linked(int(np.isin(x, y, assume_unique=True).sum()), len(x), len(y))))
            yield part.select([0, 1]).filter(pa.array(ok))


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts' sets are linked."""
    with_b = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    with rows_per_batch(pairs.sparkSession, PAIRS_AT_ONCE):
        return written(both.select("a", "b", "text_a", "text_b").mapInArrow(tk.gives_back(_verified), "a long, b long"), "verified")


def _single_features(batches):
    hasher = tk.Hasher(tk.white_space_words())
    for batch in batches:
        data, offs = tk.utf8(batch.column(1))
        for r0, d, o in tk.blocks(data, offs):
            row, g, size, _ = shingle_sets(d, o, hasher)
            cls = batch.column(0).slice(r0, len(size)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(cls[row]), pa.array(size[row], pa.int64())],
                                             ["feature", "cls", "size"])


def _by_features(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of the classes in ``rows`` that lie in different
    components: single features as signatures, by the same two filters. Linked
    sets share at least T = ceil(0.8 * size) features, so a class with fewer
    shared ones drops out, and the T - 1 most frequent of them aren't needed;
    a positional filter bounds what a pair can share. Classes that only have a
    passage in common, and copies too far apart, don't meet here."""
    left = written(rows.select("cls", "root").distinct(), "left")
    features = written(texts.join(left, "cls", "left_semi").select("cls", "text")
                       .mapInArrow(tk.gives_back(_single_features), "feature long, cls long, size long"), "features")
    shared = written(features.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "frequency")
    own = Window.partitionBy("cls")  # one text's features
    kept = (features.join(shared, "feature")
            .withColumn("place", F.row_number().over(own.orderBy("n", "feature"))).withColumn("held", F.count(F.lit(1)).over(own))
            .filter("place <= held - (size * 4 + 4) div 5 + 1"))
    kept = written(kept.join(left, "cls").select("feature", "cls", "size", "root", (F.col("held") - F.col("place") + 1).alias("rest")), "kept")
    other = kept.select("feature", *[F.col(c).alias(f"{c}2") for c in ("cls", "size", "root", "rest")])
    # positional filter: from the first common feature on, each has at most `rest` left, and linked sets
    # share at least 4/9 of the sum of their sizes; only rows that could be the first one are kept
    return (kept.join(other, "feature").filter("root < root2 AND 9 * least(rest, rest2) >= 4 * (size + size2)")
            .select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")))


BITS = 1 << 23


def _bitmap(chosen: DataFrame) -> np.ndarray:
    """One bit for each value of h modulo BITS that occurs: 1 MB at any size."""
    number = F.pmod("h", F.lit(BITS)) + 1
    rows = (chosen.groupBy(F.bitmap_bucket_number(number).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["part"] - 1) * 4096:(r["part"] - 1) * 4096 + len(bits)] = bits
    return out


def _likely(sent):
    """Of rows (h, text), those that can have a chosen h: the others needn't be shuffled."""
    def run(batches):
        bits = sent.value
        for batch in batches:
            at = batch.column(0).to_numpy() % BITS
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
    return run


def similarity_classes(docs: DataFrame, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, cls) of every document and (cls, root) of every
    class linked to another; cls is the hash of the shingle set.

    Candidate classes that share a signature are first compared with one of
    them, chosen by hash, ``rounds`` times, so large groups of copies cost a few
    comparisons a member. Classes that still share signatures across components
    are then compared through their single features (_by_features), which
    misses no link between components."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))  # tells texts apart where ids repeat or are null
    member = written(docs.mapInArrow(tk.gives_back(_classes), "doc_id long, h long, n_shingles long, cls long"), "classes")
    n_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = (docs.select("text").mapInArrow(tk.gives_back(_send(n_buckets)), PACKED)
              .groupBy("bucket").applyInArrow(_shared, PACKED)
              .groupBy("block").applyInArrow(_candidates, "sig long, cls long, size long"))
    found = written(packed.distinct(), "signatures")
    several = written(found.groupBy("sig").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).filter("x <> y").select("sig"), "shared")
    found = written(found.join(several, "sig", "left_semi"), "candidates")

    # one text of each candidate class
    pick = (member.join(found.select("cls").distinct(), "cls", "left_semi")
            .groupBy("cls").agg(F.min("h").alias("h")))
    chosen = written(pick, "chosen")
    sent = spark.sparkContext.broadcast(_bitmap(chosen))
    likely = docs.select("h", "text").mapInArrow(tk.gives_back(_likely(sent)), "h long, text string")
    texts = written(likely.join(chosen, "h").dropDuplicates(["cls"]).select("cls", "text"), "texts")

    links, checked, root = None, None, None
    rows, last = found.withColumn("root", F.col("cls")), False
    for i in range(rounds + 1):
        last = last or i == rounds
        if not last:  # one member of each signature, by a hash that changes with the round, against the others
            hub = written(rows.groupBy("sig").agg(F.min_by(F.struct("cls", "root", "size"), F.xxhash64("cls", F.lit(i))).alias("hub")), "hubs")
            pairs = (rows.join(hub, "sig").filter("hub.root <> root AND 5 * least(size, hub.size) >= 4 * greatest(size, hub.size)")
                     .select(F.least("hub.cls", "cls").alias("a"), F.greatest("hub.cls", "cls").alias("b")))
        else:
            pairs = _by_features(rows, texts)
        pairs = pairs.distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        new = _links(pairs, texts)
        checked = pairs if checked is None else checked.unionByName(pairs)
        if new.isEmpty():
            if last:
                break
            last = True  # hubs find nothing more: compare the rest
            continue
        links = new if links is None else links.unionByName(new)
        root = components(links)
        if last:
            break
        # go on with the signatures whose members are in different components
        rows = written(rows.drop("root").join(root.withColumnRenamed("node", "cls"), "cls", "left")
                       .withColumn("root", F.coalesce("root", "cls")), "rooted")
        open_ = written(rows.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("sig"), "open")
        if open_.isEmpty():
            break
        rows = written(rows.join(open_, "sig", "left_semi"), "rooted")
    if root is None:
        root = spark.createDataFrame([], "node long, root long")
    return member, root.select(F.col("node").alias("cls"), "root")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links,
    itself included) of every document.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased; a
    text of one to four words is one shingle. Texts without words, and null,
    have no shingle and are linked with nothing. Repeated rows have equal sets
    and so one component. Features are compared by 64-bit hashes; every link is
    verified on the classes' whole sets.
    """
    member, root = similarity_classes(docs)
    least = written(member.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least")), "least")
    rooted = written(least.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
    best = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    of = written(rooted.join(best, "root").select("cls", "component_id"), "of")
    return (member.join(of, "cls", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
