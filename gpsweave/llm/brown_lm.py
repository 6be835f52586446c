"""Language-model scoring with Brown class-based bigrams.

Words are counted over the whole training corpus. Every word seen at least
``min_count`` times, and one unit per word shape for all rarer words, is
assigned to a class by exchange clustering: each unit moves to the class that
raises the likelihood of the class bigrams most. The classes start from an
exchange on the driver over the most frequent words and the shapes; then, sweep
by sweep, (unit, neighbour class) counts are gathered by joins and aggregations
over the table of all unit pairs, and the executors choose each unit's class.
Counting and scoring run on the executors too; only the class pair counts, the
``head`` most frequent words with their classes and the pair counts of the
start come to the driver, whose sizes are parameters.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import bucket_of, written
from .partenum import BITS, _bitmap

N_SHAPES = 16
DISCOUNT = 0.5
FLUSH = 1 << 21
SLICES = 4  # texts are scored in so many parts, one after the other: the joins of one part at a time take disk


def _shape(data, starts, ends):
    """A word's shape: kind of its last byte (4) and length band (4)."""
    last = data[ends - 1]
    letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    kind = np.where(letter, 0, np.where((last >= 48) & (last <= 57), 1, np.where((last == 44) | (last == 46), 2, 3)))
    return (kind * 4 + np.searchsorted([4, 7, 11], ends - starts, "right")).astype(np.int8)


def _parsed(batches):
    hasher = tk.Hasher(tk.white_space_words())
    for batch in batches:
        data, offs = tk.utf8(batch.column(batch.schema.get_field_index("text")))
        for r0, d, o in tk.blocks(data, offs):
            h, first, starts, ends = hasher.words(d, o)
            yield batch, r0, h.view(np.int64), first, _shape(d, starts, ends)


def _count(batches):
    kept, size = [], 0

    def merged():
        h = np.concatenate([k[0] for k in kept])
        u, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        n = np.bincount(inverse, np.concatenate([k[2] for k in kept]), len(u)).astype(np.int64)
        return u, np.concatenate([k[1] for k in kept])[at], n

    def rows(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1]), pa.array(part[2])], ["h", "shape", "n"])

    for _, _, h, _, shape in _parsed(batches):
        u, at, n = np.unique(h, return_index=True, return_counts=True)
        kept.append((u, shape[at], n.astype(np.int64)))
        size += len(u)
        if size > FLUSH:
            kept, size = [m := merged()], len(m[0])
            if size > FLUSH // 2:
                yield rows(m)
                kept, size = [], 0
    if kept:
        yield rows(merged())


def _units(model, h, shape):
    """Unit of each word: the number of a head word that has one, else of its
    shape; a word that may be one beyond the head keeps its hash (open)."""
    at = np.minimum(np.searchsorted(model["word"], h), len(model["word"]) - 1)
    known = model["word"][at] == h
    unit = np.where(known & model["clustered"][at], at, len(model["word"]) + shape.astype(np.int64))
    if model["far"] is None:
        return unit, np.zeros(len(h), bool), at, known
    bit = h % BITS
    open_ = ~known & (model["far"][bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return np.where(open_, h, unit), open_, at, known


def _sequence(unit, first, edge):
    """Units of all rows with the edge before each row and after the last."""
    rows = len(first) - 1
    seq = np.full(len(unit) + rows + 1, edge, np.int64)
    at = np.arange(len(unit)) + np.repeat(np.arange(rows), np.diff(first)) + 1
    seq[at] = unit
    return seq


def _pair_count(model):
    """(a, b, shape of a, shape of b, n): the shape is -1 but for open units."""
    def run(batches):
        m, kept, size = model.value, [], 0
        edge = len(m["word"]) + N_SHAPES

        def merged():
            a, b, sa, sb, n = (np.concatenate(x) for x in zip(*kept))
            by = np.lexsort((b, a))
            a, b = a[by], b[by]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 0) | (np.diff(b) != 0)]))
            return a[new], b[new], sa[by][new], sb[by][new], np.add.reduceat(n[by], new)

        def rows(part):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["a", "b", "sa", "sb", "n"])

        for _, _, h, first, shape in _parsed(batches):
            unit, open_, _, _ = _units(m, h, shape)
            seq = _sequence(unit, first, edge)
            s = _sequence(np.where(open_, shape, -1), first, -1).astype(np.int8)
            kept.append((seq[:-1], seq[1:], s[:-1], s[1:], np.ones(len(seq) - 1, np.int64)))
            size += len(seq) - 1
            if size > FLUSH // 2:
                kept, size = [part := merged()], len(part[0])
                if size > FLUSH // 4:
                    yield rows(part)
                    kept, size = [], 0
        if kept:
            yield rows(merged())
    return run


def _freed(df: DataFrame) -> DataFrame:
    """A written table, once the shuffles that made it can be dropped: Spark drops
    them when the driver's JVM collects their plans."""
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()
    return df


def _with_class(pairs: DataFrame, column: str, head: np.ndarray, far: DataFrame | None) -> DataFrame:
    """Adds ``cls``, the class of the unit in a column. ``head`` has those of the
    head words, shapes and edge and is broadcast; ``far`` (h, cls) is joined."""
    near = pairs.sparkSession.createDataFrame(pa.table({"unit": np.arange(len(head)), "cls": head}))
    inside = F.col(column).between(0, len(head) - 1)
    out = (pairs.filter(inside) if far is not None else pairs).join(F.broadcast(near), F.col(column) == F.col("unit")).drop("unit")
    if far is None:
        return out
    return out.unionByName(pairs.filter(~inside).join(far.select("h", "cls"), F.col(column) == F.col("h")).drop("h"))


def _neighbours(pairs: DataFrame, n_classes: int, head: np.ndarray, far: DataFrame | None) -> DataFrame:
    """(unit, codes, counts) of each unit: how often it stands before a class
    (code = class), after one (K + class) and after itself (2K); for units beyond
    the head also their own class (2K + 1 + class)."""
    k = n_classes
    parts = [_with_class(pairs, "b", head, far).select(F.col("a").alias("unit"), F.col("cls").cast("int").alias("code"), "n"),
             _with_class(pairs, "a", head, far).select(F.col("b").alias("unit"), (F.col("cls") + k).cast("int").alias("code"), "n"),
             pairs.filter("a = b").select(F.col("a").alias("unit"), F.lit(2 * k).alias("code"), "n")]
    if far is not None:
        parts.append(far.select(F.col("h").alias("unit"), (F.col("cls") + 2 * k + 1).cast("int").alias("code"), F.lit(1).cast("long").alias("n")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _freed(written(rows.groupBy("unit", "code").agg(F.sum("n").alias("n"))
                   .groupBy("unit").agg(F.collect_list(F.struct("code", "n")).alias("x"))
                   .select("unit", F.col("x.code").alias("codes"), F.col("x.n").alias("counts")), "neighbours"))


def _unpacked(batches, head, k, step=1024):
    """unit, class, counts before and after each class without the unit itself, and after itself."""
    for batch in batches:
        for part in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
            unit, codes, counts = (part.column(i) for i in range(3))
            unit = unit.to_numpy()
            row = np.repeat(np.arange(len(unit)), codes.value_lengths().to_numpy())
            dense = np.zeros((len(unit), 3 * k + 1))
            dense[row, codes.flatten().to_numpy()] = counts.flatten().to_numpy()
            near = (unit >= 0) & (unit < len(head))
            cls = np.where(near, head[np.where(near, unit, 0)], np.argmax(dense[:, 2 * k + 1:], 1))
            own, at = dense[:, 2 * k], np.arange(len(unit))
            dense[at, cls] -= own
            dense[at, k + cls] -= own
            yield unit, cls, dense[:, :k], dense[:, k:2 * k], own


def _class_pairs(head, k):
    def run(batches):
        m = np.zeros((k, k))
        for _, cls, right, _, own in _unpacked(batches, head.value, k):
            np.add.at(m, cls, right)
            np.add.at(m, (cls, cls), own)
        at = np.flatnonzero(m)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(m.ravel()[at].astype(np.int64))], ["pair", "n"])
    return run


def _xlogx(x):
    return x * np.log(np.maximum(x, 1))


def exchange_gains(m, cls, right, left, own):
    """Gain in likelihood of each unit (row) in each class, beside class pair
    counts ``m`` that still hold the unit in its class. The last class is closed."""
    f, k, at = _xlogx, len(m), np.arange(len(cls))
    gain = np.zeros((len(cls), k))
    for counts, other, table in ((right, left, m.T), (left, right, m)):
        i, d = np.nonzero(counts)
        x, a = counts[i, d], cls[i]
        base, before = table[d], f(table)[d]   # entry with class d of each class the unit may enter
        each = np.arange(len(i))
        base[each, a] -= x                     # without the unit
        before[each, a] = f(base[each, a])
        same = np.flatnonzero(d == a)
        base[same] -= other[i[same]]
        base[same, a[same]] -= own[i[same]]
        before[same] = f(base[same])
        new = np.flatnonzero(np.diff(i, prepend=-1))
        gain[i[new]] += np.add.reduceat(f(base + x[:, None]) - before, new) if len(new) else 0.0
    diag = np.broadcast_to(np.diag(m), gain.shape).copy()
    diag[at, cls] -= right[at, cls] + left[at, cls] + own
    gain += f(diag + right + left + own[:, None]) + f(diag) - f(diag + right) - f(diag + left)
    for counts, table in ((right, m.sum(1)), (left, m.sum(0))):
        total = counts.sum(1) + own
        base = np.broadcast_to(table, gain.shape).copy()
        base[at, cls] -= total
        gain -= f(base + total[:, None]) - f(base)
    gain[:, -1] = -np.inf
    return gain


def _choose(m, head, names, turn, turns):
    """(unit, cls) of all units but the edge; those whose turn it is take their best class."""
    def run(batches):
        k = len(m)
        for unit, cls, right, left, own in _unpacked(batches, head.value, k):
            near = (unit >= 0) & (unit < len(names.value))
            name = np.where(near, names.value[np.where(near, unit, 0)], unit)
            on = (tk.mix(name.view(np.uint64)) % np.uint64(turns) == turn) & (unit != len(head.value) - 1)
            new = cls.copy()
            if on.any():
                gain = exchange_gains(m, cls[on], right[on], left[on], own[on])
                best, r = np.argmax(gain, 1), np.arange(int(on.sum()))
                new[on] = np.where(gain[r, best] > gain[r, cls[on]] + 1e-9, best, cls[on])
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(new.astype(np.int64))], ["h", "cls"])
    return run


def exchange_sweeps(pairs: DataFrame, n_classes: int, names: np.ndarray, head: np.ndarray, far: DataFrame | None, sweeps: int, turns: int = 2):
    """Classes (of the head, of the units beyond it) and class pair counts of the
    likeliest assignment met. ``pairs`` (a, b, n) holds all pairs of units, ``names``
    a number of each head unit that doesn't depend on the head's size. Units move at once against the counts of the sweep before, one of ``turns`` parts in
    each sweep, so that units which draw each other along seldom move together."""
    spark, best = pairs.sparkSession, None
    named = spark.sparkContext.broadcast(names)
    for sweep in range(sweeps + 1):
        sent = spark.sparkContext.broadcast(head)
        around = _neighbours(pairs, n_classes, head, far)
        m = np.zeros(n_classes * n_classes)
        for r in around.mapInArrow(tk.gives_back(_class_pairs(sent, n_classes)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
            m[r["pair"]] = r["n"]
        m = m.reshape(n_classes, n_classes)
        likelihood = _xlogx(m).sum() - _xlogx(m.sum(0)).sum() - _xlogx(m.sum(1)).sum()
        if best is None or likelihood > best[0]:
            best = likelihood, head, far, m
        if sweep == sweeps:
            break
        chosen = around.mapInArrow(tk.gives_back(_choose(m, sent, named, sweep % turns, turns)), "h long, cls long")
        if far is not None:
            chosen = written(chosen, "classes")
            far = chosen.filter(~F.col("h").between(0, len(head) - 1))
        near = chosen.filter(F.col("h").between(0, len(head) - 1)).toPandas()
        head = head.copy()
        head[near["h"].to_numpy(dtype=np.int64)] = near["cls"].to_numpy(dtype=np.int64)
    return best[1:]


def exchange_clusters(pairs: np.ndarray, n_classes: int, sweeps: int = 20) -> np.ndarray:
    """Class of each unit. ``pairs[a, b]`` counts b right after a; the last unit
    (text edge) keeps a class of its own. Starts from frequency order dealt
    round robin; ties go to the lowest class number."""
    u = len(pairs)
    cls = np.zeros(u, np.int64)
    order = np.argsort(-pairs[:-1].sum(1), kind="stable")
    cls[order] = np.arange(u - 1) % (n_classes - 1)
    cls[-1] = n_classes - 1
    f = lambda x: x * np.log(np.maximum(x, 1))
    member = np.zeros((u, n_classes))
    member[np.arange(u), cls] = 1
    right, left = pairs @ member, pairs.T @ member  # of each unit, by class of the neighbour
    m = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, own = cls[w], pairs[w, w]
            r, b = right[w].copy(), left[w].copy()
            r[a] -= own
            b[a] -= own
            m[a, :] -= r
            m[:, a] -= b
            m[a, a] -= own
            row, col = m.sum(1), m.sum(0)
            gain = (f(m + r) - f(m)).sum(1) + (f(m.T + b) - f(m.T)).sum(1)
            d = np.diag(m)
            gain += f(d + r + b + own) - f(d) - (f(d + r) - f(d)) - (f(d + b) - f(d))
            gain -= f(row + r.sum() + own) - f(row) + f(col + b.sum() + own) - f(col)
            gain[-1] = -np.inf
            c = int(np.argmax(gain))
            if gain[c] <= gain[a] + 1e-9:
                c = a
            m[c, :] += r
            m[:, c] += b
            m[c, c] += own
            if c != a:
                moved += 1
                cls[w] = c
                right[:, a] -= pairs[:, w]
                right[:, c] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, c] += pairs[w]
        if not moved:
            break
    return cls


def _score(model):
    def run(batches):
        m = model.value
        edge = len(m["word"]) + N_SHAPES
        for batch, r0, h, first, shape in _parsed(batches):
            rows = len(first) - 1
            unit, open_, at, known = _units(m, h, shape)
            seq, waits = _sequence(unit, first, edge), _sequence(open_, first, 0).astype(bool)
            c = m["cls"][np.where(waits, edge, seq)]
            late = waits[:-1] | waits[1:]  # transitions of a unit whose class comes by a join
            step = np.where(late, 0.0, m["step"][c[:-1], c[1:]])  # step[i] enters the i-th token; each row has its words and one end
            ends = first[1:] + np.arange(1, rows + 1)
            of_row = lambda x: np.add.reduceat(np.append(x, 0.0), np.concatenate([[0], ends[:-1]])) if rows else x
            summed = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[first])
            score = of_row(step) + summed(np.where(known, m["emit"][np.where(known, unit, edge)] + np.where(unit < len(m["word"]), 0.0, m["tail"][at]), 0.0))
            base = summed(np.where(known, m["base"][at], 0.0)) + m["end_base"]
            row = np.repeat(np.arange(rows), np.diff(first))
            rest = ~known & ~open_
            key = np.stack([row[rest], h[rest]])
            by = np.lexsort((key[1], key[0]))
            key, kind = key[:, by], shape[rest][by]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(key[0]) != 0) | (np.diff(key[1]) != 0)])) if key.shape[1] else np.zeros(0, int)
            tf = np.diff(np.append(new, key.shape[1]))
            key, kind = key[:, new], kind[new]
            part = batch.slice(r0, rows)
            s, row_of = _sequence(shape.astype(np.int64), first, 0), np.repeat(np.arange(rows), np.diff(first) + 1)
            o = np.flatnonzero(waits)                # a word whose class comes by a join, in each of its places
            i = np.flatnonzero(waits[:-1] & waits[1:])
            pick = pa.array(np.concatenate([np.arange(rows), key[0], row_of[o - 1], row_of[i]]))
            text_hash = part.column(1).to_numpy(zero_copy_only=False)
            sizes = [rows, key.shape[1], len(o), len(i)]
            # four kinds of rows: a text, one of its closed words beyond the head, an open word between
            # two classes (-1: open too), two open words in a row
            four = lambda *x: lambda t: pa.array(np.concatenate([np.broadcast_to(v, n) for v, n in zip(x, sizes)]).astype(t))
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pick), part.column(1).take(pick),
                four(text_hash, key[1], seq[o], seq[1:][i])(np.int64), four(0, kind, s[o], s[1:][i])(np.int8),
                four(text_hash, text_hash[key[0]], text_hash[row_of[o - 1]], seq[:-1][i])(np.int64), four(0, 0, 0, s[:-1][i])(np.int8),
                four(-1, -1, np.where(waits[o + 1], -1, c[o + 1]), -1)(np.int8),
                four(-1, -1, np.where(waits[o - 1], -1, c[o - 1]), -1)(np.int8),
                four(0, 0, 0, 1)(bool),
                four(0, tf, 1, 0)(np.int64), four(1, 0, 0, 0)(np.int64),
                four(np.diff(first) + 1, 0, 0, 0)(np.int64),
                four(np.diff(np.concatenate([[0], np.cumsum(known)])[first]) + m["end_known"], 0, 0, 0)(np.int64),
                four(base, 0.0, 0.0, 0.0)(float), four(score, 0.0, 0.0, 0.0)(float),
            ], SCORE_NAMES)
    return run


SCORE_SCHEMA = ("doc_id long, text_hash long, h long, shape byte, prev long, prev_shape byte, to byte, since byte, late boolean, "
                "tf long, copies long, n_tokens long, n_known long, base double, score double")
SCORE_NAMES = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]


def brown_scores(docs: DataFrame, modulus: int = 7, held: int = 2, n_words: int = 512, n_classes: int = 40,
                 head: int = 1 << 17, min_count: int = 5, sweeps: int = 4) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id as text) modulo ``modulus`` is not
    ``held``. Tokens: words between white space, A-Z lower-cased, then one end.
    ``base_score`` is the add-one unigram log10 probability; ``score`` the class
    model's: transition (M(a,b) + C p(b)) / (M(a) + C) with C the number of
    classes, emission by relative frequency in the class, words seen less than
    ``min_count`` times through their shape with absolute discounting (0.5),
    whose mass is shared by unseen words of that shape. The classes start from
    an exchange over the ``n_words`` frequent words and the shapes (a word in
    its shape's class) and are refined over all units in ``sweeps`` sweeps.

    Null text counts as empty (one token, the end). Rows that repeat an id are
    each scored by their own text. Without training rows every known count is
    0. Words are told apart by a 64-bit hash. Texts beyond the ``head`` words
    meet their counts and classes in shuffled joins, so no vocabulary is sent
    whole.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    training = docs.filter(bucket_of("doc_id", modulus) != held).select("text")
    counts = _freed(written(training.mapInArrow(tk.gives_back(_count), "h long, shape byte, n long")
                            .groupBy("h").agg(F.sum("n").alias("c"), F.max("shape").alias("shape")), "words"))
    n_docs = training.count()
    # the smallest count that at most `head` words reach, from a histogram of at most a few hundred bands
    band = F.floor(F.log2("c") * 8).cast("int")
    bands = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"), F.min("c").alias("least")).orderBy(F.desc("band")).collect()
    seen, least = 0, None
    for b in bands:
        seen += b["n"]
        if seen > head:
            break
        least = b["least"]
    n_types, n_tokens = sum(b["n"] for b in bands), sum(b["c"] for b in bands) + n_docs
    v = n_types + (n_docs > 0)
    least = least if least is not None else 2**62
    top = counts.filter(F.col("c") >= least).toPandas()
    word, c, top_shape = (top[x].to_numpy() for x in ("h", "c", "shape"))
    by = np.argsort(word)
    word, c, top_shape = word[by].astype(np.int64), c[by].astype(np.int64), top_shape[by].astype(np.int64)
    if not len(word):  # no head: one entry that no word matches
        word, c, top_shape = np.array([-2**63]), np.zeros(1, np.int64), np.zeros(1, np.int64)
    frequent = np.lexsort((word, -c))[:n_words]
    frequent = frequent[c[frequent] >= min_count]
    edge = len(word) + N_SHAPES
    tail = counts.filter(F.col("c") < least)
    far = tail.filter(F.col("c") >= min_count)
    far = None if far.isEmpty() else far
    model = {"word": word, "clustered": c >= min_count, "far": None if far is None else _bitmap(far)}

    sent = spark.sparkContext.broadcast(model)
    pairs = (training.mapInArrow(tk.gives_back(_pair_count(sent)), "a long, b long, sa byte, sb byte, n long")
             .groupBy("a", "b").agg(F.max("sa").alias("sa"), F.max("sb").alias("sb"), F.sum("n").alias("n")))
    pairs = _freed(written(pairs if far is not None else pairs.select("a", "b", "n"), "pairs"))
    if far is not None:  # an open unit is one beyond the head, or else its shape; other keys are spread and meet nothing
        waits = pairs.filter("sa >= 0 or sb >= 0")
        for unit, shape in (("a", "sa"), ("b", "sb")):
            met, closed = far.select(F.col("h").alias("key"), F.lit(True).alias("met")), F.col(shape) < 0
            waits = (waits.withColumn("key", F.when(closed, F.xxhash64("a", "b")).otherwise(F.col(unit))).join(met, "key", "left")
                     .withColumn(unit, F.when(closed | F.col("met"), F.col(unit)).otherwise(F.col(shape) + F.lit(len(word)).cast("long")))
                     .drop("key", "met"))
        waits = _freed(written(waits.groupBy("a", "b").agg(F.sum("n").alias("n")), "units"))
        pairs = pairs.filter("sa < 0 and sb < 0").select("a", "b", "n").unionByName(waits)  # a pair may have several rows

    # the start: frequent words and shapes, each other word pooled with its shape
    u = len(frequent) + N_SHAPES + 1
    unit = np.concatenate([len(frequent) + top_shape, np.arange(len(frequent), u)])
    unit[frequent] = np.arange(len(frequent))
    pooled = None if far is None else far.select("h", (F.col("shape").cast("long") + len(frequent)).alias("cls"))
    got = (_with_class(_with_class(pairs, "a", unit, pooled).select(F.col("cls").alias("from"), "b", "n"), "b", unit, pooled)
           .groupBy("from", "cls").agg(F.sum("n").alias("n")).toPandas())
    start = np.zeros((u, u))
    start[got["from"].to_numpy(dtype=np.int64), got["cls"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=float)
    n_classes = max(2, min(n_classes, u))
    cls = exchange_clusters(start, n_classes)
    of_shape = F.element_at(F.lit(cls[len(frequent):-1].tolist()), F.col("shape").cast("int") + 1).cast("long")
    cls, far, m = exchange_sweeps(pairs, n_classes, np.append(word, np.arange(N_SHAPES + 1)), cls[unit], None if far is None else far.select("h", of_shape.alias("cls")), sweeps)

    into = (m.sum(0) + 1) / (m.sum() + n_classes)
    step = np.log10((m + n_classes * into) / (m.sum(1, keepdims=True) + n_classes))
    n_class = np.log10(np.maximum(m.sum(0), 1))
    types = np.zeros(N_SHAPES)
    for r in counts.filter(F.col("c") < min_count).groupBy("shape").agg(F.count(F.lit(1)).alias("n")).collect():
        types[r["shape"]] = r["n"]
    # a word of a shape unit, by the class's tokens; its own count comes from `tail` or the join
    shape_emit = -n_class[cls[len(word):edge]]
    emit = np.concatenate([np.log10(np.maximum(c, 1)) - n_class[cls[:len(word)]], shape_emit, [0.0]])
    unseen = np.log10(np.where(types > 0, DISCOUNT * types / (types + 1), 1 / (v + 1)))
    model |= {"cls": cls, "step": step, "emit": emit, "tail": np.log10(np.maximum(c - DISCOUNT, DISCOUNT)),
              "base": np.log10(c + 1.0), "end_base": float(np.log10(n_docs + 1)), "end_known": int(n_docs > 0)}
    sent = spark.sparkContext.broadcast(model)
    at = lambda values, i: F.element_at(F.lit(np.asarray(values).ravel().tolist()), i.cast("int") + 1)
    shape_cls = lambda x: at(cls[len(word):edge], F.col(x))
    tail = tail.select("h", "c")
    if far is not None:
        tail = _freed(written(tail.join(far.select(F.col("h").alias("met"), F.col("cls").alias("own")), F.col("h") == F.col("met"), "left").drop("met"), "tail"))
    each = lambda x: F.col(x) / F.col("copies")  # noqa: E731  repeated rows of one text

    def scored(texts):
        rows = texts.mapInArrow(tk.gives_back(_score(sent)), SCORE_SCHEMA).join(tail, "h", "left")
        if far is None:
            rows, moved = rows.withColumn("own", F.lit(None).cast("long")), F.lit(0.0)
        else:
            # rows that aren't two open words meet nothing more; a key of their own spreads them
            rows = (rows.withColumn("prev", F.when(~F.col("late"), F.xxhash64("doc_id", "text_hash", "h")).otherwise(F.col("prev")))
                    .join(far.select(F.col("h").alias("prev"), F.col("cls").alias("before")), "prev", "left"))
            entered = F.coalesce("own", shape_cls("shape"))
            moved = (F.when(F.col("late"), at(step, F.coalesce("before", shape_cls("prev_shape")) * n_classes + entered)).otherwise(0.0)
                     + F.when(F.col("since") >= 0, at(step, F.col("since") * n_classes + entered)).otherwise(0.0)
                     + F.when(F.col("to") >= 0, at(step, entered * n_classes + F.col("to"))).otherwise(0.0))
        word_score = (F.when(F.col("own").isNotNull(), F.log10("c") - at(n_class, F.col("own")))
                      .otherwise(at(shape_emit, F.col("shape")) + F.coalesce(F.log10(F.col("c") - DISCOUNT), at(unseen, F.col("shape")))))
        return (rows.groupBy("doc_id", "text_hash")
                .agg(F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"),
                     F.sum(F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("n_known"),
                     F.sum(F.col("base") + F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("base"),
                     F.sum(F.col("score") + moved + F.when(F.col("tf") > 0, F.col("tf") * word_score).otherwise(0.0)).alias("score"))
                .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
                .select("doc_id", (bucket_of("doc_id", modulus) == held).alias("held_out"),
                        each("n_tokens").cast("long").alias("n_tokens"), each("n_known").cast("long").alias("n_known"),
                        F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
                        (each("base") - each("n_tokens") * float(np.log10(n_tokens + v + 1))).alias("base_score"),
                        each("score").alias("score")))

    texts = docs.withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "text")
    parts = (texts.filter(F.pmod("text_hash", F.lit(SLICES)) == i) for i in range(SLICES))
    return reduce(DataFrame.unionByName, [_freed(written(scored(part), "scores")) for part in parts])
