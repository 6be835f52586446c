"""Phrase collocations by an FM-index per shard.

A shard is a bounded number of words of one task's documents, as word numbers
with a separator between pieces. Its index is the Burrows-Wheeler transform of
the text and of its reverse, both sorted as deep as a phrase can be long. A
phrase is a pair of intervals, one in each transform; one word more on the right
(left) is one step in the reverse (forward) transform, taken for all phrases of
a shard at once: the symbols in an interval are its extensions and their counts.

Shards are walked level by level. After a level the counts are summed across
shards, by 64-bit keys; a phrase can only be frequent if all its parts are, so the
next level extends what is left. The keys of frequent parts travel as a bitmap of
bounded size: it may let a phrase through that isn't frequent, never hold one back.
Of the shards that hold a frequent phrase one owns it: in the last walk only that
one writes out its words, so a phrase is one row however many shards hold it.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textkit as tk
from .common import rows_per_batch, written

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
INSIDE_PERCENT = 80          # a phrase mostly seen inside a longer one is dropped
SHARD_WORDS = 1 << 20
MAX_BITS = 1 << 29           # of a bitmap: 64 MB
BITS_PER_KEY = 16
PROBES = (0, 10, 19)         # windows of a key's low 48 bits that give its bits
_ODD = np.uint64(0x9E3779B97F4A7C15)

INDEX = ("shard long, langs array<string>, lang binary, ids binary, counts binary, words binary, lengths binary, "
         "forward binary, backward binary")


# ----------------------------------------------------------------- indexes
def _order(key: np.ndarray) -> np.ndarray:
    """Stable order of non-negative keys; key and place are sorted as one number where both fit."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 64:
        return np.argsort(key, kind="stable")
    packed = key.astype(np.uint64) << np.uint64(bits) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def transform(t: np.ndarray, depth: int = MAX_WORDS) -> np.ndarray:
    """Burrows-Wheeler transform of a circular text, its rotations sorted by their first ``depth`` symbols."""
    rank, have = t.astype(np.int64), 1
    while have < depth:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -have)
        order, have = _order(pair), 2 * have
        if have < depth:
            pair = pair[order]
            rank[order] = np.cumsum(np.concatenate([[False], pair[1:] != pair[:-1]]))
    return t[order - 1]


def _planes(x: np.ndarray) -> np.ndarray:
    """First bytes of all numbers, then second ones ...: they pack better."""
    return np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T)


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The given spans of data, one after another."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]


class _Shard:
    """Words of a task's documents until there are enough for an index."""

    def __init__(self):
        self.parts, self.size, self.langs = [], 0, {}

    def add(self, data, starts, ends, ids, lang, fresh):
        self.parts.append((data, starts, ends, ids, lang, fresh))
        self.size += len(ids)

    def index(self, number):
        base = np.cumsum([0, *(len(p[0]) for p in self.parts[:-1])])
        data = np.concatenate([p[0] for p in self.parts])
        starts, ends = (np.concatenate([p[i] + b for p, b in zip(self.parts, base)]) for i in (1, 2))
        ids, lang, fresh = (np.concatenate([p[i] for p in self.parts]) for i in (3, 4, 5))
        names = list(self.langs)
        self.parts, self.size, self.langs = [], 0, {}
        own, one, local, counts = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
        by = np.argsort(-counts, kind="stable")                  # frequent words get small numbers, which pack well
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        own, one, local, counts = own[by], one[by], place[local], counts[by]
        sizes = (ends - starts)[one]
        t = np.zeros(len(ids) + int(fresh.sum()), np.int32)      # 0 in front of each piece
        t[np.arange(len(ids)) + np.cumsum(fresh)] = local + 1
        blobs = (lang[one].astype(np.int32), own, counts, _gather(data, starts[one], sizes), sizes.astype(np.int32),
                 _planes(transform(t)), _planes(transform(t[::-1])))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([names], pa.list_(pa.string())), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
            ["shard", "langs", "lang", "ids", "counts", "words", "lengths", "forward", "backward"])


def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that end a piece, and those of words."""
    ends = np.zeros(256, bool)
    ends[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
    words = ~ends
    words[[32, 9]] = False
    return ends, words


def _word_ids(h, salt):
    """Ids of words from their hashes and those of their languages."""
    return tk.mix(h + salt * _ODD)


def _with_ids(batches):
    """Adds the id of the word to rows (lang, word)."""
    hasher = tk.Hasher(_word_bytes()[1])
    for batch in batches:
        data, offs = tk.utf8(batch.column(1))
        h, first, _, _ = hasher.words(data, offs)
        salt = np.array([xxhash.xxh64_intdigest(x) for x in batch.column(0).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_word_ids(h, salt).view(np.int64))], ["lang", "phrase", "id"])


def _indexes(shard_words):
    def run(batches):
        ends_piece, word_bytes = _word_bytes()
        hasher = tk.Hasher(word_bytes)
        small = np.arange(256, dtype=np.uint8)
        small[65:91] += 32
        shard, number = _Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offs = tk.utf8(batch.column(1))
            for r0, d, o in tk.blocks(data, offs):
                h, first, starts, ends = hasher.words(d, o)
                if not len(h):
                    continue
                row = np.repeat(np.arange(len(o) - 1), np.diff(first))
                breaks = np.concatenate([[0], np.cumsum(ends_piece[d])])
                fresh = np.ones(len(h), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
                block = names[r0:r0 + len(o) - 1]
                salt = np.array([xxhash.xxh64_intdigest(x) for x in block], np.uint64)[row]
                ids, d = _word_ids(h, salt), small[d]
                heads, x = np.flatnonzero(fresh), 0
                while x < len(h):        # a shard ends where a piece does
                    room = heads[np.searchsorted(heads, x + max(1, shard_words - shard.size)):]
                    y = int(room[0]) if len(room) else len(h)
                    code = np.array([shard.langs.setdefault(n, len(shard.langs)) for n in block])
                    shard.add(d[starts[x]:ends[y - 1]], starts[x:y] - starts[x], ends[x:y] - starts[x], ids[x:y], code[row[x:y]], fresh[x:y])
                    x = y
                    if shard.size >= shard_words:
                        yield shard.index(number)
                        number += 1
        if shard.size:
            yield shard.index(number)
    return run


def _written_index(df: DataFrame) -> DataFrame:
    """The index table, its few large rows a row group each: neither the writer
    nor a reader holds more than about one of them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-indexes-{uuid.uuid4().hex}")
    df.write.options(**{"parquet.block.size": 1 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
                        "parquet.enable.dictionary": "false", "compression": "zstd"}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _words_of(r: dict) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Words and languages of an index, and the words' ids."""
    sizes = np.frombuffer(r["lengths"], np.int32)
    offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offs.tobytes()), pa.py_buffer(r["words"]))
    langs = pa.array(r["langs"], pa.string()).take(pa.array(np.frombuffer(r["lang"], np.int32)))
    return words, langs, np.frombuffer(r["ids"], np.uint64)


def _totals(batches):
    """Words of each language of an index."""
    for batch in batches:
        for r in batch.to_pylist():
            n = np.bincount(np.frombuffer(r["lang"], np.int32), np.frombuffer(r["counts"], np.int64), len(r["langs"]))
            yield pa.RecordBatch.from_arrays([pa.array(r["langs"], pa.string()), pa.array(n.astype(np.int64))], ["lang", "n"])


# ----------------------------------------------------------------- walking
class _Side:
    """One transform: its symbols, and where a row's symbol leads."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.to = np.empty(len(symbols), np.int32)
        self.to[_order(symbols)] = np.arange(len(symbols), dtype=np.int32)

    def extend(self, lo, size, other):
        """One word more for every interval: (phrase it extends, word, count, its
        interval here, its interval in the other transform), separators included."""
        of = np.repeat(np.arange(len(lo)), size)
        at = np.concatenate([[0], np.cumsum(size)])
        rows = np.repeat(lo - at[:-1], size) + np.arange(at[-1])
        code = of * (int(self.symbols.max(initial=0)) + 1) + self.symbols[rows]
        by = _order(code)
        code, of = code[by], of[by]
        heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        count, rows, of = np.diff(np.append(heads, len(code))), rows[by[heads]], of[heads]
        # in the other transform the extensions follow each other in the order of their words
        return of, self.symbols[rows], count, self.to[rows].astype(np.int64), other[of] + heads - at[of]


def _has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether all of a key's bits are set."""
    out = np.ones(len(key), bool)
    for shift in PROBES:
        at = key >> np.uint64(shift) & np.uint64(8 * len(bits) - 1)
        out &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _joined(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    return tk.mix(key * _ODD + more)


def walk(r: dict, filters: list[np.ndarray]):
    """Yields for each length from 1 to len(filters) + 1: the phrases of a shard
    as word numbers (a row a phrase), their keys and counts. Phrases whose parts
    aren't all in the filters are left out; filters[i] holds those of i + 1 words."""
    ids = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(r["ids"], np.uint64)])
    counts = np.frombuffer(r["counts"], np.int64)
    word, n = np.arange(1, len(ids)), len(ids)
    if filters:
        word = word[_has(filters[0], ids[1:])]
    yield word[:, None], ids[word], counts[word - 1]
    if not filters:
        return
    usable = np.zeros(n, bool)
    usable[word] = True
    forward, backward = (_Side(_numbers(r[c])) for c in ("forward", "backward"))
    lo = (len(forward.symbols) - int(counts.sum()) + np.cumsum(counts) - counts)[word - 1]     # behind the separators
    phrases, size, at = word[:, None], counts[word - 1], [lo, lo]     # intervals in forward, backward
    codes = []                                          # of the phrases one word shorter
    for length in range(2, len(filters) + 2):
        right = length % 2 == 0                         # words are added on both ends in turn
        side, here = (backward, 1) if right else (forward, 0)
        of, symbol, size, mine, others = side.extend(at[here], size, at[1 - here])
        keep = usable[symbol]
        of, symbol, size, mine, others = (v[keep] for v in (of, symbol, size, mine, others))
        old = phrases[of]
        new = np.concatenate([old, symbol[:, None]], 1) if right else np.concatenate([symbol[:, None], old], 1)
        if length > 2:                                  # the part without the word on the other end must be there as well
            keep = _known(codes, new[:, 1:] if right else new[:, :-1], n)
            size, mine, others, new = (v[keep] for v in (size, mine, others, new))
        keys = ids[new[:, 0]]
        for j in range(1, length):
            keys = _joined(keys, ids[new[:, j]])
        at = [others, mine] if right else [mine, others]
        if length <= len(filters):
            keep = _has(filters[length - 1], keys)
            new, keys, size, at = new[keep], keys[keep], size[keep], [x[keep] for x in at]
        yield new, keys, size
        phrases, codes = new, _codes(new, n)


def _known(codes, phrases, n):
    """Which phrases are among those that ``codes`` was made of."""
    code, found = phrases[:, 0].astype(np.int64), np.ones(len(phrases), bool)
    for level, j in zip(codes, range(1, phrases.shape[1])):
        code = code * n + phrases[:, j]
        where = np.minimum(np.searchsorted(level, code), max(0, len(level) - 1))
        found &= level[where] == code if len(level) else False
        code = where
    return found


def _codes(phrases, n):
    """Sorted codes of all prefix lengths of the phrases: a prefix's place and the next word."""
    out, code = [], phrases[:, 0].astype(np.int64)
    for j in range(1, phrases.shape[1]):
        level, code = np.unique(code * n + phrases[:, j], return_inverse=True)
        out.append(level)
    return out


def _tag(shard: int) -> np.uint64:
    """A shard's mark, as random as the keys."""
    return tk.mix(np.array([shard + 1], np.uint64))[0]


def _keys(sent):
    def run(batches):
        filters = [s.value for s in sent]
        for batch in batches:
            for r in batch.to_pylist():
                for _, keys, size in walk(r, filters):
                    pass
                by = np.argsort(keys)      # neighbours share their high bytes, which the shuffle's compression takes out
                tag = np.full(len(by), _tag(r["shard"]))
                yield pa.RecordBatch.from_arrays([pa.array(keys[by].view(np.int64)), pa.array(size[by], pa.int64()), pa.array(tag.view(np.int64))],
                                                 ["id", "f", "tag"])
    return run


def _phrases(sent, owned):
    """The words of the phrases that a shard owns."""
    def run(batches):
        filters, own = [s.value for s in sent], owned.value
        for batch in batches:
            for r in batch.to_pylist():
                words, langs, _ = _words_of(r)
                for phrases, keys, _ in islice(walk(r, filters), 1, len(filters)):
                    keep = _has(own, keys ^ _tag(r["shard"]))
                    phrases, keys = phrases[keep] - 1, keys[keep].view(np.int64)
                    for i in range(0, len(phrases), 1 << 16):
                        p = phrases[i:i + (1 << 16)]
                        text = pc.binary_join_element_wise(*(words.take(pa.array(p[:, j])) for j in range(p.shape[1])), " ")
                        yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 16)]), langs.take(pa.array(p[:, 0])), text], ["id", "lang", "phrase"])
    return run


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids, of a power of two of at most MAX_BITS bits."""
    bits = 1 << 15
    while bits < min(MAX_BITS, BITS_PER_KEY * keys.count()):
        bits *= 2
    keys = keys.select(F.explode(F.array(*(F.pmod(F.shiftrightunsigned("id", p), F.lit(bits)) + 1 for p in PROBES))).alias("bit"))
    out = np.zeros(bits // 8, np.uint8)
    for part, own in (keys.groupBy(F.bitmap_bucket_number("bit").alias("part"))
                      .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toLocalIterator()):
        own = np.frombuffer(bytes(own), np.uint8)
        out[(part - 1) * 4096:(part - 1) * 4096 + len(own)] = own
    return out


# ------------------------------------------------------------------ scores
def _scored(known: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the lowest-scoring cut. ``known`` has the counts of all parts."""
    part = "array_join(slice(w, {0}, {1}), ' ')".format
    cuts = (phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
            .select("*", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
            .select("lang", "phrase", "a", "k", F.expr(part("1", "k")).alias("left"), F.expr(part("k + 1", "size(w)")).alias("right")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("(CAST(a AS DECIMAL(19,0)) * 2000000BD) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    return (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of
    2 to 4 words.

    A-Z are lower-cased; pieces end at .,;:!? and 0x0A-0x0D, words at space and
    tab. Null text is empty, a null language is ``und``. Documents without words
    add nothing; repeated rows count again; an empty table gives no rows. Other
    columns, ids included, are ignored.

    A task holds one shard at a time; a shard ends with a piece, so only a piece
    longer than a shard makes a larger one. Ties in score and count go by phrase.
    Words and phrases are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    index = _written_index(texts.mapInArrow(tk.gives_back(_indexes(shard_words)), INDEX))
    sent, levels = [], []

    with rows_per_batch(spark, 1):     # an index is one row of several MB
        for _ in range(MAX_WORDS):
            keys = index.drop("words", "lengths").mapInArrow(tk.gives_back(_keys(list(sent))), "id long, f long, tag long")
            keys = written(keys.groupBy("id").agg(F.sum("f").alias("f"), F.min("tag").alias("owner")).filter(F.col("f") >= min_count), "keys")
            levels.append(keys)
            sent.append(spark.sparkContext.broadcast(_bitmap(keys.select("id"))))
        words, frequent = levels[0], reduce(DataFrame.unionByName, levels[1:])
        owned = spark.sparkContext.broadcast(_bitmap(frequent.select(F.col("id").bitwiseXOR(F.col("owner")).alias("id"))))
        total = written(index.select("langs", "lang", "counts").mapInArrow(_totals, "lang string, n long")
                        .groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        texts = index.mapInArrow(tk.gives_back(_phrases(list(sent), owned)), "id long, lang string, phrase string")
        # the bitmaps may let a phrase through in another shard, or one that isn't frequent
        texts = texts.groupBy("id").agg(F.min(F.struct("lang", "phrase")).alias("of"))
        found = written(texts.join(frequent, "id").select("of.lang", "of.phrase", "f"), "phrases")
    # counts of the words of phrases, by the words' ids
    used = written(found.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct(), "used")
    used = used.mapInArrow(_with_ids, "lang string, phrase string, id long").join(words, "id").select("lang", "phrase", "f")
    known = written(found.unionByName(used), "known")

    # a phrase's count inside longer ones is largest in one that is one word longer
    cut = F.split("phrase", " ")
    inside = (found.filter(F.size(cut) > 2)
              .select("lang", "f", F.explode(F.array(F.array_join(F.slice(cut, F.lit(1), F.size(cut) - 1), " "),
                                                     F.array_join(F.slice(cut, F.lit(2), F.size(cut) - 1), " "))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (found.join(inside, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longer") < INSIDE_PERCENT * F.col("f"), F.lit(True))).select("lang", "phrase", "f"))
    scored = written(_scored(known, written(kept, "candidates")), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each slice of a language first, so no task ranks a whole language
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(sliced)).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
