"""Removal of long repeated byte strings by a logarithmic family of sparse
suffix arrays.

A suffix array of a batch is the sorted table of its sampled suffixes. The
sample is local to the content: of the ``k``-byte strings inside every window
of ``length`` bytes, the one with the smallest hash is taken (the leftmost of
equal ones), so equal windows sample the same place, wherever they stand. One
entry covers all consecutive windows that sample the same place: ``g`` is the
hash of its k bytes, ``r`` of all bytes its windows cover.

``SuffixIndexFamily.add`` takes a batch, merge-scans its sorted keys against
those of every level, and adds it as a level; two levels of equal size merge
into one of the next size, so n batches are kept in at most log2(n) + 1 levels.
The scans yield the keys that occur more than once. Only their entries are then
compared exactly: entries with equal covered bytes are repeats as a whole;
where only a part agrees (the ends of a match), window by window.

The same index can hold runs of words as well: passages of many short words
have fewer than LENGTH bytes. Their windows are sampled and compared in the same
way, word by word instead of byte by byte, and count once a row, so that what
repeats is what stands in different rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import written
from .partenum import BITS, _bitmap

LENGTH, K = 400, 200
WORDS_K = 8  # words of a sampled place of a word window
CHUNK = 1 << 21  # bytes of one text taken at a time; longer ones in chunks that overlap by LENGTH - 1
_POSITION = np.uint64((1 << 22) - 1)


class _Bytes:
    """Hashes of byte strings of a block."""

    def __init__(self):
        self.hasher = tk.Hasher(np.ones(256, bool), lower=False)

    def load(self, data):
        self.prefix = self.hasher.prefix(data)
        return self

    def load_words(self, hashes):
        self.hasher._grow(len(hashes))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.hasher.powers[:len(hashes)], dtype=np.uint64)])
        return self

    def spans(self, starts, ends):
        h = (self.prefix[ends] - self.prefix[starts]) * self.hasher.inverse[starts]
        return tk.mix(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _pieces(data, offs, length):
    """(row, first byte, bytes) chunks of rows of at least ``length`` bytes (or words), in blocks of at most CHUNK."""
    for row in np.flatnonzero(np.diff(offs) >= length).tolist():
        a, b = int(offs[row]), int(offs[row + 1])
        for at in range(a, b - length + 1, CHUNK):
            yield row, at - a, data[at:min(b, at + CHUNK + length - 1)]


def _grouped(data, offs, length=LENGTH):
    """Blocks of chunks: (rows, first bytes, block, offsets)."""
    rows, firsts, parts, size = [], [], [], 0
    for row, first, part in _pieces(data, offs, length):
        if parts and size + len(part) > CHUNK:
            yield rows, firsts, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])
            rows, firsts, parts, size = [], [], [], 0
        rows.append(row)
        firsts.append(first)
        parts.append(part)
        size += len(part)
    if parts:
        yield rows, firsts, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def sampled(n: int, offs: np.ndarray, b: _Bytes, length: int = LENGTH, k: int = K):
    """Entries of a block of n bytes (or words), loaded in ``b``: chunk number,
    first and last window start (in the block), sampled position, g, r."""
    w = length - k + 1
    at = np.arange(n - k + 1)
    h = b.spans(at, at + k)
    key = (h & ~_POSITION) | at.astype(np.uint64)
    # smallest key of w consecutive ones: minima from the left and from the right within runs of w
    m = -(-len(key) // w) * w
    padded = np.full(m, ~np.uint64(0))
    padded[:len(key)] = key
    left = np.minimum.accumulate(padded.reshape(-1, w), axis=1).ravel()
    right = np.minimum.accumulate(padded.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(right[:count], left[w - 1:w - 1 + count])
    place = (least & _POSITION).astype(np.int64)
    valid = np.zeros(n + 1, np.int64)  # windows inside one chunk
    np.add.at(valid, offs[:-1], 1)
    np.add.at(valid, offs[1:] - length + 1, -1)
    valid = np.cumsum(valid)[:count] > 0
    change = np.ones(count + 1, bool)
    change[1:count] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    border = offs[1:-1]
    change[border[border < count]] = True
    edges = np.flatnonzero(change)
    first, last = edges[:-1], edges[1:] - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    place = place[first]
    chunk = np.searchsorted(offs, first, "right") - 1
    lo = place - first
    r = tk.mix(b.spans(first, last + length) ^ lo.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    return chunk, first, last, place, h[place], r


def _batch(*columns):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "h", "start", "stop", "place", "n", "g", "r"])


def _byte_entries(batches):
    """Entries (kind 0), combined within a block, and spans known to repeat
    within it (kind 1: bytes start .. stop)."""
    b = _Bytes()
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offs = tk.utf8(batch.column(1))
        for rows, firsts, block, at in _grouped(data, offs):
            chunk, first, last, place, g, r = sampled(len(block), at, b.load(block))
            if not len(first):
                continue
            shift = np.array(firsts)[chunk] - at[chunk]
            h = ids[np.array(rows)[chunk]]
            by = np.lexsort((first, r, g))
            new = np.ones(len(by), bool)
            new[1:] = (g[by][1:] != g[by][:-1]) | (r[by][1:] != r[by][:-1])
            heads = np.flatnonzero(new)
            n = np.diff(np.append(heads, len(by)))
            one = by[heads]
            # spans of entries that occur more than once here, neighbouring ones joined
            again = np.sort(by[np.repeat(n > 1, n)])
            s, e, own = first[again] + shift[again], last[again] + shift[again] + LENGTH, chunk[again]
            join = np.zeros(len(s), bool)
            join[1:] = (own[1:] == own[:-1]) & (s[1:] <= e[:-1])
            starts = np.flatnonzero(~join)
            ends = np.append(starts[1:], len(s)) - 1 if len(s) else starts
            zeros = np.zeros(len(starts), np.int64)
            yield _batch(
                np.concatenate([np.zeros(len(one), np.int8), np.ones(len(starts), np.int8)]),
                np.concatenate([h[one], h[again][starts]]),
                np.concatenate([first[one] + shift[one], s[starts]]),
                np.concatenate([last[one] + shift[one] + LENGTH, e[ends]]),
                np.concatenate([place[one] + shift[one], zeros]),
                np.concatenate([n, zeros]),
                np.concatenate([g[one].view(np.int64), zeros]),
                np.concatenate([r[one].view(np.int64), zeros]))


def _word_entries(batch, words, hasher, b):
    """Entries of word windows (kind 2; start, stop and place in words). n is 1
    for the first of a row's equal entries and 0 for the others."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    data, offs = tk.utf8(batch.column(1))
    for r0, d, o in tk.blocks(data, offs):
        hashes, first_word, _, _ = hasher.words(d, o)
        parts = []
        for rows, firsts, block, at in _grouped(hashes, first_word, words):
            chunk, first, last, place, g, r = sampled(len(block), at, b.load_words(block), words, WORDS_K)
            shift = np.array(firsts)[chunk] - at[chunk]
            parts.append((np.array(rows)[chunk], first + shift, last + shift + words, place + shift, g, r))
        if not parts:
            continue
        row, start, stop, place, g, r = (np.concatenate(x) for x in zip(*parts))
        by = np.lexsort((r, g, row))
        n = np.ones(len(by), np.int64)
        n[by[1:]] = (np.diff(row[by]) != 0) | (g[by[1:]] != g[by[:-1]]) | (r[by[1:]] != r[by[:-1]])
        yield _batch(np.full(len(row), 2, np.int8), ids[r0 + row], start, stop, place, n,
                     tk.mix(g ^ np.uint64(tk._ODD)).view(np.int64), r.view(np.int64))


def _entries(words):
    def run(batches):
        hasher, b = tk.Hasher(tk.white_space_words(), lower=False), _Bytes()
        for batch in batches:
            yield from _byte_entries([batch])
            if words:
                yield from _word_entries(batch, words, hasher, b)
    return run


ENTRY_SCHEMA = "kind byte, h long, start long, stop long, place long, n long, g long, r long"


class SuffixIndexFamily:
    """The keys of the batches so far, in levels of sorted tables. A level of
    size s holds s batches; ``repeats`` are the keys seen more than once."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def add(self, entries: DataFrame) -> None:
        keys = entries.groupBy("g").agg(F.sum("n").alias("n"))
        level = written(keys.repartition("g").sortWithinPartitions("g"), "level")
        self.repeats.append(level.filter("n > 1").select("g"))
        fresh = level.select("g")
        for _, older in self.levels:
            self.repeats.append(written(fresh.join(older.select("g"), "g"), "scan"))
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, older = self.levels.pop()
            level = written(older.unionByName(level).groupBy("g").agg(F.sum("n").alias("n"))
                            .sortWithinPartitions("g"), "level")
            size *= 2
        self.levels.append((size, level))

    def repeated_keys(self) -> DataFrame:
        out = self.repeats[0]
        for more in self.repeats[1:]:
            out = out.unionByName(more)
        return written(out.distinct(), "repeats")


STEP = 8  # windows compared together
WINDOW_SCHEMA = "kind byte, h long, start long, size int, alone boolean, cover long, core long, windows array<long>"


def _window_rows(words):
    """Rows of windows of each entry of a text. Bytes (kind 0): up to STEP
    neighbouring windows (those with equal distance to the sampled place, divided
    by STEP), with the hash of all the bytes they cover, of the bytes they share,
    and of each window. Words (kind 2): all windows of the entry, each by its hash."""
    def run(batches):
        hasher, b = tk.Hasher(tk.white_space_words(), lower=False), _Bytes()
        for batch in batches:
            for row in range(batch.num_rows):
                h = batch.column(0)[row].as_py()
                data, offs = tk.utf8(batch.column(1).slice(row, 1))
                wanted = batch.column(2).slice(row, 1).flatten()
                kind, *wanted = (wanted.field(j).to_numpy(zero_copy_only=False) for j in range(5))
                if len(out := _byte_windows(data, b, *(x[kind == 0] for x in wanted))):
                    yield _window_batch(0, h, *zip(*out))
                start, stop, _, n = (x[kind == 2] for x in wanted)
                if len(start):
                    b.load_words(hasher.words(data, offs)[0])
                    size = stop - start - words + 1
                    at = np.concatenate([[0], np.cumsum(size)])
                    s = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
                    windows = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(b.spans(s, s + words).view(np.int64)))
                    none = np.zeros(len(start), np.int64)
                    yield _window_batch(2, h, start, size, n == 1, none, none, windows)
    return run


def _window_batch(kind, h, start, size, alone, cover, core, windows):
    n = len(size)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, h, np.int64)), pa.array(start, pa.int64()), pa.array(size).cast(pa.int32()),
        pa.array(alone), pa.array(cover, pa.int64()), pa.array(core, pa.int64()),
        windows if isinstance(windows, pa.Array) else pa.array(windows, pa.list_(pa.int64()))],
        ["kind", "h", "start", "size", "alone", "cover", "core", "windows"])


def _byte_windows(data, b, start, stop, place, n):
    out = []
    for k in np.argsort(start).tolist():
        base = max(0, int(place[k]) - LENGTH)
        b.load(data[base:min(len(data), int(place[k]) + 2 * LENGTH)])
        s = np.arange(start[k], stop[k] - LENGTH + 1)
        hashes = b.spans(s - base, s - base + LENGTH)
        group = (place[k] - s) // STEP
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.append(heads[1:], len(s))
        cover = b.spans(s[heads] - base, s[ends - 1] - base + LENGTH) ^ tk.mix((place[k] - s[heads]).astype(np.uint64))
        near = place[k] - group[heads] * STEP - base  # the last start of the group, whether or not it is a window here
        core = b.spans(near, near + LENGTH - STEP + 1) ^ tk.mix(group[heads].astype(np.uint64) + np.uint64(1 << 32))
        for j, (x, y) in enumerate(zip(heads.tolist(), ends.tolist())):
            out.append((int(s[x]), y - x, int(n[k]) == 1, cover[j].astype(np.int64), core[j].astype(np.int64), hashes[x:y].view(np.int64)))
    return out


def _covered(spans):
    """Number of places in spans that may overlap."""
    s, e = (spans.field(j).to_numpy(zero_copy_only=False) for j in range(2))
    by = np.argsort(s, kind="stable")
    s, e = s[by], np.maximum.accumulate(e[by])
    return int((e - np.maximum(s, np.concatenate([s[:1], e[:-1]]))).sum())


def _kept(batches):
    for batch in batches:
        n_bytes, removed, n_spans, digest, shared = [], [], [], [], []
        for row in range(batch.num_rows):
            data, _ = tk.utf8(batch.column(1).slice(row, 1))
            spans = batch.column(2)[row]
            gone, pieces, at, runs = 0, [], 0, 0
            if spans.is_valid and len(spans):
                spans = spans.values
                s, e = (spans.field(j).to_numpy(zero_copy_only=False) for j in range(2))
                by = np.argsort(s, kind="stable")
                s, e = s[by], np.maximum.accumulate(e[by])
                heads = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                for a, z in zip(s[heads].tolist(), e[np.append(heads[1:], len(s)) - 1].tolist()):
                    pieces.append(data[at:a])
                    gone, at, runs = gone + z - a, z, runs + 1
            pieces.append(data[at:])
            sha = hashlib.sha256()
            for p in pieces:
                sha.update(np.ascontiguousarray(p))
            n_bytes.append(len(data))
            removed.append(gone)
            n_spans.append(runs)
            digest.append(sha.hexdigest())
            runs = batch.column(3)[row]
            shared.append(_covered(runs.values) if runs.is_valid and len(runs) else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(n_spans, pa.int64()), pa.array(digest), pa.array(shared, pa.int64())],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared_words"])


def _repeated(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select(*by)


def _split(texts: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``texts`` whose h can be one of ``chosen``, and those whose h can't:
    these needn't be shuffled to meet it. Only h is looked at in Python."""
    bits = texts.sparkSession.sparkContext.broadcast(_bitmap(chosen))

    @F.pandas_udf("boolean")
    def likely(h: pd.Series) -> pd.Series:
        at = h.to_numpy() % BITS
        return pd.Series((bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    marked = texts.withColumn("likely", likely("h"))
    return marked.filter("likely").drop("likely"), marked.filter("not likely").drop("likely")


def repeated_spans(docs: DataFrame, n_batches: int = 4, words: int = 0) -> DataFrame:
    """h (xxhash64 of the text), spans (array of start, stop byte places, which
    may overlap) of every text with bytes covered by a LENGTH-byte string that
    also starts elsewhere in the table; runs (the same of words) covered by
    ``words`` words that also stand in another row."""
    texts = docs.select(F.xxhash64("text").alias("h"), "text")
    entries = written(texts.mapInArrow(tk.gives_back(_entries(words)), ENTRY_SCHEMA), "entries")
    own = entries.filter("kind <> 1")
    family = SuffixIndexFamily()
    for i in range(n_batches):
        family.add(own.filter(F.pmod(F.xxhash64("h"), F.lit(n_batches)) == i))
    shared = written(own.join(family.repeated_keys(), "g", "left_semi"), "shared")

    regions = written(shared.groupBy("kind", "g", "r").agg(F.sum("n").alias("n"), F.min(F.struct("h", "start", "stop", "place")).alias("one")), "regions")
    whole = shared.join(regions.filter("n > 1").select("g", "r"), ["g", "r"], "left_semi").select("kind", "h", "start", "stop")
    mixed = written(_repeated(regions, "g"), "mixed")
    several = regions.join(mixed, "g", "left_semi")
    entry = F.struct("kind", "start", "stop", "place", "n").alias("entry")
    compared = several.select("kind", "n", "one.*").filter("kind = 0 or n > 1")
    if words:  # entries of one row: each of its places
        places = several.filter("kind = 2 and n = 1").select("g", "r")
        compared = compared.unionByName(shared.filter("kind = 2").drop("n").join(places, ["g", "r"], "left_semi")
                                        .select("kind", F.lit(1).cast("long").alias("n"), "h", "start", "stop", "place"))
    compared = written(compared.select("h", entry).groupBy("h").agg(F.collect_list("entry").alias("entries")), "compared")
    # texts that are copies of each other give the same rows: one of them is enough
    meet = _split(texts, compared)[0].join(compared, "h").select("h", "text", "entries")
    all_windows = written(meet.mapInArrow(tk.gives_back(_window_rows(words)), WINDOW_SCHEMA), "windows")
    windows = all_windows.filter("kind = 0")
    covers = written(_repeated(windows.select("h", "start", "cover").distinct(), "cover"), "covers")
    cores = written(_repeated(windows.select("h", "start", "core").distinct(), "core"), "cores")
    alone = windows.filter("alone")
    by_cover = alone.join(covers, "cover", "left_semi").select("h", "start", (F.col("start") + F.col("size") - 1 + LENGTH).alias("stop"))
    open_cores = written(alone.join(covers, "cover", "left_anti").join(cores, "core", "left_semi").select("core").distinct(), "open")
    single = written(windows.join(open_cores, "core", "left_semi").select("h", "start", "alone", F.posexplode("windows").alias("i", "window"))
                     .select("h", (F.col("start") + F.col("i")).alias("start"), "alone", "window").distinct(), "single")
    by_window = (single.filter("alone").join(written(_repeated(single, "window"), "same"), "window", "left_semi")
                 .select("h", "start", (F.col("start") + LENGTH).alias("stop")))
    of_bytes = lambda df: df.select(F.lit(0).cast("byte").alias("kind"), "h", "start", "stop")
    spans = of_bytes(entries.filter("kind = 1")).unionByName(whole).unionByName(of_bytes(by_cover)).unionByName(of_bytes(by_window))
    if words:
        runs = all_windows.filter("kind = 2").select("h", "start", "alone", F.posexplode("windows").alias("i", "window"))
        same = written(runs.groupBy("window").agg(F.min("alone").alias("alone"), F.min("h").alias("low"), F.max("h").alias("high"))
                       .filter("not alone or low < high").select("window"), "same-words")
        spans = spans.unionByName(runs.filter("alone").join(same, "window", "left_semi").select(F.lit(2).cast("byte").alias("kind"), "h",
                                  (F.col("start") + F.col("i")).alias("start"), (F.col("start") + F.col("i") + words).alias("stop")))
    span = F.struct("start", "stop")
    return written(spans.groupBy("h").agg(F.collect_set(F.when(F.col("kind") == 0, span)).alias("spans"),
                                          F.collect_set(F.when(F.col("kind") == 2, span)).alias("runs")), "spans")


def remove_repeats(docs: DataFrame, n_batches: int = 4, words: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    Every byte covered by a LENGTH-byte string that also starts anywhere else
    (in another text or the same one) is removed; strings are judged on the
    input. Null counts as empty, shorter texts lose nothing, and rows with equal
    texts, repeated rows too, are copies of each other. Texts are told apart
    and strings compared by 64-bit hashes. What meets in one task is one text
    and its spans; hot keys are combined before shuffles or split by adaptive
    execution, which joins written tables only.

    With ``words`` (at least WORDS_K), also n_shared_words: how many words of the
    document (between white space, in their case) are covered by runs of that
    many words which also stand in another row. Nothing is removed for them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(docs, n_batches, words)
    with_spans, without = _split(docs.withColumn("h", F.xxhash64("text")), spans)
    none = F.lit(None).cast("array<struct<start: long, stop: long>>")
    out = (with_spans.join(spans, "h", "left").select("doc_id", "text", "spans", "runs")
           .unionByName(without.select("doc_id", "text", none.alias("spans"), none.alias("runs")))
           .mapInArrow(tk.gives_back(_kept), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared_words long"))
    return out if words else out.drop("n_shared_words")
