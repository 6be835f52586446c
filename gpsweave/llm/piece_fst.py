"""SentencePiece encoding and decoding as weighted finite-state transduction.

``compile_model`` builds one transducer from the model: the normaliser (space
to the piece alphabet's mark, a mark in front), one arc per piece with its cost
(minus its score), and byte arcs for characters without a piece. Encoding
composes it with each input and takes the shortest path in the tropical
semiring (min, +).

For merge-trained (BPE) models the transducer is also composed with a bigram
acceptor over pieces: the pair (a, b) costs 0 if merging the text a+b gives
exactly a, b, and infinity otherwise. Of the paths of finite cost that leaves
the one merging would give, so results agree with the sentencepiece library's
(but for a mark character in the input itself, which becomes byte pieces here,
so that it decodes to itself).

Inputs are composed word by word: no piece has the mark after another
character (checked when compiling), so shortest paths of words join to the
shortest path of the text, and each distinct word of a task is solved once,
all words together, position by position.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk

MARK = "\u2581"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Kinds of pieces in the model format.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
BYTE_COST = 1e12
LITERAL_MARK = "\ud800"  # stands for a mark in the input itself; no text holds a lone surrogate
MAX_WORDS = 400_000  # words a task remembers; beyond it starts anew
SLICE_BYTES = 400_000  # text encoded at a time; bounds the arcs in memory
_P = np.uint64(0x9E3779B97F4A7C55)


def _merge(symbols: list[str], score: dict[str, float]) -> list[str]:
    """Repeatedly joins the adjacent pair whose joined piece scores best, the
    leftmost of equal ones."""
    symbols = list(symbols)
    while len(symbols) > 1:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            s = score.get(symbols[i] + symbols[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            break
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


def compile_model(spark: SparkSession, path: str) -> dict:
    """Reads a SentencePiece model file (through Spark, so any store will do)
    and returns its transducer as tables."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    raw = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").first()[0]
    model = proto.ModelProto()
    model.ParseFromString(bytes(raw))
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only identity normalisers with escaped white space are compiled")
    merges = model.trainer_spec.model_type == 2
    pieces, byte_ids, score = [], np.full(256, -1, np.int64), {}
    for i, p in enumerate(model.pieces):
        if p.type == BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
        elif p.type in (NORMAL, USER_DEFINED):
            score[p.piece] = p.score
            pieces.append((p.piece, i, -p.score))
    if any(MARK in p.lstrip(MARK) for p, _, _ in pieces):
        raise ValueError("a piece crosses a word border")
    if merges:  # pieces that merging never yields have no arc
        pieces = [p for p in pieces if len(_merge(p[0], score)) == 1]
    text = {i: p for p, i, _ in pieces}
    decode = [b""] * len(model.pieces)
    for p, i, _ in pieces:
        decode[i] = p.replace(MARK, " ").encode()
    for b, i in enumerate(byte_ids):
        if i >= 0:
            decode[i] = bytes([b])
    return {"text": text, "id": {p: i for p, i, _ in pieces}, "cost": {i: c for _, i, c in pieces}, "score": score, "bytes": byte_ids,
            "byte_fallback": bool((byte_ids >= 0).all()), "unknown": model.trainer_spec.unk_id, "decode": decode,
            "prefix": norm.add_dummy_prefix, "merges": merges, "longest": max(len(p) for p, _, _ in pieces)}


class Transducer:
    """Composes words with a compiled model. Made inside a task."""

    def __init__(self, model: dict):
        self.m = model
        self.values = np.arange(0x110000, dtype=np.uint64)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            self.values = (self.values + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(factor)
            self.values ^= self.values >> np.uint64(shift)
        strings = list(model["id"])
        cps = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        size = np.array([len(s) for s in strings])
        ends = np.cumsum(size)
        h = self._hash(self._prefix(cps), ends - size, ends)
        by = np.argsort(h)
        self.keys, self.ids = h[by], np.array([model["id"][s] for s in strings])[by]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        self.front = np.zeros(1 << 20, bool)
        self.front[self.keys >> np.uint64(44)] = True
        self.cost = np.full(len(model["decode"]), np.inf)
        for i, c in model["cost"].items():
            self.cost[i] = c
        # pairs the acceptor has judged, sorted
        self.pairs, self.pair_ok = np.array([-1], np.int64), np.array([False])

    def _prefix(self, cps):
        n = len(cps)
        steps = np.full(n + 1, _P, np.uint64)
        steps[0] = 1
        self.powers = np.cumprod(steps)
        steps[1:] = np.uint64(pow(int(_P), -1, 2**64))
        self.inverse = np.cumprod(steps)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[cps] * self.powers[:n], out=out[1:])
        return out

    def _hash(self, prefix, starts, ends):
        h = (prefix[ends] - prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x5851F42D4C957F2D)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    def _pairs(self, a, b):
        """Whether the acceptor allows piece b after piece a."""
        key = a.astype(np.int64) * (1 << 32) + b
        u, inverse = np.unique(key, return_inverse=True)
        at = np.searchsorted(self.pairs, u)
        new = self.pairs[np.minimum(at, len(self.pairs) - 1)] != u
        if new.any():
            text, score = self.m["text"], self.m["score"]
            fresh = u[new]
            # two pieces that join to a piece would be merged on
            ok = np.fromiter((x + y not in score and _merge(x + y, score) == [x, y] for x, y in
                              ((text[k >> 32], text[k & 0xFFFFFFFF]) for k in fresh.tolist())), bool, len(fresh))
            self.pairs, self.pair_ok = np.insert(self.pairs, at[new], fresh), np.insert(self.pair_ok, at[new], ok)
            at = np.searchsorted(self.pairs, u)
        return self.pair_ok[at][inverse]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the shortest paths of all words, one after the other, and
        the number of ids of each word."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        cps = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(w) for w in words])
        ends = np.cumsum(size)
        begins = ends - size
        end_of = np.repeat(ends, size)
        prefix = self._prefix(cps)
        n = len(cps)
        at = np.arange(n)
        arcs = []  # (from, to, piece)
        for length in range(1, self.m["longest"] + 1):
            at = at[at + length <= end_of[at]]
            if not len(at):
                break
            h = self._hash(prefix, at, at + length)
            hit = np.flatnonzero(self.front[h >> np.uint64(44)])
            k = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
            good = self.keys[k] == h[hit]
            arcs.append((at[hit[good]], at[hit[good]] + length, self.ids[k[good]]))
            if length == 1:  # characters without a piece: byte arcs, one step for the whole character
                lone = np.ones(n, bool)
                lone[at[hit[good]]] = False
                lone = np.flatnonzero(lone)
                arcs.append((lone, lone + 1, np.full(len(lone), -1)))
        start, end, piece = (np.concatenate(x) for x in zip(*arcs))
        offset = end - np.repeat(begins, size)[start]  # positions within the words, 1 upwards
        by = np.argsort(offset, kind="stable")
        start, end, piece, offset = start[by], end[by], piece[by], offset[by]
        bounds = np.searchsorted(offset, np.arange(1, int(size.max()) + 2))
        # best[i]: cost of the shortest path to the border before character i; shared borders
        # between words are kept apart by storing a state at its last character
        best, back, last = np.full(n, np.inf), np.full(n, -1), np.full(n, -2)
        is_begin = np.zeros(n + 1, bool)
        is_begin[begins] = True
        for t in range(len(bounds) - 1):
            s, e, p = (x[bounds[t]:bounds[t + 1]] for x in (start, end, piece))
            first = is_begin[s]
            previous = np.where(first, 0, s - 1)
            cost = np.where(first, 0.0, best[previous]) + np.where(p >= 0, self.cost[p], BYTE_COST)
            if self.m["merges"]:
                check = np.flatnonzero(~first & (p >= 0) & np.isfinite(cost))
                check = check[last[previous[check]] >= 0]
                cost[check[~self._pairs(last[previous[check]], p[check])]] = np.inf
            live = np.isfinite(cost)
            s, e, p, cost = s[live], e[live], p[live], cost[live]
            by = np.lexsort((s, cost, e))  # of equal costs the longest piece
            e_sorted = e[by]
            top = by[np.concatenate([[True], e_sorted[1:] != e_sorted[:-1]])] if len(by) else by
            best[e[top] - 1], back[e[top] - 1], last[e[top] - 1] = cost[top], s[top], p[top]
        # walk all paths back at once: (word, step from the end, first character, piece)
        word, at = np.arange(len(words)), ends.copy()
        dead = last[ends - 1] == -2  # no path of finite cost
        word, at = word[~dead], at[~dead]
        walked, step = [], 0
        while len(word):
            s, p = back[at - 1], last[at - 1]
            walked.append((word, np.full(len(word), step), s, p))
            step += 1
            on = s > begins[word]
            word, at = word[on], s[on]
        word, step, s, p = (np.concatenate(x) for x in zip(*walked)) if walked else (np.zeros(0, np.int64),) * 4
        by = np.lexsort((-step, word))
        word, s, p = word[by], s[by], p[by]
        odd = np.flatnonzero(p < 0)
        own = {int(w): self._merged(words[w]) for w in np.flatnonzero(dead)}
        if len(odd) or own:  # characters as bytes, words without a path
            parts, at = [], 0
            spelled = {c: self._bytes(chr(c)) for c in np.unique(cps[s[odd]]).tolist()}
            sizes = np.ones(len(p), np.int64)
            sizes[odd] = [len(spelled[c]) for c in cps[s[odd]].tolist()]
            flat = np.repeat(p, sizes)
            starts = np.cumsum(sizes) - sizes
            for k, c in zip(starts[odd].tolist(), cps[s[odd]].tolist()):
                flat[k:k + len(spelled[c])] = spelled[c]
            counts = np.bincount(word, sizes, len(words)).astype(np.int64)
            if own:
                edges = np.cumsum(counts)
                for w in sorted(own):
                    parts += [flat[at:edges[w]], np.array(own[w], np.int64)]
                    at = edges[w]
                    counts[w] = len(own[w])
                flat = np.concatenate([*parts, flat[at:]])
            return flat.astype(np.int32), counts
        return p.astype(np.int32), np.bincount(word, minlength=len(words))

    def _bytes(self, c: str) -> list[int]:
        c = MARK if c == LITERAL_MARK else c
        return self.m["bytes"][list(c.encode())].tolist() if self.m["byte_fallback"] else [self.m["unknown"]]

    def _merged(self, word: str) -> list[int]:
        """Of a word without a path of finite cost: plain merging."""
        ids = []
        for s in _merge(list(word), self.m["score"]):
            ids.extend((self.m["id"][s],) if s in self.m["id"] else [i for c in s for i in self._bytes(c)])
        return ids


def normalise(text: str, prefix: bool = True) -> str:
    if MARK in text:
        text = text.replace(MARK, LITERAL_MARK)
    return (MARK if prefix and text else "") + text.replace(" ", MARK)


def decode_ids(model: dict, ids: list[int]) -> str:
    """The output side: pieces to text, runs of byte pieces to characters, the mark in front dropped."""
    table = model["decode"]
    raw = b"".join([table[i] for i in ids])
    if model["prefix"] and raw[:1] == b" ":
        raw = raw[1:]
    return raw.decode("utf-8", "replace")


def _gather(starts, sizes):
    """Places of runs given by their starts and sizes, one after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


class _Words:
    """Numbers of the words seen so far and their ids, in one array."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, words, ids, sizes):
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])


def _segments(text: str, prefix: bool) -> list[str]:
    """The words of a normalised text, each with the mark in front of it."""
    text = normalise(text, prefix)
    if MARK + MARK in text or "\0" in text or not text.startswith(MARK):
        return _SEGMENT.findall(text)
    return text.replace(MARK, "\0" + MARK).split("\0")[1:]


def _encoded(sent, keep_text):
    def run(batches):
        model = sent.value
        # a worker keeps its copy of the broadcast model from task to task, and with it the judged pairs
        fst, known = model.setdefault("made here", None) or Transducer(model), _Words()
        model["made here"] = fst
        is_byte = np.isinf(fst.cost)
        spell = np.frombuffer(b"".join(model["decode"]), np.uint8)
        spell_size = np.array([len(x) for x in model["decode"]])
        spell_start = np.cumsum(spell_size) - spell_size
        for batch in batches:
            data, offs = tk.utf8(batch.column(1))
            for r, _, o in tk.blocks(data, offs, SLICE_BYTES):
                part = batch.slice(r, len(o) - 1)
                texts = [t or "" for t in part.column(1).to_pylist()]
                segments = [_segments(t, model["prefix"]) for t in texts]
                flat = [w for s in segments for w in s]
                new = [w for w in dict.fromkeys(flat) if w not in known.number]
                if len(known.number) + len(new) > MAX_WORDS:
                    known, new = _Words(), list(dict.fromkeys(flat))
                known.add(new, *fst.encode(new))
                number = np.fromiter(map(known.number.__getitem__, flat), np.int64, len(flat))
                doc_of = np.repeat(np.arange(len(texts)), [len(s) for s in segments])
                sizes = known.sizes[number]
                ids = known.ids[_gather(known.starts[number], sizes)]
                owner = np.repeat(doc_of, sizes)
                n_tokens = np.bincount(owner, minlength=len(texts))
                n_bytes = np.bincount(owner, is_byte[ids], len(texts)).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32)), pa.array(ids))
                # the output side: the pieces' bytes
                raw = spell[_gather(spell_start[ids], spell_size[ids])].tobytes()
                ends = np.cumsum(np.bincount(owner, spell_size[ids], len(texts)).astype(np.int64)).tolist()
                decoded = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                if model["prefix"]:
                    decoded = [x[1:] if x[:1] == b" " else x for x in decoded]
                columns = [part.column(0), pa.array(n_tokens, pa.int64()), pa.array(n_bytes), lists,
                           pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                           pa.array([a == b.encode("utf-8", "surrogatepass") for a, b in zip(decoded, texts)])]
                names = ["doc_id", "n_tokens", "n_byte_tokens", "token_ids", "decoded_sha256", "round_trip"]
                if keep_text:
                    columns.append(pa.array([x.decode("utf-8", "replace") for x in decoded]))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


SCHEMA = "doc_id long, n_tokens long, n_byte_tokens long, token_ids array<int>, decoded_sha256 string, round_trip boolean"


def encode_documents(docs: DataFrame, model_path: str, keep_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, token_ids, decoded_sha256 (hex digest of
    the text decoded from the ids), round_trip (decoded text equals the input),
    with ``keep_text`` also ``decoded``.

    Null counts as empty; an empty text has no tokens. Repeated rows are each
    encoded. Characters without a piece become byte pieces, so every text
    decodes to itself. The compiled model (a few MB, fixed by the model file) is
    sent to the executors once.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(compile_model(spark, model_path))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(tk.gives_back(_encoded(sent, keep_text)), SCHEMA + (", decoded string" if keep_text else "")))
