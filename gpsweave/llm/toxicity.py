"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton after
folding homoglyphs and digit substitutions; matches inside exception phrases
don't count; the sum is normalised by length and calibrated.

The lexicon is learned: words and word beginnings that labelled toxic documents
hold far more often than others, weighted by log odds."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import bucket_of
from .labelled import SAMPLE_ROWS, training_rows

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "е": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "г": "r", "п": "n", "ь": "b",
    "А": "a", "В": "b", "Е": "e", "І": "i", "Ј": "j", "К": "k", "М": "m", "Н": "h", "О": "o", "Р": "p", "С": "c",
    "Ѕ": "s", "Т": "t", "У": "y", "Х": "x",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ω": "w", "η": "n", "γ": "y", "σ": "o", "Α": "a", "Β": "b", "Ε": "e", "Ζ": "z", "Η": "h", "Ι": "i", "Κ": "k",
    "Μ": "m", "Ν": "n", "Ο": "o", "Ρ": "p", "Τ": "t", "Υ": "y", "Χ": "x",
    "ı": "i", "ⅼ": "l", "ⅰ": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ᴏ": "o", "​": None, "‍": None, "­": None,
    **{chr(0xFF21 + i): chr(97 + i) for i in range(26)}, **{chr(0xFF41 + i): chr(97 + i) for i in range(26)},
})
FOREIGN = re.compile("[­ıɑɡʟͰ-ԯᴏ​‍ⅰ-ⅿＡ-ｚ]")
# Digits and signs that stand for letters. i and l are one letter here, since 1 stands for both.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i"}
SIGNS = re.compile(rb"(?<![$@!])[$@!](?=[a-z0-9])")
SIGN_LETTERS = {b"$": b"s", b"@": b"a", b"!": b"i"}
# Phrases with a lexicon word in a harmless sense.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum", "sore loser",
              "pathetic fallacy", "stupid question")
STEM_CHARS = range(3, 11)
MIN_ODDS, MIN_SHARE, LEXICON_SIZE = 2.5, 0.01, 2000


def _table() -> bytes:
    t = bytearray(b" " * 256)
    for b in range(128, 256):
        t[b] = b
    for b in range(26):
        t[97 + b] = t[65 + b] = 97 + b
    for a, b in DIGITS.items():
        t[ord(a)] = ord(b)
        t[ord(a.upper())] = ord(b)
    return bytes(t)


TABLE = _table()


def fold(text: str) -> str:
    """The folded UTF-8 bytes as Latin-1 text: letters and non-ASCII bytes,
    words with one or more spaces between and around them."""
    if not text.isascii() and FOREIGN.search(text):
        text = text.translate(HOMOGLYPHS)
    raw = text.encode("utf-8", "surrogatepass")
    if b"$" in raw or b"@" in raw or b"!" in raw:
        raw = SIGNS.sub(lambda m: SIGN_LETTERS[m[0]], raw.lower())
    return " " + raw.translate(TABLE).decode("latin-1") + " "


def _terms(batches):
    """(term, documents, toxic documents) of a partition; a term is ' word ' or ' beginning'."""
    seen: dict = {}
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = set()
            for w in set(fold(text or "").split()):
                own.add(f" {w} ")
                own.update(" " + w[:k] for k in STEM_CHARS if k < len(w))
            for t in own:
                n = seen.setdefault(t, [0, 0])
                n[0] += 1
                n[1] += label
        if len(seen) > 1_000_000:
            yield from _term_rows(seen)
            seen = {}
    yield from _term_rows(seen)


def _term_rows(seen):
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([t.encode("latin-1") for t in seen], pa.binary()), pa.array([n[0] for n in seen.values()], pa.int64()),
                                          pa.array([n[1] for n in seen.values()], pa.int64())], ["term", "n", "toxic"])


def _automaton(lexicon: dict[str, float]):
    a = ahocorasick.Automaton()
    for t, w in lexicon.items():
        a.add_word(t, (w, len(t) - t.endswith(" ")))
    for p in EXCEPTIONS:
        t = fold(p)
        a.add_word(t, (None, len(t) - 1))
    a.make_automaton()
    return a


def _outside(hits: list, spans: list) -> list:
    """The hits (start, end, weight) that lie in no span (start, end). The
    automaton gives both by rising ends, so one pass from the last to the first
    suffices: of the spans that reach a hit's end, the smallest start counts."""
    kept, i, least = [], len(spans) - 1, float("inf")
    for h in reversed(hits):
        while i >= 0 and spans[i][1] + 1 >= h[1]:
            least = min(least, spans[i][0])
            i -= 1
        if least > h[0]:
            kept.append(h)
    return kept[::-1]


def measure(text: str, automaton) -> list[float]:
    """Features of one text: weight per word, total weight, largest weight,
    distinct terms, hits per word."""
    s = fold(text)
    n = max(1, len(s.split()))
    hits, spans = [], []
    for end, (w, size) in automaton.iter(s):
        size += s[end] == " "  # the closing space of a whole word belongs to the match
        if w is None:
            spans.append((end - size, end))
        else:
            hits.append((end - size + 1, end, w))
    if spans:
        hits = _outside(hits, spans)
    best = {}  # one hit per word: its largest weight
    for a, _, w in hits:
        best[a] = max(best.get(a, 0.0), w)
    total = sum(best.values())
    kinds = len({s[a:a + 8] for a in best})
    return [np.log1p(100 * total / n), np.log1p(total), max(best.values(), default=0.0), np.log1p(kinds), np.log1p(1000 * len(best) / n)]


def _measured(lexicon):
    def run(batches):
        automaton = _automaton(lexicon)
        for batch in batches:
            x = [measure(t or "", automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])
    return run


def _scored(lexicon, model):
    def run(batches):
        automaton = _automaton(lexicon)
        for batch in batches:
            for r in range(0, batch.num_rows, 256):
                part = batch.slice(r, 256)
                x = np.array([measure(t or "", automaton) for t in part.column(1).to_pylist()])
                s = (x - model["mean"]) / model["std"] @ model["w"] + model["b"]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30))))], ["doc_id", "score"])
    return run


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Terms by document log odds (add 0.5), of at least MIN_SHARE of the toxic
    documents; of a word and its beginnings the one with the highest odds, the
    longest of equal ones. At most ``size`` terms."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"]
    if not toxic or toxic == n:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (toxic - F.col("toxic") + 0.5)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (n - toxic - F.col("n") + F.col("toxic") + 0.5))
    found = (rows.mapInArrow(tk.gives_back(_terms), "term binary, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
             .withColumn("odds", odds).filter((F.col("odds") >= MIN_ODDS) & (F.col("toxic") >= max(3, MIN_SHARE * toxic)))
             .orderBy(F.desc("odds"), F.desc(F.length("term")), "term").limit(4 * size).collect())
    lexicon: dict[str, float] = {}
    taken: set = set()
    for r in found:
        t = bytes(r["term"]).decode("latin-1")
        beginnings = {t[:k] for k in range(4, len(t) + 1)}
        if t in taken or any(b in lexicon for b in beginnings):
            continue  # part of a stronger term, or an extension of one
        lexicon[t] = float(r["odds"])
        taken |= {t[:k] for k in range(4, len(t))}
        if len(lexicon) >= size:
            break
    return lexicon


def fit_calibration(x: np.ndarray, y: np.ndarray, steps: int = 2000) -> dict:
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.01
        return {"mean": np.zeros(5), "std": np.ones(5), "w": np.zeros(5), "b": float(np.log(rate / (1 - rate)))}
    mean, std = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.c_[(x - mean) / std, np.ones(len(x))]
    w, l2 = np.zeros(6), np.array([1e-3] * 5 + [0])
    speed = 4.0 / (np.linalg.eigvalsh(z.T @ z / len(z))[-1] + 1e-3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= speed * (z.T @ (p - y) / len(y) + l2 * w)
    return {"mean": mean, "std": std, "w": w[:5], "b": float(w[5])}


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns lexicon and calibration from at most about ``sample`` labelled rows
    whose crc32(doc_id as text) modulo 5 is not 0; scores only the text. Null
    counts as empty; an empty text has no match and the lowest score. Repeated
    rows are each scored. Without labels of both kinds no term is learned and
    all scores are equal.
    """
    rows = training_rows(docs, labels, "toxic", sample)
    lexicon = learn_lexicon(rows)
    got = rows.mapInArrow(tk.gives_back(_measured(lexicon)), "x array<double>, label int").toPandas()
    x, y = np.array(got["x"].tolist(), float).reshape(len(got), 5), got["label"].to_numpy()
    by = np.lexsort((*x.T, y))
    model = fit_calibration(x[by], y[by])
    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .mapInArrow(tk.gives_back(_scored(lexicon, model)), "doc_id long, score double"))
    return scored.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
