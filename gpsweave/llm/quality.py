"""Quality classifier: Bradley-Terry pairwise ranking. From pairs of a good and
a bad document it learns weights by logistic loss on the differences of their
features; the threshold is a quantile of the training scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from . import textkit as tk
from .common import bucket_of, written
from .labelled import training_labels

# share of bytes in each class
BYTE_CLASSES = [b"*#&$%~^_=+<>{}[]@\\/", b"!?", b"|", bytes(range(65, 91)), b"0123456789", b".,;:", b"\n"]
N_FEATURES = len(BYTE_CLASSES) + 8
PAIRS_PER_DOCUMENT = 8
BLOCK_ROWS = 5000   # training rows of a block, about


def _features(data, offs, hasher):
    """Feature matrix of a block of rows."""
    rows = len(offs) - 1
    size = np.maximum(np.diff(offs), 1)
    out = np.zeros((rows, N_FEATURES))
    for j, cls in enumerate(BYTE_CLASSES):
        table = np.zeros(256, bool)
        table[list(cls)] = True
        at = np.flatnonzero(table[data])
        out[:, j] = np.diff(np.searchsorted(at, offs)) / size
    j = len(BYTE_CLASSES)
    h, first, starts, ends = hasher.words(data, offs)
    n = np.diff(first)
    words = np.maximum(n, 1)
    row = np.repeat(np.arange(rows), n)
    of_row = lambda x: np.bincount(row, x, rows)
    out[:, j] = np.log1p(n)
    out[:, j + 1] = of_row(ends - starts) / words
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out[:, j + 2] = of_row(same) / words
    by = np.lexsort((h, row))
    hs, rs = h[by], row[by]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    heads = np.flatnonzero(new)
    run = np.diff(np.append(heads, len(h)))
    types = np.bincount(rs[heads], minlength=rows)
    out[:, j + 3] = types / words
    out[:, j + 4] = np.log1p(types) - 0.9 * np.log1p(n)  # types against what the length lets expect
    top = np.zeros(rows)
    np.maximum.at(top, rs[heads], run)
    out[:, j + 5] = top / words
    # words that stand five words before too: loops longer than one word
    back = np.zeros(len(h))
    back[5:] = (h[5:] == h[:-5]) & (row[5:] == row[:-5])
    out[:, j + 6] = of_row(back) / words
    once = np.bincount(rs[heads[run == 1]], minlength=rows)
    out[:, j + 7] = once / words
    return out


def _feature_rows(batches):
    hasher = tk.Hasher(tk.white_space_words())
    for batch in batches:
        data, offs = tk.utf8(batch.column(1))
        for r0, d, o in tk.blocks(data, offs):
            x = _features(d, o, hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(r0, len(x)), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and feature vector of every row, written once: a few per cent of
    the texts' size, so that no text is shuffled to its label."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(tk.gives_back(_feature_rows), "doc_id long, x array<double>"), "features")


def _scaled(x, mean, std):
    return np.clip((x - mean) / std, -8, 8)


def _pairs(z, y, pairs, seed, others=(None, None)):
    """Differences good - bad, each row in about ``pairs`` of them. ``others``
    (bad, good) stand in for a class the block doesn't have."""
    good, bad = z[y == 1], z[y == 0]
    n = pairs * max(len(good), len(bad))
    good, bad = (rows if len(rows) else other for rows, other in ((good, others[1]), (bad, others[0])))
    if good is None or bad is None or not len(good) or not len(bad):
        return np.zeros((0, z.shape[1]))
    rng = np.random.RandomState(seed % 2**32)
    return good[np.resize(rng.permutation(len(good)), n)] - bad[np.resize(rng.permutation(len(bad)), n)]


def _loss(d, w):
    """Sums over the pairs: their number, logistic loss, gradient, Hessian."""
    m = np.clip(d @ w, -50, 50)
    p = 1 / (1 + np.exp(m))
    return len(d), np.log1p(np.exp(-m)).sum(), -(d.T @ p), (d * (p * (1 - p))[:, None]).T @ d


def _newton(at, size: int, l2: float, steps: int) -> np.ndarray:
    """The weights with the least mean loss plus l2 |w|^2 / 2; ``at(w)`` sums up all pairs."""
    w, step, best = np.zeros(size), np.zeros(size), np.inf
    for _ in range(steps):
        n, loss, g, h = at(w + step)
        if not n:
            break
        loss = loss / n + l2 * (w + step) @ (w + step) / 2
        if loss > best + 1e-12:     # too long a step
            step = step / 2
            continue
        done = best - loss < 1e-10
        w, best = w + step, loss
        if done:
            break
        step = -np.linalg.solve(h / n + l2 * np.eye(size), g / n + l2 * w)
    return w


def _threshold(n: int, bad: int, ranked, spread: float) -> tuple[float, float]:
    """The quantile of the bad share, in the middle of the gap around it, and
    the spread. ``ranked`` gives the scores of some ranks of the n."""
    if not 0 < bad < n:
        return 0.0, 1.0
    at = [min(max(q, 0.0), 1.0) * (n - 1) for q in (bad / n - 0.5 / n, bad / n + 0.5 / n)]
    ranks = sorted({min(int(a) + k, n - 1) for a in at for k in (0, 1)})
    values = dict(zip(ranks, ranked(ranks)))
    low, high = (values[int(a)] + (a - int(a)) * (values[min(int(a) + 1, n - 1)] - values[int(a)]) for a in at)
    return float((low + high) / 2), max(float(spread), 1e-9)


def fit_bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS_PER_DOCUMENT, steps: int = 60,
                      l2: float = 1e-3, seed: int = 7) -> dict:
    """Weights from pairs (good, bad) of rows in memory, each in about ``pairs`` of
    them. Without both classes the weights are 0 and every score equal.
    ``quality_model`` is the same over a table."""
    mean, std = (x.mean(0), np.maximum(x.std(0), 1e-9)) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    z = _scaled(x, mean, std)
    d = _pairs(z, y, pairs, seed)
    w = _newton(lambda v: _loss(d, v), z.shape[1], l2, steps)
    raw = z @ w
    cut, spread = _threshold(len(y), int((y == 0).sum()), lambda ranks: np.sort(raw)[ranks], raw.std() if len(raw) else 0)
    return {"mean": mean, "std": std, "w": w, "cut": cut, "spread": spread}


def _score(model, threshold, x):
    z = _scaled(x, model["mean"], model["std"])
    s = 4 * (z @ model["w"] - model["cut"]) / model["spread"] + np.log(threshold / (1 - threshold))
    return 1 / (1 + np.exp(-np.clip(s, -50, 50)))


def _text_scores(model, threshold):
    def run(texts):
        hasher = tk.Hasher(tk.white_space_words())
        for text in texts:
            scores = [_score(model, threshold, _features(d, o, hasher)) for _, d, o in tk.blocks(*tk.utf8(text))]
            yield pa.array(np.concatenate([np.zeros(0), *scores]))
    return run


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block of training rows as one row, its order independent of the partitions."""
    x, y = np.array(pdf["x"].tolist(), float).reshape(len(pdf), N_FEATURES), pdf["label"].to_numpy()
    by = np.lexsort((*x.T, y))
    return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "x": [x[by].tobytes()], "y": [y[by].astype(np.int8).tobytes()]})


def _unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["x"], float).reshape(-1, N_FEATURES), np.frombuffer(row["y"], np.int8)


def _sums(blocks: DataFrame, per_block) -> np.ndarray:
    """The sum of ``per_block(block, x, y)``, a vector for each block, in the
    blocks' order: the same digits whatever the partitions."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                v = per_block(row["block"], *_unpacked(row))
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([v], pa.list_(pa.float64()))], ["block", "v"])
    got = blocks.mapInArrow(run, "block long, v array<double>").collect()
    return np.sum([r.v for r in sorted(got, key=lambda r: r.block)], axis=0)


def _values_at(raw: DataFrame, ranks: list[int]) -> list[float]:
    """The values of column ``raw`` at some ranks (from 0): counted into ever
    narrower bins until few values are left."""
    out = []
    for rank in ranks:
        part, below = raw, 0
        while True:
            lo, hi, n = part.agg(F.min("raw"), F.max("raw"), F.count(F.lit(1))).first()
            if lo == hi or n <= BLOCK_ROWS:
                out.append(lo if lo == hi else sorted(r.raw for r in part.collect())[rank - below])
                break
            part = part.withColumn("bin", F.least(F.floor((F.col("raw") - lo) / (hi - lo) * 1000), F.lit(999)))
            for r in sorted(part.groupBy("bin").count().collect()):
                if below + r["count"] > rank:
                    break
                below += r["count"]
            part = part.filter(F.col("bin") == r.bin).drop("bin")
    return out


def quality_model(features: DataFrame, labels: DataFrame, pairs: int = PAIRS_PER_DOCUMENT, steps: int = 60,
                  l2: float = 1e-3, seed: int = 7) -> dict:
    """``fit_bradley_terry`` over every labelled row of ``features`` (doc_id, x).
    The rows are cut into blocks by a hash; a block makes its pairs and the
    driver gets sums of fixed size from each, never rows."""
    usable = training_labels(labels, "quality")
    rows = written(features.join(usable, "doc_id").select("doc_id", "x", "label"), "training")
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < good < n:
        return {"mean": np.zeros(N_FEATURES), "std": np.ones(N_FEATURES), "w": np.zeros(N_FEATURES), "cut": 0.0, "spread": 1.0}
    block = F.pmod(F.xxhash64("doc_id"), F.lit(-(-n // BLOCK_ROWS)))
    blocks = written(rows.select("x", "label", block.alias("block")).groupBy("block")
                     .applyInPandas(_packed, "block long, x binary, y binary"), "blocks")
    mean = _sums(blocks, lambda b, x, y: x.sum(0)) / n
    std = np.maximum(np.sqrt(_sums(blocks, lambda b, x, y: ((x - mean) ** 2).sum(0)) / n), 1e-9)
    # some rows of each class, for blocks that lack one
    others = [_scaled(np.array([r.x for r in rows.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "x").limit(200).collect()]), mean, std)
              for c in (0, 1)]

    def at(w):
        def per_block(b, x, y):
            k, loss, g, h = _loss(_pairs(_scaled(x, mean, std), y, pairs, seed + b, others), w)
            return np.concatenate([[k, loss], g, h.ravel()])
        v = _sums(blocks, per_block)
        return v[0], v[1], v[2:2 + N_FEATURES], v[2 + N_FEATURES:].reshape(N_FEATURES, N_FEATURES)

    w = _newton(at, N_FEATURES, l2, steps)
    middle = _sums(blocks, lambda b, x, y: np.atleast_1d((_scaled(x, mean, std) @ w).sum()))[0] / n
    spread = np.sqrt(_sums(blocks, lambda b, x, y: np.atleast_1d(((_scaled(x, mean, std) @ w - middle) ** 2).sum()))[0] / n)

    def raws(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_scaled(_unpacked(row)[0], mean, std) @ w)], ["raw"])
    raw = written(blocks.mapInArrow(raws, "raw double"), "raw")
    cut, spread = _threshold(n, n - good, lambda ranks: _values_at(raw, ranks), spread)
    return {"mean": mean, "std": std, "w": w, "cut": cut, "spread": spread}


def quality_texts(docs: DataFrame, training: DataFrame, labels: DataFrame, threshold: float = 0.3,
                  names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The rows and columns of ``docs`` with the score and the decision in two
    more columns, ``names``; learns from all labelled texts of ``training``."""
    model = quality_model(document_features(training), labels)
    # only the texts go to Python and only the scores come back; each is computed once
    score = F.arrow_udf(tk.gives_back(_text_scores(model, threshold)), "double", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    return docs.withColumn(names[0], score("text")).withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns from all labelled rows whose crc32(doc_id as text) modulo 5 is not
    0. The raw score is a weighted sum of text features, which are taken once
    for training and scores; its quantile at the training rows' share of bad
    documents is mapped to ``threshold``. Only the text is scored; null counts
    as empty, and an empty text has a score like any other. Repeated rows are
    each scored. Without labels of both kinds every score is ``threshold``.
    """
    features = document_features(docs)
    model = quality_model(features, labels)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            score = _score(model, threshold, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])
    scored = features.mapInArrow(tk.gives_back(run), "doc_id long, score double, predicted int")
    return scored.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
