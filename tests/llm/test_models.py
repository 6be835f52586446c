"""Quality, toxicity and the class language model: held-out accuracy, brute
force for the counts, awkward cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from cases import ROWS, documents, key, labels, low
from conftest import SF01
from gpsweave.llm import toxicity as tox
from gpsweave.llm.brown_lm import brown_scores, exchange_clusters, exchange_gains
from gpsweave.llm.queries import op3_toxicity, op9_quality, op10_brown_lm
from gpsweave.llm.quality import fit_bradley_terry, quality_scores

SF1 = "/root/testdata/sf0.1"


def held(d, m=5):
    return zlib.crc32(("" if d is None else str(d)).encode()) % m == 0


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality_on_held_out_rows(spark):
    got = op9_quality(spark, SF1).toPandas().merge(spark.read.parquet(f"{SF1}/labels.parquet").toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(held)).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    out = got[got.held_out]
    assert auc(out.score.to_numpy(), out.quality.to_numpy()) > 0.98
    assert (out.predicted == out.quality).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    got = op3_toxicity(spark, SF1).toPandas().merge(spark.read.parquet(f"{SF1}/labels.parquet").toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(held)).all() and got.score.between(0, 1).all()
    out = got[got.held_out]
    assert auc(out.score.to_numpy(), out.toxic.to_numpy()) > 0.95
    assert (out.predicted == out.toxic).mean() > 0.97


def test_classifiers_take_awkward_rows(spark):
    good, bad = "A plain sentence with many different words in a good order.", "### $$$ spam spam spam spam ### %%% ***"
    rows = ROWS + [(100 + i, (good if i % 2 else bad) + f" {i}") for i in range(40)]
    lab = [(100 + i, i % 2, 1 - i % 2) for i in range(40)] + [(None, 1, 0), (1, None, None), (4, 1, 0), (101, 1, 0)]
    docs, lab = documents(spark, rows), labels(spark, lab)
    for fn, column in ((quality_scores, "doc_id"), (tox.toxicity_scores, "doc_id")):
        got = fn(docs, lab).collect()
        assert sorted(key((r.doc_id,)) for r in got) == sorted(key((d,)) for d, _ in rows)
        assert all(0 <= r.score <= 1 for r in got)
        none = fn(docs, lab.limit(0)).collect()
        assert len(none) == len(rows) and len({round(r.score, 9) for r in none}) == 1
        assert fn(docs.limit(0), lab).count() == 0
    q = {r.doc_id: r.predicted for r in quality_scores(docs, lab).collect()}
    t = {r.doc_id: r.predicted for r in tox.toxicity_scores(docs, lab).collect()}
    assert all(q[100 + i] == i % 2 and t[100 + i] == 1 - i % 2 for i in range(40))


def test_hits_inside_exception_phrases():
    import random
    import time
    rng = random.Random(3)
    for _ in range(300):
        ends = sorted(rng.randrange(60) for _ in range(rng.randrange(12)))
        hits = [(e - rng.randrange(9), e, 1.0) for e in ends]
        spans = [(e - rng.randrange(15), e) for e in sorted(rng.randrange(60) for _ in range(rng.randrange(1, 8)))]
        assert tox._outside(hits, spans) == [h for h in hits if not any(a <= h[0] and h[1] <= b + 1 for a, b in spans)]
    automaton = tox._automaton({" trash": 4.0})
    started = time.time()
    assert tox.measure("trash can " * 15000, automaton)[1] == 0.0
    assert tox.measure("trash can " * 15000 + "trash", automaton)[2] == 4.0
    assert time.time() - started < 5


def test_bradley_terry_learns_the_order():
    rng = np.random.RandomState(1)
    y = np.repeat([0, 1], 300)
    x = rng.normal(size=(600, 3))
    x[:, 1] += 2 * y
    m = fit_bradley_terry(x, y)
    assert m["w"][1] > 5 * abs(m["w"][[0, 2]]).max()
    raw = np.clip((x - m["mean"]) / m["std"], -8, 8) @ m["w"]
    assert abs((raw < m["cut"]).mean() - 0.5) < 0.01        # the quantile of the bad share


def test_folding_and_exceptions():
    lexicon = {tox.fold(w).rstrip() + " ": 5.0 for w in ("idiot", "clown", "trash")} | {tox.fold("achlich").rstrip(): 4.0}
    a = tox._automaton(lexicon)
    hit = lambda t: tox.measure(t, a)[2]
    for t in ("You IDIOT!", "you іdiоt", "1d10t", "ｉｄｉｏｔ", "an !diot", "c1own", "achlichkeit", "idiot***", "(idiot)"):
        assert hit(t) > 0, t
    for t in ("idiotic", "patriot", "the trash can", "a clown fish", "", "machlich", "💡"):
        assert hit(t) == 0, t
    assert hit("the trash can, you trash") > 0
    assert tox.measure("idiot", a)[0] > tox.measure("idiot " + "word " * 200, a)[0]     # normalised by length


def test_language_model_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(300)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + ROWS
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in brown_scores(documents(spark, rows)).collect()), key=key)
    tokens = [(d, re.findall(r"[^\x20\x09-\x0D]+", low(t))) for d, t in rows]
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    count = Counter(w for d, t in tokens if not out(d) for w in [*t, "\0end"])
    n, v = sum(count.values()), len(count)
    want = sorted(((d, out(d), len(t) + 1, sum(w in count for w in [*t, "\0end"]), n,
                    sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in [*t, "\0end"])) for d, t in tokens), key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])) for a, b in zip(got, want))


def test_class_model_beats_the_unigram_on_held_out_text(spark):
    got = op10_brown_lm(spark, SF01).toPandas()
    out = got[got.held_out]
    per_token = lambda c: out[c].sum() / out.n_tokens.sum()
    assert (got.score < 0).all() and per_token("score") > per_token("base_score")
    assert len(got) == 1000


def test_exchange_finds_planted_classes():
    rng = np.random.RandomState(2)
    u, k = 41, 4                                 # 40 units in 4 planted classes, a follows b by class
    cls = np.arange(u - 1) % k
    pairs = np.zeros((u, u))
    for a in range(u - 1):
        for b in range(u - 1):
            pairs[a, b] = rng.poisson(30 if cls[b] == (cls[a] + 1) % k else 1)
    found = exchange_clusters(pairs, k + 1)
    assert all(len({found[i] for i in range(u - 1) if cls[i] == c}) == 1 for c in range(k))
    assert len(set(found[:-1])) == k and found[-1] not in found[:-1]


def test_language_model_of_empty_tables(spark):
    assert brown_scores(documents(spark).limit(0)).count() == 0
    none = brown_scores(documents(spark, [(d, "some words") for d in range(50) if zlib.crc32(str(d).encode()) % 7 == 2])).collect()
    assert none and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in none)


def planted_texts():
    """Words of one shape whose class alone says what follows: a then b then c."""
    rng = np.random.RandomState(3)
    groups = [[f"w{g}{i:03d}x" for i in range(60)] for g in "abc"]
    rows = []
    for d in range(700):
        g = rng.randint(3)
        rows.append((d, " ".join(groups[(g + i) % 3][rng.randint(60)] for i in range(30)) + (f" rare{d}" if d % 3 else "")))
    return rows


def test_classes_of_words_beyond_the_frequent_ones(spark):
    docs = documents(spark, planted_texts(), clash=False)
    want = None
    for head in (1 << 17, 100):                 # classes of the units beyond the head come by joins
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.score) for r in brown_scores(docs, n_words=20, n_classes=8, head=head).collect()))
        want = want or got
        assert [x[:3] for x in got] == [x[:3] for x in want]
        assert max(abs(a[3] - b[3]) for a, b in zip(got, want)) < 1e-6
    out = [x for x in want if zlib.crc32(str(x[0]).encode()) % 7 == 2]
    # a word of a known class: 1 of 60; a class model that pools them by shape gives 1 of 180
    assert sum(x[3] for x in out if x[0] % 3 == 0) / sum(x[1] - 1 for x in out if x[0] % 3 == 0) > -2.0


def test_gains_of_a_move_are_those_of_the_likelihood():
    rng = np.random.RandomState(4)
    u, k = 12, 4
    pairs = rng.poisson(3, (u, u)).astype(float)
    cls = np.append(rng.randint(0, k - 1, u - 1), k - 1)

    def counts(cls):
        member = np.eye(k)[cls]
        return member.T @ pairs @ member

    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    likelihood = lambda m: f(m) - f(m.sum(0)) - f(m.sum(1))
    member, own = np.eye(k)[cls], np.diag(pairs).copy()
    right, left = pairs @ member, pairs.T @ member
    right[np.arange(u), cls] -= own
    left[np.arange(u), cls] -= own
    gain = exchange_gains(counts(cls), cls, right, left, own)
    for i in range(u - 1):
        for c in range(k - 1):
            moved = cls.copy()
            moved[i] = c
            assert abs(gain[i, c] - gain[i, cls[i]] - likelihood(counts(moved)) + likelihood(counts(cls))) < 1e-8


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    import gpsweave.llm.quality as quality
    monkeypatch.setattr(quality, "BLOCK_ROWS", 40)
    rng = np.random.RandomState(2)
    ids = np.arange(500)
    y = (rng.rand(500) < 0.7).astype(int)
    x = rng.normal(size=(500, quality.N_FEATURES))
    x[:, 2] += 2 * y
    x[ids == 499] = 1000.0                             # one row that moves every mean
    features = spark.createDataFrame([(int(d), x[d].tolist()) for d in ids], "doc_id long, x array<double>").repartition(7)
    marks = spark.createDataFrame([(int(d), int(y[d])) for d in ids], "doc_id long, quality int")
    m, again = quality.quality_model(features, marks), quality.quality_model(features.repartition(3), marks)
    used = np.array([not held(d) for d in ids])
    assert used[499]
    assert np.allclose(m["mean"], x[used].mean(0)) and np.allclose(m["std"], x[used].std(0))
    assert (m["w"] == again["w"]).all() and m["cut"] == again["cut"]
    raw = np.sort(np.clip((x[used] - m["mean"]) / m["std"], -8, 8) @ m["w"])
    bad = int((y[used] == 0).sum())
    n = len(raw)
    assert np.isclose(m["cut"], np.quantile(raw, [(bad - 0.5) / n, (bad + 0.5) / n]).mean())
    assert abs((raw < m["cut"]).mean() - bad / n) < 0.01
    small = quality.fit_bradley_terry(x[used], y[used])
    assert np.corrcoef(m["w"], small["w"])[0, 1] > 0.95


def test_quality_fit_uses_every_pair():
    x = np.zeros((30_000, 15))
    x[::2, 0], x[1::2, 0] = 1.0, -1.0
    x[1::2, 1] = np.arange(15_000) >= 14_990           # rare: a sample of the pairs loses most of it
    import gpsweave.llm.quality as quality
    d = quality._pairs(x, np.tile([1, 0], 15_000), 8, 7)
    assert len(d) == 120_000 and (d[:, 1] == -1).sum() == 80
    d = quality._pairs(np.concatenate([x, x]), np.tile([1, 0], 30_000), 8, 7)
    assert len(d) == 240_000


def test_language_model_scores_each_text_once_in_any_number_of_parts(spark, monkeypatch):
    import gpsweave.llm.brown_lm as lm
    docs = documents(spark, planted_texts() + ROWS, clash=False)
    made, write = [], lm.written
    monkeypatch.setattr(lm, "written", lambda df, name: made.append(name) or write(df, name))
    got = {}
    for slices in (1, 4):
        monkeypatch.setattr(lm, "SLICES", slices)
        got[slices] = sorted(map(tuple, brown_scores(docs, n_words=20, n_classes=8, head=100).collect()), key=key)
    assert [x[:5] for x in got[1]] == [x[:5] for x in got[4]] and len(got[4]) == len(planted_texts() + ROWS)
    assert all(abs(a[i] - b[i]) < 1e-6 for a, b in zip(got[1], got[4]) for i in (5, 6))
    assert made.count("scores") == 5


def test_an_open_word_is_one_row_with_the_classes_beside_it():
    import pyarrow as pa
    from types import SimpleNamespace

    import gpsweave.llm.brown_lm as lm
    names = ["alpha", "beta", "farone", "fartwo", "unseen"]
    text = "alpha farone beta farone fartwo alpha unseen"
    h = next(lm._parsed([pa.RecordBatch.from_pydict({"text": [" ".join(names)]})]))[2]
    word, far = np.sort(h[:2]), np.zeros(lm.BITS // 8, np.uint8)
    for x in h[2:4] % lm.BITS:
        far[x >> 3] |= 1 << (x & 7)
    k = 3
    cls = np.concatenate([[0, 1], np.zeros(lm.N_SHAPES, int), [2]])
    model = {"word": word, "clustered": np.ones(2, bool), "far": far, "cls": cls, "step": np.arange(9.0).reshape(k, k), "emit": np.zeros(len(cls)),
             "tail": np.zeros(2), "base": np.zeros(2), "end_base": 0.0, "end_known": 1}
    rows = [(1, 11, text), (2, 22, ""), (3, 33, "fartwo")]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["doc_id", "text_hash", "text"])
    got = pa.Table.from_batches(lm._score(SimpleNamespace(value=model))([batch])).to_pylist()
    of = {n: int(np.searchsorted(word, x)) for n, x in zip(names[:2], h)}
    places = sorted((r["doc_id"], r["h"], r["since"], r["to"], r["tf"]) for r in got if r["copies"] == 0 and not r["late"])
    far1, far2, unseen = (int(x) for x in h[2:])
    assert places == sorted([(1, far1, of["alpha"], of["beta"], 1), (1, far1, of["beta"], -1, 1), (1, far2, -1, of["alpha"], 1), (1, unseen, -1, -1, 1), (3, far2, 2, 2, 1)])
    assert [(r["doc_id"], r["prev"], r["h"], r["tf"]) for r in got if r["late"]] == [(1, far1, far2, 0)]
    step = model["step"]
    known = step[2, of["alpha"]] + step[of["alpha"], 0] + step[0, 2]      # edge to alpha, alpha to the shape of unseen, that to the edge
    assert [(r["doc_id"], r["n_tokens"], r["score"]) for r in got if r["copies"]] == [(1, 8, known), (2, 1, step[2, 2]), (3, 2, 0.0)]
