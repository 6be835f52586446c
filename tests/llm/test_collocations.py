"""Collocations against brute force, and the walk over one shard's index."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cases import CLASHING, ROWS, key, low
from gpsweave.llm.collocations import _numbers, _planes, collocations, transform


def brute(rows, top, least):
    f, total = defaultdict(Counter), Counter()
    for lang, t in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=key)


def sentences(seed, n=400):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(60)] + ["É", "naïve", "日本", "A", "b#", "x'"]
    fixed = [[rng.choice(voc) for _ in range(rng.randint(2, 6))] for _ in range(12)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 30)):
            w += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(voc)]
            w.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "!?"]))
        rows.append((rng.choice(["en", "en", "de", None, ""]), "".join(x if re.match(r"[\s.,!?]", x) else x + " " for x in w)))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string").repartition(4)
    for c in CLASHING + ["rank", "phrase", "id", "f"]:
        df = df.withColumn(c, F.lit("clash")) if c not in df.columns else df
    return df


def got(df, **kw):
    return sorted((tuple(r) for r in collocations(df, **kw).collect()), key=key)


def test_collocations_brute_force(spark):
    rows = sentences(1) + [("en", t) for _, t in ROWS] + [(None, None), ("xx", "one two. one two"), ("xx", "one two")]
    df = frame(spark, rows)
    for kw in ({"min_count": 3, "shard_words": 500}, {"min_count": 30}, {"min_count": 2, "top": 7, "shard_words": 1 << 21}):
        assert got(df, **kw) == brute(rows, kw.get("top", 2000), kw["min_count"])


def test_collocations_of_empty_tables(spark):
    df = frame(spark, [(None, None), ("en", " .,\n"), ("en", "")])
    assert got(df) == [] and got(df.filter("false")) == []


def test_arrow_batches_are_as_before(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    got(frame(spark, [("en", "a b c d " * 40)]))
    assert spark.conf.get(name) == before


def test_transform_sorts_rotations():
    rng = np.random.default_rng(2)
    t = rng.integers(0, 4, 300).astype(np.int32)
    rotations = sorted(range(300), key=lambda i: (tuple(np.roll(t, -i)[:4]), i))
    assert transform(t).tolist() == [t[i - 1] for i in rotations]


def test_a_phrase_is_written_by_one_of_its_shards(spark, monkeypatch):
    rows = [("en", "a b c d e f g")] * 400 + [("de", f"a b c d x{i}") for i in range(400)]
    df = frame(spark, rows)
    made, whole = [], type(df).mapInArrow

    def spied(self, run, schema, **kw):
        out = whole(self, run, schema, **kw)
        if "phrase" in out.columns:
            made.append(out)
        return out

    monkeypatch.setattr(type(df), "mapInArrow", spied)
    assert got(df, shard_words=50) == brute(rows, 2000, 30)
    texts = made[0].select("lang", "phrase")
    # 15 phrases of one language and 6 of the other, in shards of 50 words; the bitmap may let a few through twice
    assert texts.distinct().count() == 21 and texts.count() <= 30


def test_symbols_come_back_from_planes():
    x = np.array([0, 1, 255, 256, 70_000, 2**31 - 1], np.int32)
    assert _numbers(_planes(x).tobytes()).tolist() == x.tolist() and not len(_numbers(b""))
