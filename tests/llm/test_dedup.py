"""Exact dedup, Jaccard components and long repeats against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from cases import ROWS, documents, key, low, near_copies
from conftest import SF001
from gpsweave.llm.components import components
from gpsweave.llm.exact_dedup import exact_dedup
from gpsweave.llm.partenum import jaccard_components
from gpsweave.llm.suffix_index import LENGTH, SuffixIndexFamily, remove_repeats


def test_exact_dedup_cases(spark):
    got = [tuple(r) for r in exact_dedup(documents(spark)).collect()]
    groups = defaultdict(list)
    for d, t in ROWS:
        groups[low(t)].append(d)
    want = []
    for d, t in ROWS:
        g = groups[low(t)]
        keep = max((x for x in g if x is not None), default=None)
        want.append((d, keep if keep is not None else d, len(g), d == (keep if keep is not None else d), hashlib.sha256(low(t).encode()).hexdigest()))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_exact_dedup_same_length_and_prefix_but_other_text(spark):
    rows = [(1, "a" * 100 + "x"), (2, "a" * 100 + "y"), (3, "A" * 100 + "X"), (4, "É"), (5, "é")]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(documents(spark, rows)).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (5, 1)}   # only A-Z is lower-cased


def brute_components(rows):
    sets, parent, inverse = [], list(range(len(rows))), defaultdict(list)
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset())

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        for g in s:
            inverse[g].append(i)
    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in inverse[g] if j < i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=key)


def test_jaccard_components_cases(spark):
    rows = [(i + 100, t) for i, t in near_copies(3, groups=12, shared=25)] + ROWS
    long = " ".join(f"z{i}" for i in range(200))
    rows += [(None, long), (None, long + " end"), (999, long + " other"), (999, " ".join(f"y{i}" for i in range(90)))]   # no id, one id twice
    got = sorted((tuple(r) for r in jaccard_components(documents(spark, rows)).collect()), key=key)
    assert got == brute_components(rows)


def test_jaccard_components_on_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in jaccard_components(df).collect()), key=key) == brute_components(rows)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)] + [(301, 300), (300, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}


def brute_repeats(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[s:s + LENGTH] for _, t in texts for s in range(len(t) - LENGTH + 1))
    out = []
    for d, t in texts:
        gone, end = bytearray(len(t)), 0
        for s in range(len(t) - LENGTH + 1):
            if seen[t[s:s + LENGTH]] > 1:
                a = max(s, end)
                gone[a:s + LENGTH] = b"\1" * (s + LENGTH - a)
                end = s + LENGTH
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=key)


def repeat_rows():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdé fgh ij") for _ in range(n))
    passages = [text(rng.randint(300, 900)) for _ in range(5)]
    rows = []
    for i in range(40):
        t = text(rng.randint(0, 500))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            t += p[rng.randint(0, 60):len(p) - rng.randint(1, 60)] + text(rng.randint(0, 200))
        rows.append((i, t))
    return rows + [(200, "De " * 300), (201, "asga " * 200 + text(300)), (202, "x" * 400), (203, "x" * 399), (204, "y" * 401),
                   (205, None), (206, ""), (207, rows[5][1]), (207, rows[5][1]), (None, rows[6][1])]


@pytest.mark.parametrize("batches", [1, 4])
def test_long_repeats_cases(spark, batches):
    rows = repeat_rows()
    got = sorted((tuple(r) for r in remove_repeats(documents(spark, rows), batches).collect()), key=key)
    assert got == brute_repeats(rows)


def test_index_family_merges_geometrically(spark):
    family = SuffixIndexFamily()
    sizes = []
    for i in range(6):
        family.add(spark.createDataFrame([(i, 1), (99, 1)], "g long, n long"))
        sizes.append([s for s, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2]]
    assert [r.g for r in family.repeated_keys().collect()] == [99]


def test_empty_tables(spark):
    empty = documents(spark).limit(0)
    assert exact_dedup(empty).count() == 0
    assert jaccard_components(empty).count() == 0
    assert remove_repeats(empty).count() == 0


def word_run_rows():
    rng = random.Random(5)
    voc = [f"{c}{i}" for c in "abcde" for i in range(60)]
    some = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    runs = [some(n) for n in (50, 51, 52, 60, 75, 130)]                         # 50 is too short; all have fewer than 400 bytes but the last
    rows = [(i, f"{some(rng.randint(0, 60))} {runs[i % 6]}\n{some(rng.randint(0, 60))} {rng.choice(runs)} ") for i in range(40)]
    cut = runs[4].split()
    rows += [(100, some(300)), (101, " ".join(cut[:60])), (102, "x " + " ".join(cut[20:])), (103, runs[3].upper()), (104, " ".join(runs[1].split()[1:]))]
    inside, own = some(70), some(70)
    rows += [(109, f"{own} {some(7)} {own} {own}")]                            # repeats itself only
    rows += [(110, f"{inside} {some(9)} {inside}"), (111, some(80)), (112, None), (113, ""), (114, some(50)), (115, "w " * 51), (116, "w " * 90)]
    twice = f"{some(30)} {cut[0]}"
    return rows + [(120, f"{inside[:-3]} z {twice}"), (None, rows[42][1]), (121, rows[46][1]), (121, rows[46][1]), (122, runs[5] + " " + runs[5])]


def test_words_in_passages_that_other_rows_have(spark):
    rows, size = word_run_rows(), 51
    texts = [(d, (t or "").split()) for d, t in rows]
    holders = defaultdict(set)
    for i, (_, w) in enumerate(texts):
        for s in range(len(w) - size + 1):
            holders[tuple(w[s:s + size])].add(i)
    want = [(d, len({s + j for s in range(len(w) - size + 1) if len(holders[tuple(w[s:s + size])]) > 1 for j in range(size)})) for d, w in texts]
    assert sum(n > 0 for _, n in want) > 20 and sum(n == 0 for _, n in want) > 7
    for batches in (1, 4):
        got = remove_repeats(documents(spark, rows), batches, words=size)
        assert sorted(((r.doc_id, r.n_shared_words) for r in got.collect()), key=key) == sorted(want, key=key)
        assert sorted((tuple(r)[:5] for r in got.collect()), key=key) == brute_repeats(rows)
