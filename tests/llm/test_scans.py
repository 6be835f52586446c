"""License scan and decontamination against plain Python."""

import math
import re

from cases import ROWS, documents, key, low
from gpsweave.llm import license_scan as lic
from gpsweave.llm.decontaminate import contamination

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_licenses(text):
    w = WORD.findall(low(text))
    hits = [(i, label) for p, label in lic.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    found = []
    for paragraph in re.split(lic.PARAGRAPH_END, low(text)):
        words = WORD.findall(paragraph)
        for notice, label in lic.NOTICES:
            t = set(notice.split())
            for i in range(len(words)):
                own = set(words[i:i + lic.window(notice)])
                if len(own & t) >= math.ceil(lic.CONTAINMENT * len(t) - 1e-9):
                    found.append((label, len(own & t) / len(t)))
    base = sorted({x for _, x in hits})
    return (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(base),
            ",".join(sorted(set(base) | {x for x, _ in found})), 1.0 if hits else max((s for _, s in found), default=0.0))


EXTRA = [(50, "cc by cc by cc"), (51, "Licensed under the\nApache License, Version 2.0!"), (52, "licensed under the apache license version 2 0 and more words"),
         (53, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"),
         (54, "this work is licensed under the GNU general public license, version 3. all rights reserved all rights reserved"),
         (55, "acc by; cc bye; ccby"), (56, "license mit the under released"),
         (57, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation\nfiles"),
         (58, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"),
         (59, "This Source Code Form is subject to the terms of the Mozilla Public\r\nLicense, v. 2.0. If a copy of the MPL"),
         (60, "released under\n \t\nthe mit license"), (61, "released under one or another of the better known ones, the mit license"),
         (62, "mit " * 5000 + "x " * 4093 + "released under the mit license " + "y " * 5000), (63, "the mit license released under\r\n\r\nthe"),
         (64, "redistribution and use in source and binary forms with or without modification are allowed")]


def test_license_scan_cases(spark):
    rows = ROWS + EXTRA
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
                  for r in lic.license_scan(documents(spark, rows)).collect()), key=key)
    assert got == sorted(((d, *brute_licenses(t)) for d, t in rows), key=key)
    labels = {r[0]: r[6] for r in got}
    assert [labels[i] for i in (51, 56, 57, 58, 59, 60, 61, 62, 63, 64)] == ["apache-2.0", "mit", "mit", "bsd", "mpl-2.0", "", "", "mit", "mit", "bsd"]


def test_license_sql_on_the_cases(spark):
    """The query's SQL on the same rows: wrapped notices too."""
    import duckdb
    from gpsweave.llm.oracle import oracle_sql
    docs = documents(spark, [(i, *r[1:]) for i, r in enumerate(ROWS + EXTRA)])
    con = duckdb.connect()
    own = docs.select("doc_id", "text").toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text FROM own")
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({oracle_sql()['op2_license_scan']})").fetchall())
    assert sorted(tuple(r) for r in lic.license_scan(docs).select(*cols).collect()) == want


def brute_contamination(rows, items, t=0.8):
    word = re.compile("[0-9a-z\u0080-\U0010ffff]+")
    grams = lambda w, n: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    out = []
    for i, x in items:
        w = word.findall(low(x))
        n = min(5, len(w))
        if i is None or not n:
            continue
        own = grams(w, n)
        for d, y in rows:
            k = len(own & grams(word.findall(low(y)), n))
            if k >= math.ceil(t * len(own) - 1e-9):
                out.append((d, i, len(own), k, k / len(own)))
    return sorted(out, key=key)


def test_contamination_cases(spark):
    from cases import BASE
    w = [f"q{i}" for i in range(30)]
    rows = ROWS + [(60, "intro " + " ".join(w) + " outro"), (61, " ".join(w[:15] + ["other"] + w[15:])), (62, " ".join(w[:14])),
                   (63, ", ".join(w).upper()), (64, "the ONE, two! three")]
    items = [(0, " ".join(w)), (1, BASE), (2, "one two three"), (3, None), (4, "  ... "), (5, "one two three"), (None, BASE), (6, " ".join(w)), (6, " ".join(w))]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "'x' AS doc_id", "'y' AS n_item")
    got = sorted((tuple(r) for r in contamination(documents(spark, rows), bench).collect()), key=key)
    assert got == brute_contamination(rows, items)
    assert {r[0] for r in got if r[1] == 0} == {60, 61, 63}


def test_sketches_never_miss(spark):
    """Random items with as many words changed as the threshold lets pass."""
    import random
    rng = random.Random(5)
    voc = [f"v{i}" for i in range(5000)]
    items = [(i, " ".join(rng.sample(voc, rng.randint(5, 59)))) for i in range(60)]
    rows = []
    for i, x in items:
        w = x.split()
        for c in range(3):
            y = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                y[rng.randrange(len(y))] = rng.choice(voc)
            rows.append((len(rows), " ".join(rng.sample(voc, 200) + y + rng.sample(voc, 300))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contamination(documents(spark, rows, clash=False), bench).collect()), key=key)
    assert got == brute_contamination(rows, items) and len(got) > 60


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert lic.license_scan(documents(spark).limit(0)).count() == 0
    assert contamination(documents(spark).limit(0), bench).count() == 0
    assert contamination(documents(spark), bench.limit(0)).count() == 0
