"""License scan: exact phrase places, and an exact set-similarity join of text
blocks with license notices. DataFrame operations only.

A notice may be wrapped over lines and has dots inside ("v. 2.0"), so a block is
a run of words: every window of a paragraph as long as the notice and a fifth
more. Windows are formed only around the words that the prefix filter asks for.

The join follows prefix filtering: tokens are ordered by their document
frequency over the whole corpus (rarest first); a block that holds at least
``ceil(t * |T|)`` of a notice's tokens must hold one of the notice's first
``|T| - ceil(t * |T|) + 1`` tokens in that order. A length filter and a
positional filter drop candidates before the exact count."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

# Characters of a word (digits, letters, everything beyond ASCII).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrase -> label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Blocks don't cross blank lines.
PARAGRAPH_END = r"\n[ \t\r]*\n"
# Notices in their usual short wording -> label. Lower case, words only.
NOTICES = [
    ("released under the mit license", "mit"),
    ("this project is licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("released into the public domain", "public-domain"),
]
CONTAINMENT = 0.9
CHUNK = 4096  # words of a paragraph that are looked through at once


def window(notice: str) -> int:
    """Words of the blocks compared with a notice."""
    n = len(notice.split())
    return n + ceil(n / 5)


def _words(text: Column) -> Column:
    """The words of a lower-cased text, each with one space before and after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, NOT_WORD, " ")), F.lit(" "))


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _tokens(words: Column) -> Column:
    return F.array_remove(F.split(words, " "), "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def phrase_places(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base_labels to rows that
    have a column ``words`` (see _words)."""
    w = F.col("words")
    n_words = F.when(F.length(w) <= 2, F.lit(0)).otherwise(_spaces(w) - 1)
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        hit, size = f" {phrase} ", phrase.count(" ") + 1
        found = F.contains(w, F.lit(hit))
        counts.append(F.when(found, F.regexp_count(w, F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(found, _spaces(F.substring_index(w, hit, 1))))
        # the rest after the last place: each of its words ends with one space
        lasts.append(F.when(found, n_words - size - _spaces(F.substring_index(w, hit, -1))))
        labels.append(F.when(found, F.lit(label)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return docs.withColumns({
        "n_words": n_words.cast("long"), "n_base": total.cast("long"),
        "first_word": F.least(*firsts, F.lit(None).cast("int")).cast("long"),
        "last_word": F.greatest(*lasts, F.lit(None).cast("int")).cast("long"),
        "base_list": F.array_compact(F.array(*labels))})


def license_scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES,
                 containment: float = CONTAINMENT) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    ``labels`` holds the base labels and those of the notices of which some
    block of the text (see ``window``) holds at least the share ``containment``
    of the distinct words; ``score`` is 1.0 for a base phrase, else the largest such share,
    else 0.0. Null text counts as empty: no words, empty labels, score 0. Rows
    that repeat an id are each returned, with the labels of their own text. The
    notices are a parameter of the code and small, so they are broadcast; the
    token order needs one count per word of the notices.
    """
    sets = [sorted(set(t.split())) for t, _ in notices]
    need = [ceil(containment * len(s) - 1e-9) for s in sets]
    vocabulary = sorted({w for s in sets for w in s})
    norm = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("low", ascii_lower(F.col("text")))
    # one scan: the base columns, the notices' words a text holds, and the lower-cased
    # text where they are enough for some notice
    enough = F.lit(False)
    for w, n in zip(sets, need):
        enough = enough | (F.size(F.array_intersect(_strings(w), F.col("vocabulary"))) >= n)
    base = written(
        phrase_places(norm.withColumn("words", _words(F.col("low"))))
        .withColumn("vocabulary", F.array_intersect(_tokens(F.col("words")), _strings(vocabulary)))
        .select("doc_id", F.xxhash64("text").alias("h"), "n_words", "n_base", "first_word", "last_word", "base_list",
                "vocabulary", F.when(enough, F.col("low")).alias("candidate")), "licenses")

    # document frequency of the notices' words over the whole corpus
    count = {r["w"]: r["n"] for r in base.select(F.explode("vocabulary").alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    spark = docs.sparkSession
    prefixes = []
    for i, s in enumerate(sets):
        s = sorted(s, key=rank.get)
        for at in range(len(s) - need[i] + 1):
            prefixes.append((s[at], i, at, len(s), need[i], window(notices[i][0]), s, notices[i][1]))
    prefix = spark.createDataFrame(prefixes, "token string, notice int, at int, size int, need int, width int, words array<string>, label string")

    # chunks of a paragraph's words, each with the words that a window starting in it can reach
    reach = max((window(t) for t, _ in notices), default=1)
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(CHUNK))
    chunks = (base.filter(F.col("candidate").isNotNull())
              .select("doc_id", "h", F.explode(F.split("candidate", PARAGRAPH_END)).alias("paragraph"))
              .select("doc_id", "h", _tokens(_words(F.col("paragraph"))).alias("all"))
              .select("doc_id", "h", F.explode(F.transform(starts, lambda s: F.slice("all", s + 1, F.lit(CHUNK + reach - 1)))).alias("chunk"))
              .filter(F.size(F.array_intersect("chunk", _strings(order))) >= min(need, default=0)))
    # every place of a prefix word, with the words around it
    asked = _strings(sorted({p[0] for p in prefixes}))
    places = F.filter(F.transform("chunk", lambda w, i: F.struct(w.alias("token"), i.alias("i"))), lambda x: F.array_contains(asked, x["token"]))
    first = lambda x: F.greatest(x["i"] - (reach - 1), F.lit(0))
    around = F.transform(places, lambda x: F.struct(x["token"].alias("token"), (x["i"] - first(x)).alias("i"),
                                                    F.slice("chunk", first(x) + 1, F.lit(2 * reach - 1)).alias("near")))
    windows = F.transform(F.sequence(F.greatest(F.col("i") - F.col("width") + 1, F.lit(0)), F.col("i")),
                          lambda s: F.array_intersect(_strings(order), F.slice("near", s + 1, F.col("width"))))
    pairs = (chunks.select("doc_id", "h", F.inline(around)).join(F.broadcast(prefix), "token")
             .select("doc_id", "h", "token", "at", "size", "need", "words", "label", F.explode(windows).alias("block"))
             .withColumns({"n": F.size("block"), "pos": F.array_position("block", F.col("token")) - 1})
             # length filter; positional filter: words before, this one, words after
             .filter("n >= need and least(at, pos) + 1 + least(size - at - 1, n - pos - 1) >= need")
             .withColumn("share", F.size(F.array_intersect("block", "words")) / F.col("size"))
             .filter(F.size(F.array_intersect("block", "words")) >= F.col("need")))
    found = written(pairs.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("text_hash"))
                    .agg(F.collect_set("label").alias("more"), F.max("share").alias("share")), "notices")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return (base.drop("vocabulary", "candidate").join(found, (F.col("h") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    joined(F.col("base_list")).alias("base_labels"),
                    joined(F.concat("base_list", F.coalesce("more", _strings([])))).alias("labels"),
                    F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")))
