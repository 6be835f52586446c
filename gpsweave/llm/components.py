"""Connected components of a table of links, by the least label of the
neighbours and pointer jumping, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """node, root (least node of its component) of every node with a link to
    another. ``links`` has the columns a and b; loops and repeats do no harm.

    A round gives every node the least label of itself and its neighbours, then
    that label's own label, so a chain of length n takes about log(n) rounds and
    a star two. Labels are written each round; the links are read from one
    written table, so adaptive execution can split a node with many of them.
    """
    both = written(links.filter("a <> b").select(F.inline(F.expr(
        "array(named_struct('u', a, 'v', b), named_struct('u', b, 'v', a))"))).distinct(), "links")
    labels = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("root")), "labels")
    state = None
    while True:
        now = tuple(labels.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "root").cast("decimal(38,0)"))).first())
        if now == state:
            return labels.select(F.col("u").alias("node"), "root")
        state = now
        of = labels.select(F.col("u").alias("v"), F.col("root").alias("near"))
        least = both.join(of, "v").groupBy("u").agg(F.min("near").alias("near"))
        jump = labels.select(F.col("u").alias("near"), F.col("root").alias("far"))
        labels = written(labels.join(least, "u").select("u", F.least("root", "near").alias("near"))
                         .join(jump, "near").select("u", F.least("near", "far").alias("root")), "labels")
