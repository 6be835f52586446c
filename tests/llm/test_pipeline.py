"""The corpus pipeline: each stage judged on its own input, and the registered
queries and SQL of the subpackage."""

import re

import corpus_pipeline as cp
import pyarrow as pa
import pytest

import __spark_entry__ as E
from cases import documents, low
from conftest import SF001, SF01
from gpsweave.llm import oracle
from gpsweave.llm.quality import quality_texts
from gpsweave.llm.queries import queries
from oracle_harness import compare
from test_dedup import brute_components
from test_scans import brute_contamination


def test_every_operator_has_its_query():
    names = set(queries())
    assert {re.match(r"op(\d+)_", n).group(1) for n in names} == {str(i) for i in range(1, 11)} and len(names) == 10
    assert names | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql_form(spark, duck01, name):
    r = compare(spark, duck01, name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert r["cols_ok"] and r["spark_rows"] == r["duck_rows"] and r["values_ok"], r


def test_stages_keep_and_drop_what_they_should(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    rows = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    seen, columns = rows(docs), docs.columns
    for name, stage in cp.STAGES:
        out = cp.written(stage(spark, docs, SF01), name)
        kept = rows(out)
        assert set(kept) <= set(seen)
        gone = set(seen) - set(kept)
        if name == "quality_classifier":
            labelled = [d for d in seen if d in quality]
            assert sum((d in kept) == (quality[d] == 1) for d in labelled) > 0.97 * len(labelled)
        elif name == "exact_dedup":
            last = {}
            for d, t in seen.items():
                last[low(t)] = max(last.get(low(t), d), d)
            assert set(kept) == set(last.values())
        elif name == "ngram_jaccard_join":
            assert gone == {d for d, _, c in brute_components(list(seen.items())) if c != d}
        elif name == "benchmark_decontamination":
            assert gone == {d for d, *_ in brute_contamination(list(seen.items()), items)} and gone
        else:
            assert not gone and kept == seen and out.filter("not round_trip").count() == 0
        if name != cp.STAGES[-1][0]:
            assert out.columns == columns
        docs, seen = out, kept


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF001)
    assert out.filter("not round_trip").count() == 0 and 0 < out.count() < 200


def test_stages_take_awkward_rows(spark):
    docs = documents(spark)
    for name, stage in cp.STAGES:
        if name != "quality_classifier":          # the awkward texts are of low quality
            out = cp.written(stage(spark, docs, SF001), name)
            if name != "sentencepiece":
                assert out.columns == docs.columns
            docs = out
    ids = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=lambda x: (x is None, x))
    assert None in ids and len(ids) == len(docs.collect())
    kept = cp.written(cp.quality_classifier(spark, documents(spark), SF001), "quality")
    assert kept.columns == documents(spark).columns
    empty = documents(spark).limit(0)
    assert all(cp.written(stage(spark, empty, SF001), name).count() == 0 for name, stage in cp.STAGES)


def test_texts_go_to_python_in_small_batches_and_stay_there(spark):
    docs = spark.range(3000, numPartitions=1).selectExpr("id doc_id", "repeat('some words ', 1000) text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])
    seen = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(seen) == 3000 and max(seen) * 11_000 < 16 << 20
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    scored = quality_texts(docs, docs, labels)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert scored.filter("predicted = cast(score >= 0.3 as int)").count() == 3000
