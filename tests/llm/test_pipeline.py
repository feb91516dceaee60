"""Pipeline stages: their decisions take effect, and columns come back as they were."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from riskframe.llm import decontaminate, minhash_join, words  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as score", "'x' as copies", "'y' as source_size")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= ids
        if name == "near_dedup":
            assert minhash_join.classes(docs).where("id != component").count() == 0 and docs.count() == len(left)
        ids = left
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (2, "a b c d e f g", "s"), (None, None, "s"), (3, "", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect() if r["doc_id"] is not None)
    assert got == [1, 3]


def test_no_task_of_the_leak_search_keeps_two_python_workers(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three four five six seven")], "item_id long, text string")
    plans, write = [], decontaminate.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(decontaminate, "written", noted)
    rows = decontaminate.contamination(docs, items).collect()
    assert [(r["id"], r["item"], r["share"]) for r in rows] == [(1, 7, 1.0)]
    assert max(p.split("== Initial Plan ==")[0].count("MapInArrow") for p in plans) == 1


def test_python_functions_of_all_stages_give_memory_back(spark, monkeypatch):
    frame, functions = type(spark.range(1)), []
    run = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *a, **k: functions.append(f) or run(self, f, *a, **k))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF)
    monkeypatch.undo()

    trimmed = []
    monkeypatch.setattr(words.pa, "default_memory_pool", lambda: trimmed.append(1) or words.pa.system_memory_pool())
    for f in functions:
        before = len(trimmed)
        list(f(iter([])))
        assert len(trimmed) > before, f
