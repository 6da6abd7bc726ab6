"""The pipeline against a plain version, stage by stage."""

from __future__ import annotations

import tempfile

import corpus_pipeline
from test_llm_results import exact_classes

from postlens.llm import op6_quality_rules as op6
from postlens.llm import op9_decontaminate as op9

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    path = tempfile.mkdtemp(prefix="postlens-case-")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{path}/{name}")
        before, docs = docs, spark.read.parquet(f"{path}/{name}")
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.count() == len(seen[name])
        if name != "mixing":
            assert docs.columns == columns
        if name == "quality_rules":
            book = op6.apply_policy(op6.ledger(before), op6.POLICIES["v1"])
            assert seen[name] == {r["doc_id"] for r in book.where("kept").collect()}
        if name == "near_dedup":
            found = [(r["doc_id"], r["text"].encode()) for r in before.collect()]
            assert seen[name] == set(exact_classes(found).values())
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            bad = {r["doc_id"] for r in op9.find_leaks(spark, before, bench).collect()}
            assert bad and seen[name] == seen["near_dedup"] - bad
        if name == "secrets":
            assert seen[name] == seen["decontaminate"]
            assert docs.where("text rlike 'AKIA[A-Z0-9]{16}|[0-9a-f]{24}'").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in run.collect()} == seen["mixing"]
    assert corpus_pipeline.ORACLE_SQL is None
