"""Beyond the bound of a broadcast the plan shuffles instead: the same rows must come out."""

import pytest

import corpus_pipeline
from lakeshelf.llm import decontaminate, licenses, lines, neardup

SF = "/root/testdata/sf0.001"
CASES = {
    "lines": (lines, "MAX_BROADCAST_LINES", lambda spark, docs: lines.without_recurring(docs, spare_copies=False)),
    "licenses": (licenses, "MAX_BROADCAST_SHINGLES", lambda spark, docs: licenses.scan(docs, licenses.template_table(spark))),
    "decontaminate": (decontaminate, "MAX_BROADCAST_SEEDS", lambda spark, docs: decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))),
    "neardup": (neardup, "MAX_BROADCAST_IDS", lambda spark, docs: neardup.near_duplicates(docs)),
    "pipeline": (corpus_pipeline, "MAX_BROADCAST_IDS", lambda spark, docs: corpus_pipeline.near_dedup(spark, docs, SF)),
}


@pytest.mark.parametrize("name", CASES)
def test_shuffled_branch_gives_the_same_rows(spark, monkeypatch, name):
    module, bound, run = CASES[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(map(str, run(spark, docs).collect()))
    monkeypatch.setattr(module, bound, 0)
    assert sorted(map(str, run(spark, docs).collect())) == want
    assert want
