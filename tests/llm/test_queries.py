"""Every query with SQL against DuckDB, and those without against plain Python, on the smallest tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import brute
import corpus_pipeline
from lakeshelf.llm import decontaminate, lines, neardup, pieces, quality, repair
from lakeshelf.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=repr)


def test_op1(spark, table):
    sp = pieces.PieceEncoder(pieces.default_model()).library
    want = []
    for d, t in table:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(sp.decode(ids))))
    assert rows(spark, "op1_pieces") == sorted(want, key=repr)


def test_op3(spark, table):
    assert rows(spark, "op3_substrings") == sorted(((d, n, r, h) for d, n, r, _, h in brute.repeated(table, 13, brute.words, " ".join)), key=repr)


def test_op4(spark, table):
    out = rows(spark, "op4_quality")
    assert [r[:6] for r in out] == sorted(((d, *brute.base_statistics(t)) for d, t in table), key=repr)


def test_op6(spark, table):
    enc = repair.WordEncoder(repair.default_vocabulary())
    want, start = [], 0
    for (d, t), ids in zip(sorted(table), enc.whole([t or "" for _, t in sorted(table)])):
        ids = ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(spark, "op6_repair") == sorted(want, key=repr)


def test_op7(spark, table):
    assert rows(spark, "op7_neardup") == sorted(((d, n, c, d == c) for d, n, c in brute.near(table)), key=repr)


def test_op9(spark, table):
    assert rows(spark, "op9_suffixes") == sorted(brute.repeated(table, 50, lambda t: (t or "").encode(), bytes), key=repr)


def test_pipeline_stages(spark, docs, corpus):
    """Each stage on odd documents: its columns stay, its decisions take effect, and nothing else goes."""
    d = docs(corpus + [(-7, corpus[0][1]), (-7, corpus[0][1])]).cache()
    before = d.collect()
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["quality_rules"](spark, d, SF)
    assert kept.columns == d.columns
    ok = quality.judged(d, ["doc_id", "text", "lang", "source"]).filter("kept").count()
    assert kept.count() == ok < len(before)

    out = stage["line_dedup"](spark, d, SF)
    assert out.columns == d.columns and out.count() == len(before)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())

    out = stage["near_dedup"](spark, d, SF).collect()
    found = {c for i, _, c in brute.near([(r.doc_id, r.text) for r in before if r.doc_id != -7]) if i is not None}
    assert sorted(r.doc_id for r in out if r.doc_id is not None and r.doc_id != -7 and r.doc_id in found) == sorted(r for r in {x.doc_id for x in out} if r in found)
    assert len([r for r in out if r.doc_id is None]) == len([r for r in before if r.doc_id is None])
    assert len([r for r in out if r.doc_id == -7]) <= 1

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaky = docs([(1, "before it " + items[0][1] + " after it"), (2, "quite clean"), (None, "clean"), (3, None)])
    assert sorted(str(r.doc_id) for r in stage["decontamination"](spark, leaky, SF).collect()) == ["2", "3", "None"]

    out = stage["sentencepiece"](spark, d, SF)
    assert out.count() == len(before)


def test_pipeline_against_the_operators(spark):
    """The documents that come out are those that the operators keep, one after the other."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    keep = {r.doc_id for r in quality.judged(docs).filter("kept").collect()}
    docs = spark.createDataFrame(docs.filter(docs.doc_id.isin(list(keep))).collect(), docs.schema)
    text = {r.doc_id: r.text for r in lines.without_recurring(docs).collect()}
    near = {d for d, _, c in brute.near(sorted(text.items()), 80) if d == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, _ in brute.leaks([(d, text[d]) for d in near], items)}
    sp = pieces.PieceEncoder(pieces.default_model()).library
    want = {d: sp.encode(text[d], add_bos=True, add_eos=True) for d in near - leaks}
    out = corpus_pipeline.run(spark, SF).collect()
    assert len(out) == len(want) and {r.doc_id: list(r.ids) for r in out} == want
    assert 100 < len(want) < len(keep)


def test_no_query_is_missing():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline"} | set(QUERIES) <= names and {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert os.path.exists(corpus_pipeline.__file__) and decontaminate and neardup
