"""op9's buckets stay small: windows are hashed only where long stretches are shared, and buckets are as many as the texts need."""

import random

import brute
import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F

from lakeshelf.llm import repeats, suffixes
from lakeshelf.llm.common import shuffles_deleted

U = np.uint64


def noise(r, n):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def opened(rows):
    """Findings of the anchors' steps that ask for windows, in one process."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    sent = list(repeats._scan(repeats.Bytes, 50, 16, 1, lambda k1, ctx: np.zeros(len(k1), np.int32))(iter([batch])))
    out = repeats._resolve(1, lambda k1: np.zeros(len(k1), bool))(iter([b for b in sent if b.column("kind")[0].as_py() == repeats.SENT]))
    return sum(len(repeats.unpack(b)[0]) for o in out if o.column("kind")[0].as_py() != repeats.RESOLVED for b in o.column("blob").to_pylist())


def test_short_common_phrases_open_no_windows():
    r = random.Random(3)
    phrase, line = noise(r, 30), noise(r, 80)
    assert opened([(i, noise(r, 200) + phrase + noise(r, 200)) for i in range(60)]) == 0
    assert opened([(i, noise(r, 200) + line + noise(r, 200)) for i in range(60)]) > 0


def test_as_many_partitions_as_the_texts_need(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "PART_BYTES", 4000)
    out = suffixes.without_repeated_bytes(docs(corpus))
    assert out.rdd.getNumPartitions() > 4
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    got = out.select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.repeated(corpus, 50, lambda t: (t or "").encode(), bytes), key=repr)


def test_slices_keep_equal_values_together():
    rng = np.random.default_rng(1)
    blobs = [repeats.pack(rng.integers(0, 300, 1000).astype(U), np.arange(1000)) for _ in range(5)]
    whole = repeats.joined(blobs, (U, np.int64))
    some = list(repeats.slices(blobs, (U, np.int64), 10_000))
    assert len(some) > 5 and max(len(h) for h, _ in some) < 2000
    assert sum(len(set(h.tolist())) for h, _ in some) == len(set(whole[0].tolist()))
    assert sorted(zip(*[np.concatenate(c).tolist() for c in zip(*some)])) == sorted(zip(*[c.tolist() for c in whole]))


def test_shuffle_files_of_stored_steps_go_and_the_setting_comes_back(spark, docs, corpus):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    cached = docs(corpus).cache()
    out = suffixes.without_repeated_bytes(cached)
    assert spark.conf.get(key) == before
    assert sorted(map(repr, out.collect())) == sorted(map(repr, out.collect()))
    assert cached.count() == len(corpus)
    with shuffles_deleted(spark):
        with shuffles_deleted(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
