"""Suffix-array dedup over bytes (operator 9).

The suffixes that start at anchors (see ``repeats``) are sorted by their leading bytes: a sample
of the suffixes gives splitters, by which Spark range-partitions them; each bucket sorts
its suffixes by multikey quicksort (the first 8 bytes as one character, then, among equal ones,
the whole context; a bucket that is too large for one sort in several slices), so that equal suffixes are neighbours, and
neighbours tell what repeats. Leading bytes so frequent that they are several splitters at once
are dealt over all their buckets, and compared across these bucket boundaries by their windows.

Defined cases
  * texts are their UTF-8 bytes; null texts are empty; matches never cross documents.
  * texts of under 50 bytes lose nothing. Further columns are ignored.
  * rows that share a doc_id do not remove each other's bytes; a null doc_id is larger than all others.
  * an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks
from lakeshelf.llm.common import read
from lakeshelf.llm.repeats import Bytes, anchors, prefix, without_repeats

LENGTH, GRAM = 50, 16
# Splitters come from this share of the documents, one suffix in SAMPLE_STEP of each.
SAMPLE_SHARE, SAMPLE_STEP, SEED = 0.02, 8, 7


def _leading(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            seq = Bytes(batch)
            if len(seq.at) and seq.at[-1] >= length:
                _, k1, _, _, _, _ = anchors(seq, prefix(seq.values()), length, GRAM)
                yield pa.RecordBatch.from_arrays([pa.array((k1[::SAMPLE_STEP] ^ np.uint64(1 << 63)).view(np.int64))], names=["k"])
    return work


def splitters(length: int):
    """A function that gives the borders of ``parts`` ranges of leading bytes, from a sketch of bounded size."""
    def of(docs: DataFrame, parts: int) -> np.ndarray:
        shares = [i / parts for i in range(1, parts)]
        if not shares:
            return np.zeros(0, np.uint64)
        found = None
        for some in (docs.select("text").sample(SAMPLE_SHARE, SEED), docs.select("text")):  # all, if a few documents gave no sample
            sketch = F.percentile_approx("k", F.array(*map(F.lit, shares)), max(10_000, 20 * parts))
            found = found or some.mapInArrow(_leading(length), "k long").agg(sketch).first()[0]
        return np.array(found or [], np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return of


def without_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, removed (array of start, length in bytes: the maximal removed runs), kept (binary)."""
    return without_repeats(docs, Bytes, "n_bytes", length, GRAM, splitters(length))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeated_bytes(read(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
