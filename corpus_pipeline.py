"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet
and reads it again as the next one's documents. All stages but the last return the columns
of documents; rows and columns of any further name pass through. What the operators do with
nulls, ties and repeated rows is in their modules; here:

  * a document is dropped by the quality rules row by row, also where rows share a doc_id.
  * line dedup keeps all rows; where it changes a text, n_chars follows it.
  * near-dedup keeps the document with the smallest doc_id of each component, and of rows that share
    a doc_id the first in the order of their columns; rows with a null doc_id all stay.
  * decontamination drops all rows of a doc_id with a leak.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.llm import decontaminate, lines, neardup, pieces, quality
from lakeshelf.llm.common import fresh, read, release, stored, written
from lakeshelf.operators.joins import fits, maybe_broadcast

# Tables of ids are broadcast up to so many rows (under 100 bytes each), else joined by shuffle.
MAX_BROADCAST_IDS = 500_000


def _matching(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on all columns of ``ids``, nulls equal."""
    names = {c: fresh(docs.columns, f"_id_{c}") for c in ids.columns}
    ids = stored(ids.toDF(*names.values()), "pipeline-ids")
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(own)) for c, own in names.items()])
    return docs.join(maybe_broadcast(ids, fits(ids, MAX_BROADCAST_IDS)), on, how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that it rejects go."""
    mark = fresh(docs.columns, "_text")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    out = quality.judged(marked, ["doc_id", "lang", "source", mark]).filter(~F.col("kept"))
    return _matching(marked, out.select("doc_id", "lang", "source", mark).distinct(), "left_anti").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: recurring lines go."""
    out = lines.without_recurring(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _orderable(docs: DataFrame, name: str) -> Column:
    """The column, or its JSON where Spark cannot order its type (maps, also inside others)."""
    kind = docs.schema[name].dataType.simpleString()
    return F.to_json(F.struct(docs[name])) if "map<" in kind or kind == "variant" else docs[name]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 at a similarity of 0.8: one document of each component stays."""
    named = neardup.near_duplicates(docs, percent=80).filter("doc_id is not null")
    first = named.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = _matching(docs.filter("doc_id is not null"), first, "left_semi")
    twice = named.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    shared = _matching(kept, twice, "left_semi")
    order = Window.partitionBy("doc_id").orderBy(*[_orderable(docs, c).asc_nulls_first() for c in docs.columns])
    row = fresh(docs.columns, "_row")
    one = shared.withColumn(row, F.row_number().over(order)).filter(F.col(row) == 1).drop(row)
    return _matching(kept, twice, "left_anti").unionByName(one).unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    return _matching(docs, found.select("doc_id").distinct(), "left_anti")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: doc_id, n_tokens, ids (with begin and end ids), decoded_chars."""
    return pieces.encoded(docs, schema="doc_id long, n_tokens long, ids array<int>, decoded_chars long",
                          row=lambda ids, text: (len(ids), ids.astype("int32"), len(text)))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# Robust estimates, signatures and token ids have no SQL; the tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    before = written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, before, docs)
    return docs
