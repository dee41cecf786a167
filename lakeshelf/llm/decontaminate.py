"""Benchmark decontamination by spaced seeds (operator 5). DataFrame functions only.

A seed is a fixed mask over consecutive words that ignores some positions: two
texts that differ only there give the same seed hash. Benchmark and corpus
seeds are joined on that hash; each hit fixes how the item lies in the
document, and the words around it are compared on that alignment.

An item leaks into a document when, on one alignment, some 13 consecutive aligned
words (lower-cased, split at ``[ \\t-\\r]+``) have at least 11 equal, i.e. a
similarity of 0.8 with up to two substitutions. Each mask of MASKS alone
has, in any 13 words with any two substituted, a placement that avoids both
(``tests/llm`` enumerates this), so the seed join loses no such overlap.

Shorter items are compared whole: 0.8 of the words of items of 5 to 12 words must be equal, all of those of 3 or 4. The lighter
masks of SHORT_MASKS together avoid any one substitution in 5 words, so also the two that 10 to 12 words may
have (one half of them has one at most); items of 3 or 4 words have a mask of all their words.

Defined cases
  * items of one or two words are not sought (any text may hold them), nor empty or null ones.
  * null or empty texts contain nothing; a null doc_id is a document of its own; rows
    that share a doc_id are judged together.
  * items with equal words are searched for once and all reported.
  * empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import read, stored, words
from lakeshelf.operators.joins import fits, maybe_broadcast

MASKS = ("11010011", "11001011")
SHORT_MASKS = ("1101", "1011")
OVERLAP, EQUAL, WHOLE, SHORTEST = 13, 11, 5, 3
# Benchmark seeds are broadcast up to so many rows (24 bytes each), else joined by shuffle.
MAX_BROADCAST_SEEDS = 1_000_000


def _folded(text: Column) -> Column:
    return words(F.lower(text))


def _seeds(h: Column, masks) -> Column:
    """All seeds of an array of word hashes: array of (at, seed)."""
    def placed(mask):
        offsets = [i for i, b in enumerate(mask) if b == "1"]
        one = lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(mask), *[F.get(h, i + o) for o in offsets]).alias("seed"))
        last = F.size(h) - len(mask)
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one))
    return F.flatten(F.array_compact(F.array(*[placed(m) for m in masks])))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_equal, n_window, doc_word, item_word: the best overlap of each leak."""
    items = benchmark.select("item_id", _folded(F.col("text")).alias("w")).filter(F.size("w") >= SHORTEST)
    same = items.groupBy("w").agg(F.collect_set(F.struct("item_id")).alias("item_ids"))
    same = same.select(F.xxhash64("w").alias("rep"), "w", "item_ids", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    items = stored(same, "items")
    lengths = [r[0] for r in items.filter(F.size("w") < OVERLAP).select(F.size("w")).distinct().collect()]  # 10 values at most
    # Masks, and the least and greatest length of the items they are for; those without such items are left out.
    kinds = [(MASKS, OVERLAP, None), (SHORT_MASKS, WHOLE, OVERLAP - 1), *[(("1" * n,), n, n) for n in range(SHORTEST, WHOLE)]]
    kinds = [(m, lo, hi) for m, lo, hi in kinds if hi is None or any(lo <= n <= hi for n in lengths)]
    seeds = [items.filter(F.size("w").between(lo, hi) if hi else F.size("w") >= lo).select("rep", F.inline(_seeds(F.col("h"), m))) for m, lo, hi in kinds]
    seeds = stored(reduce(DataFrame.unionByName, seeds).select("rep", F.col("at").alias("item_at"), "seed").distinct(), "seeds")
    small = fits(seeds, MAX_BROADCAST_SEEDS)

    masks = [x for m, _, _ in kinds for x in m]
    hashed = docs.select("doc_id", F.transform(_folded(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    # inline would add a test that the array is not empty, for which Spark computes all seeds a second time.
    placed = hashed.select("doc_id", F.inline_outer(_seeds(F.col("h"), masks)))
    hits = placed.join(maybe_broadcast(seeds, small), "seed").select("doc_id", "rep", (F.col("at") - F.col("item_at")).alias("shift"))
    # One row per document; the written table gives the planner its size for the next join.
    hits = hits.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("rep", "shift")).alias("hits"))
    hits = stored(hits.withColumnRenamed("doc_id", "hit_id"), "hits")

    at = docs.select("doc_id", "text").join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")))
    at = at.select("doc_id", F.transform(_folded(F.col("text")), lambda w: F.xxhash64(w)).alias("d"), F.explode("hits").alias("hit"))
    at = at.join(maybe_broadcast(items.select("rep", "h"), small), F.col("hit.rep") == F.col("rep"))
    first = F.greatest(F.lit(0), -F.col("hit.shift"))
    last = F.least(F.size("h"), F.size("d") - F.col("hit.shift"))
    equal = F.transform(F.sequence(F.lit(0), F.size("h") - 1), lambda j: (
        F.get("h", j).eqNullSafe(F.get("d", j + F.col("hit.shift")))).cast("int"))
    wide = F.least(F.size("h"), F.lit(OVERLAP))
    at = at.select("doc_id", "rep", F.col("hit.shift").alias("shift"), first.alias("first"), last.alias("last"), wide.alias("wide"), equal.alias("e"))
    at = at.filter(F.col("last") - F.col("first") >= F.col("wide"))
    window = lambda s: F.struct(F.aggregate(F.slice("e", s + 1, F.col("wide")), F.lit(0), lambda a, x: a + x).alias("n_equal"), (-s).alias("s"))
    best = F.array_max(F.transform(F.sequence(F.col("first"), F.col("last") - F.col("wide")), window))
    at = at.withColumn("best", best)
    need = F.when(F.col("wide") >= OVERLAP, EQUAL).when(F.col("wide") >= WHOLE, F.floor((4 * F.col("wide") + 4) / 5)).otherwise(F.col("wide"))
    at = at.filter(F.col("best.n_equal") >= need)
    found = at.groupBy("doc_id", "rep").agg(F.max(F.struct(
        F.col("best.n_equal").alias("n_equal"), (F.col("best.s") - F.col("shift")).alias("neg_doc"), F.col("best.s").alias("neg_item"), "wide")).alias("b"))
    found = found.join(items.select("rep", F.inline("item_ids")), "rep")
    return found.select("doc_id", "item_id", F.col("b.n_equal").cast("long").alias("n_equal"), F.col("b.wide").cast("long").alias("n_window"),
                        (-F.col("b.neg_doc")).cast("long").alias("doc_word"), (-F.col("b.neg_item")).cast("long").alias("item_word"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_equal", "n_window")


OP5_SQL = r"""
WITH d0 AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
b0 AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT doc_id, len(w) AS nd, unnest(w) AS x, unnest(range(len(w))) AS p FROM d0),
b AS (SELECT item_id, len(w) AS nb, CASE WHEN len(w) >= 13 THEN 11 WHEN len(w) >= 5 THEN (4 * len(w) + 4) // 5 ELSE len(w) END AS need, unnest(w) AS x, unnest(range(len(w))) AS j FROM b0 WHERE len(w) >= 3),
m AS (SELECT doc_id, item_id, nd, nb, need, p - j AS shift, j FROM d JOIN b USING (x)),
c AS (SELECT doc_id, item_id, nd, nb, need, shift,
        count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS n
      FROM (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= need)),
ok AS (SELECT * FROM c WHERE least(nb, nd - shift) - greatest(0, -shift) >= least(nb, 13) AND n >= need)
SELECT doc_id, item_id, max(n) AS n_equal, CAST(max(least(nb, 13)) AS BIGINT) AS n_window FROM ok GROUP BY doc_id, item_id
"""
