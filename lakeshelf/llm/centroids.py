"""Exact centroid clustering with a progressive search over Walsh-Hadamard coefficients (operator 11).

Vectors become integers, floor(scale * x). Their Walsh-Hadamard transform is exact in integers and
keeps squared distances up to the factor ``dim``, so a sum over some of the coefficients never passes the
whole: it is a lower bound. For each vector, coefficient differences to all centroids are added up
from coarse (few sign changes) to fine; after LEAD coefficients the leading centroid is finished, and at each further
step centroids whose partial sum already passes that distance are dropped (they are strictly
worse). The others finish all coefficients, and the nearest of them, by the smaller number on a tie, is
the exact answer.

A round is one pass over the vectors: tasks send at most 65 totals a centroid, Spark adds them up, and
the driver sees (dim + 1) numbers a centroid, whatever the number of vectors. No row is moved by its
cluster, so a cluster that holds a third of all vectors costs nothing.

Defined cases
  * vectors that are null, of another length, or hold a null, NaN or infinite component (also after the
    factor) are left out; an empty table, or one without a proper vector, gives an empty result.
  * repeated rows are vectors of their own. Of seeds with the same id (null ids come last), those
    with smaller components come first.
  * fewer vectors than centroids: as many centroids as vectors. A centroid without vectors stays where it is.
  * integers beyond 2^24 are worked on as Python's, exactly; a distance or sum that a long cannot hold is null, and
    a total of over 38 digits raises.
  * further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import read, small_batches, stored

DIM, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
LEAD = 8
EXACT = 1 << 24  # components up to this give transforms and sums within 64 bits
MAX_LONG = (1 << 63) - 1
WHOLE = pa.decimal128(38, 0)


def by_sign_changes(dim: int) -> np.ndarray:
    """Places of the natural-order transform, from few sign changes to many."""
    h = np.ones((1, 1), np.int64)
    while len(h) < dim:
        h = np.block([[h, h], [h, -h]])
    return np.argsort(np.count_nonzero(np.diff(h, axis=1), axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two long), coefficients from coarse to fine."""
    n, dim = x.shape
    step = 1
    while step < dim:
        pairs = x.reshape(n, dim // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dim)
        step *= 2
    return x[:, by_sign_changes(dim)]


def _least(part: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, in order: its least value, and where it stands first."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(part, starts)
    found = np.flatnonzero(part == np.repeat(least, np.diff(np.r_[starts, len(row)])))
    _, first = np.unique(row[found], return_index=True)
    return least, found[first]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid, and how many coefficient differences were taken."""
    n, k, dim = len(x), len(centroids), x.shape[1]
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, x.dtype), 0
    xs, cs = transform(x), transform(centroids)
    row, col = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    part = np.zeros(n * k, xs.dtype)
    bound, taken, lo, hi = None, 0, 0, 1
    while lo < dim:
        d = xs[row, lo:hi] - cs[col, lo:hi]
        part = part + (d * d).sum(axis=1)
        taken += d.size
        if hi >= LEAD and bound is None:
            _, at = _least(part, row)
            d = xs - cs[col[at]]
            bound = (d * d).sum(axis=1)
            taken += d.size
        if bound is not None:
            keep = part <= bound[row]
            row, col, part = row[keep], col[keep], part[keep]
        lo, hi = hi, 2 * hi
    least, at = _least(part, row)
    return col[at], least // dim, taken


def assigned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` for rows of doubles that hold integers of any size; distances are Python's integers where 64 bits may not do."""
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    wide = (np.abs(x) > EXACT).any(axis=1) | (max(abs(int(v)) for c in centroids for v in c) > EXACT)
    for rows, kind in ((np.flatnonzero(~wide), np.int64), (np.flatnonzero(wide), object)):
        if len(rows):
            own = x[rows].astype(np.int64) if kind is np.int64 else np.array([[int(v) for v in r] for r in x[rows]], object)
            cluster[rows], distance[rows], _ = nearest(own, np.array(centroids, kind))
    return cluster, distance


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: float) -> DataFrame:
    """id, x (array of doubles that hold the integers) of the proper vectors, as a stored table."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            long = pa.compute.list_value_length(b.column("x")).fill_null(-1).to_numpy(zero_copy_only=False) == dim
            b = b.filter(pa.array(long))
            x = _matrix(b.column("x"), dim)  # nulls are NaN here
            with np.errstate(over="ignore"):
                x = np.floor(x * scale)
            fine = np.isfinite(x).all(axis=1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x[fine].ravel()), dim).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(fine)), lists], names=["id", "x"])

    need = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("x"))
    return stored(need.mapInArrow(work, "id long, x array<double>"), "vectors")


def _totals(vectors: DataFrame, centroids: list[list[int]], dim: int) -> dict[int, list[int]]:
    """For each cluster: the sums of its vectors' components, then their number."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for b in batches:
            x = _matrix(b.column("x"), dim)
            cluster, _ = assigned(x, centroids)
            for c in np.unique(cluster):
                own = x[cluster == c]
                small = np.abs(own).max() <= EXACT
                add = own.astype(np.int64).sum(axis=0).tolist() if small else [sum(int(v) for v in col) for col in own.T]
                sums[int(c)] = [a + b for a, b in zip(sums.get(int(c), [0] * (dim + 1)), [*add, len(own)])]
        rows = [(c, i, Decimal(v)) for c, s in sums.items() for i, v in enumerate(s)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(zip(*rows), (pa.int32(), pa.int32(), WHOLE))], names=["cluster", "place", "total"])

    parts = vectors.select("x").mapInArrow(work, "cluster int, place int, total decimal(38,0)")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():  # at most k * (dim + 1) rows
        out.setdefault(r.cluster, [0] * (dim + 1))[r.place] = int(r.total)
    return out


def _long(value: int | None) -> int | None:
    return value if value is not None and value <= MAX_LONG else None


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, k: int = CENTROIDS,
              rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, list[list[int]], dict[int, int | None]]:
    """(id, cluster, distance of each proper vector; the final centroids; each cluster's summed distance, None beyond a long)."""
    spark = vectors.sparkSession
    small_batches(spark)
    ints = integer_vectors(vectors, id_col, vector_col, dim, scale)
    draw = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    seeds = ints.orderBy(draw.asc_nulls_last(), "x").limit(k).collect()  # k rows
    centroids = [[int(v) for v in r.x] for r in seeds]
    if not centroids:
        return ints.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], {}
    for _ in range(rounds):
        for c, (*sums, n) in _totals(ints, centroids, dim).items():
            centroids[c] = [s // n for s in sums]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, distance = assigned(_matrix(b.column("x"), dim), centroids)
            longs = pa.array([_long(int(d)) for d in distance], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(cluster.astype(np.int32)), longs], names=["id", "cluster", "distance"])

    out = stored(ints.mapInArrow(work, "id long, cluster int, distance long"), "clustered")
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("wide"))
    return out, centroids, {r.cluster: None if r.wide else int(r.s) for r in sums.collect()}  # k rows


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering of all embeddings, with inertias and digests of the final centroids."""
    out, centroids, sums = clustered(read(spark, sf_dir, "embeddings"))
    whole = None if None in sums.values() else sum(sums.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, _long(s), _long(whole), digest[c]) for c, s in sums.items()]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.withColumnRenamed("id", "vec_id").join(F.broadcast(named), "cluster").select(  # named has k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_KEPT = f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0)"""


def _sql() -> str:
    """Each round: all distances to the few centroids, the nearest, exact floors of the means."""
    steps = [_KEPT, f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS cluster, v AS c
  FROM kept QUALIFY cluster < {CENTROIDS})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS (
  SELECT vec_id, v, cluster, CAST(d AS BIGINT) AS d FROM (
    SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM (SELECT row_number() OVER () AS n, * FROM kept), c{r} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, cluster) = 1))""")
        if r < ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (
    SELECT cluster, unnest(v) AS x, unnest(range({DIM})) AS i FROM a{r}) GROUP BY ALL) GROUP BY cluster)""")
            steps.append(f"c{r + 1} AS (SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""


OP11_SQL = _sql()
