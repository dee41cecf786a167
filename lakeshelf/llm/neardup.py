"""MinHash near-duplicates by an inverted join of signature coordinates (operator 7).

Texts (A-Z lower-cased) become sets of 5-word shingles. Texts with equal sets are one class,
and the class's smallest doc_id stands for it. Each class is posted under coordinate-value
pairs of its MinHash signature. A pair of classes of the least similarity that links (``percent``: 85 in the
query, 80 in the pipeline) agrees in ``least`` of the COORDS coordinates (40 at 85, 35 at 80)
but for a chance of a few in a million, and then shares one of
the first COORDS - least + 1 coordinates in any common order of the pairs. The order is by
frequency, rarest first, so the long lists are skipped: a class is posted only under its rarest values
(the prefix). Frequencies come from a sketch of fixed size over all classes; its errors change the
order for everyone alike, and so lose nothing.

Links need not be listed to find components. In each list, the class with the most frequent values (the
hub, often the original of a group) is compared with every other one, and each class is verified
against its best hub. Then only classes of one list that are in different components yet remain: those
outside the list's largest component are compared, in blocks, with all of the list. A pair is looked at in
one list alone, counts as a candidate if ``least`` coordinates agree, and is confirmed on the full sets. No pairs
are written but confirmed links, one for each class and component met, so output grows with the lists.

Defined cases
  * texts of under 5 words: one shingle, the whole sequence; no words or null text: the empty set, linked with nothing.
  * a null doc_id: no component, kept; it takes part in no link.
  * rows that share a doc_id are each judged by their own text; if both stand for a class they are one in the graph.
  * an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks, gather, text_bytes
from lakeshelf.llm.common import parallelism, read, release, small_batches, stored, written
from lakeshelf.llm.components import components
from lakeshelf.llm.repeats import Words, mix, prefix, span
from lakeshelf.operators.joins import fits, maybe_broadcast

SHINGLE, PERCENT = 5, 85
COORDS, MISSED = 64, 2.5e-6  # chance that a pair at the threshold agrees in fewer coordinates than are asked for
SKETCH_BITS = 20  # the sketch of frequencies has 2 ** SKETCH_BITS counts (8 MB) whatever the input
BLOCK = 256
MAX_BROADCAST_IDS = 1_000_000
U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = mix(np.arange(1, COORDS + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)


def agreeing(percent: int) -> int:
    """The most coordinates that a pair of similarity percent / 100 agrees in but for a chance of MISSED."""
    p, below, least = percent / 100, 0.0, 0
    while least < COORDS and (below := below + comb(COORDS, least) * p ** least * (1 - p) ** (COORDS - least)) <= MISSED:
        least += 1
    return max(least, 1)


class _Folded(Words):
    """Words with A-Z lower-cased."""

    def __init__(self, batch: pa.RecordBatch):
        super().__init__(batch)
        self.buf = _LOWER[self.buf]


def _sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, one after the other; and the bounds."""
    seq = _Folded(batch)
    values = seq.values()
    sums = prefix(values)
    count = np.diff(seq.at)
    size = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), size)
    start = np.repeat(seq.at[:-1], size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    end = np.minimum(start + n, seq.at[1:][row])
    h = mix(span(sums, start, end) + (end - start).astype(U) * U(0xA0761D6478BD642F))
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def _sign(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            h, at = _sets(batch, n)
            size = np.diff(at)
            rows = np.flatnonzero(size)
            first = at[:-1][rows]
            both, sig = np.zeros((2, len(size)), U), np.zeros((len(size), COORDS), np.uint32)
            if len(rows):
                both[0, rows] = np.add.reduceat(mix(h ^ U(0x5851F42D4C957F2D)), first)
                both[1, rows] = np.add.reduceat(mix(h ^ U(0x14057B7EF767814F)), first)
                for j, seed in enumerate(_SEEDS):
                    sig[rows, j] = np.minimum.reduceat(((h ^ (h >> U(29))) * seed >> U(32)).astype(np.uint32), first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(both[0].view(np.int64)), pa.array(both[1].view(np.int64)),
                 pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc_id", "n_shingles", "s1", "s2", "sig"])
    return work


def signed(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, s1, s2 (128-bit identity of the set), sig (COORDS 32-bit minima)."""
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return d.mapInArrow(_sign(n), "doc_id long, n_shingles long, s1 long, s2 long, sig binary")


def _signatures(column: pa.Array) -> np.ndarray:
    buf, _ = text_bytes(column)
    return np.frombuffer(buf.tobytes(), np.uint32).reshape(-1, COORDS)


def _keys(sig: np.ndarray) -> np.ndarray:
    return mix(sig.astype(U) | np.arange(COORDS, dtype=U)[None, :] << U(32))


SLICES = 16


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for part in range(0, batch.num_rows, 4096):
            keys = _keys(_signatures(batch.column("sig").slice(part, 4096)))
            total += np.bincount((keys >> U(64 - SKETCH_BITS)).astype(np.int64).ravel(), minlength=len(total))
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(SLICES, -1)], pa.binary())], names=["slice", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
            total[s] = total.get(s, 0) + np.frombuffer(c, np.int64)
    for s, c in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([c.tobytes()], pa.binary())], names=["slice", "counts"])


def frequencies(classes: DataFrame) -> np.ndarray:
    """Counts of hashed coordinate-value pairs over all classes: 2 ** SKETCH_BITS numbers."""
    schema = "slice int, counts binary"
    rows = classes.select("sig").mapInArrow(_count, schema).repartitionById(SLICES, F.col("slice")).mapInArrow(_add, schema).collect()
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    for r in rows:
        out[r["slice"]] += np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def _prefix(sig: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the coordinates of the COORDS - least + 1 rarest (a row each), and how frequent all values of a row are together."""
    keys = _keys(sig)
    often = counts[(keys >> U(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(np.minimum(often, 1 << 30).astype(U) << U(33) | keys >> U(31), axis=1, kind="stable")
    return keys, order[:, :COORDS - least + 1], often.sum(1)


def _post(shared, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for part in range(0, batch.num_rows, 2048):
                b = batch.slice(part, 2048)
                keys, coords, often = _prefix(_signatures(b.column("sig")), counts, least)
                rep = b.column("rep").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.take_along_axis(keys, coords, 1).ravel().view(np.int64)), pa.array(coords.ravel().astype(np.int32)),
                     pa.array(np.repeat(rep, coords.shape[1])), pa.array(np.repeat(often, coords.shape[1]))], names=["key", "coord", "rep", "often"])
    return work


def _agree(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 4096):
                b = batch.slice(part, 4096)
                same = (_signatures(b.column("a_sig")) == _signatures(b.column("b_sig"))).sum(1)
                ok = same >= least
                yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok)), pa.array(same[ok].astype(np.int32))], names=["a", "b", "same"])
    return work


def _set_rows(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            h, at = _sets(batch, n)
            sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], names=["id", "shingles"])
    return work


def _sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """Full shingle sets of the documents whose id is in ``ids`` (column id)."""
    ids = stored(ids.distinct(), "set-ids")
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    d = d.join(maybe_broadcast(ids, fits(ids, MAX_BROADCAST_IDS)), d["doc_id"] == ids["id"], "left_semi")
    return stored(d.mapInArrow(_set_rows(n), "id long, shingles array<long>"), "sets")


def _linked(a, b, both, percent: int) -> object:
    """Whether sets of sizes a and b with ``both`` in common are similar enough."""
    return both * 100 >= (a + b - both) * percent


class _Block:
    """The rows of a list's block: the classes to compare with all of the list."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.whole: tuple | None = None

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)

    def columns(self) -> tuple:
        if self.whole is None:
            self.whole = tuple(np.concatenate(c) for c in zip(*self.parts))
        return self.whole


def _candidates(left: tuple, right: tuple, coord: int, least: int) -> np.ndarray:
    """Pairs (left x right) in different components that agree in ``least`` coordinates and have this list as their first common one."""
    _, l_comp, l_sig, l_mask = left[:4]
    _, r_comp, r_sig, r_mask = right[:4]
    same = l_sig[:, None, :] == r_sig[None, :, :]
    ok = (same.sum(2) >= least) & (l_comp[:, None] != r_comp[None, :])
    i, j = np.nonzero(ok)
    if len(i):
        bits = np.packbits(same[i, j], axis=1, bitorder="little").view(U).ravel() & l_mask[i] & r_mask[j]
        keep = (bits & (~bits + U(1))) == U(1) << U(coord)
        i, j = i[keep], j[keep]
    return i, j


def _compare(confirm: bool, least: int, percent: int):
    """Rows come by (key, blk), those of the block (role 0) first. Without ``confirm``: (key, id) of all candidates;
    with it: the confirmed links, one for each class of the block and component met."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, _Block()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                key, blk, role, coord, ids, comp = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "blk", "role", "coord", "id", "comp")]
                sig, mask = _signatures(b.column("sig")), b.column("mask").to_numpy(zero_copy_only=False).view(U)
                if confirm:
                    sets = b.column("shingles")
                    flat, bounds = sets.flatten().to_numpy(zero_copy_only=False).view(U), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))])
                edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (blk[1:] != blk[:-1]) | (role[1:] != role[:-1]), [True]]))
                out: list[tuple[np.ndarray, np.ndarray]] = []
                for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    group = (key[s], blk[s])
                    if group != now:
                        now, block = group, _Block()
                    mine = [ids[s:e], comp[s:e], sig[s:e], mask[s:e]]
                    if role[s] == 0:
                        if confirm:
                            block.add(*mine, np.array([flat[bounds[x]:bounds[x + 1]] for x in range(s, e)] + [None], object)[:-1])
                        else:
                            block.add(*mine)
                        continue
                    if not block.parts:  # no class fell to this block
                        continue
                    left = block.columns()
                    for t in range(s, e, 256):  # BLOCK x 256 x COORDS comparisons at a time
                        right = [c[t - s:t - s + 256] for c in mine]
                        i, j = _candidates(left, right, int(coord[s]), least)
                        if not len(i):
                            continue
                        if not confirm:
                            found = np.unique(np.concatenate([left[0][i], right[0][j]]))
                            out.append((np.full(len(found), key[s]), found))
                            continue
                        for u in np.unique(i).tolist():
                            own, xs = left[4][u], j[i == u]
                            lo, size = bounds[t + xs], bounds[t + xs + 1] - bounds[t + xs]
                            x = gather(flat, lo, size)
                            place = np.minimum(np.searchsorted(own, x), len(own) - 1)
                            both = np.add.reduceat((own[place] == x).astype(np.int64), np.cumsum(size) - size)
                            xs = xs[_linked(len(own), size, both, percent)]
                            if len(xs):
                                _, first = np.unique(right[1][xs], return_index=True)
                                out.append((np.full(len(first), left[0][u]), right[0][xs[first]]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b"])
    return work


def _masked(shared, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [np.zeros(0, U)]
            for part in range(0, batch.num_rows, 2048):
                _, coords, _ = _prefix(_signatures(batch.column("sig").slice(part, 2048)), shared.value, least)
                masks.append(np.bitwise_or.reduce(U(1) << coords.astype(U), axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("sig"), pa.array(np.concatenate(masks).view(np.int64))], names=["id", "sig", "mask"])
    return work


def _blocks(lists: DataFrame, comps: DataFrame, about: DataFrame, parts: int) -> DataFrame:
    """Rows of the lists that still hold several components, dealt for ``_compare``."""
    at = lists.join(comps, lists["id"] == comps["node"], "left").select("key", "coord", "id", F.coalesce("component", "id").alias("comp"))
    at = stored(at, "list-components")
    sizes = at.groupBy("key", "comp").count().groupBy(F.col("key").alias("k")).agg(
        F.max(F.struct("count", "comp")).alias("most"), F.sum("count").alias("all"), F.count("*").alias("n"))
    sizes = sizes.filter("n > 1").select("k", F.col("most.comp").alias("main"), F.ceil((F.col("all") - F.col("most.count")) / BLOCK).cast("int").alias("nb"),
                                         F.ceil(F.col("all") / (2 * BLOCK)).cast("int").alias("na"))
    at = at.join(stored(sizes, "list-sizes"), F.col("key") == F.col("k"))
    # Both sides of a long list are dealt in blocks, and each pair of blocks is a group of its own.
    own = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    mine = at.filter(F.col("comp") != F.col("main")).withColumn("blk", F.explode(F.sequence(own * F.col("na"), own * F.col("na") + F.col("na") - 1)))
    other = F.pmod(F.xxhash64("id", F.lit(1)), F.col("na")).cast("int")
    every = at.withColumn("blk", F.explode(F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda b: b * F.col("na") + other)))
    rows = mine.withColumn("role", F.lit(0)).unionByName(every.withColumn("role", F.lit(1)))
    rows = rows.select("key", "blk", "role", "coord", F.col("id").alias("i"), "comp")
    rows = rows.join(about, F.col("i") == F.col("id")).drop("i")
    return rows.repartition(parts, "key", "blk").sortWithinPartitions("key", "blk", "role")


def links(docs: DataFrame, classes: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Confirmed links (a, b) between classes that give the same components as all links. ``classes``: rep, n, sig."""
    spark = docs.sparkSession
    parts, least = parallelism(spark), agreeing(percent)
    shared = spark.sparkContext.broadcast(frequencies(classes))  # 8 MB, whatever the input
    posts = classes.select("rep", "sig").mapInArrow(_post(shared, least), "key long, coord int, rep long, often long")
    hubs = posts.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("m"), F.max(F.struct("often", (-F.col("rep")).alias("r"))).alias("h"))
    hubs = hubs.filter("m > 1").select("k", (-F.col("h.r")).alias("hub"))
    lists = stored(posts.join(hubs, F.col("key") == F.col("k")).select("key", "coord", F.col("rep").alias("id"), "hub"), "lists")

    # Each class against the hub that it agrees most with.
    pairs = lists.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sig = classes.select(F.col("rep").alias("i"), "sig")
    pairs = pairs.join(sig, F.col("a") == F.col("i")).drop("i").withColumnRenamed("sig", "a_sig")
    pairs = pairs.join(sig, F.col("b") == F.col("i")).drop("i").withColumnRenamed("sig", "b_sig")
    best = pairs.mapInArrow(_agree(least), "a long, b long, same int").groupBy("b").agg(F.max(F.struct("same", (-F.col("a")).alias("a"))).alias("x"))
    best = stored(best.select((-F.col("x.a")).alias("a"), "b"), "best-hubs")
    sets = _sets_of(docs, best.select(F.col("a").alias("id")).union(best.select("b")), n)
    x, y = [sets.select(F.col("id").alias(f"{c}_id"), F.col("shingles").alias(f"{c}_set")) for c in "xy"]
    tried = best.join(x, F.col("b") == F.col("x_id")).join(y, F.col("a") == F.col("y_id"))
    both = F.size(F.array_intersect("x_set", "y_set"))
    first = stored(tried.filter(_linked(F.size("x_set"), F.size("y_set"), both, percent)).select("a", "b"), "hub-links")

    # What is left: classes of one list in different components.
    comps = components(first)
    about = stored(classes.select("rep", "sig").mapInArrow(_masked(shared, least), "id long, sig binary, mask long"), "prefixes")
    schema = "a long, b long"
    found = _blocks(lists.select("key", "coord", "id"), comps, about, parts).mapInArrow(_compare(False, least, percent), schema).distinct()
    found = stored(found.select(F.col("a").alias("fk"), F.col("b").alias("fi")), "candidates")
    again = lists.select("key", "coord", "id").join(found, (F.col("key") == F.col("fk")) & (F.col("id") == F.col("fi")), "left_semi")
    sets = _sets_of(docs, found.select(F.col("fi").alias("id")), n)
    known = about.join(sets.withColumnRenamed("id", "s"), F.col("id") == F.col("s")).drop("s")
    second = _blocks(again, comps, known, parts).mapInArrow(_compare(True, least, percent), schema).distinct()
    return first.unionByName(stored(second, "list-links"))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (null for a null doc_id) of each document; sets of a similarity of ``percent`` link."""
    spark, before = docs.sparkSession, written()
    small_batches(spark)
    every = stored(signed(docs, n), "signed")
    classes = every.filter("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = stored(classes, "classes")
    comps = components(links(docs, classes, n, percent))
    named = classes.join(comps, F.col("rep") == F.col("node"), "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("n_shingles").alias("cn"), F.coalesce("component", "rep").alias("component_id"))
    same = (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n_shingles") == F.col("cn"))
    named = stored(named, "class-components")
    release(spark, before, every, named)
    out = every.drop("sig").join(named, same, "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"), percent=85)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
