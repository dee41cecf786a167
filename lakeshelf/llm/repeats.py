"""Repeated windows of n symbols over all documents, by anchors (operator 9); its helpers serve operator 3 too.

A window that starts in a document is removed if the same n symbols also start in a
document with a smaller doc_id. To find these without shuffling every window, each window
chooses an anchor: of the k-symbol grams in it, the one with the least hash. Equal windows choose
equal anchors at equal places, so only anchors (about 2 in n - k + 2 positions) are shuffled.

  scan      each task finds its anchors and the hash of the context of each: the n - 1 symbols
            on either side that a window with this anchor can have. Of equal contexts in a task
            only those of the smallest doc_id go on; the others are repeats already.
  resolve   buckets of anchors with equal grams lie together. Of equal contexts, all but those of
            the smallest doc_id are repeats as a whole. Of the windows of the others, half reach far
            ahead of the anchor and half far behind it: each half shares 33 or 34 bytes. Only where several documents
            have these too does the first document of each context have to look at the windows one by one.
  windows   these windows alone are hashed, and the smallest doc_id of each decides.
  removed   the document's own symbols and all that was found for it meet once more.

Grams alone would not do: in a large corpus most of them come in several documents, and nearly all windows would be hashed.

Rows between the steps are packed arrays, a few for each task and bucket. There are as many buckets as the texts need
(PART_BYTES each), whatever the session's number, and a bucket that is larger still is worked on in slices. Each step that has to see a
text again sends the texts and the findings to the same partition, by row; nothing is collected.
Rows are told apart by doc_id and a hash of the text, so rows that share a doc_id are
documents of their own, none smaller than the other. A null doc_id counts as larger than all others.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks, gather, text_bytes
from lakeshelf.llm.common import parallelism, shuffles_deleted, small_batches, stored

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
NO_ID = (1 << 63) - 1  # a null doc_id
FLUSH = 1_000_000  # anchors that a task holds before it sends them on
PART_BYTES = 24 << 20  # of text for each partition, at most
HELD_BYTES = 64 << 20  # of unpacked arrays that a task works on at once
FOUND = "part int, kind int, blob binary"
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD ** i and its inverse, modulo 2 ** 64, for i up to n."""
    if len(_powers[0]) <= n:
        m = max(n + 1, 1 << 20)
        for k, base in enumerate((ODD, U(pow(int(ODD), -1, 1 << 64)))):
            steps = np.full(m, base, U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums from which ``span`` gives the polynomial hash of any run of values."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0][:len(values)], out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def sliding(a: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over each w neighbours."""
    have = 1
    while have * 2 <= w:
        a = f(a[:-have], a[have:])
        have *= 2
    return f(a[:len(a) - (w - have)], a[w - have:]) if w > have else a


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, like bytes of the numbers side by side and compressed."""
    parts = [(a.dtype.str, len(a), a.view(np.uint8).reshape(len(a), -1).T.tobytes()) for a in arrays]
    raw = pickle.dumps(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
    return [np.frombuffer(b, np.uint8).reshape(-1, n).T.copy().view(d).reshape(-1) if n else np.zeros(0, d) for d, n, b in pickle.loads(raw)]


def joined(blobs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    """The arrays of several blobs, each put together."""
    opened = [unpack(b) for b in blobs]
    return [np.concatenate([o[i] for o in opened]) if opened else np.zeros(0, k) for i, k in enumerate(kinds)]


def slices(blobs: list[bytes], kinds: tuple, held: int | None = None) -> Iterator[list[np.ndarray]]:
    """As ``joined``, but of more than ``held`` bytes one slice after the other; equal values of the first array come in the same slice."""
    times = -(-sum(int.from_bytes(b[:8], "little") for b in blobs) // (held or HELD_BYTES))
    if times <= 1:
        yield joined(blobs, kinds)
        return
    for i in range(times):
        some = []
        for blob in blobs:
            arrays = unpack(blob)
            mine = mix(arrays[0]) % U(times) == U(i)
            some.append([a[mine] for a in arrays])
        yield [np.concatenate(a) for a in zip(*some)]


class Bytes:
    """Texts of a batch as sequences of bytes."""

    def __init__(self, batch: pa.RecordBatch):
        self.buf, self.at = text_bytes(batch.column("text"))

    def values(self) -> np.ndarray:
        return self.buf.astype(U) + U(1)

    def grams(self, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each position the next 8 bytes as a number that sorts like them, and the hash of the k - 8 after."""
        v = self.buf.astype(U)
        for s in (1, 2, 4):
            v = v[:-s] << U(8 * s) | v[s:]
        n = len(self.buf) - k + 1
        i = np.arange(n)
        return v[:n], (mix(span(sums, i + 8, i + k)) >> U(32)).astype(np.uint32)

    def kept(self, covered: np.ndarray) -> pa.Array:
        left = np.concatenate([[0], np.cumsum(~covered)])[self.at]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(left) - 1, [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(self.buf[~covered])]).cast(pa.binary())


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words:
    """Texts of a batch as sequences of words, by a hash of each."""

    def __init__(self, batch: pa.RecordBatch):
        self.buf, offsets = text_bytes(batch.column("text"))
        n = len(self.buf)
        apart = np.ones(n + 1, bool)  # position i: a space
        apart[:n] = SPACE[self.buf]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.ones(n + 1, bool)
        before[1:] = apart[:-1]
        self.start = np.flatnonzero(~apart & (before | cut))
        after = apart | cut
        self.end = np.flatnonzero(~apart[:n] & after[1:]) + 1
        self.at = np.searchsorted(self.start, offsets)

    def values(self) -> np.ndarray:
        sums = prefix(self.buf.astype(U) + U(1))
        return mix(span(sums, self.start, self.end) + (self.end - self.start).astype(U) * U(0xC2B2AE3D27D4EB4F))

    def grams(self, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        i = np.arange(len(self.start) - k + 1)
        return mix(span(sums, i, i + k)), np.zeros(len(i), np.uint32)

    def kept(self, covered: np.ndarray) -> pa.Array:
        """Remaining words joined by one space."""
        start, size = self.start[~covered], (self.end - self.start)[~covered] + 1
        text = gather(np.append(self.buf, np.uint8(0x20)), start, size)
        ends = np.cumsum(size)
        text[ends - 1] = 0x20
        n_kept = np.concatenate([[0], np.cumsum(~covered)])[self.at]
        at = np.concatenate([[0], ends])[n_kept]
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)])
        lengths = np.maximum(np.diff(at) - 1, 0)
        return pa.array([x[:n] for x, n in zip(whole.to_pylist(), lengths.tolist())], pa.binary())


def anchors(seq, sums: np.ndarray, n: int, k: int):
    """Anchor positions, their grams' first part, whether windows that reach ahead and that reach behind have them; and for each
    position its rank, for each window start the least rank in the window (0: no window)."""
    total = int(seq.at[-1])
    if total < n:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    k1, k2 = seq.grams(sums, k)
    rank = (mix(k1 + k2.astype(U) * ODD) >> U(32)).astype(np.uint32) | np.uint32(1)
    w, near = n - k + 1, ahead(n, k)
    least = sliding(rank, w, np.minimum)
    end = np.repeat(seq.at[1:], np.diff(seq.at))[:len(least)]
    least[np.arange(len(least)) + n > end] = 0
    pad = np.zeros(w - 1, np.uint32)
    padded = np.concatenate([pad, least, pad])  # the windows that hold position i start at padded[i] to padded[i + w - 1]
    before = sliding(padded, w - near, np.maximum)[:len(rank)] == rank
    after = sliding(padded, near, np.maximum)[w - near:][:len(rank)] == rank
    i = np.flatnonzero(before | after)
    return i, k1[i], after[i], before[i], rank, least


def ahead(n: int, k: int) -> int:
    """How many of the n - k + 1 places that an anchor can have in a window count as near its start: such windows reach ahead."""
    return (n - k) // 2 + 1


def row_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """doc_id (null as NO_ID) and a 32-bit hash of the text for each row."""
    doc = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    buf, at = text_bytes(batch.column("text"))
    sums = prefix(buf.astype(U) + U(1))
    h = mix(span(sums, at[:-1], at[1:]) + np.diff(at).astype(U))
    return doc, (h >> U(32)).astype(np.uint32)


def home_of(doc: np.ndarray, tag: np.ndarray, parts: int) -> np.ndarray:
    """The partition in which a row meets what was found for it."""
    return (mix(doc.view(U) * ODD + tag.astype(U)) % U(parts)).astype(np.int32)


def dealt(part: np.ndarray, kind: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row for each partition that gets something."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    arrays = [a[order] for a in arrays]
    for s, e in zip(edge[:-1], edge[1:]):
        yield pa.RecordBatch.from_arrays([pa.array([int(part[s])], pa.int32()), pa.array([kind], pa.int32()), pa.array([pack(*[a[s:e] for a in arrays])], pa.binary())],
                                         names=["part", "kind", "blob"])


def findings(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, kind: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Findings, sent to the rows' home partitions."""
    order = np.lexsort((pos, tag, doc))
    doc, tag, pos = doc[order], tag[order], pos[order]
    yield from dealt(home_of(doc, tag, parts), kind, doc, tag, pos)


def _smallest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each entry the least doc among those with the same key."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if not len(first):
        return doc.copy()
    least = np.minimum.reduceat(doc[order], first)
    out = np.empty_like(doc)
    out[order] = np.repeat(least, np.diff(np.append(first, len(key))))
    return out


ANCHOR = (U, U, np.uint32, np.uint32, np.int64, np.uint32, np.int32)  # gram, context, near ones ahead and behind, doc, tag, position
WINDOW = (U, np.int64, np.uint32, np.int32)  # hash, doc, tag, position
PLACE = (np.int64, np.uint32, np.int32)  # doc, tag, position
# Kinds of packed rows; texts come last in their partition.
SENT, RESOLVED, AHEAD, BEHIND, REPEATED, TEXT = range(6)


def _near(there: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """24 bits of the hashes, 0 where nothing is there."""
    return np.where(there, np.maximum(hashed >> U(40), U(1)), U(0)).astype(np.uint32)


def _scan(make: Callable, n: int, k: int, parts: int, bucket: Callable):
    near = ahead(n, k)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            k1, ctx, front, back, doc, tag, pos = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            repeat = doc > _smallest(mix(k1) ^ ctx, doc)
            yield from findings(doc[repeat], tag[repeat], pos[repeat], RESOLVED, parts)
            k1, ctx, front, back, doc, tag, pos = [c[~repeat] for c in (k1, ctx, front, back, doc, tag, pos)]
            yield from dealt(bucket(k1, ctx), SENT, k1, ctx, front, back, doc, tag, pos)

        size = 0
        for batch in chunks(batches):
            seq = make(batch)
            if not len(seq.at) or seq.at[-1] < n:
                continue
            sums = prefix(seq.values())
            i, k1, after, before, _, _ = anchors(seq, sums, n, k)
            row = np.searchsorted(seq.at, i, side="right") - 1
            start, end = np.maximum(seq.at[row], i - (n - k)), np.minimum(seq.at[row + 1], i + n)
            ctx = mix(span(sums, start, end) + mix((i - start).astype(U) << U(32) | (end - i).astype(U)))
            # What all windows share that reach ahead: up to n - near + 1 symbols from the anchor on; behind: near symbols before it, and it.
            front = _near(after, mix(span(sums, i, np.minimum(i + n - near + 1, end))))
            back = _near(before, mix(span(sums, np.maximum(i - near, start), i + k)))
            doc, tag = row_keys(batch)
            held.append([k1, ctx, front, back, doc[row], tag[row], (i - seq.at[row]).astype(np.int32)])
            size += len(i)
            if size >= FLUSH:
                yield from flush()
                size = 0
        if held:
            yield from flush()
    return work


def multikey(*keys: np.ndarray) -> np.ndarray:
    """Order by the keys in turn; entries that differ in one key are not compared by the next."""
    order = np.argsort(keys[0], kind="stable")
    tied = np.concatenate([[False], keys[0][order][1:] == keys[0][order][:-1]]) if len(order) else np.zeros(0, bool)
    for key in keys[1:]:
        if not tied.any():
            break
        run = np.cumsum(~tied)
        among = np.flatnonzero(tied | np.append(tied[1:], False))  # entries with an equal neighbour so far
        order[among] = order[among][np.lexsort((key[order[among]], run[among]))]
        sorted_key = key[order]
        tied = tied & np.concatenate([[False], sorted_key[1:] == sorted_key[:-1]])
    return order


def _several(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each entry whether those with the same key are of several docs."""
    order = np.argsort(key, kind="stable")
    sorted_key, doc = key[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(key) else np.zeros(0, np.int64)
    out = np.zeros(len(key), bool)
    if len(first):
        out[order] = np.repeat(np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first), np.diff(np.append(first, len(doc))))
    return out


def _resolve(parts: int, spread: Callable):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for batch in batches for b in batch.column("blob").to_pylist()]
        for k1, ctx, front, back, doc, tag, pos in slices(blobs, ANCHOR):
            if not len(k1):
                continue
            order = multikey(k1, ctx)
            k1, ctx, front, back, doc, tag, pos = [c[order] for c in (k1, ctx, front, back, doc, tag, pos)]
            first = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (ctx[1:] != ctx[:-1])]))
            least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(doc))))
            repeat = doc > least
            yield from findings(doc[repeat], tag[repeat], pos[repeat], RESOLVED, parts)
            for kind, near in ((AHEAD, front), (BEHIND, back)):
                look = np.flatnonzero(~repeat & (near > 0))
                look = look[spread(k1[look]) | _several(mix(k1[look]) + near[look].astype(U) * ODD, doc[look])]
                yield from findings(doc[look], tag[look], pos[look], kind, parts)
    return work


def _meet(batches: Iterator[pa.RecordBatch], kinds: tuple) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """For each batch of texts, the findings of its partition, which come first: kind -> (row key, doc, tag, pos) sorted."""
    blobs: dict[int, list[bytes]] = {kind: [] for kind in kinds}
    found = None
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        n = int(np.searchsorted(kind, TEXT))
        for k, blob in zip(kind[:n].tolist(), batch.column("blob").slice(0, n).to_pylist()):
            blobs[k].append(blob)
        if n < len(kind):
            if found is None:
                found = {}
                for k in kinds:
                    doc, tag, pos = joined(blobs.pop(k), PLACE)
                    key = mix(doc.view(U) * ODD + tag.astype(U))
                    order = np.argsort(key, kind="stable")
                    found[k] = key[order], pos[order]
            yield found, batch.slice(n)


def _of_rows(found: tuple, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Findings for the rows of a batch: row index and position; and doc, tag of the rows."""
    key, pos = found
    doc, tag = row_keys(batch)
    own = mix(doc.view(U) * ODD + tag.astype(U))
    lo, hi = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
    row = np.repeat(np.arange(len(own)), hi - lo)
    return row, gather(pos, lo, hi - lo).astype(np.int64), doc, tag


def _windows(make: Callable, n: int, k: int, parts: int):
    near = ahead(n, k)
    places = {AHEAD: np.arange(near), BEHIND: np.arange(near, n - k + 1)}  # of an anchor in its windows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, doc, tag, pos = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            repeat = doc > _smallest(h, doc)
            yield from findings(doc[repeat], tag[repeat], pos[repeat], REPEATED, parts)
            h, doc, tag, pos = h[~repeat], doc[~repeat], tag[~repeat], pos[~repeat]
            yield from dealt(((h >> U(32)) * U(parts) >> U(32)).astype(np.int32), SENT, h, doc, tag, pos)

        size = 0
        for found, whole in _meet(batches, (AHEAD, BEHIND)):
            for batch in chunks([whole]):
                rows = np.unique(np.concatenate([_of_rows(found[kind], batch)[0] for kind in places]))
                if not len(rows):
                    continue
                batch = batch.take(pa.array(rows))
                seq = make(batch)
                sums = prefix(seq.values())
                _, _, _, _, rank, least = anchors(seq, sums, n, k)
                starts = []
                for kind, place in places.items():
                    row, at, doc, tag = _of_rows(found[kind], batch)
                    i = seq.at[row] + at
                    # Windows whose least gram is this anchor.
                    s = i[:, None] - place[None, :]
                    ok = (s >= seq.at[row][:, None]) & (s < len(least))
                    ok &= least[np.where(ok, s, 0)] == rank[i][:, None]
                    starts.append(s[ok])
                s = np.unique(np.concatenate(starts))
                r = np.searchsorted(seq.at, s, side="right") - 1
                held.append([mix(span(sums, s, s + n)), doc[r], tag[r], (s - seq.at[r]).astype(np.int32)])
                size += len(s)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()
    return work


def _decide(parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for batch in batches for b in batch.column("blob").to_pylist()]
        for h, doc, tag, pos in slices(blobs, WINDOW):
            repeat = doc > _smallest(h, doc)
            yield from findings(doc[repeat], tag[repeat], pos[repeat], REPEATED, parts)
    return work


def cut_out(make: Callable, n: int, k: int, unit: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, whole in _meet(batches, (RESOLVED, REPEATED)):
            for batch in chunks([whole]):
                seq = make(batch)
                total = int(seq.at[-1])
                marks = np.zeros(total + 1, np.int64)
                for kind, before, after in ((RESOLVED, n - k, n), (REPEATED, 0, n)):
                    row, at, _, _ = _of_rows(found[kind], batch)
                    i = seq.at[row] + at
                    marks += np.bincount(np.maximum(i - before, seq.at[row]), minlength=total + 1)
                    marks -= np.bincount(np.minimum(i + after, seq.at[row + 1]), minlength=total + 1)
                covered = np.cumsum(marks)[:total] > 0
                cut = np.zeros(total + 1, bool)
                cut[seq.at] = True
                open_ = covered & (cut[:total] | ~np.concatenate([[False], covered[:-1]])) if total else covered
                close = covered & (cut[1:] | ~np.concatenate([covered[1:], [False]])) if total else covered
                start, end = np.flatnonzero(open_), np.flatnonzero(close) + 1
                of = np.searchsorted(seq.at, start, side="right") - 1
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, seq.at).astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(start - seq.at[of]), pa.array(end - start)], names=["start", "length"]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(seq.at).astype(np.int64)), spans, seq.kept(covered)],
                                                 names=["doc_id", unit, "removed", "kept"])
    return work


def by_part(df: DataFrame, parts: int) -> DataFrame:
    return df.repartitionById(parts, F.col("part"))


def with_texts(found: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """Findings and all texts, by home partition, the findings first."""
    texts = docs.mapInArrow(_homes(parts), "part int, kind int, blob binary, doc_id long, text string")
    rows = found.withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}).unionByName(texts)
    return by_part(rows, parts).sortWithinPartitions("kind")


def without_repeats(docs: DataFrame, make: Callable, unit: str, n: int, k: int,
                    splitters: Callable[[DataFrame, int], np.ndarray] | None = None) -> DataFrame:
    """doc_id, ``unit`` (symbols of the text), removed (array of start, length in symbols), kept (binary).

    ``splitters`` gives the borders of gram ranges, one fewer than partitions; without it grams
    are dealt by equal ranges, which suits hashes.
    """
    small_batches(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(parallelism(docs.sparkSession), -(-size // PART_BYTES))
    edges = splitters(d, parts) if splitters else None

    def bucket(k1: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        if edges is None:
            return ((k1 >> U(32)) * U(parts) >> U(32)).astype(np.int32)
        # A gram that is several borders at once is frequent: its contexts are dealt over all the buckets between.
        lo, hi = np.searchsorted(edges, k1, "left"), np.searchsorted(edges, k1, "right")
        return (lo + (ctx >> U(8)) % (hi - lo + 1).astype(U)).astype(np.int32) if len(edges) else np.zeros(len(k1), np.int32)

    def spread(k1: np.ndarray) -> np.ndarray:
        if edges is None or not len(edges):
            return np.zeros(len(k1), bool)
        return np.searchsorted(edges, k1, "right") - np.searchsorted(edges, k1, "left") > 0

    # What the scan already settled passes through the buckets' step beside the anchors.
    scanned = d.mapInArrow(_scan(make, n, k, parts, bucket), FOUND)
    with shuffles_deleted(docs.sparkSession):
        first = stored(by_part(scanned, parts).mapInArrow(_passing(_resolve(parts, spread), (RESOLVED,)), FOUND), f"{unit}-first")
        looked = with_texts(first.filter(F.col("kind").isin(AHEAD, BEHIND)), d, parts).mapInArrow(_windows(make, n, k, parts), FOUND)
        second = stored(by_part(looked, parts).mapInArrow(_passing(_decide(parts), (REPEATED,)), FOUND), f"{unit}-second")
    all_found = first.filter(F.col("kind") == RESOLVED).unionByName(second)
    schema = f"doc_id long, {unit} long, removed array<struct<start:long,length:long>>, kept binary"
    return with_texts(all_found, d, parts).mapInArrow(cut_out(make, n, k, unit), schema)


def _homes(parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, tag = row_keys(batch)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(home_of(doc, tag, parts)), pa.array(np.full(n, TEXT, np.int32)), pa.nulls(n, pa.binary()), batch.column("doc_id"), batch.column("text")],
                                             names=["part", "kind", "blob", "doc_id", "text"])
    return work


def _passing(work: Callable, kinds: tuple):
    """``work`` on the packed rows that were sent, with those of other kinds passed on as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = []
        for batch in batches:
            other = pa.compute.not_equal(batch.column("kind"), SENT)
            yield batch.filter(other)
            sent.append(batch.filter(pa.compute.invert(other)))
        yield from work(iter(sent))
    return run
