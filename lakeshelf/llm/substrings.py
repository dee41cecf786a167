"""Substring dedup over words by level-wise doubling (operator 3).

To find the windows of 13 words that start in several documents, windows are looked at level by
level: of 4 words, of 7, of 13; each length is twice the one before, less one where the next is odd. Only at
the first level are all windows looked at. A longer window is a candidate if both windows of
which it consists, one at either end, repeated at the length before; all others are never
looked at again, and levels end where no candidate survives. Longer windows than the target
are not sought: whatever repeats over more words is covered by its windows of 13.

  distinct  each task hashes its candidates and sends each hash once for each home partition, by
            hash; a frequent window is one entry a task and home, however often it comes.
  again     a hash that comes from several rows repeats. It goes back to the homes that sent it.
  extended  there the words meet what repeats. The stretches of words in which some candidate
            of the next length lies are all that goes on; they are written, packed.
  decided   at the target length the entries carry the least and greatest doc_id, and what comes back is the
            least doc_id of all: windows of larger ones are removed.

Before the target, 48 bits of a hash tell windows apart: what agrees by chance is only looked at once more. At the
target it is 64 bits. Rows are told apart by doc_id and a hash of the text (see ``repeats``).

Defined cases
  * words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null, empty and blank texts have none.
  * texts of under 13 words lose nothing. Further columns are ignored.
  * rows that share a doc_id do not remove each other's words; a null doc_id is larger than all others.
  * an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks, gather
from lakeshelf.llm.common import parallelism, read, small_batches, stored
from lakeshelf.llm.repeats import (FLUSH, FOUND, REPEATED, SENT, TEXT, U, Words, by_part, cut_out, dealt, findings, home_of, joined, mix, pack,
                                   prefix, row_keys, span, unpack, with_texts)

WINDOW, BASE = 13, 4


def doubled(window: int, base: int = BASE) -> list[int]:
    """The lengths of the levels: at least two, the first of at most ``base`` words if that is over one."""
    out = [window, (window + 1) // 2]
    while out[-1] > max(base, 1):
        out.append((out[-1] + 1) // 2)
    return out[::-1]


class Stretches(NamedTuple):
    """Stretches of words: doc, tag and position of the first word in its text, number of words; and the hashes of all the words."""

    doc: np.ndarray
    tag: np.ndarray
    pos: np.ndarray
    size: np.ndarray
    values: np.ndarray

    def row(self) -> np.ndarray:
        """A number for each stretch, equal for those of one row, which are neighbours."""
        new = (self.doc[1:] != self.doc[:-1]) | (self.tag[1:] != self.tag[:-1])
        return np.concatenate([[0], np.cumsum(new)]) if len(self.doc) else np.zeros(0, np.int64)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each window of n words within a stretch: its first word in ``values``, its stretch, its hash."""
        of = np.repeat(np.arange(len(self.size)), self.size)
        at = np.flatnonzero(np.arange(len(of)) + n <= np.cumsum(self.size)[of])
        return at, of[at], mix(span(prefix(self.values), at, at + n))

    def extended(self, at: np.ndarray, of: np.ndarray, again: np.ndarray, n: int, longer: int) -> Stretches:
        """The stretches in which some window of ``longer`` words has windows of n at both ends that repeat."""
        alive = np.zeros(len(self.values) + longer, bool)
        alive[at[again]] = True
        stretch = np.zeros(len(self.values), np.int64)
        stretch[at] = of
        ends = np.cumsum(self.size)
        first = at[again]
        first = first[alive[first + longer - n] & (first + longer <= ends[stretch[first]])]
        new = np.concatenate([[True], (np.diff(first) > 1) | (np.diff(stretch[first]) > 0)]) if len(first) else np.zeros(0, bool)
        begin = first[new]
        last = first[np.append(new[1:], True)] if len(first) else first
        size = last - begin + longer
        s = stretch[begin]
        return Stretches(self.doc[s], self.tag[s], (self.pos[s] + begin - (ends - self.size)[s]).astype(np.int32), size.astype(np.int32),
                         gather(self.values, begin, size))


def _of_texts(batch: pa.RecordBatch) -> Iterator[Stretches]:
    for part in chunks([batch]):
        seq = Words(part)
        doc, tag = row_keys(part)
        yield Stretches(doc, tag, np.zeros(len(doc), np.int32), np.diff(seq.at).astype(np.int32), seq.values())


def _of_blobs(batch: pa.RecordBatch) -> Iterator[Stretches]:
    for blob in batch.column("blob").to_pylist():
        yield Stretches(*unpack(blob))


def _buckets(h: np.ndarray, bits: int, parts: int) -> np.ndarray:
    return ((h >> U(bits - 32)) * U(parts) >> U(32)).astype(np.int32)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where sorted entries begin that differ from the one before in some key."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _distinct(of: Callable, n: int, parts: int, last: bool):
    """Sends (hash, home, whether several rows have it), or at the last level (hash, home, least doc, greatest doc)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, home, row, doc = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            order = np.lexsort((home, h))
            h, home, row, doc = h[order], home[order], row[order], doc[order]
            pair = _edges(h, home)
            if last:
                yield from dealt(_buckets(h[pair], 64, parts), SENT, h[pair], home[pair], np.minimum.reduceat(doc, pair), np.maximum.reduceat(doc, pair))
            else:
                alike = _edges(h)
                several = np.minimum.reduceat(row, alike) < np.maximum.reduceat(row, alike)
                several = np.repeat(several, np.diff(np.append(alike, len(h))))
                yield from dealt(_buckets(h[pair], 48, parts), SENT, h[pair], home[pair], several[pair].astype(np.uint8))

        size = rows = 0
        for batch in batches:
            for s in of(batch):
                _, stretch, h = s.windows(n)
                if not len(h):
                    continue
                row = s.row() + rows
                rows = int(row[-1]) + 1
                held.append([h if last else h >> U(16), home_of(s.doc, s.tag, parts)[stretch], row[stretch], s.doc[stretch]])
                size += len(h)
                if size >= FLUSH:
                    yield from flush()
                    size = rows = 0
        if held:
            yield from flush()
    return work


def _all(batches: Iterator[pa.RecordBatch], kinds: tuple) -> list[np.ndarray]:
    return joined([b for batch in batches for b in batch.column("blob").to_pylist()], kinds)


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that several rows have, for each home that sent them."""
    h, home, several = _all(batches, (U, np.int32, np.uint8))
    if not len(h):
        return
    order = np.lexsort((home, h))
    h, home, several = h[order], home[order], several[order]
    alike = _edges(h)
    count = np.diff(np.append(alike, len(h)))
    # Tasks have rows of their own, so that two entries are two rows.
    repeat = np.repeat((count > 1) | (np.maximum.reduceat(several, alike) > 0), count)
    h, home = h[repeat], home[repeat]
    one = _edges(h, home)
    yield from dealt(home[one], REPEATED, h[one])


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least doc of each hash, for each home with a larger one."""
    h, home, low, high = _all(batches, (U, np.int32, np.int64, np.int64))
    if not len(h):
        return
    order = np.lexsort((home, h))
    h, home, low, high = h[order], home[order], low[order], high[order]
    alike = _edges(h)
    least = np.repeat(np.minimum.reduceat(low, alike), np.diff(np.append(alike, len(h))))
    larger = high > least
    h, home, least = h[larger], home[larger], least[larger]
    one = _edges(h, home)
    yield from dealt(home[one], REPEATED, h[one], least[one])


def _met(batches: Iterator[pa.RecordBatch], kinds: tuple) -> Iterator[tuple[list[np.ndarray], pa.RecordBatch]]:
    """For each batch of texts or stretches, what came back to its partition (first there), sorted by hash."""
    blobs: list[bytes] = []
    back = None
    for batch in batches:
        n = int(np.searchsorted(batch.column("kind").to_numpy(zero_copy_only=False), TEXT))
        blobs += batch.column("blob").slice(0, n).to_pylist()
        if n < batch.num_rows:
            if back is None:
                back = joined(blobs, kinds)
                order = np.argsort(back[0], kind="stable")
                back = [b[order] for b in back]
                blobs.clear()
            yield back, batch.slice(n)


def _found_in(h: np.ndarray, sorted_h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in sorted ones, and whether they are there."""
    if not len(sorted_h):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    i = np.minimum(np.searchsorted(sorted_h, h), len(sorted_h) - 1)
    return i, sorted_h[i] == h


def _extended(of: Callable, n: int, longer: int, parts: int):
    """The stretches that go on, packed for their home."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (again,), batch in _met(batches, (U,)):
            for s in of(batch):
                at, stretch, h = s.windows(n)
                _, repeat = _found_in(h >> U(16), again)
                left = s.extended(at, stretch, repeat, n, longer)
                if len(left.doc):
                    home = int(home_of(left.doc[:1], left.tag[:1], parts)[0])
                    yield pa.RecordBatch.from_arrays([pa.array([home], pa.int32()), pa.array([TEXT], pa.int32()), pa.array([pack(*left)], pa.binary())],
                                                     names=["part", "kind", "blob"])
    return work


def _decided(n: int, parts: int):
    """The windows to be removed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (known, least), batch in _met(batches, (U, np.int64)):
            for s in _of_blobs(batch):
                at, of, h = s.windows(n)
                i, there = _found_in(h, known)
                there[there] = s.doc[of[there]] > least[i[there]]
                at, of = at[there], of[there]
                begin = np.cumsum(s.size) - s.size
                yield from findings(s.doc[of], s.tag[of], (s.pos[of] + at - begin[of]).astype(np.int32), REPEATED, parts)
    return work


def without_repeated_words(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """doc_id, n_words, removed (array of start, length in words), kept (binary: remaining words joined by a space)."""
    small_batches(docs.sparkSession)
    parts = parallelism(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    lengths = doubled(window, base)
    left = None  # the stretches of words that are still looked at; at first all texts
    for n, longer in zip(lengths, lengths[1:]):
        of = _of_texts if left is None else _of_blobs
        sent = (d if left is None else left).mapInArrow(_distinct(of, n, parts, False), FOUND)
        again = by_part(sent, parts).mapInArrow(_again, FOUND)
        met = with_texts(again, d, parts) if left is None else by_part(left.unionByName(again), parts).sortWithinPartitions("kind")
        left = stored(met.mapInArrow(_extended(of, n, longer, parts), FOUND), f"words-{longer}")
        if left.isEmpty():
            break
    sent = left.mapInArrow(_distinct(_of_blobs, window, parts, True), FOUND)
    least = by_part(sent, parts).mapInArrow(_least, FOUND)
    found = stored(by_part(left.unionByName(least), parts).sortWithinPartitions("kind").mapInArrow(_decided(window, parts), FOUND), "words-found")
    schema = "doc_id long, n_words long, removed array<struct<start:long,length:long>>, kept binary"
    return with_texts(found, d, parts).mapInArrow(cut_out(Words, window, 1, "n_words"), schema)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeated_words(read(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
