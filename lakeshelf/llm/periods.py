"""Runs of periodic words by Kruskal over descending common prefixes (operator 13).

A run is a stretch of words with smallest period q, at least LEAST words and EXPONENT periods long, that
no neighbouring word extends. Suffixes of a document are sorted by doubling; neighbours in that order are the
edges, their common prefixes the weights. Edges are taken by falling weight and unite classes of suffixes
(union-find); each class keeps its positions in order, and the smaller is put into the larger. Positions i < j that
become neighbours in a class at weight l share exactly l words. If j - i <= l, these and the words between them
have the period j - i: a seed, of j - i + l words, that cannot go on to the right. One that cannot go on to
the left either is a run, and every run is found so: its first two periods start at positions that no position of
their class parts (that would be a smaller period), and that unite at its length less one period.

Only weights of SHORTEST words or more can give a run of EXPONENT periods, so the suffixes sorted are those whose first SHORTEST
words come twice in the document; the others have no such neighbour. This drops no run.

A document is one row of work: about 100 bytes a word in its task, and n log n steps. Rows are independent, so
nothing is shuffled and no key is hot.

Defined cases
  * words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null, empty and blank texts have none: no runs, four nulls, digests of the
    empty string.
  * a null doc_id has no crc32 and leaves its text as it is; repeated rows are rows of their own.
  * an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeshelf.llm.arrays import chunks
from lakeshelf.llm.common import WORD_PATTERN, read, small_batches

LEAST, EXPONENT = 6, 4
SHORTEST = 5  # LEAST - 1 for period 1; (EXPONENT - 1) * q and LEAST - q are larger for others
BLOCK = 512
_WORDS = re.compile(WORD_PATTERN)
Run = tuple[int, int, int]  # start, length, period


class Positions:
    """Numbers in order, in blocks of bounded length, so that an insertion moves few of them."""

    __slots__ = ("blocks", "last")

    def __init__(self, first: int):
        self.blocks, self.last = [[first]], [first]

    def __iter__(self) -> Iterator[int]:
        for b in self.blocks:
            yield from b

    def add(self, x: int) -> tuple[int, int]:
        """Insert; returns its neighbours (-1 where there is none)."""
        k = min(bisect(self.last, x), len(self.blocks) - 1)
        block = self.blocks[k]
        at = bisect(block, x)
        before = block[at - 1] if at else self.last[k - 1] if k else -1
        after = block[at] if at < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else -1
        block.insert(at, x)
        self.last[k] = block[-1]
        if len(block) > 2 * BLOCK:
            self.blocks[k:k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.last[k:k + 1] = [block[BLOCK - 1], block[-1]]
        return before, after


def neighbours(ids: np.ndarray, least: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of suffixes that share ``least`` words or more: positions, positions, common words."""
    n = len(ids)
    none = np.zeros(0, np.int64)
    if n <= least:
        return none, none, none
    padded = np.concatenate([ids + 1, np.zeros(least, np.int64)])
    key = padded[:n]
    for k in range(1, least):  # ranks of ever longer windows, in the order of their words
        key = np.unique(key * (int(padded.max()) + 1) + padded[k:k + n], return_inverse=True)[1]
    count = np.bincount(key)
    often = np.flatnonzero(count[key] > 1)
    if not len(often):
        return none, none, none
    # A rank is how many suffixes come before the first of its group, so that groups can be split in place.
    rank = np.append((np.cumsum(count) - count)[key], -1).astype(np.int32)
    levels, width, at = [(rank, least)], least, often
    while len(at):
        own, then = rank[at], rank[at + width]  # equal windows lie within the text
        order = np.lexsort((then, own))
        at, own, then = at[order], own[order], then[order]
        place = np.arange(len(at))
        group = np.r_[True, own[1:] != own[:-1]]
        part = group | np.r_[True, then[1:] != then[:-1]]
        first = np.maximum.accumulate(np.where(part, place, 0))
        rank = rank.copy()
        rank[at] = own + first - np.maximum.accumulate(np.where(group, place, 0))
        width *= 2
        levels.append((rank, width))
        at = at[np.bincount(first, minlength=len(at))[first] > 1]
    order = often[np.argsort(rank[often], kind="stable")]
    i, j = order[:-1], order[1:]
    common = np.zeros(len(i), np.int64)
    for rank, width in reversed(levels):
        common += width * (rank[i + common] == rank[j + common])
    close = common >= least
    i, j, common = i[close], j[close], common[close]
    for _ in range(least - 1):  # what is left is shorter than the shortest window; the padding differs from all words
        common += (padded[i + common] == padded[j + common]) & (padded[i + common] > 0)
    return i, j, common


def runs(ids: np.ndarray) -> list[Run]:
    """All runs, by start and period."""
    i, j, common = neighbours(ids)
    if not len(i):
        return []
    order = np.argsort(-common, kind="stable")
    word, up, size, members, found = ids.tolist(), {}, {}, {}, []

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b, l in zip(i[order].tolist(), j[order].tolist(), common[order].tolist()):
        a, b = root(a), root(b)
        if size.get(a, 1) < size.get(b, 1):
            a, b = b, a
        if a not in members:
            members[a] = Positions(a)
        small = list(members.pop(b, (b,)))
        for t, x in enumerate(small):
            before, after = members[a].add(x)
            if t and before == small[t - 1]:
                before = -1  # neighbours before already
            if t + 1 < len(small) and (after < 0 or small[t + 1] < after):
                after = -1  # the next one comes between
            for lo, hi in ((before, x), (x, after)):
                q = hi - lo
                if lo >= 0 and hi >= 0 and q + l >= max(LEAST, EXPONENT * q) and (lo == 0 or word[lo - 1] != word[hi - 1]):
                    found.append((lo, q + l, q))
        up[b] = a
        size[a] = size.get(a, 1) + size.pop(b, 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def word_numbers(words: list[str]) -> np.ndarray:
    seen: dict[str, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def greatest(found: list[Run]) -> Run | None:
    """The run of greatest exact length / period; ties by start, then period."""
    best = None
    for r in found:  # in order of start and period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(n: int, found: list[Run]) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, q in found:
        steps[start + q] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def seeded(words: list[str], doc_id: int | None) -> list[str]:
    """The contract's texts: one in ten is made periodic from a place on that its doc_id gives."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a:a + p]
    return words[:a] + (head * (-(-(n - a) // p)))[:n - a]


def run_table(docs: DataFrame, schema: str, row, change=None) -> DataFrame:
    """One row per document: doc_id and what ``row(words, runs)`` makes (the other columns of ``schema``);
    ``change(words, doc_id)`` may alter the words first."""
    small_batches(docs.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64() if f.endswith(" long") else pa.string() for f in schema.split(", ")[1:]]
        for batch in chunks(batches):
            made = []
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = _WORDS.findall(text.as_py() or "")
                words = change(words, d) if change else words
                made.append(row(words, runs(word_numbers(words))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*made), types)]], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(work, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digests(words: list[str], found: list[Run]) -> tuple:
    best = greatest(found)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = [words[i] for i in np.flatnonzero(collapsed(len(words), found))] if found else words
    return (len(found), *four, _sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), _sha(" ".join(kept)))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, one in ten made periodic first."""
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return run_table(read(spark, sf_dir, "documents"), schema, _digests, seeded)
