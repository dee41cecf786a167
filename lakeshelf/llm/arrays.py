"""Arrow and numpy helpers of the operators that work on batches inside Spark tasks."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

# Texts are worked on in pieces of about so many bytes, so that a task's arrays stay small; one text is never cut.
CHUNK_BYTES = 1 << 20
# Tokenizers look up each distinct word once a piece, and hold little besides it.
WORD_CHUNK_BYTES = 6 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``size`` bytes of text, or one row: large batches sliced, small ones put together."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        if have + ends[-1] > size and held:
            yield pa.concat_batches(held)
            held, have = [], 0
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            part = batch.slice(at, to - at)
            if to < batch.num_rows:
                yield part
            else:
                held, have = [*held, part], have + int(ends[-1]) - done
            at = to
    if held:
        yield pa.concat_batches(held)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces flat[starts[i] : starts[i] + lengths[i]] one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


@contextmanager
def without_gc():
    """Large dicts of strings and ids hold no cycles; walking them again and again takes a fifth of the time."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def word_ids(starts: np.ndarray, flat: np.ndarray, slots: np.ndarray, sizes: np.ndarray, step: int = 1 << 17) -> list[np.ndarray]:
    """Ids of each text from the slots of its words; ``sizes`` are the texts' word counts. About ``step`` words at a time."""
    out: list[np.ndarray] = []
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + step, side="right")))
        these = slots[done:int(ends[to - 1])]
        begin = starts[these]
        lengths = starts[these + 1] - begin
        cuts = np.concatenate([[0], np.cumsum(lengths)])[ends[at:to] - done]
        out += np.split(gather(flat, begin, lengths), cuts[:-1])
        at = to
    return out


class Remembered:
    """Ids of strings. Those that come often stay over the tasks of a Python worker: at most ``limit`` of them, then anew."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # starts[i + 1] is the end of string i

    def slots(self, strings: list[str], often: np.ndarray, encode) -> np.ndarray:
        """Places in ``starts`` of distinct strings, until the next call; ``often`` tells which to keep for
        longer, ``encode`` gives the ids of a list of new ones."""
        if len(self.slot) > self.limit:
            self.clear()
        out = np.fromiter(map(self.slot.get, strings, repeat(-1)), np.int64, len(strings))
        new = np.flatnonzero(out < 0)
        if len(new):
            new = np.concatenate([new[often[new]], new[~often[new]]])  # those that stay come first
            with without_gc():
                found = encode([strings[i] for i in new.tolist()])
            n = len(self.slot)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ends = self.starts[n] + np.cumsum(lengths)
            while n + len(new) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while ends[-1] > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.starts[n]:ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
            self.starts[n + 1:n + 1 + len(new)] = ends
            out[new] = np.arange(n, n + len(new))
            stay = new[:int(often[new].sum())]
            self.slot.update(zip([strings[i] for i in stay.tolist()], range(n, n + len(stay))))
        return out
