"""Token-id files compressed by Re-Pair grammars (operator 6).

Texts are encoded with a byte-level BPE of the tokenizers library and ended by END_ID, in
ascending doc_id order: Spark range-partitions the documents by doc_id, and each partition
is one shard. A shard is cut into blocks of whole documents (about BLOCK_IDS ids). In each
block, Re-Pair rounds replace frequent neighbouring ids by nonterminals, with a rule
for each; no rule crosses the end of a document.

The file format is Parquet, one row a block, so that any store and Spark's committers do:
  shard int, block int     place in ascending doc_id order
  n_ids long               ids that the block expands to
  doc_ids binary           int64 each
  doc_at binary            uint32 each, and one more: where each document's symbols begin in ``symbols``
  rules binary             uint32 pairs: nonterminal BASE + i expands to the two symbols of pair i
  lengths binary           uint32 each: ids that nonterminal BASE + i expands to
  symbols binary           uint16, or uint32 if ``wide``
  wide boolean
A document is read from its block alone: its symbols are a slice, and the lengths tell how
many ids lie before any place without expanding it (``document_ids``).

Rounds: a round counts all pairs of the block, takes those of MIN_COUNT or more by falling count (ROUND_RULES at
most), and replaces their occurrences at once; of two that overlap, that of the more frequent pair.
A pair that is left MIN_COUNT occurrences so gets its rule, any other waits for the next round. Rounds
go on until no pair occurs MIN_COUNT times (a run of one id holds every other of its pairs).

Defined cases
  * null text: the empty text, END_ID alone.
  * a null doc_id comes first and is kept as null; rows that share a doc_id follow each other, by text.
  * a document longer than a block is a block of its own; empty tables give empty files and
    an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks, gather, without_gc, word_ids
from lakeshelf.llm.common import parallelism, read, small_batches, stored
from lakeshelf.session import scratch_path

END_ID = 2
BASE = 51_000  # first nonterminal; all ids of the vocabulary are below
BLOCK_IDS, MIN_COUNT, ROUND_RULES = 1_000_000, 24, 2000
LARGE, BUCKET_BITS = 1 << 16, 20
MAX_PIECES, BATCH = 600_000, 5_000
TEXT_BYTES = 16 << 20  # each distinct word of so much text is looked up once
TAIL = ".,;:!?$*&%#|"
# Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on, in order.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_ALPHABET = dict(zip((b for b in range(256) if b not in _PRINTED), range(256, 512)))
NO_ID = -(1 << 63)  # a null doc_id
SCHEMA = "shard int, block int, n_ids long, doc_ids binary, doc_at binary, rules binary, lengths binary, symbols binary, wide boolean"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Pieces:
    """Ids of pieces of words, kept over the tasks of a Python worker: about ``limit`` of them, then anew."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # starts[i + 1] is the end of piece i

    def slots(self, pieces: list[str], encode) -> np.ndarray:
        """Places in ``starts`` of distinct pieces, until the next call; ``encode`` gives the ids of new ones and their numbers."""
        if len(self.slot) > self.limit:
            self.clear()
        out = np.fromiter(map(self.slot.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(out < 0)
        if len(new):
            names = [pieces[i] for i in new.tolist()]
            flat, sizes = encode(names)
            n = len(self.slot)
            ends = self.starts[n] + np.cumsum(sizes)
            self.starts = np.append(self.starts, np.zeros(max(0, n + len(new) + 1 - len(self.starts)), np.int64))
            self.flat = np.append(self.flat, np.zeros(max(0, ends[-1] - len(self.flat)), np.uint32))
            self.flat[self.starts[n]:ends[-1]] = flat
            self.starts[n + 1:n + 1 + len(new)] = ends
            out[new] = np.arange(n, n + len(new))
            self.slot.update(zip(names, range(n, n + len(new))))
        return out


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of texts by the tokenizers library, whose model sees each distinct piece of a word once.

    The vocabulary's own pre-tokenisation cuts before a space that stands between two
    characters other than white space, around a line feed that stands so, and between a
    letter and marks of TAIL that end a word. Texts whose spaces all stand so are cut in these places,
    a batch's distinct words at once; words that are not letters and such marks are encoded whole, and so are other texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model = self.tok.model
        self.pieces = Pieces(MAX_PIECES)

    def alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the pre-tokeniser leaves whole, one after the other, and their number in each."""
        flat: list[int] = []
        ends = []
        tokenize = self.model.tokenize
        for p in pieces:
            mapped = p.replace(" ", "\u0120") if p.isascii() and p != "\n" else p.encode().decode("latin-1").translate(BYTE_ALPHABET)
            flat += [t.id for t in tokenize(mapped)]
            ends.append(len(flat))
        return np.array(flat, np.uint32), np.diff(np.array(ends, np.int64), prepend=0)

    def whole(self, texts: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(texts), BATCH):  # the library's results take far more room than the ids
            out += [e.ids for e in self.tok.encode_batch(texts[i:i + BATCH], add_special_tokens=False)]
        return out

    def words(self, words: pa.Array, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and the n + 1 places where they begin; ``spaced`` ones have a space before them."""
        lines = pc.split_pattern(words, "\n")
        sizes = pc.list_value_length(lines).to_numpy()
        lines = lines.flatten()
        of_word = np.repeat(np.arange(len(words)), sizes)
        later = np.concatenate([[False], of_word[1:] == of_word[:-1]])
        stems = pc.utf8_rtrim(lines, characters=TAIL)
        letters = np.fromiter(map(str.isalpha, strings(stems)), bool, len(stems))
        odd = np.bincount(of_word[~letters], minlength=len(words)) > 0
        take = ~odd[of_word]
        lines, stems, of_word, later = lines.filter(pa.array(take)), stems.filter(pa.array(take)), of_word[take], later[take]
        marked = np.flatnonzero(pc.not_equal(pc.binary_length(lines), pc.binary_length(stems)).to_numpy(zero_copy_only=False))
        tails = [x[len(s):] for x, s in zip(strings(lines.take(pa.array(marked))), strings(stems.take(pa.array(marked))))]
        with_space = pa.array(spaced[of_word] & ~later)
        space = pa.scalar(" ", pa.large_string())
        stems = pc.if_else(with_space, pc.binary_join_element_wise(space, stems, pa.scalar("", pa.large_string())), stems).dictionary_encode()
        marks = pa.array(tails, pa.large_string()).dictionary_encode()
        slots = self.pieces.slots([*strings(stems.dictionary), *strings(marks.dictionary), "\n"], self.alone)
        # Pieces of a line: the line feed before it, its stem, its tail.
        count = 1 + later
        count[marked] += 1
        ends = np.cumsum(count)
        piece = np.empty(int(count.sum()), np.int64)
        piece[(ends - count)[later]] = slots[-1]
        piece[ends - count + later] = slots[stems.indices.to_numpy()]
        piece[ends[marked] - 1] = slots[len(stems.dictionary) + marks.indices.to_numpy()]
        begin = self.pieces.starts[piece]
        length = self.pieces.starts[piece + 1] - begin
        flat = gather(self.pieces.flat, begin, length)
        long = np.bincount(np.repeat(of_word, count), weights=length, minlength=len(words)).astype(np.int64)
        rest = np.flatnonzero(odd)
        if len(rest):
            found = self.whole([" " + w if b else w for w, b in zip(strings(words.take(pa.array(rest))), spaced[rest])])
            at = np.cumsum(long)[rest]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.insert(flat, np.repeat(at, sizes), np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))
            long[rest] = sizes
        return flat, np.concatenate([[0], np.cumsum(long)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, r"[\s\v\p{Z}\x1c-\x1f\x{85}] |^ | $|^$| [\s\v\p{Z}\x1c-\x1f\x{85}]").to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        even = np.flatnonzero(~odd)
        if len(even):
            # The first word of a text has no space before it.
            split = pc.split_pattern(texts.take(pa.array(even)), " ")
            sizes = pc.list_value_length(split).to_numpy()
            words = split.flatten().dictionary_encode()
            index = words.indices.to_numpy()
            first = np.cumsum(sizes) - sizes
            heads = np.unique(index[first])
            n = len(words.dictionary)
            forms = pa.concat_arrays([words.dictionary, words.dictionary.take(pa.array(heads))])
            with without_gc():
                flat, starts = self.words(forms, np.arange(len(forms)) < n)
            at = index.astype(np.int64)
            at[first] = n + np.searchsorted(heads, index[first])
            for k, ids in zip(even, word_ids(starts, flat, at, sizes)):
                out[k] = ids
        rest = np.flatnonzero(odd)
        for k, ids in zip(rest, self.whole([texts[int(k)].as_py() for k in rest])):
            out[k] = np.array(ids, np.uint32)
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _order(keys: np.ndarray, symbols: int) -> np.ndarray:
    """Places of the keys (two symbols each) in ascending order."""
    at, one = len(keys).bit_length(), symbols.bit_length()
    if 2 * one + at > 63:
        return np.argsort(keys)
    packed = ((keys >> 32) << one | (keys & 0xFFFFFFFF)) << at | np.arange(len(keys))
    packed.sort()  # numbers alone are sorted several times faster than their places
    return packed & ((1 << at) - 1)


def compress(ids: np.ndarray, starts: np.ndarray, min_count: int = MIN_COUNT, max_rounds: int | None = None):
    """Re-Pair of a block: (symbols, starts in symbols, rules as an n x 2 array, lengths)."""
    seq = ids.astype(np.int32)
    starts = starts.astype(np.int64)
    rules: list[np.ndarray] = []
    lengths = np.ones(BASE, np.int64)
    again = np.ones(len(seq), bool)
    again[starts[starts > 0] - 1] = False  # no pair leaves its document
    again[-1:] = False
    look = np.flatnonzero(again)  # places of all pairs that can be frequent
    while len(look) and (max_rounds is None or len(rules) < max_rounds):
        keys = seq.take(look).astype(np.int64) << 32 | seq[1:].take(look)
        if len(look) > LARGE:  # pairs in a bucket of under min_count are not sorted
            bucket = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).view(np.int64)
            often = np.flatnonzero((np.bincount(bucket, minlength=1 << BUCKET_BITS) >= min_count).take(bucket))
            look, keys = look.take(often), keys.take(often)
        # Only a pair of equal ids can overlap itself: of a run of neighbours take each other one.
        equal = np.flatnonzero(keys >> 32 == keys & 0xFFFFFFFF)
        run = np.maximum.accumulate(np.where(np.diff(look[equal], prepend=-2) > 1, np.arange(len(equal)), 0)) if len(equal) else equal
        free = np.ones(len(look), bool)
        free[equal[(np.arange(len(equal)) - run) % 2 == 1]] = False
        order = _order(keys, len(lengths))
        found = keys.take(order)
        edge = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1], [True]])) if len(found) else np.zeros(1, np.int64)
        counts = np.add.reduceat(free[order].astype(np.int64), edge[:-1]) if len(found) else np.zeros(0, np.int64)
        often = np.flatnonzero(counts >= min_count)
        if not len(often):
            break
        often = often[np.lexsort((found[edge[often]], -counts[often]))]
        pairs, none = found[edge[often]], len(often)
        rank_of = np.full(len(counts), none, np.int32)
        rank_of[often] = np.arange(none)
        rank = np.empty(len(look), np.int32)
        rank[order] = np.repeat(rank_of, np.diff(edge))
        frequent = np.flatnonzero(rank < none)
        look, rank, free = look.take(frequent), rank.take(frequent), free.take(frequent)
        # Of two occurrences that overlap, the one of the more frequent pair is replaced.
        free = np.flatnonzero(free)
        tried, by = look.take(free), rank.take(free)
        beside = np.full(len(tried) + 2, none, np.int32)
        beside[1:-1] = by
        before = np.where(np.diff(tried, prepend=-2) == 1, beside[:-2], none)
        after = np.where(np.diff(tried, append=len(seq) + 2) == 1, beside[2:], none)
        wins = np.flatnonzero((by < before) & (by < after) & (by < ROUND_RULES))
        at, by = tried.take(wins), by.take(wins)
        use = np.flatnonzero(np.bincount(by, minlength=none) >= min_count)  # the most frequent pair always
        new = np.zeros(none, np.int32)
        new[use] = len(lengths) + np.arange(len(use))
        at, by = at[new[by] > 0], by[new[by] > 0]
        seq[at] = new[by]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        # Counts of known pairs only fall, so what can be frequent next are the frequent ones of now and those with a new symbol.
        again = np.zeros(len(seq), bool)
        again[look] = True
        again[at] = True
        keep = np.flatnonzero(keep)  # places are taken faster than marked ones are picked
        seq, again = seq.take(keep), again.take(keep)
        again[np.maximum(at - np.arange(len(at)) - 1, 0)] = True
        starts = starts - np.searchsorted(at + 1, starts)
        again[starts[starts > 0] - 1] = False
        again[-1:] = False
        look = np.flatnonzero(again)
        a, b = pairs[use] >> 32, pairs[use] & 0xFFFFFFFF
        rules.append(np.stack([a, b], 1))
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
    return seq, starts, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), lengths[BASE:]


def _expansions(rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and starts of what each symbol below BASE + len(rules) expands to."""
    starts = np.concatenate([np.arange(BASE), BASE + np.cumsum(lengths) - lengths]).astype(np.int64)
    flat = np.concatenate([np.arange(BASE, dtype=np.uint32), np.zeros(int(lengths.sum()), np.uint32)])
    size = np.concatenate([np.ones(BASE, np.int64), lengths])
    done = 0
    largest = rules.max(1) if len(rules) else np.zeros(0, np.int64)
    while done < len(rules):  # a round's rules only name symbols of earlier rounds
        late = np.flatnonzero(largest[done:] >= BASE + done)
        to = done + int(late[0]) if len(late) else len(rules)
        both = rules[done:to].ravel()
        made = gather(flat, starts[both], size[both])
        flat[starts[BASE + done]:starts[BASE + done] + len(made)] = made
        done = to
    return flat, starts


class Block:
    """A block read back from its row."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.at = np.frombuffer(row["doc_at"], np.uint32).astype(np.int64)
        self.rules = np.frombuffer(row["rules"], np.uint32).reshape(-1, 2).astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], np.uint32 if row["wide"] else np.uint16).astype(np.int64)

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < BASE, 1, self.lengths[np.maximum(symbols - BASE, 0)] if len(self.lengths) else 1)

    def starts(self) -> np.ndarray:
        """Ids before each document of the block, and all ids at the end; nothing is expanded for it."""
        return np.concatenate([[0], np.cumsum(self._sizes(self.symbols))])[self.at]

    def ids(self) -> np.ndarray:
        """All ids of the block."""
        flat, starts = _expansions(self.rules, self.lengths)
        return gather(flat, starts[self.symbols], self._sizes(self.symbols))

    def document(self, k: int) -> np.ndarray:
        """Ids of the block's k-th document, by expanding its symbols alone."""
        out, stack = [], self.symbols[self.at[k]:self.at[k + 1]][::-1].tolist()
        while stack:
            s = stack.pop()
            if s < BASE:
                out.append(s)
            else:
                a, b = self.rules[s - BASE].tolist()
                stack += [b, a]
        return np.array(out, np.uint32)


def _write_blocks(vocabulary: str | None, block_ids: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary or default_vocabulary())
        shard, n = TaskContext.get().partitionId(), 0
        docs: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal n, docs, parts, held
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            symbols, starts, rules, lengths = compress(np.concatenate(parts), starts)
            wide = BASE + len(rules) > 0xFFFF
            row = [shard, n, held, np.array(docs, np.int64).tobytes(), starts.astype(np.uint32).tobytes(), rules.astype(np.uint32).tobytes(),
                   lengths.astype(np.uint32).tobytes(), symbols.astype(np.uint32 if wide else np.uint16).tobytes(), wide]
            n, docs, parts, held = n + 1, [], [], 0
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in chunks(batches, size=TEXT_BYTES):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text"))):
                if parts and held + len(ids) + 1 > block_ids:
                    yield block()
                docs.append(NO_ID if doc is None else doc)
                parts.append(np.append(ids, np.uint32(END_ID)))
                held += len(ids) + 1
        if parts:
            yield block()
    return work


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents to ``path`` in the format above."""
    small_batches(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    d = d.repartitionByRange(parallelism(docs.sparkSession), F.col("doc_id").asc_nulls_first())
    d = d.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    d.mapInArrow(_write_blocks(vocabulary, block_ids), SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str, schema: str = "ids array<int>", row=None) -> DataFrame:
    """Each document of the files: doc_id, start, n_tokens and its ids, or what ``row`` makes of the id array."""
    row = row or (lambda ids: (ids.astype(np.int32),))
    blocks = spark.read.schema(SCHEMA).parquet(path)
    # Ids before each block: sums within each shard, and over the shards (one small row each).
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("all"))
    shards = shards.select("shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("earlier"))
    before = sizes.select("shard", "block", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("before")).join(shards, "shard")
    before = stored(before.select("shard", "block", (F.col("before") + F.col("earlier")).alias("before")), "block-starts")
    extra = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r)
                starts = b.starts()
                made = list(zip(*[row(ids) for ids in np.split(b.ids(), starts[1:-1])]))
                doc_ids = pa.array(b.doc_ids, mask=b.doc_ids == NO_ID)
                n = len(b.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * n, pa.int32()), pa.array([r["block"]] * n, pa.int32()), doc_ids, pa.array(starts[:-1]), pa.array(np.diff(starts)),
                     *[pa.array(c) for c in made]], names=["shard", "block", "doc_id", "at", "n_tokens", *extra])

    rows = blocks.mapInArrow(work, "shard int, block int, doc_id long, at long, n_tokens long, " + schema)
    return rows.join(before, ["shard", "block"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", *extra)


def document_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """Random access: the ids of a few documents, each from its block alone."""
    found = {}
    for r in spark.read.schema(SCHEMA).parquet(path).mapInArrow(_only(doc_ids), "doc_id long, ids array<int>").collect():
        found[r["doc_id"]] = r["ids"]
    return found


def _only(doc_ids: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r)
                for k in np.flatnonzero(np.isin(b.doc_ids, doc_ids)).tolist():
                    yield pa.RecordBatch.from_arrays([pa.array(b.doc_ids[k:k + 1]), pa.array([b.document(k).tolist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return work


def op6_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids, read the files back: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "token-ids")
    write_ids(read(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, "ids_crc32 long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))
