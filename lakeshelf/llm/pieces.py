"""SentencePiece encoding and decoding (operator 1), for BPE models with the identity normalizer.

A text (spaces as U+2581, one put before) is cut where no piece of the vocabulary
has the two characters side by side: no merge can cross such a place. Each
distinct part is encoded once, by backtracking: at each position the longest
piece (Aho-Corasick matches) is tried, then shorter ones; a piece may follow
another only if merging both their characters anew gives just these two pieces;
a position from which no encoding goes on is cleared in a bit field
and never tried again. Characters without a piece become their bytes.

The rule on neighbours is exact where merge priorities are distinct. Parts that hold a
piece whose score others share (runs of spaces) are merged directly, by a heap.

Defined cases
  * null text: the empty text, whose ids are the begin and end ids alone.
  * repeated rows give a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakeshelf.llm.arrays import WORD_CHUNK_BYTES, Remembered, chunks, word_ids
from lakeshelf.llm.common import read, small_batches

SPACE = "▁"
MAX_WORDS, MAX_PARTS, MAX_PAIRS = 100_000, 250_000, 200_000
DECODED = 64
_UNITS = re.compile(" +[^ ]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Exact encoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix \
                or not norm.escape_whitespaces or not model.trainer_spec.byte_fallback or kinds - {1, 2, 3, 6}:
            raise NotImplementedError("only BPE models with the identity normalizer, a space put before, byte fallback and no user-defined pieces")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.text = [p.piece for p in model.pieces]
        self.size = [len(p.piece) for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.joint = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        if any(j[1] == SPACE and j[0] != SPACE for j in self.joint):
            raise NotImplementedError("a piece has a space after another character")
        often = Counter(self.score[i] for p, i in self.id.items() if len(p) > 1)
        self.tied = {i for p, i in self.id.items() if len(p) > 1 and often[self.score[i]] > 1}
        self.match = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.match.add_word(p, i)
        self.match.make_automaton()
        self.shorter: dict[int, int] = {}
        self.follows: dict[int, bool] = {}
        self.parts: dict[str, list[int]] = {}
        self.words = Remembered(MAX_WORDS)

    def merged(self, s: str) -> list[int]:
        """Pieces of ``s`` (known characters) by merging: the best-scored neighbours first, of equals the leftmost."""
        sym = list(s)
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (p := self.id.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-self.score[p], i, j, self.size[p]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not sym[i] or nxt[i] != j or not sym[j] or len(sym[i]) + len(sym[j]) != size:
                continue
            sym[i] += sym[j]
            sym[j] = ""
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        return [self.id[x] for x in sym if x]

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 20 | b
        if (known := self.follows.get(key)) is None:
            if len(self.follows) >= MAX_PAIRS:
                self.follows.clear()
            known = self.follows[key] = self.merged(self.text[a] + self.text[b]) == [a, b]
        return known

    def next_shorter(self, t: int) -> int:
        """The longest piece that is a proper prefix of piece ``t``, or -1."""
        if (known := self.shorter.get(t)) is None:
            p = self.text[t]
            known = self.shorter[t] = next((self.id[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), -1)
        return known

    def backtracked(self, s: str) -> list[int]:
        """Pieces of a part without a place that no merge crosses."""
        if (whole := self.id.get(s)) is not None and len(s) == 1:
            return [whole]
        n = len(s)
        longest = [-1] * (n + 1)
        for last, t in self.match.iter(s):
            longest[last + 1 - self.size[t]] = t  # ends come in order, so the longest stays
            if t in self.tied:
                return self.merged(s)
        alive = (1 << (n + 1)) - 1  # bit p: an encoding may go on from position p
        out: list[int] = []
        at, t = 0, longest[0]
        while t >= 0:
            before = out[-1] if out else -1
            while True:
                to = at + self.size[t]
                if alive >> to & 1 and (self.may_follow(before, t) if before >= 0 else n != to or self.merged(s) == [t]):
                    out.append(t)
                    at, t = to, longest[to]
                    break
                if (t := self.next_shorter(t)) < 0:
                    alive &= ~(1 << at)
                    out.pop()
                    at -= self.size[before]
                    t = before
                    break
        return out

    def part(self, s: str) -> list[int]:
        if (known := self.parts.get(s)) is None:
            if len(self.parts) >= MAX_PARTS:
                self.parts.clear()
            if len(s) == 1 and s not in self.id:
                known = [self.byte[b] for b in s.encode()]
            else:
                known = self.backtracked(s)
            self.parts[s] = known
        return known

    def unit(self, s: str) -> list[int]:
        """Ids of a string that begins with a space and lies between two places that no merge crosses."""
        s = s.replace(" ", SPACE)
        joint, out, at = self.joint, [], 0
        for i in range(1, len(s)):
            if s[i - 1:i + 1] not in joint:
                out += self.part(s[at:i])
                at = i
        return out + self.part(s[at:])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without begin and end ids."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, f"  |^ | $|^$|{SPACE}")
        odd = odd.to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        even = np.flatnonzero(~odd)
        if len(even):
            split = pc.split_pattern(texts.take(pa.array(even)), " ")
            words = split.flatten().dictionary_encode()
            index = words.indices.to_numpy()
            often = np.bincount(index, minlength=len(words.dictionary)) > 1
            slots = self.words.slots(words.dictionary.to_numpy(zero_copy_only=False).tolist(), often, lambda new: [self.unit(" " + w) for w in new])[index]
            for k, ids in zip(even, word_ids(self.words.starts, self.words.flat, slots, pc.list_value_length(split).to_numpy())):
                out[k] = ids
        for k in np.flatnonzero(odd):
            text = texts[int(k)].as_py().replace(SPACE, " ")  # the model knows one kind of space
            ids = [i for u in _UNITS.findall(" " + text) for i in self.unit(u)] if text else []
            out[k] = np.array(ids, np.uint32)
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each model file and Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, model: str | None = None, schema: str = "doc_id long, ids array<int>, decoded string", row=None) -> DataFrame:
    """doc_id, ids (with begin and end ids), decoded text; ``row`` may turn (ids array, decoded) into other columns."""
    small_batches(docs.sparkSession)
    row = row or (lambda ids, decoded: (ids.astype(np.int32), decoded))
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model or default_model())
        for batch in chunks(batches, size=WORD_CHUNK_BYTES):
            texts = enc.encode(batch.column("text"))
            made = []
            for at in range(0, len(texts), DECODED):  # lists of Python ints take ten times the room of the ids
                whole = [np.concatenate([[enc.begin], ids, [enc.end]]).astype("<u4") for ids in texts[at:at + DECODED]]
                decoded = enc.library.decode([ids.tolist() for ids in whole], num_threads=1)
                made += [row(ids, text) for ids, text in zip(whole, decoded)]
            made = list(zip(*made))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in made]], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(work, schema)


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, of all documents."""
    digest = lambda ids, text: (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    return encoded(read(spark, sf_dir, "documents"), None, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)
