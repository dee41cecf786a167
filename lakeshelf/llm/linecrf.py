"""Document quality from a linear-chain conditional random field over lines (operator 12).

Each line with a word is labelled good or bad. Its own statistics and those of the lines before and after
it give the log odds of "good"; two weights reward neighbours of the same label. A document's score is
the mean of its lines' forward-backward marginals, weighted by their length in characters.

Learning: lines take the label of their document, and the penalised log likelihood is maximised by
L-BFGS. The statistics of the learning documents are stored once; an evaluation is one Spark job over them in
which each task sums its documents' gradients, so the driver sees one vector a task. At most SAMPLE
documents are learned from: those whose doc_id has the smallest hash. Scoring is one pass over all documents, with
nothing shuffled.

Statistics are of the text alone, the same for every language; label, language, source and doc_id are never among them.

Defined cases
  * a null, empty or blank text has one line without words, all of whose statistics but the constant are 0.
  * of repeated label rows the smallest label counts, null labels and null doc_ids not at all; documents that share a
    doc_id are rows of their own, in learning too. A document with a null doc_id is scored and is not held out.
  * without any label the weights stay 0 and every score is 0.5; with one class, scores lean to it.
  * an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.arrays import chunks
from lakeshelf.llm.common import parallelism, read, small_batches, stored

SAMPLE = 4_000  # documents to learn from
PENALTY, EVALUATIONS, MEMORY = 1.0, 40, 8
THRESHOLD, FOLDS = 0.3, 5
# Statistics of a line, as shares between 0 and 1 but for the logarithms of its words and of their length.
STATISTICS = ("constant", "words", "word_length", "symbols", "exclamations", "capitals", "digits", "stops", "odd_words", "repeated_word",
              "words_again", "pairs_again", "line_again", "unfinished")
N = len(STATISTICS)
_COUNTED = (r"[#*$%&|<>]", "!", r"\p{Lu}", r"\p{Nd}", r"[.,;:?]")


def _again(items: list) -> float:
    return 1.0 - len(set(items)) / len(items) if items else 0.0


_ODD = re.compile(r"[^\w.,;:?\s]+(?=\s|$)")


def line_statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines with a word, text after text: statistics, length in characters; and each text's number of lines."""
    kept, first, counts = [], [], []
    for t in texts.to_pylist():
        lines = [x for x in (t or "").split("\n") if x and not x.isspace()] or [""]
        seen: set[str] = set()
        for x in lines:
            first.append(x not in seen)
            seen.add(x)
        kept += lines
        counts.append(len(lines))
    column = pa.array(kept, pa.large_string())
    chars = pa.compute.utf8_length(column).to_numpy().astype(np.float64)
    length = np.maximum(chars, 1.0)
    out = np.zeros((len(kept), N), np.float32)
    out[:, 0] = 1.0
    for k, pattern in enumerate(_COUNTED):
        out[:, 3 + k] = np.sqrt(pa.compute.count_substring_regex(column, pattern).to_numpy() / length)
    for i, line in enumerate(kept):
        w = line.split()
        if w:
            n = len(w)
            same = sum(map(str.__eq__, w, w[1:]))
            out[i, 1], out[i, 2] = math.log1p(n) / 5, math.log(sum(map(len, w)) / n) / 2
            out[i, 8:] = (len(_ODD.findall(line)) / n, same / n, _again(w), _again(list(zip(w, w[1:]))), not first[i], w[-1][-1] not in ".!?")
    return out, length, np.array(counts, np.int64)


def _with_neighbours(x: np.ndarray) -> np.ndarray:
    """A document's lines with the statistics of the line before and of the line after (zeros at its ends)."""
    none = np.zeros((1, N), x.dtype)
    return np.hstack([x, np.vstack([none, x[:-1]]), np.vstack([x[1:], none])])


def _soft(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def forward_backward(odds: list[float], bad: float, good: float) -> tuple[list[float], list[float], float]:
    """Log odds of the forward messages, of the backward messages, and the log of the normaliser. ``odds`` are the
    lines' own, ``bad`` and ``good`` the weights of two neighbours with that same label."""
    ahead, total = [odds[0]], 0.0
    for e in odds[1:]:
        a = ahead[-1]
        to_bad = _soft(bad, a)
        total += to_bad
        ahead.append(e + _soft(0.0, a + good) - to_bad)
    back = [0.0]
    for e in odds[:0:-1]:
        b = e + back[-1]
        back.append(_soft(0.0, good + b) - _soft(bad, b))
    return ahead, back[::-1], total + _soft(0.0, ahead[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def marginals(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The chance of "good" for each line of one document."""
    ahead, back, _ = forward_backward((_with_neighbours(x) @ weights[:-2]).tolist(), *weights[-2:].tolist())
    return _sigmoid(np.array(ahead) + np.array(back))


def log_likelihood(x: np.ndarray, label: int, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Of one document whose lines all have the label, and its gradient."""
    z = _with_neighbours(x)
    odds, bad, good = z @ weights[:-2], float(weights[-2]), float(weights[-1])
    ahead, back, total = forward_backward(odds.tolist(), bad, good)
    ahead, back = np.array(ahead), np.array(back)
    p = _sigmoid(ahead + back)
    value = (odds.sum() + good * (len(x) - 1) if label else bad * (len(x) - 1)) - total
    # Chances that neighbours are both bad, and both good: messages of the two sides times the weight of the pair.
    right = odds[1:] + back[1:]
    pairs = np.stack([np.full(len(x) - 1, bad), right, ahead[:-1], ahead[:-1] + good + right])
    pairs = np.exp(pairs - pairs.max(axis=0)) if len(x) > 1 else np.zeros((4, 0))
    pairs /= pairs.sum(axis=0)
    same = [(len(x) - 1) * (1 - label) - pairs[0].sum(), (len(x) - 1) * label - pairs[3].sum()]
    return value, np.append((label - p) @ z, same)


def lbfgs(function: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, evaluations: int, memory: int = MEMORY) -> np.ndarray:
    """Minimise ``function`` (value, gradient) from ``x`` with at most so many evaluations."""
    value, grad = function(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < evaluations and np.abs(grad).max() > 1e-3 * max(1.0, abs(value)) / len(x):
        step, held = -grad, []
        for s, y in reversed(past):
            held.append(a := s @ step / (s @ y))
            step = step - a * y
        step = step * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1.0 / max(1.0, np.abs(grad).sum()))
        for (s, y), a in zip(past, reversed(held)):
            step = step + (a - y @ step / (s @ y)) * s
        slope, size = grad @ step, 1.0
        while True:
            then, after = function(x + size * step)
            used += 1
            if then <= value + 1e-4 * size * slope:
                break
            size /= 3
            if used >= evaluations:
                return x
        s, y = size * step, after - grad
        if s @ y > 1e-10:
            past = [*past, (s, y)][-memory:]
        x, value, grad = x + s, then, after
    return x


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights from the labelled documents outside of fold 0."""
    spark = docs.sparkSession
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    known = known.filter(fold(F.col("doc_id")) != 0).filter("label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x, _, counts = line_statistics(b.column("text"))
            at = pa.array(np.concatenate([[0], np.cumsum(counts) * N]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], names=["label", "x"])

    need = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).join(F.broadcast(known), "doc_id")  # known has at most ``sample`` rows
    rows = stored(need.select("label", "text").mapInArrow(statistics, "label int, x array<float>"), "lines")
    rows = stored(rows.repartition(min(parallelism(spark), 16)), "learning")

    def negative(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, grad = 0.0, np.zeros(len(weights))
            for b in batches:
                for y, x in zip(b.column("label").to_pylist(), b.column("x")):
                    v, g = log_likelihood(x.values.to_numpy().reshape(-1, N).astype(np.float64), y, weights)
                    value, grad = value + v, grad + g
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([grad.tolist()])], names=["value", "grad"])

        parts = rows.mapInArrow(work, "value double, grad array<double>").collect()  # one row a task
        value = sum(p.value for p in parts) - 0.5 * PENALTY * weights @ weights
        return -value, PENALTY * weights - sum((np.array(p.grad) for p in parts), np.zeros(len(weights)))

    return lbfgs(negative, np.zeros(3 * N + 2), EVALUATIONS)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score (the length-weighted chance that its lines are good) of every document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x, length, counts = line_statistics(b.column("text"))
            ends = np.cumsum(counts)
            scores = [float(np.average(marginals(x[e - n:e].astype(np.float64), weights), weights=length[e - n:e])) for e, n in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(work, "doc_id long, score double")


def op12_linecrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents from the labels outside of fold 0."""
    small_batches(spark)
    docs = read(spark, sf_dir, "documents")
    out = scored(docs, learned(docs, read(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
