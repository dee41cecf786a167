"""Centroid clustering, line labels by a random field, and periodic runs, against plain Python."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from lakeshelf.llm import centroids, linecrf, periods

SF = "/root/testdata/sf0.001"


# --- centroid clustering


def plain_clusters(rows, dim=64, k=16, rounds=3):
    """[(id, cluster, distance)] and the final centroids."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds if cents else 0):
        by = {}
        for (_, v), (_, j) in zip(kept, assign()):
            by.setdefault(j, []).append(v)
        for j, members in by.items():
            cents[j] = [sum(c) // len(members) for c in zip(*members)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign())] if cents else [], cents


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, x string, cluster int").repartition(3)


def by_value(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters(spark, seed):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [m + r.gauss(0, 0.2) for m in r.choice(middles)]) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(60)]  # ties and copies
    rows += [rows[4], rows[4], (None, rows[5][1]), (None, rows[6][1]), (-3, [0.0] * 64), (9999, [1 / 64] * 64)]
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65), (304, [None] + [0.1] * 63), (305, [float("nan")] * 64), (306, [float("inf")] + [0.0] * 63)]
    out, cents, sums = centroids.clustered(vectors(spark, rows))
    want, plain = plain_clusters(rows)
    assert cents == plain and by_value(out.collect()) == by_value(want)
    assert sums == {j: sum(d for _, c, d in want if c == j) for j in {c for _, c, _ in want}}


def test_few_vectors_wide_ones_and_none(spark):
    rows = [(1, [2.0 ** 21] * 64), (2, [-3.0 * 2 ** 22] + [0.25] * 63), (3, [0.25] * 64)]
    out, cents, _ = centroids.clustered(vectors(spark, rows))
    want, plain = plain_clusters(rows)
    assert cents == plain and by_value(out.collect()) == by_value(want)
    out, _, sums = centroids.clustered(vectors(spark, [*rows, (4, [1e12] * 64), (5, [-1e12] * 64)]), k=1, rounds=1)
    assert [r.distance is None for r in out.orderBy("id").collect()] == [False, False, False, True, True] and sums == {0: None}
    for odd in ([], [(1, None), (2, [0.0])]):
        out, cents, sums = centroids.clustered(vectors(spark, odd))
        assert out.collect() == [] and cents == [] and sums == {}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0, 1, 40]), st.sampled_from([np.int64, object]))
def test_search_is_exact_and_stops_early(seed, spread, kind):
    r = np.random.default_rng(seed)
    c = r.integers(-60, 60, (16, 64))
    x = c[r.integers(0, 16, 50)] + r.integers(-spread, spread + 1, (50, 64))
    all_d = ((x[:, None] - c[None]) ** 2).sum(2)
    cluster, distance, taken = centroids.nearest(x.astype(kind), c.astype(kind))
    assert cluster.tolist() == all_d.argmin(1).tolist() and distance.tolist() == all_d.min(1).tolist()
    assert spread > 1 or taken < 0.6 * 50 * 16 * 64
    assert (centroids.transform(x) ** 2).sum(1).tolist() == (64 * (x ** 2).sum(1)).tolist()


def test_op11_inertia(spark):
    rows = centroids.op11_centroids(spark, SF).collect()
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for c in {r.cluster for r in rows}:
        assert {r.cluster_inertia for r in rows if r.cluster == c} == {sum(r.distance for r in rows if r.cluster == c)}


# --- periodic runs


def plain_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q):
                    s = w[i:j + q]
                    if not any(s[d:] == s[:-d] for d in range(1, q)):
                        out.add((i, j + q - i, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_op13(doc_id, text):
    w = brute.words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    four = (None,) * 4
    if found:
        from fractions import Fraction
        s, m, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        four = (s, m, q, 1000 * m // q)
    return (doc_id, len(found), *four, brute.sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.integers(0, 60), st.booleans())
def test_runs(w, p, more, twice):
    w = w + [w[-1 - i % min(p, len(w))] for i in range(more)] if w else w
    w = w + [9] + w if twice else w
    assert periods.runs(np.array(w, np.int64)) == plain_runs(w)


def test_runs_of_long_texts():
    for n, p in ((30_000, 1), (30_000, 7), (30_000, 7_400)):
        w = (list(range(p)) * (n // p + 1))[:n]
        assert periods.runs(np.array([*w, 99_999], np.int64)) == [(0, n, p)]
    r = random.Random(4)
    w = [r.randrange(3) for _ in range(3000)]
    assert periods.runs(np.array(w, np.int64)) == plain_runs(w)


def test_positions():
    r = random.Random(3)
    numbers = r.sample(range(20_000), 6_000)
    p, held = periods.Positions(numbers[0]), {numbers[0]}
    for x in numbers[1:200]:
        assert p.add(x) == (max((y for y in held if y < x), default=-1), min((y for y in held if y > x), default=-1))
        held.add(x)
    for x in numbers[200:]:
        p.add(x)
    assert list(p) == sorted(numbers)


def test_run_table(docs, corpus):
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    odd = [*corpus, (20, "a b " * 40), (21, "x " * 9), (21, "x " * 9), (22, "a b c a b c a b c a b"), (23, "a b c a b c a b c a b c")]
    out = periods.run_table(docs(odd), schema, periods._digests, periods.seeded)
    assert by_value(out.collect()) == by_value(plain_op13(d, t) for d, t in odd)
    assert periods.run_table(docs([]), schema, periods._digests).collect() == []


def test_op13(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = by_value(periods.op13_periods(spark, SF).collect())
    assert out == by_value(plain_op13(d, t) for d, t in table) and sum(r[1] for r in out) > 10


# --- quality by line labels


def test_marginals_of_all_labellings():
    r = np.random.default_rng(1)
    for n in (1, 2, 5):
        e, bad, good = r.normal(size=n), 0.7, -0.4
        total, on = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s = math.exp(sum(e[i] for i in range(n) if y[i]) + sum(good if a else bad for a, b in zip(y, y[1:]) if a == b))
            total, on = total + s, on + s * np.array(y)
        ahead, back, log_total = linecrf.forward_backward(e.tolist(), bad, good)
        assert abs(log_total - math.log(total)) < 1e-9
        assert np.allclose(1 / (1 + np.exp(-(np.array(ahead) + np.array(back)))), on / total)


def test_gradient():
    r = np.random.default_rng(2)
    for n, label in ((1, 1), (4, 0), (6, 1)):
        x, w = r.normal(size=(n, linecrf.N)), r.normal(size=3 * linecrf.N + 2) * 0.3
        value, grad = linecrf.log_likelihood(x, label, w)
        for k in (0, 3, linecrf.N + 2, len(w) - 2, len(w) - 1):
            up = w.copy()
            up[k] += 1e-6
            assert abs((linecrf.log_likelihood(x, label, up)[0] - value) / 1e-6 - grad[k]) < 1e-3


def test_minimum():
    a = np.diag([1.0, 10.0, 100.0])
    x = linecrf.lbfgs(lambda v: (0.5 * (v - 3) @ a @ (v - 3), a @ (v - 3)), np.zeros(3), 60)
    assert np.allclose(x, 3, atol=1e-2)


def test_scores_of_odd_texts(spark, docs, corpus):
    rows = [*corpus, (600, "a\n" * 3000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, 0), (None, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    out = linecrf.scored(docs(rows), linecrf.learned(docs(rows), labels)).collect()
    assert sorted(r.doc_id or 0 for r in out) == sorted(d or 0 for d, _ in rows) and all(0 <= r.score <= 1 for r in out)
    none = linecrf.learned(docs(rows), labels.limit(0))
    assert {r.score for r in linecrf.scored(docs(rows), none).collect()} == {0.5}
    assert linecrf.scored(docs([]), none).collect() == []


def test_op12_held_out(spark):
    """Accuracy on the fold that was not learned from; folds and decisions follow their definitions."""
    sf = "/root/testdata/sf0.01"
    rows = linecrf.op12_linecrf(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    fold = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in fold if y], [s for s, _, y in fold if not y]
    assert sum(p == y for _, p, y in fold) >= 0.95 * len(fold)
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
