"""Places where an operator once did less than the whole job."""

import itertools
import random

import numpy as np
import pytest

import brute
import corpus_pipeline
from lakeshelf.llm import decontaminate, licenses, lines, neardup, repair


def most_frequent(seq, starts):
    """Occurrences of the most frequent pair that do not overlap, no document's end between its two."""
    counts, last = {}, {}
    ends = set((starts[1:] - 1).tolist())
    for i, pair in enumerate(zip(seq[:-1].tolist(), seq[1:].tolist())):
        if i not in ends and last.get(pair) != i - 1:
            counts[pair] = counts.get(pair, 0) + 1
            last[pair] = i
    return max(counts.values(), default=0)


@pytest.mark.parametrize("n", [6_000, 140_000, 400_000])
def test_grammars_leave_no_frequent_pair(n):
    r = np.random.default_rng(n)
    ids = r.integers(3, 50_000, n).astype(np.uint32)
    ids[n // 50:n // 50 + 600] = np.tile(np.array([7, 9], np.uint32), 300)  # lies between the runs that were once counted
    ids[n // 2:n // 2 + 300] = 11
    ids[n // 3:n // 3 + 900] = np.tile(np.arange(100, 130, dtype=np.uint32), 30)
    starts = np.unique(np.concatenate([[0, n], r.integers(1, n, n // 500)]))
    symbols, at, rules, lengths = repair.compress(ids, starts)
    assert most_frequent(symbols, at) < repair.MIN_COUNT
    assert [7, 9] in rules.tolist() and [11, 11] in rules.tolist()
    row = dict(doc_ids=b"", doc_at=at.astype(np.uint32).tobytes(), rules=rules.astype(np.uint32).tobytes(), lengths=lengths.astype(np.uint32).tobytes(),
               symbols=symbols.astype(np.uint32).tobytes(), wide=True)
    assert (repair.Block(row).ids() == ids).all() and (repair.Block(row).starts() == starts).all()


def similar_pairs(changed, pairs=60):
    """Pairs of texts (2 k, 2 k + 1) of 300 words, ``changed`` of them in a row other ones."""
    rows = []
    for k in range(pairs):
        w = [f"d{k}w{i}" for i in range(300)]
        at = 20 + 3 * k
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:at] + [f"d{k}n{i}" for i in range(changed)] + w[at + changed:]))]
    return rows


def test_near_duplicates_between_080_and_085(spark, docs):
    close, far = similar_pairs(25), [(1000 + d, "far " + t.replace("d", "e")) for d, t in similar_pairs(32)]
    assert all(80 <= 100 * len(a & b) / len(a | b) < 85 for a, b in [[brute.shingles(t) for _, t in close[:2]]])
    assert all(100 * len(a & b) / len(a | b) < 80 for a, b in [[brute.shingles(t) for _, t in far[:2]]])
    d = docs(close + far)
    one = lambda percent: {r.doc_id: r.component_id for r in neardup.near_duplicates(d, percent=percent).collect()}
    assert one(80) == {i: i - i % 2 if i < 1000 else i for i, _ in close + far}
    assert all(a == b for a, b in one(85).items())
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, d, "").collect()}
    assert kept == {i for i, _ in close + far if i >= 1000 or i % 2 == 0}


def test_near_duplicates_at_080_equal_brute_force(docs, corpus):
    texts = {d: brute.shingles(t) for d, t in random.Random(1).sample(corpus, len(corpus)) if d is not None}
    want = {d: d for d in texts}
    links = [(a, b) for a in texts for b in texts if a < b and texts[a] and 100 * len(texts[a] & texts[b]) >= 80 * len(texts[a] | texts[b])]
    for _ in texts:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    out = neardup.near_duplicates(docs(corpus), percent=80).filter("doc_id is not null").collect()
    assert {r.doc_id: r.component_id for r in out} == want


def test_agreeing_coordinates():
    assert (neardup.agreeing(85), neardup.agreeing(80)) == (40, 35)


def test_only_verified_copies_keep_recurring_lines(docs):
    own = lambda i: " ".join(f"own{'abcdefghij'[i]}{'klmnopqrst'[k]}" for k in range(10))
    notice = "\n".join(f"the notice {a * 3} that every page of the house carries" for a in "abc")
    rows = [(i, f"{own(i)}\n{notice}") for i in range(6)]  # 30 of 40 words recur
    rows += [(10 + i, rows[0][1]) for i in range(3)]
    out = {r.doc_id: r.text for r in lines.without_recurring(docs(rows)).collect()}
    assert out == {0: rows[0][1], **{i: own(i) for i in range(1, 6)}, **{10 + i: rows[0][1] for i in range(3)}}


def filler(i):
    return " ".join(f"own{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[k]}" for k in range(10))


def test_short_lines_and_several_kinds_in_a_leaf(docs):
    rows = [(i, f"{filler(i)}\nAll rights reserved.") for i in range(6)]
    first = lambda i: f"user {'abcdef'[i] * 3} logged in from the {'ghijkl'[i] * 2} host at noon"
    log = [(100 + i, f"{filler(10 + i)}\nthe job server has started {'abcdef'[i] * 3} with all its workers") for i in range(6)]
    log += [(200 + i, f"{filler(20 + i)}\nthe job server lost touch {'abcdef'[i] * 3} and gave up waiting") for i in range(6)]
    log += [(300 + i, f"{filler(30 + i)}\nthe job server {' '.join('pqrstuvw'[(i + k) % 8] * (i + 2) for k in range(7))}") for i in range(8)]  # prose between them
    log += [(400, filler(50) + "\n" + first(0))]
    out = {r.doc_id: r for r in lines.without_recurring(docs(rows + log)).collect()}
    assert [out[i]._n_removed for i in range(6)] == [0, 1, 1, 1, 1, 1] and out[3].text == filler(3)
    assert [out[100 + i]._n_removed for i in range(6)] == [0, 1, 1, 1, 1, 1] == [out[200 + i]._n_removed for i in range(6)]
    assert {out[300 + i]._n_removed for i in range(8)} == {0} == {out[400]._n_removed}
    few = {r.doc_id: r._n_removed for r in lines.without_recurring(docs(rows[:5])).collect()}
    assert set(few.values()) == {0}  # prose repeats so short a line by chance


def test_the_query_spares_no_document(docs):
    notice = "\n".join(f"the notice {a * 3} that every page of the house carries" for a in "abc")
    rows = [(i, f"{filler(i)}\n{notice}") for i in range(6)]  # 30 of 40 words recur
    out = {r.doc_id: r._n_removed for r in lines.without_recurring(docs(rows), spare_copies=False).collect()}
    assert out == {0: 0, **{i: 3 for i in range(1, 6)}}


def test_short_items_with_a_word_changed(spark, docs):
    item = "which river runs past the old mill of the northern town"
    bench = spark.createDataFrame([(1, item), (2, "what is seven twelfths"), (3, "name two moons"), (4, "the"), (5, "of the"), (6, "a b c d e")], "item_id long, text string")
    rows = [(10, f"{filler(1)} {item.replace('old', 'new')} {filler(2)}"), (11, f"{filler(3)} what is seven twelfths {filler(4)}"), (12, "what is six twelfths"),
            (13, f"{filler(5)} {item.replace('old', 'new').replace('river', 'brook').replace('past', 'by')}"), (14, "name two moons"), (15, "x a b z d e y"), (16, "a b z d y")]
    rows.append((17, item.replace("which", "what").replace("town", "place")))
    want = brute.leaks(rows, [tuple(r) for r in bench.collect()])
    out = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert out == want and set(out) == {(10, 1), (11, 2), (14, 3), (15, 6), (17, 1)}


def test_short_masks_lose_nothing():
    """With any one substitution in 5 words, some placement of a short mask avoids it; so one does with any two in 10."""
    for n, bad in ((5, 1), (10, 2), (11, 2), (12, 2)):
        for gone in itertools.combinations(range(n), bad):
            assert any(not any(m[g - at] == "1" for g in gone if 0 <= g - at < len(m)) for m in decontaminate.SHORT_MASKS for at in range(n - len(m) + 1))


def test_licenses_in_source_comments(spark, docs):
    notices = dict(licenses.TEMPLATES)
    words = notices["apache-2.0-notice"].split()
    comment = lambda mark: "\n".join(f"{mark} {' '.join(words[i:i + 11])}" for i in range(0, len(words), 11))
    rows = [(k, f"{filler(k)}\n{comment(mark)}\n{filler(k + 1)}") for k, mark in enumerate((" *", "#", "//", "--", ";;", "<!--"))]
    found = {(r.doc_id, r.template_id) for r in licenses.scan(docs(rows), licenses.template_table(spark)).collect()}
    assert {(k, "apache-2.0-notice") for k in range(6)} <= found
    full = {(r.doc_id, r.template_id) for r in licenses.scan(docs(list(enumerate(notices.values()))), licenses.template_table(spark)).collect()}
    assert {(i, name) for i, name in enumerate(notices)} <= full


CLASHES = ("_text", "_all", "_words", "_drop", "_row", "_id_doc_id", "d", "drop", "held", "doc", "_n_removed", "all")


def test_clashing_column_names_pass_all_stages(spark, corpus):
    rows = [(d, t, "en", "s", None if t is None else len(t), *[f"{c}{i}" for c in CLASHES], {"k": str(i)}) for i, (d, t) in enumerate(corpus + corpus[:3])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES) + ", m map<string,string>"
    docs = spark.createDataFrame(rows, schema)
    asked = {tuple(r[5:-1]): r[0] for r in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert asked[tuple(r[c] for c in CLASHES)] == r.doc_id and r.m == {"k": r._text.removeprefix("_text")}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == len(rows)
