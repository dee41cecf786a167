"""The training-data operators against plain Python, on small texts with every odd case."""

import hashlib
import json
import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from lakeshelf.llm import chat, decontaminate, licenses, lines, neardup, pieces, quality, repair, substrings, suffixes
from lakeshelf.llm.components import components

ODD = "abAB   \n\tß漢😀.,$'01▁\x00 ́"


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def total(column):
    from pyspark.sql import functions as F

    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x["length"])


def test_substrings(docs, corpus):
    from pyspark.sql import functions as F

    out = substrings.without_repeated_words(docs(corpus)).select("doc_id", "n_words", total("removed").alias("r"), F.size("removed").alias("s"), F.sha2("kept", 256).alias("h"))
    want = brute.repeated(corpus, 13, brute.words, " ".join)
    assert got(out, "*") == sorted(want, key=repr)


@pytest.mark.parametrize("window, base, levels", [(2, 4, [1, 2]), (5, 1, [1, 2, 3, 5]), (26, 4, [4, 7, 13, 26]), (13, 13, [7, 13])])
def test_substring_levels(docs, corpus, window, base, levels):
    """Any target and first length give the windows of the target; each level is twice the one before, or one less."""
    from pyspark.sql import functions as F

    assert substrings.doubled(window, base) == levels
    some = corpus[::3]
    out = substrings.without_repeated_words(docs(some), window, base)
    out = out.select("doc_id", "n_words", total("removed").alias("r"), F.size("removed").alias("s"), F.sha2("kept", 256).alias("h"))
    assert got(out, "*") == sorted(brute.repeated(some, window, brute.words, " ".join), key=repr)


def test_substrings_chained_and_frequent(docs):
    """Halves that repeat apart from each other are no repeat; a window in all texts, often in each, is one; nothing left ends the levels."""
    half = [[f"{c}{i}" for i in range(7)] for c in "abcd"]
    rows = [(1, " ".join(half[0] + half[1])), (2, " ".join(half[0] + half[2])), (3, " ".join(half[3] + half[1])), (4, " ".join(half[0] + half[1][:6]))]
    out = {r.doc_id: [(x.start, x.length) for x in r.removed] for r in substrings.without_repeated_words(docs(rows)).collect()}
    assert out == {1: [], 2: [], 3: [], 4: [(0, 13)]}
    often = [(i, "x " * (13 + i)) for i in range(40)]
    out = {r.doc_id: (r.n_words, sum(x.length for x in r.removed)) for r in substrings.without_repeated_words(docs(often)).collect()}
    assert out == {i: (13 + i, 13 + i if i else 0) for i in range(40)}
    none = [(i, " ".join(f"{i}-{k}" for k in range(50))) for i in range(5)]
    assert [r.removed for r in substrings.without_repeated_words(docs(none)).collect()] == [[]] * 5


def test_suffixes(docs, corpus):
    from pyspark.sql import functions as F

    out = suffixes.without_repeated_bytes(docs(corpus)).select("doc_id", "n_bytes", total("removed").alias("r"), F.size("removed").alias("s"), F.sha2("kept", 256).alias("h"))
    want = brute.repeated(corpus, 50, lambda t: (t or "").encode(), bytes)
    assert got(out, "*") == sorted(want, key=repr)


def test_suffixes_rows_that_share_a_doc_id(docs):
    a, b = "".join(map(chr, range(32, 122))), "".join(map(chr, range(122, 32, -1)))
    out = suffixes.without_repeated_bytes(docs([(5, a), (5, b), (5, a), (7, b)]))
    assert sorted((r.doc_id, r.n_bytes, sum(x.length for x in r.removed)) for r in out.collect()) == [(5, 90, 0), (5, 90, 0), (5, 90, 0), (7, 90, 90)]


@pytest.mark.parametrize("make", [substrings.without_repeated_words, suffixes.without_repeated_bytes, neardup.near_duplicates, quality.judged, pieces.encoded,
                                  lines.without_recurring])
def test_empty_tables(spark, make):
    assert make(empty(spark)).collect() == []


def test_near_duplicates(docs, corpus):
    out = neardup.near_duplicates(docs(corpus))
    assert got(out, "doc_id", "n_shingles", "component_id") == sorted(brute.near(corpus), key=repr)


def test_near_duplicates_of_a_group_without_a_hub(docs):
    """A chain of texts, each similar only to its neighbours, is one component."""
    r = random.Random(3)
    w = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        rows.append((1000 - i, " ".join(w)))
        at = r.randrange(380)
        w[at:at + 5] = [f"n{i}x{k}" for k in range(5)]
    out = neardup.near_duplicates(docs(rows))
    assert got(out, "doc_id", "n_shingles", "component_id") == sorted(brute.near(rows), key=repr)


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, x) for x in range(5001, 5100)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got(components(spark.createDataFrame(edges, "a long, b long")), "node", "component") == sorted(((x, find(x)) for x in nodes), key=repr)


def test_quality_statistics_and_base_rules(docs, corpus):
    out = quality.judged(docs(corpus), ["doc_id", "text"]).collect()
    assert len(out) == len(corpus)
    for r in out:
        s = brute.base_statistics(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
        assert r.base_failed == (s[0] < 20 or 100 * s[4] > 30 * s[0])
        assert r.kept is not None and not (r.kept and r.base_failed)


def robust_distances(texts):
    """Squared distances of texts from their group's least-determinant estimate, in numpy."""
    x, noise = [], []
    for t in texts:
        n, c, s, d, rep = brute.base_statistics(t)
        lines = max(1, sum(bool(brute.WORD.search(z)) for z in t.split("\n")))
        x.append([np.log(c / n), np.sqrt(s / n), np.sqrt(d / lines), np.sqrt(rep / n)])
        noise.append([0.25 / n, 0.25 / n, 0.25 / lines, 2 / n])
    x, noise = np.array(x), np.mean(noise, 0)
    half = lambda v: brute.quantile_low(v, 0.5)

    def dist(m, cov):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov + np.diag(noise)), x - m)

    def step(m, cov):
        d2 = dist(m, cov)
        near = x[d2 <= brute.quantile_low(d2, quality.SHARE) + 1e-12]
        cov = np.cov(near.T, bias=True)
        return np.linalg.slogdet(cov + np.diag(noise))[1], near.mean(0), cov

    m = np.array([half(c) for c in x.T])
    far = np.sqrt(((x - m) ** 2 / noise).sum(1))
    z = (x - m) / np.maximum(far, 1e-9)[:, None]
    starts = [(m, np.diag([(1.4826 * half(abs(c - k))) ** 2 for c, k in zip(x.T, m)])), (x.mean(0), np.cov(x.T, bias=True)),
              (m, z.T @ z / len(x) * half(far ** 2))]
    ends = []
    for start in starts:
        best = step(*start)
        while (new := step(*best[1:]))[0] < best[0] - 2e-9:
            best = new
        ends.append(best)
    _, m, cov = min(ends, key=lambda e: e[0])
    near = x[dist(m, quality.CONSISTENT[0] * cov) <= quality.REWEIGHT]
    return dist(near.mean(0), quality.CONSISTENT[1] * np.cov(near.T, bias=True))


def test_quality_outliers(spark):
    """The verdicts equal those of the same estimate in numpy, for a group of its own, a pooled one and a null one."""
    r = random.Random(2)
    rows = []
    for i in range(700):
        lang, source = ("en", "big") if i < 400 else ("en", f"s{i % 3}") if i < 650 else (None, None)
        w = ["word" * r.randint(1, 2) + "x" * r.randint(0, 3) for _ in range(r.randint(25, 120))]
        if i % 29 == 0:
            w = [x + "$$$" for x in w]
        if i % 31 == 0:
            w = ["q" * 60 for _ in w[:6]] + [f"{'z' * 40}{k}" for k in range(30)]
        rows.append((i, " ".join(w) + "\n" + " ".join(w[:3]), lang, source))
    out = {x.doc_id: x for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    groups = {}
    for i, t, lang, source in rows:
        if not out[i].base_failed:
            groups.setdefault("big" if source == "big" else "pool" if lang else "rest", []).append((i, t))
    for name, members in groups.items():
        reject = (robust_distances([t for _, t in members]) > quality.CUTOFF) & (len(members) >= quality.MIN_POOL)
        assert [out[i].kept for i, _ in members] == [not z for z in reject], name
        assert name == "rest" or 0 < reject.sum() < 0.2 * len(members)


def test_quality_limits_follow_the_group(spark):
    """The same texts are outliers where a group's own spread is small and usual where it is large, also along a joint direction."""
    r = random.Random(4)

    def text(mean, symbols, n=200):
        return " ".join("w" * max(1, round(r.gauss(mean, 1))) + ("$" if k < symbols else "") for k in range(n))

    rows = [(i, text(6, 0), "en", "even") for i in range(300)]
    wide = [r.uniform(-1, 1) for _ in range(300)]
    rows += [(1000 + i, text(6 + 2 * u, round(40 + 39 * u)), "en", "wide") for i, u in enumerate(wide)]  # long words go with symbols
    same = [text(6, 40) for _ in range(5)]
    rows += [(2000 + i, t, "en", "even") for i, t in enumerate(same)] + [(3000 + i, t, "en", "wide") for i, t in enumerate(same)]
    rows += [(4000 + i, text(4, 79), "en", "wide") for i in range(5)]  # each coordinate is usual, the pair is not
    out = {x.doc_id: x.kept for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for group, first in (("even", 0), ("wide", 1000)):
        assert sum(out[first + i] for i in range(300)) >= 297, group
    assert not any(out[2000 + i] for i in range(5)) and all(out[3000 + i] for i in range(5)) and not any(out[4000 + i] for i in range(5))


def test_each_mask_avoids_any_two_substitutions():
    for mask in decontaminate.MASKS:
        ones = [i for i, b in enumerate(mask) if b == "1"]
        for subs in combinations(range(decontaminate.OVERLAP), 2):
            assert any(not any(a + i in subs for i in ones) for a in range(decontaminate.OVERLAP - len(mask) + 1)), (mask, subs)


def test_contaminated(spark, docs):
    r = random.Random(4)
    vocab = [f"v{i}" for i in range(60)] + ["the", "of"] * 10
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([40, 30, 13, 14, 9, 5, 12, 3, 0])] + [(50, None), (None, " ".join(text(20)))]
    items.append((60, items[0][1].upper()))
    rows = [(500, None), (501, ""), (None, items[1][1])]
    for i in range(120):
        w = text(r.randint(0, 60))
        item = (r.choice(items)[1] or "").split()
        lo = r.randint(0, max(0, len(item) - 13))
        part = item[lo:lo + r.randint(11, 40)]
        for _ in range(r.randint(0, 5)):
            if part:
                part[r.randrange(len(part))] = r.choice(vocab)
        at = r.randint(0, len(w))
        rows.append((i, r.choice([" ", "\n", "  "]).join(w[:at] + part + w[at:])))
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")
    out = decontaminate.contaminated(docs(rows), bench)
    want = brute.leaks(rows, items)
    assert got(out, "doc_id", "item_id", "n_equal") == sorted(((*k, v) for k, v in want.items()), key=repr)
    assert len(want) > 40
    for none in (bench.limit(0),):
        assert decontaminate.contaminated(docs(rows), none).collect() == []
    assert decontaminate.contaminated(empty(spark), bench).collect() == []


def test_licenses(spark, docs):
    notices = dict(licenses.TEMPLATES)
    mit = notices["mit-notice"].split()
    rows = [(1, "x y z " * 30 + notices["mit-notice"].upper().replace(" ", "\n") + " tail"), (2, " ".join(mit[:30])), (3, " ".join(mit[:60])), (4, None), (5, ""), (6, "MIT"),
            (None, "a b c d e. Released under the MIT License."), (7, " ".join(mit[:20] + ["changed"] + mit[21:])), (8, "Released under the MIT Licence."),
            (9, "Released under the MIT License. " * 300)]
    found = {(r.doc_id, r.template_id): (r.n_shared, r.n_template, r.word) for r in licenses.scan(docs(rows), licenses.template_table(spark)).collect()}
    m = len({tuple(mit[i:i + 5]) for i in range(len(mit) - 4)})
    assert set(found) == {(1, "mit-notice"), (3, "mit-notice"), (7, "mit-notice"), (None, "mit-line"), (9, "mit-line")}
    assert found[1, "mit-notice"][:2] == (m, m) and found[9, "mit-line"] == (1, 1, 0)
    assert licenses.scan(docs(rows), licenses.template_table(spark).limit(0)).collect() == []


def test_lines(spark, docs):
    long = "these words stand alone in the text of number "
    filler = lambda i: "\n".join(f"{a}{i}z{k} stays as {b}{i} it was here" for k, (a, b) in enumerate(zip("pqrst", "uvwxy")))
    filler = lambda i: " ".join(f"f{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}{'xyzuv'[k % 5] * (k + 1)}" for k in range(24))
    rows = [(i, f"{filler(i)}\nSubscribe to our weekly letter now\nReport {i} of the day 1{i}\n\n{long}{filler(i + 40)}") for i in range(6)]
    rows += [(20, None), (21, ""), (22, "Subscribe to our weekly letter now"), (23, "two words\ntwo words"), (24, f"two words\n{filler(30)}"), (25, f"two words\n{filler(31)}"),
             (None, "Subscribe to our weekly letter now"), (30, f"Subscribe to the brand new weekly letter today dear\n{filler(32)}"),
             (31, f"Subscribe to the brand old weekly letter today dear\n{filler(33)}"), (32, f"Subscribe to the brand new weekly letter today sir\n{filler(34)}")]
    out = {(r.doc_id, r.source, r.text): r for r in lines.without_recurring(docs(rows)).collect()}
    text = {r.doc_id: r.text for r in out.values() if r.doc_id is not None}
    removed = {r.doc_id: r._n_removed for r in out.values() if r.doc_id is not None}
    assert text[0] == rows[0][1] and text[3] == f"{filler(3)}\n\n{long}{filler(43)}"
    assert [removed[i] for i in range(6)] == [0, 2, 2, 2, 2, 2]
    assert text[20] is None and text[21] == "" and text[22].startswith("Subscribe") and text[24].startswith("two")  # a copy as a whole; too few words
    assert {r.text for r in out.values() if r.doc_id is None} == {"Subscribe to our weekly letter now"}
    assert removed[30] == 0 and removed[31] == removed[32] == 1  # one template of the leaf, by the words most lines have
    bare = {r.doc_id: r._n_removed for r in lines.without_recurring(docs(rows), spare_copies=False).collect()}
    assert bare[22] == 1


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(pieces.default_model())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=6))
def test_pieces_equal_the_library(texts):
    enc = test_pieces_equal_the_library.enc = getattr(test_pieces_equal_the_library, "enc", None) or pieces.PieceEncoder(pieces.default_model())
    assert [x.tolist() for x in enc.encode(pa.array(texts, pa.string()))] == enc.library.encode(texts, num_threads=1)


def test_pieces_long_runs(encoder):
    texts = [c * n for c in " a-=\n0" for n in (1, 2, 3, 15, 16, 17, 64, 301)] + ["a" * 3000 + " " * 2000 + "b"]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == encoder.library.encode(texts, num_threads=1)


def test_pieces_backtrack(encoder):
    """Parts where the longest piece first is wrong exist, so backtracking and neighbour checks are at work."""
    words = ["the", "unbelievable", "ention", "Therheading", "queeaux", "straße", "xxxxxxxx", "ererererst"]
    greedy = 0
    for w in words:
        s = pieces.SPACE + w
        out, at = [], 0
        while at < len(s):
            n = max(k for k in range(1, len(s) - at + 1) if s[at:at + k] in encoder.id)
            out.append(encoder.id[s[at:at + n]])
            at += n
        assert encoder.backtracked(s) == encoder.merged(s)
        greedy += out != encoder.backtracked(s)
    assert greedy


def test_encoded(docs, corpus, encoder):
    out = {(r.doc_id, r.decoded): list(r.ids) for r in pieces.encoded(docs(corpus)).collect()}
    for d, t in corpus:
        ids = encoder.library.encode(t or "", add_bos=True, add_eos=True)
        assert out[d, encoder.library.decode(ids)] == ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=40), max_size=12), st.integers(2, 6))
def test_grammars_round_trip(parts, least):
    ids = np.array([x for p in parts for x in p], np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    symbols, at, rules, lengths = repair.compress(ids, starts, min_count=least, max_rounds=8)
    row = dict(doc_ids=np.arange(len(parts)).tobytes(), doc_at=at.astype(np.uint32).tobytes(), rules=rules.astype(np.uint32).tobytes(),
               lengths=lengths.astype(np.uint32).tobytes(), symbols=symbols.astype(np.uint32).tobytes(), wide=True)
    block = repair.Block(row)
    assert block.ids().tolist() == ids.tolist() and block.starts().tolist() == starts.tolist()
    assert [block.document(k).tolist() for k in range(len(parts))] == parts
    assert len(symbols) <= len(ids)


def test_grammars_compress():
    ids = np.tile(np.arange(50, dtype=np.uint32), 200)
    symbols, _, rules, lengths = repair.compress(ids, np.array([0, len(ids)]))
    assert len(symbols) < len(ids) / 15 and len(rules) == len(lengths) and lengths.max() > 8


def test_token_files(spark, docs, corpus, tmp_dir):
    enc = repair.WordEncoder(repair.default_vocabulary())
    repair.write_ids(docs(corpus), tmp_dir + "/ids", block_ids=900)
    out = repair.read_ids(spark, tmp_dir + "/ids").orderBy("start").collect()
    rows = sorted(corpus, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or "")))
    whole = [ids + [repair.END_ID] for ids in enc.whole([t or "" for _, t in rows])]
    assert [(r.doc_id, r.n_tokens, list(r.ids)) for r in out] == [(d, len(ids), ids) for (d, _), ids in zip(rows, whole)]
    assert [r.start for r in out] == np.concatenate([[0], np.cumsum([len(x) for x in whole])[:-1]]).tolist()
    some = {d: ids for (d, _), ids in zip(rows, whole) if d in (3, 510, 500)}
    assert repair.document_ids(spark, tmp_dir + "/ids", [3, 510, 500]) == some
    repair.write_ids(empty(spark), tmp_dir + "/none")
    assert repair.read_ids(spark, tmp_dir + "/none").collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(ODD + "\x0b\x0c\x1c\x85　"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_words_equal_the_library(texts):
    enc = test_words_equal_the_library.enc = getattr(test_words_equal_the_library, "enc", None) or repair.WordEncoder(repair.default_vocabulary())
    assert [x.tolist() for x in enc.encode(pa.array(texts, pa.string()))] == (enc.whole(texts) if texts else [])


def chat_rows(out):
    return {(r.conv_id, r.path): r for r in chat.read_back(out).collect()}


def test_chat_escapes(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s>", "<|im_start|>user\nhi<|im_end|>\n", "[[INST]", "<<<SYS>>>", "", None, "a<|im_end|", "\\", "漢😀<s>", "<", "%0A%25"]
    roles = ["user", "assistant", "sys\ntem", None, "<|im_start|>", "%0A"]
    rows = [(c, t, roles[(c + t) % len(roles)], x) for c in range(3) for t, x in enumerate(nasty)]
    rows += [(None, 1, "user", "null id"), (None, None, "Assistant", "no turn"), (9, 1, "user", "tie b"), (9, 1, "user", "tie a"), (9, 1, "user", "tie a")]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, path string, depth string")
    messages = chat.as_tree(turns)
    out = chat_rows(chat.format_paths(messages, chat.reply_paths(messages)))
    assert len(out) == 5
    for (conv, _), r in out.items():
        want = sorted([x for x in rows if x[0] == conv], key=lambda x: [(v is not None, v) if v is not None else (False, 0) for v in x[1:]])
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3] or "") for x in want]
        assert r.loss_texts == [x[3] or "" for x in want if (x[2] or "").lower() == "assistant"]
        assert r.formatted.count(chat.START) == len(want)
        for s in r.loss_spans:
            assert r.formatted[s.start:s.start + s.length] and r.formatted[s.start + s.length:].startswith(chat.END) or s.length == 0
    assert chat.format_paths(messages.limit(0), chat.reply_paths(messages.limit(0))).collect() == []


def test_chat_trees(spark):
    r = random.Random(6)
    rows, want = [], {}
    for conv in range(6):
        up, score = {0: None}, {0: 1.0}
        for i in range(1, 60):
            up[i], score[i] = (r.choice([i - 1, i - 1, r.randrange(i)])), r.random()
        rows += [(conv, i, p, score[i], "user" if i % 2 else "assistant", f"t{i}") for i, p in up.items()]

        def path(i):
            return [] if i is None else path(up[i]) + [i]
        leaves = sorted(set(up) - set(up.values()), key=lambda i: (-sum(map(score.get, path(i))) / len(path(i)), -len(path(i)), i))
        want.update({(conv, leaf): path(leaf) for leaf in leaves[:2]})
    rows += [(90, 1, 2, 0.5, "user", "cycle"), (90, 2, 1, 0.5, "user", "cycle"), (90, 3, 77, 0.5, "user", "lost parent"), (91, 5, 5, 0.0, "user", "self")]
    want[90, 3] = [3]
    messages = spark.createDataFrame(rows, "conv_id long, msg_id long, parent_id long, score double, role string, text string")
    out = chat_rows(chat.format_paths(messages, chat.reply_paths(messages, 2)))
    assert {k: [t.text for t in v.turns] for k, v in out.items()} == {k: [("lost parent" if k[0] == 90 else f"t{i}") for i in v] for k, v in want.items()}
