import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def docs(spark):
    """Builds documents of (doc_id, text) with further columns, some with names that the operators use."""
    def build(rows, partitions=3):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, w string, kept string, n_words string, line string, "
                  "template string, key string, kind string, part string, blob string, n_shingles string, h string, ids string, start string, d string, k string")
        full = [(d, t, "en" if i % 3 else None, None if i % 5 == 0 else "s", None if t is None else len(t), *["x"] * 15) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, schema).repartition(partitions)
    return build


@pytest.fixture(scope="session")
def corpus():
    """Small texts with copies, near copies, shared passages, nulls, empty and odd ones, ties and repeated rows."""
    import random

    r = random.Random(5)
    vocab = [a + b for a in ("the", "on", "ein", "que", "ß", "é", "lo", "ra") for b in ("", "st", "ré", "und", "$", ".", ",")]

    def text(n):
        return "".join(r.choice(vocab) + r.choice([" ", " ", " ", "  ", "\n", ".\n", "\t"]) for _ in range(n))

    base = [text(r.randint(1, 260)) for _ in range(30)]
    passage = text(70)
    line = "Page 12 of the licensed report of ours"
    rows = list(enumerate(base))
    for i, t in enumerate(base[:12]):
        w = t.split(" ")
        for k in range(3):
            v = list(w)
            for _ in range(max(1, len(v) // (60 >> k))):
                v[r.randrange(len(v))] = r.choice(vocab)
            rows.append((100 + 3 * i + k, " ".join(v)))
    rows += [(200 + i, base[i % 5]) for i in range(10)]
    rows += [(300 + i, text(30) + passage + text(30)) for i in range(8)]
    rows += [(400 + i, text(60) + "\n" + line.replace("12", str(i)) + "\n" + text(60)) for i in range(6)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "a b c d"), (505, "A b C d"), (506, "x" * 200), (507, "x" * 120), (508, "a " * 400), (509, "a " * 300)]
    rows += [(510, passage * 12), (None, base[0]), (None, None), (None, text(40)), (-7, base[1])]
    r.shuffle(rows)
    return rows
