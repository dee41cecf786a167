"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LATE = 1 << 63  # a null doc_id is larger than all others


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated(rows, n, symbols, join):
    """op3 / op9: (doc_id, symbols, removed, spans, kept hash) of each (doc_id, text)."""
    seqs = [(LATE if d is None else d, symbols(t)) for d, t in rows]
    first = {}
    for d, s in seqs:
        for i in range(len(s) - n + 1):
            g = tuple(s[i:i + n])
            first[g] = min(first.get(g, d), d)
    out = []
    for (d, s), (doc, _) in zip(seqs, rows):
        cov = [False] * len(s)
        for i in range(len(s) - n + 1):
            if first[tuple(s[i:i + n])] < d:
                cov[i:i + n] = [True] * n
        spans = sum(c and not (i and cov[i - 1]) for i, c in enumerate(cov))
        out.append((doc, len(s), sum(cov), spans, sha(join([x for x, c in zip(s, cov) if not c]))))
    return out


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near(rows, percent=85):
    """op7: (doc_id, set size, component) of each (doc_id, text), linked from ``percent`` similarity; ids are distinct or null."""
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    known = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else find(d)) for d, s in sets]


def base_statistics(text):
    """op4: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def leaks(docs, items, wide=13, need=11):
    """op5: {(doc_id, item_id): most equal words of a window} on any alignment."""
    out = {}
    for d, t in docs:
        w = words((t or "").lower())
        for item, text in items:
            b = words((text or "").lower())
            if len(b) < 3:
                continue
            n = min(wide, len(b))
            enough = need if n == wide else (4 * n + 4) // 5 if n >= 5 else n
            for shift in range(-len(b) + 1, len(w)):
                lo, hi = max(0, -shift), min(len(b), len(w) - shift)
                eq = [b[j] == w[j + shift] for j in range(lo, hi)]
                best = max((sum(eq[i:i + n]) for i in range(len(eq) - n + 1)), default=0)
                if best >= enough:
                    out[d, item] = max(out.get((d, item), 0), best)
    return out


def quantile_low(values, q):
    """The least value with at least a share q of the values up to it."""
    v = sorted(values)
    return v[max(0, math.ceil(q * len(v)) - 1)]
