"""Plain single-machine versions of the operators, for comparison in tests."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeated_windows(rows, depth):
    """{position: (n_bytes, n_removed, n_spans, sha)} of a list of texts."""
    raw = [(t or "").encode() for t in rows]
    seen = Counter(t[i : i + depth] for t in raw for i in range(len(t) - depth + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone[i : i + depth] = [True] * depth
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def shingles(text, words):
    found = SPLIT.findall(ascii_lower(text))
    if not found:
        return frozenset()
    run = min(words, len(found))
    return frozenset(tuple(found[i : i + run]) for i in range(len(found) - run + 1))


def jaccard_components(rows, words, percent):
    """(id, shingles, smallest id of the component) for (id, text)."""
    sets = [(i, shingles(t, words)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_word: dict = {}
    for k, (_, s) in enumerate(sets):
        for w in s:
            by_word.setdefault(w, []).append(k)
    pairs = Counter()
    for members in by_word.values():
        for a in range(len(members)):
            for b in range(a):
                pairs[members[b], members[a]] += 1
    for (a, b), both in pairs.items():
        if 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
            parent[root(a)] = root(b)
    least: dict = {}
    for k, (i, _) in enumerate(sets):
        r = root(k)
        least[r] = i if r not in least or least[r] is None else least[r] if i is None else min(least[r], i)
    return [(i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets)]
