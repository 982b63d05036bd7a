"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(texts: dict, k: int, threshold: int) -> dict:
    """{id: least id that links of similarity reach}."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in ids}


def repetition(text):
    """(words, word characters, symbols, repeated lines, repeated words, longest repeat in words)."""
    w = WORD.findall(text or "")
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    order = sorted(range(len(w)), key=lambda i: w[i:])
    longest = 0
    for i, j in zip(order, order[1:]):
        n = 0
        while max(i, j) + n < len(w) and w[i + n] == w[j + n]:
            n += 1
        longest = max(longest, n)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked), longest


def covered(text, least):
    """Words inside strings of ``least`` words or more that start twice or more in the text."""
    w = WORD.findall(text or "")
    seen = collections.Counter(tuple(w[i : i + least]) for i in range(len(w) - least + 1))
    return len({j for i in range(len(w) - least + 1) if seen[tuple(w[i : i + least])] > 1 for j in range(i, i + least)})


def removed(rows: list, length: int) -> list:
    """(bytes, removed, spans, digest of the rest) for each text of ``rows``."""
    texts = [(t or "").encode() for t in rows]
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def toxicity(texts: dict, labels: list) -> dict:
    """{id: score} by a scan of all labelled examples; small enough that every one of them is an example."""
    fold = bytes(b + 32 if 65 <= b < 91 else b if b > 127 or 97 <= b < 123 else 32 for b in range(256))

    def terms(t):
        p = b"    " + (t or "").encode().translate(fold) + b"    "
        return collections.Counter(p[i : i + 5] for i in range(len(p) - 4))

    known: dict = {}
    for i, toxic in labels:
        if i in texts and not _held_out(i):
            known[i] = max(toxic, known.get(i, 0))
    ids, held = sorted(known), {i: terms(t) for i, t in texts.items()}
    n = [sum(v == c for v in known.values()) for c in (0, 1)]
    counts = [collections.Counter(x for i in ids if known[i] == c for x in held[i]) for c in (0, 1)]
    vocabulary = {}
    for x in counts[0] | counts[1]:
        both, p = counts[0][x] + counts[1][x], (counts[0][x] + counts[1][x]) / sum(n)
        gap = (counts[1][x] / n[1] - counts[0][x] / n[0]) ** 2
        if both >= 5 and p < 1 and gap >= max(0.02, 3.84 * (1 / n[0] + 1 / n[1])) * p * (1 - p):
            vocabulary[x] = math.log((1 + len(ids)) / (1 + both)) + 1

    def vector(i):
        v = {x: (1 + math.log(c)) * vocabulary[x] for x, c in held[i].items() if x in vocabulary}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    vectors = {i: vector(i) for i in texts}
    prior = n[1] / sum(n)

    def vote(i, without=None):
        own = vectors[i]
        near = [(-round(s, 12), j) for j in ids if j != without and (s := sum(w * vectors[j].get(x, 0.0) for x, w in own.items())) > 0]
        near = sorted(near)[:31]
        weight = [s**4 for s, _ in near]
        return round((sum(w for w, (_, j) in zip(weight, near) if known[j]) + 0.01 * prior) / (sum(weight) + 0.01), 9)

    votes = sorted((vote(i, i), known[i]) for i in ids)
    steps: list = []  # pools of (first vote, sum, number)
    for v, group in itertools.groupby(votes, key=lambda x: x[0]):
        y = [b for _, b in group]
        steps.append((v, sum(y), len(y)))
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, b, m = steps.pop()
            v0, a, k = steps.pop()
            steps.append((v0, a + b, k + m))
    out = {}
    for i in texts:
        v = vote(i)
        below = [s for s in steps if s[0] <= v] or steps[:1]
        out[i] = below[-1][1] / below[-1][2]
    return out
