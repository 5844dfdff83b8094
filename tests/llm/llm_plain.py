"""Plain Python versions of the training-data operators, for small tables."""
import collections
import hashlib
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def base_statistics(text):
    w = WORD.findall(text or "")
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    marked = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            marked.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked)


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[i:] for i in range(size)]))


def components(sets, percent):
    """{key: smallest key reachable} of {key: set} under the Jaccard threshold."""
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


BASE_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        return (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.split("."))
                or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15)
    return [(k, m.start(), m.end()) for k, p in BASE_PATTERNS for m in re.finditer(p, text or "") if ok(k, m.group())]


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Targets by repeated sharing of the excess."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out = dict.fromkeys(order, 0.0)
    left, open_ = budget * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        whole = sum(w[s] for s in open_)
        for s in open_:
            out[s] += left * w[s] / whole
        left = 0
        for s in list(open_):
            if out[s] > cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = cap * sizes[s]
                open_.discard(s)
    return out


def without_repeats(texts, length=400):
    """(bytes, removed, runs, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out
