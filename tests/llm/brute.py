"""Plain versions of the operators, for small tables."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeated(sequences, window):
    """For each sequence, which items a window that starts elsewhere too covers."""
    times = Counter(s[i : i + window] for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        hit = [False] * len(s)
        for i in range(len(s) - window + 1):
            if times[s[i : i + window]] > 1:
                hit[i : i + window] = [True] * window
        out.append(hit)
    return out


def base_counts(text):
    w, text = words(text), text or ""
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, again = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def cosine(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
