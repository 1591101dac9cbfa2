"""Plain Python versions of what the operators return."""

import hashlib
import re

SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text):
    words = SPACED.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def components(docs, percent):
    """docs: (doc_id, text) with distinct ids -> {doc_id: (n, component)}."""
    sets = {i: shingle_set(t) for i, t in docs}
    owner = {i: i for i in sets}

    def top(i):
        while owner[i] != i:
            i = owner[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for i in sets:
        near = {}
        for x in sets[i]:
            for j in by[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                owner[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}
