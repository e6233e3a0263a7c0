"""Plain versions of what the operators compute."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def connected(n, pairs):
    """The least index of the component of each of ``n``."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(x) for x in range(n)]


def brute_runs(docs, min_words):
    """Lines kept and removed of (id, text) rows, by trying every run of every document."""
    lines = [text.split("\n") if text is not None else [] for _, text in docs]
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    first = {}
    for nth, k in enumerate(order):
        for lo in range(len(lines[k])):
            for hi in range(lo + 1, len(lines[k]) + 1):
                first.setdefault(tuple(lines[k][lo:hi]), (nth, lo))
    out = {}
    for nth, k in enumerate(order):
        words = [len(WORDS.findall(x)) for x in lines[k]]
        gone = set()
        for lo in range(len(lines[k])):
            for hi in range(lo + 1, len(lines[k]) + 1):
                if sum(words[lo:hi]) >= min_words and first[tuple(lines[k][lo:hi])] < (nth, lo):
                    gone.update(range(lo, hi))
        kept = None if docs[k][1] is None else "\n".join(x for p, x in enumerate(lines[k]) if p not in gone)
        out[k] = (kept, sorted(gone))
    return out
