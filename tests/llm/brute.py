"""Plain single-process versions of the operators."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near(rows, percent):
    """{id: (set size, component)} for rows (id, text) of distinct ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def cut(rows, length):
    """{position in rows: (n_bytes, n_removed, n_spans, sha, kept bytes)}; rows of an id are at equal places."""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        for i in range(len(b) - length + 1):
            x = b[i : i + length]
            first[x] = min(first.get(x, (d, i)), (d, i))
    out = {}
    for k, (d, b) in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(v for v, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def contained(docs, items, threshold=0.8):
    found = {}
    own = {i: shingle_set(t) for i, t in items}
    for d, t in docs:
        s = shingle_set(t)
        for i, x in own.items():
            if x and len(s & x) >= threshold * len(x):
                found[d, i] = (len(x), len(s & x))
    return found
