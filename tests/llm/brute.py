"""Plain versions of the operators' results, for small tables."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, kept_sha256)}; docs in ascending order."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def fingerprint(text, k=4):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[p : p + k]) for p in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    """{node: smallest node reachable}; linked(a, b)."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def secrets(text):
    """Spans (start, kind, end) of the known forms."""
    found = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), "assign", m.end()))
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], ("assign", "access", "hex").index(s[1])))


def top_k(vectors, every, k):
    ids = np.array([i for i, _ in vectors])
    x = np.floor(np.array([v for _, v in vectors], float) * 1024).astype(np.int64)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        s = x @ x[q]
        order = [o for o in np.lexsort((ids, -s)) if ids[o] != ids[q]][:k]
        out += [(int(ids[q]), r, int(ids[o]), int(s[o])) for r, o in enumerate(order, 1)]
    return sorted(out)
