"""Plain versions of the operators, by their definitions."""

import hashlib
import re
from collections import Counter


def tuples(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def without_repeats(rows, least):
    """(id, n_bytes, n_removed, n_spans, kept) of (id, text)."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    windows = Counter(b[p:p + least] for _, b in texts for p in range(len(b) - least + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - least + 1):
            if windows[b[p:p + least]] > 1:
                gone[p:p + least] = [True] * least
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def near_components(rows, width, p, q):
    """(id, n_shingles, component id) of (id, text)."""
    sets = [shingles(t, width) for _, t in rows]
    lists, up = {}, list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in lists.get(g, ()))
        for j, n in both.items():
            if q * n >= p * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
        for g in s:
            lists.setdefault(g, []).append(i)
    ids = [i for i, _ in rows]
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min((x for x in (least.get(root(i)), ids[i]) if x is not None), default=None)
    return [(ids[i], len(sets[i]), least[root(i)]) for i in range(len(ids))]
