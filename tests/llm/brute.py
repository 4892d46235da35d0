"""Plain, slow versions of the operators, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_components(docs, percent=85):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) pairs; every pair that shares a shingle is compared."""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            up[d] = up[up[d]]
            d = up[d]
        return d
    at = {}
    for d, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(d)
    done = set()
    for group in at.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if (a, b) in done or root(a) == root(b):
                    continue
                done.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}
