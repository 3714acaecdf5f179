"""The pipeline after its filter, restated by brute force."""

import re


def pipeline_after_filter(rows):
    """{doc_id: words left} of (doc_id, text) rows."""
    import xxhash
    rows = sorted(rows)
    seen, first = set(), []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if norm not in seen:
            seen.add(norm)
            first.append((i, t))
    fp = {}
    for i, t in first:
        w = [x.lower() for x in (t or "").encode().split()]
        parts = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(fp)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out, windows = {}, set()
    for i, t in first:
        if find(i) != i:
            continue
        w = (t or "").split()
        off = [False] * len(w)
        for k in range(len(w) - 19):
            q = tuple(w[k:k + 20])
            if q in windows:
                off[k:k + 20] = [True] * 20
            windows.add(q)
        out[i] = off.count(False)
    return out
