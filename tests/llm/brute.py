"""Plain versions of the operators' contracts, for small tables."""

import re
import zlib


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(rows, k, percent):
    """(doc_id, n, component, kept) of [(doc_id, text)] with unique ids."""
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    both = {}
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                both[a, b] = both.get((a, b), 0) + 1
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in sets)


def repeats(rows, length):
    """{doc_id: (n_bytes, n_removed, n_spans, kept bytes)} of [(doc_id, text)]."""
    first = {}
    data = {d: (t or "").encode() for d, t in rows}
    for d in sorted(data):
        for i in range(len(data[d]) - length + 1):
            first.setdefault(data[d][i:i + length], d)
    out = {}
    for d, x in data.items():
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if first[x[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(x), sum(gone), spans, bytes(b for b, g in zip(x, gone) if not g))
    return out


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
