"""Plain versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(UPPER, UPPER.lower())


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def alnum_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def spans(mask):
    return [m.span() for m in re.finditer(b"\x01+", bytes(mask))]


def bytes_removed(docs, size, first_stays=False):
    """[(id, text)] in order -> {id: (bytes, removed, spans, kept hash)}."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter()
    for _, b in raw:
        seen.update(b[a:a + size] for a in range(len(b) - size + 1))
    out, before = {}, set()
    for i, b in raw:
        mask = bytearray(len(b))
        for a in range(len(b) - size + 1):
            s = b[a:a + size]
            if (s in before) if first_stays else seen[s] > 1:
                mask[a:a + size] = b"\x01" * size
            before.add(s)
        out[i] = (len(b), sum(mask), len(spans(mask)), sha(bytes(x for x, m in zip(b, mask) if not m)))
    return out


def words_removed(docs, size=13):
    """Windows that start in a document with a smaller key go."""
    first = {}
    for key, t in docs:
        w = words(t)
        for a in range(len(w) - size + 1):
            first.setdefault(tuple(w[a:a + size]), key)
    out = {}
    for key, t in docs:
        w = words(t)
        mask = bytearray(len(w))
        for a in range(len(w) - size + 1):
            if first[tuple(w[a:a + size])] < key:
                mask[a:a + size] = b"\x01" * size
        out[key] = (len(w), sum(mask), sha(b" ".join(x for x, m in zip(w, mask) if not m)))
    return out


def rule_statistics(text):
    b = (text or "").encode()
    w = words(text)
    lines, dup = set(), 0
    for line in b.split(b"\n"):
        if words(line.decode()):
            dup += line in lines
            lines.add(line)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    mask = bytearray(len(w))
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            mask[i:i + 3] = b"\x01" * 3
    repeat = sum(mask)
    return (len(w), sum(len(x.decode()) for x in w), sum(b.count(c) for c in b"#*$%&|<>"), dup, repeat,
            len(w) < 50 or 100 * repeat > 50 * len(w))


def simhash(text, shingle=3):
    import xxhash
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    s = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else (
        [b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(keys, links):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near_components(fingerprints, distance=3):
    """{key: fingerprint} -> {key: smallest key reachable}."""
    keys = sorted(fingerprints)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if (fingerprints[a] ^ fingerprints[b]).bit_count() <= distance]
    return components(keys, links)


def contamination(text, items, size=13):
    """items: [(id, text)] -> (words, hit, items, items hash, contaminated)."""
    windows = {}
    for i, t in items:
        w = alnum_words(t)
        n = min(size, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(str(i))
    w = alnum_words(text)
    mask, names = bytearray(len(w)), set()
    for n in {len(x) for x in windows}:
        for a in range(len(w) - n + 1):
            found = windows.get(tuple(w[a:a + n]))
            if found:
                names |= found
                mask[a:a + n] = b"\x01" * n
    hit = sum(mask)
    return len(w), hit, len(names), sha(",".join(sorted(names)).encode()), hit > 0 and 20 * hit >= len(w)
