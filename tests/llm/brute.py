"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def near_duplicates(rows):
    """Rows (doc_id, n_shingles, component_id, kept) for unique ids."""
    sets, where, root = {}, defaultdict(list), {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, text in sorted(rows):
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        root[i] = i
        shared = Counter(j for g in sets[i] for j in where[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in sets[i]:
            where[g].append(i)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in root)


def repeated_passages(rows, length=50):
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(i, first.get(b[p : p + length], i))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        spans = np.flatnonzero(np.diff(gone, prepend=False, append=False))
        out.append((i, len(b), int(gone.sum()), len(spans) // 2, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out)


def sketch(text, k=128):
    def chained(words):
        h = 42
        for w in words:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        return h - (1 << 64) if h >> 63 else h

    w = [x for x in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if x]
    found = {chained(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {chained(w)} if w else set()
    return sorted(found)[:k]


def likeness(a, b, k=128):
    whole = sorted({*a, *b})[:k]
    return len({*whole} & {*a} & {*b}) / len(whole) if whole else 1.0


def fingerprints(rows):
    """Rows of the query for unique ids."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    text = lambda s: "".join(f"{h & (1 << 64) - 1:016x}" for h in s)
    out = []
    for at, (i, t) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        a, b = sketch(t), sketch(edited)
        out.append((i, len(t), sha(edited), text(a), text(b), likeness(a, b), likeness(a, sketch(following))))
    return sorted(out)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal_data(text):
    """Base spans (start, kind number, end, kind)."""
    out = []
    for n, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def contamination(docs, items, window=10):
    def words(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - window) + 1 if w else 0):
            windows[tuple(w[i : i + window])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if own := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), sha(ids), bool(hit)))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())
