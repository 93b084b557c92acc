"""Plain versions of the operators, for small tables."""

import hashlib
import re

import numpy as np
import xxhash

KINDS = ("email", "ip", "card", "phone")
_PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components(n, pairs):
    """For each of n things, the smallest one that pairs join it with."""
    low = list(range(n))

    def find(i):
        while low[i] != i:
            low[i] = low[low[i]]
            i = low[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        low[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def pii(text):
    out = []
    for kind, pattern in _PII:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1])]
                if not 12 <= len(d) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", lower(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def contamination(docs, items, window=10):
    """By doc: number of words, hit words, items."""
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + window]), set()).add("" if name is None else str(name))
    sizes = sorted({len(w) for w in windows})
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((len(w), hit, found))
    return out


def repeats(rows, length=100):
    """By doc_id: bytes, removed bytes, runs, digest of the rest."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        change = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                change[p] += 1
                change[p + length] -= 1
            seen.add(s)
        gone = np.cumsum(change)[:len(data)] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i] = (len(data), int(gone.sum()), runs, sha(bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out
