"""Plain definitions of the operators' results, one document (or pair) at a time."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def top_k(rows, is_query, k=5):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept[i, tuple(int(np.floor(256 * float(x))) for x in v)] = None
    out = []
    for qi, qv in kept:
        if is_query(qi):
            scored = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in kept if i != qi and len(v) == len(qv)]
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def exact_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        body = (t or "").translate(LOWER)
        ids = [x for x in groups[body] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return out


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def jaccard(rows, words, percent):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    full = [(i, s) for i, s in sets if s and i is not None]
    for a, (i, x) in enumerate(full):
        for j, y in full[:a]:
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= percent * (len(x) + len(y) - n):
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets if i is not None)


_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text):
    out = []
    for kind, pattern in _PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def pieces(rows, tokenizer, capacity=2048):
    out = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for p, lo in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[lo : lo + capacity], dtype="<u4")
            out.append((i, p, lo, len(part), zlib.crc32(part.tobytes())))
    return out
