"""Plain counterparts of the operators for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def repeats(rows, length):
    """(id, bytes, removed, spans, digest of the rest) for rows (id, text)."""
    held = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in held for i in range(len(b) - length + 1))
    out = []
    for d, b in held:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=5):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(w) >= size:
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def near_groups(rows):
    """Per row (id, set size, smallest id reachable) for rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[top(j)] = top(i)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return out


def quality(row):
    """The base counts of a text."""
    d, text = row
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    return (d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """Spans of the patterns as kind:start:end, checked without cleverness."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(digits[::-1])]
                if not 16 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
