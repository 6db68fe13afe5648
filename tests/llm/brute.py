"""Plain statements of the results, for small tables."""

import hashlib
import math
import re
from collections import Counter


def shingle_sets(rows, width=5):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        if len(words) >= width:
            out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
        else:
            out.append({tuple(words)} if words else set())
    return out


def jaccard_components(rows):
    """Per row ``(id, set size, component)``; links where 100 * shared >= 75 * union."""
    sets, having = shingle_sets(rows), {}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        shared = Counter(j for x in own for j in having.get(x, ()))
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in own:
            having.setdefault(x, []).append(i)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, len(sets[i]), low.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def substring_removal(rows, length=50):
    """``{id: (bytes, removed, spans, digest of the rest)}`` for unique ids."""
    first = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p : p + length], doc)
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < doc:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def secrets(text, classes, allowed, unit):
    """``(base, all)`` spans as (start, rank, end, kind), sorted."""
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    base = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    more = []
    for i, c in enumerate(classes):
        units = [round(n * math.log2(n) * unit) if n else 0 for n in range(c.window + 1)]
        limit = math.floor(c.window * (math.log2(c.window) - c.bits) * unit)
        for m in re.finditer("[%s]{%d,}" % (re.escape(c.alphabet), c.window), text):
            if any(re.search(p, m[0]) for p in allowed):
                continue
            at = [
                j
                for j in range(len(m[0]) - c.window + 1)
                if sum(units[n] for n in Counter(m[0][j : j + c.window]).values()) <= limit
            ]
            if at:
                low, high = m.start() + at[0], m.start() + at[-1] + c.window
                if not any(b[0] < high and low < b[2] for b in base):
                    more.append((low, 3 + i, high, c.name))
    return sorted(base), sorted(base + more)
