"""Plain versions of the contracts, for small fixtures."""

import hashlib
import re

UPPER = {i: i + 32 for i in range(65, 91)}


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def components(texts: dict, width: int):
    sets = {}
    for d, t in texts.items():
        w = spaced(t)
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def contamination(docs, items, window=13):
    out = {}
    for d, t in docs:
        w, hit, found = letters(t), set(), set()
        for item, text in items:
            q = letters(text)
            n = min(window, len(q))
            for j in range(len(q) - n + 1 if q else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == q[j : j + n]:
                        hit |= set(range(i, i + n))
                        found.add(str(item))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def repeats(docs, length):
    seen = {}
    for k, (_, t) in enumerate(docs):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i : i + length], []).append((k, i))
    out = []
    for k, (_, t) in enumerate(docs):
        b = (t or "").encode()
        gone = set()
        for i in range(len(b) - length + 1):
            if len(seen[b[i : i + length]]) > 1:
                gone |= set(range(i, i + length))
        out.append((len(b), len(gone), bytes(x for i, x in enumerate(b) if i not in gone)))
    return out


def line_drops(docs, least=5, least_characters=8):
    lines = sorted(((d, i, re.findall(r"[^\x20\x09-\x0D]+", x)) for d, t in docs for i, x in enumerate((t or "").split("\n"))), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, kept = {d: [] for d, _ in docs}, []

    def near(x, y):
        if x == y:
            return True
        if (len(x) < least) != (len(y) < least):
            return False
        if len(x) < least:
            x, y = list(" ".join(x)), list(" ".join(y))
            if min(len(x), len(y)) < least_characters:
                return False
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y, strict=True)) <= 1
        long_, short = (x, y) if len(x) > len(y) else (y, x)
        return len(long_) == len(short) + 1 and any(long_[:k] + long_[k + 1 :] == short for k in range(len(long_)))

    for d, i, w in lines:
        if w and any(near(w, x) for x in kept):
            out[d].append(i)
        if w:
            kept.append(w)
    return out


def license_shares(text, templates):
    """Label and best share of every template that a block of twice its length, from any word, contains."""
    w, out = letters(text), []
    for t in templates:
        n = max((len(set(w[i : i + 2 * len(t.words)]) & set(t.words)) for i in range(len(w))), default=0)
        out += [(t.label, n / len(t.tokens))] if n >= t.need else []
    return out
