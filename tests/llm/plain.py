"""Plain Python versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if c[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable, for each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def repeated_bytes(texts, length=400):
    """For each text the flags of its bytes that lie in a repeated passage."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                flags[i:i + length] = b"\1" * length
        out.append(bytes(flags))
    return out


TOKEN = re.compile(r"[^\W_]+")


def held_items(docs, items, share=0.8):
    """``{(doc, item)}``: some alignment agrees in ``share`` of the item's tokens."""
    tokens = {i: TOKEN.findall((t or "").lower()) for i, t in items}
    places = defaultdict(list)
    for i, w in tokens.items():
        for k, x in enumerate(w):
            places[x].append((i, k))
    found = set()
    for d, text in docs:
        lined = Counter()
        for p, x in enumerate(TOKEN.findall((text or "").lower())):
            for i, k in places.get(x, ()):
                lined[i, p - k] += 1
        found |= {(d, i) for (i, _), n in lined.items() if n >= share * len(tokens[i])}
    return found


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in full]
        level = (total - sum(most * sizes[n] for n in full)) / sum(weight[n] for n in rest) if rest else 0
        more = {n for n in rest if level * weight[n] > most * sizes[n]}
        if not more:
            return {n: float(most * sizes[n]) if n in full else level * weight[n] for n in names}
        full |= more
