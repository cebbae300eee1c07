"""Plain Python forms of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_classes(docs, n=5, threshold=0.8):
    """``id -> (class, links)`` from ``(id, text)`` pairs with unique ids."""
    sets, where = {}, defaultdict(list)
    for i, text in docs:
        w = words(text)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        for g in sets[i]:
            where[g].append(i)
    shared = Counter((a, b) for held in where.values() for x, a in enumerate(held) for b in held[x + 1 :])
    near = [(a, b) for (a, b), c in shared.items() if c >= threshold * (len(sets[a]) + len(sets[b]) - c) - 1e-9]
    links = Counter(x for pair in near for x in pair)
    found = components(sets, near)
    return {i: (found[i], links[i]) for i in sets}


def removed(docs, length=400):
    """``(n_bytes, n_removed, n_spans, digest)`` of every text of a list."""
    data = [(t or "").encode() for t in docs]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repetition(text, lengths=(5, 6, 7, 8, 9, 10)):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, characters in repeats, in repeated lines."""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    twice = {k + d for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    again = [line for k, line in enumerate(lines) if line in lines[:k]]
    chars = []
    for n in lengths:
        seen, inside = set(), set()
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            if g in seen:
                inside |= set(range(k, k + n))
            seen.add(g)
        chars.append(sum(len(w[k]) for k in inside))
    base = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(again), len(twice))
    return base, chars, sum(len(x) for line in again for x in words(line))


BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def base_spans(text):
    """Spans of the plain patterns, in order."""
    found = []
    for number, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), number, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def source_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """``source -> target`` from ``source -> size``, sources in order and null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest = share * sum(sizes.values()) - most * sum(sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / free for s in order}
        over = {s for s in order if target[s] > most * sizes[s]}
        if not over - full:
            return target
        full |= over


def shared_stretches(docs, n=51):
    """``id -> places of words`` inside n-word strings that occur in another text, too."""
    where = defaultdict(set)
    split = {i: words(t) for i, t in docs}
    for i, w in split.items():
        for k in range(len(w) - n + 1):
            where[tuple(w[k : k + n])].add(i)
    out = defaultdict(set)
    for i, w in split.items():
        for k in range(len(w) - n + 1):
            if len(where[tuple(w[k : k + n])]) > 1:
                out[i] |= set(range(k, k + n))
    return out


def word_runs(w, shortest=6, copies=4):
    """``(start, length, period)`` of every run, lag by lag over the whole text."""
    out = []
    for q in range(1, len(w) // copies + 1):
        same = [w[i] == w[i + q] for i in range(len(w) - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            size = j - i + q
            if j > i and size >= max(shortest, copies * q):
                stretch = w[i : i + size]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def segmentations(unit, pieces):
    """All ways to put some bytes together."""
    if not unit:
        yield ()
    for p in pieces:
        if unit.startswith(p):
            for rest in segmentations(unit[len(p) :], pieces):
                yield (p, *rest)
