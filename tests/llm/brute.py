"""Plain Python answers to what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
MATCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    words = [SPACE_WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_groups(rows: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """id -> (shingles, smallest id of its group)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def contamination(texts: list[str | None], items: list[tuple], window: int = 13) -> list[tuple]:
    """(words, hit words, sorted item ids, contaminated) per text."""
    def words(t):
        return MATCH_WORD.findall((t or "").translate(LOWER))

    runs: dict[tuple, set[str]] = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            runs.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(r) for r in runs}
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (r := tuple(w[i:i + n])) in runs:
                    hit.update(range(i, i + n))
                    found |= runs[r]
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def runs(words: list, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(min_length, min_exponent * p):
                found.setdefault((i, j + p - i), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def simhash(text: str | None, k: int = 3) -> int:
    import xxhash

    w = SPACE_WORD.findall((text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by(values: dict, near) -> dict:
    """Key -> smallest key of its group, keys being linked where ``near`` holds for their values."""
    parent = {i: i for i in values}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = sorted(values)
    for n, a in enumerate(keys):
        for b in keys[n + 1:]:
            if near(values[a], values[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in keys}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    """(word, n, n_near, form, form_n, root) of every word."""
    form, near = {}, {}
    for w in counts:
        others = [o for o in counts if one_edit(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, counts[w], near[w], form[w], counts.get(form[w]), root))
    return out
