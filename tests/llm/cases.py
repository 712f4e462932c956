"""Small tables with the awkward cases that every operator has to take, and plain versions of the operators."""

from __future__ import annotations

import re

LOWER = {i: i + 32 for i in range(65, 91)}
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None, pattern=ALPHANUMERIC) -> list[str]:
    return pattern.findall((text or "").translate(LOWER))


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text, SPACED)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(sets: dict[int, frozenset], percent: int) -> dict[int, int]:
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[:n]:
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def windows(items: list[tuple], size: int) -> dict[tuple, set[str]]:
    out: dict[tuple, set[str]] = {}
    for item, text in items:
        w = words(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            out.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    return out


def contamination(text: str | None, known: dict[tuple, set[str]]) -> tuple[int, set[int], set[str]]:
    w = words(text)
    hit, items = set(), set()
    for k in {len(x) for x in known}:
        for i in range(len(w) - k + 1):
            names = known.get(tuple(w[i : i + k]))
            if names:
                hit |= set(range(i, i + k))
                items |= names
    return len(w), hit, items
