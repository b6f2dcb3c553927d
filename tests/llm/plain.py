"""Plain versions that the operators are held against."""

from __future__ import annotations

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    words = spaced(text)
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def components(sets: dict[int, set], percent: int = 85) -> dict[int, int]:
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in sets}
