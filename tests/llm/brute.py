"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substring_dedup(documents: dict[int, str | None]) -> dict[int, tuple[int, int, str]]:
    words = {d: WORDS.findall(t or "") for d, t in documents.items()}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i : i + 13]), d)
    out = {}
    for d, own in words.items():
        gone = set()
        for i in range(len(own) - 12):
            if first[tuple(own[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        left = " ".join(w for i, w in enumerate(own) if i not in gone)
        out[d] = (len(own), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def shingles(text: str | None) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_groups(documents: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in documents.items()}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = collections.defaultdict(list)
    for d, own in sorted(sets.items()):
        shared = collections.Counter(e for s in own for e in holders[s])
        for e, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[e]) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(d)
    return {d: (len(own), find(d)) for d, own in sets.items()}


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORDS.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated_lines, len(covered)


def edit_distance_in(item: list[str], text: list[str]) -> int:
    """Least edit distance of the item to a stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        above, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(above[j - 1] + (word != other), above[j] + 1, row[-1] + 1))
    return min(row)
