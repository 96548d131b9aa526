"""Plain versions of the operators' rules, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict


class Groups:
    def __init__(self) -> None:
        self.top: dict = {}

    def find(self, x):
        self.top.setdefault(x, x)
        while self.top[x] != x:
            x = self.top[x]
        return x

    def join(self, a, b) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.top[b] = a


LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text: str | None, k: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_duplicates(docs: list[tuple[int, str | None]], k: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component)."""
    sets = {i: shingles(t, k) for i, t in docs}
    by = defaultdict(list)
    groups = Groups()
    for i, s in sets.items():
        groups.find(i)
        for x in s:
            by[x].append(i)
    tried = set()
    for ids in by.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best_stretch(pattern: str, text: str) -> int:
    """Least edits from pattern to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most `most`: a banded alignment."""
    if abs(len(a) - len(b)) > most:
        return False
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            new[j] = i if j == 0 else min(row.get(j - 1, most + 1) + (x != b[j - 1]), row.get(j, most + 1) + 1, new.get(j - 1, most + 1) + 1)
        row = new
    return row.get(len(b), most + 1) <= most


def near_lines(names: list[str], similarity: float = 0.9, least: int = 9) -> list[tuple[str, str]]:
    """All pairs of different lines within the edit similarity. An edit spoils one of a line's 6-grams without overlap at most."""
    names = sorted((n for n in names if len(n) >= least), key=len)
    grams = [{n[k : k + 6] for k in range(len(n) - 5)} for n in names]
    out = []
    for j, y in enumerate(names):
        most = int(len(y) * (1 - similarity) + 1e-9)
        pieces = {y[k : k + 6] for k in range(0, len(y) - 5, 6)}
        i = j - 1
        while i >= 0 and len(names[i]) >= len(y) - most:
            if most and len(pieces - grams[i]) <= most and within(names[i], y, most):
                out.append((names[i], y))
            i -= 1
    return out


def dedup_lines(docs: list[tuple[int, str | None]], lines: dict[tuple[int, int], str]) -> dict[int, set[int]]:
    """doc_id -> positions to cut; lines: (doc_id, position) -> normalised line. All pairs, by edit similarity alone."""
    groups = Groups()
    for a, b in near_lines(list(set(lines.values()))):
        groups.join(a, b)
    first: dict[str, tuple[int, int]] = {}
    for at, n in sorted(lines.items()):
        first.setdefault(groups.find(n), at)
    out = defaultdict(set)
    for at, n in lines.items():
        if first[groups.find(n)] != at:
            out[at[0]].add(at[1])
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end), by start and kind."""
    out = []
    for kind, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")) or kind == 2 and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)
