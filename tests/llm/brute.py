"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import re

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def components(texts: dict[int, str | None], words: int, percent: int = 80) -> dict[int, int]:
    """Smallest reachable id of each document, all pairs compared."""
    sets = {}
    for i, text in texts.items():
        w = split_words(text)
        sets[i] = set(zip(*[w[k:] for k in range(words)])) if len(w) >= words else ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def chunks(text: str, window: int = 2, divisor: int = 3) -> list[list[str]]:
    lines = text.split("\n")
    values = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if i == len(lines) - 1 or sum(values[i - k] * 31**k for k in range(window) if i >= k) % divisor == 0:
            out.append(now)
            now = []
    return out


def dedup_lines(texts: dict[int, str], min_lines: int = 2) -> dict[int, str]:
    """Texts without chunks of several lines that came before."""
    seen, out = set(), {}
    for i in sorted(texts):
        kept = []
        for chunk in chunks(texts[i]):
            if len(chunk) < min_lines or tuple(chunk) not in seen:
                kept += chunk
            if len(chunk) >= min_lines:
                seen.add(tuple(chunk))
        out[i] = "\n".join(kept)
    return out


def repeated_runs(texts: dict[int, str]) -> dict[int, set[int]]:
    """Numbers of the lines under runs of two or more lines seen before, every pair of places compared in order."""
    seen: dict[tuple[str, str], tuple[int, int]] = {}
    out: dict[int, set[int]] = {}
    for i in sorted(texts):
        lines, lost = texts[i].split("\n"), set()
        for k in range(len(lines) - 1):
            first = seen.setdefault((lines[k], lines[k + 1]), (i, k))
            if first != (i, k):
                lost |= {k + 1} if first == (i, k - 1) else {k, k + 1}
        out[i] = lost
    return out


def benchmark_words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def hits(text: str | None, items: dict[int, str], width: int = 10) -> tuple[set[int], set[int]]:
    """(places of hit words, items that occur)."""
    words, hit, found = benchmark_words(text), set(), set()
    for item, own in items.items():
        w = benchmark_words(own)
        n = min(width, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return hit, found


def repeated_words(texts: dict[int, str | None], width: int) -> dict[int, set[int]]:
    """Places of the words under runs of `width` words that occur more than once."""
    seen: dict[tuple, list[tuple[int, int]]] = {}
    for i, text in texts.items():
        w = split_words(text)
        for s in range(len(w) - width + 1):
            seen.setdefault(tuple(w[s : s + width]), []).append((i, s))
    out: dict[int, set[int]] = {}
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                out.setdefault(i, set()).update(range(s, s + width))
    return out
