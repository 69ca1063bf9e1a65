"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(docs: dict[int, str | None], window: int = 50) -> dict[int, tuple[int, int, str]]:
    words = {d: SPACE_WORD.findall(t or "") for d, t in docs.items()}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = {p for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < d for p in range(i, i + window)}
        out[d] = (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def shingles(text: str | None) -> set[tuple]:
    w = SPACE_WORD.findall(fold(text))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def classes(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def contamination(docs: dict[int, str | None], items: dict[int, str | None], n: int = 13) -> dict[int, tuple]:
    windows: dict[tuple, set[str]] = {}
    for i, t in items.items():
        w = ALNUM_WORD.findall(fold(t))
        m = min(n, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    lengths = {len(x) for x in windows}
    out = {}
    for d, t in docs.items():
        w = ALNUM_WORD.findall(fold(t))
        hit, found = set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if ids := windows.get(tuple(w[k : k + m])):
                    found |= ids
                    hit |= set(range(k, k + m))
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out
