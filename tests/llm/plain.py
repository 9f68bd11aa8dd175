"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def roots(n: int, links) -> list[int]:
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def repeated_words(rows: list[tuple[int, str | None]], window: int) -> list[tuple]:
    words = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), sha(kept.encode())))
    return out


def repeated_bytes(rows: list[tuple[int, str | None]], length: int) -> list[tuple]:
    """``rows`` in order."""
    seen, out = set(), []
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(b), int(gone.sum()), runs, sha(bytes(np.frombuffer(b, np.uint8)[~gone]))))
    return out


def texts_with_copies(seed: int, n: int, words: int = 60, letters: int = 12, blanks: str = " ") -> list[tuple[int, str | None]]:
    """Random texts that copy stretches from each other and from themselves."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(letters)]
    rows: list[tuple[int, str | None]] = []
    for i in range(n):
        own: list[str] = []
        for _ in range(rng.randint(0, 4)):
            if rows and rng.random() < 0.5:
                old = (rng.choice(rows)[1] or "").split()
                a = rng.randrange(len(old) + 1)
                own += old[a : a + rng.randint(0, words)]
            else:
                own += [rng.choice(vocabulary) + rng.choice(["", str(rng.randrange(99))]) for _ in range(rng.randint(0, words))]
        rows.append((i * 3, rng.choice(blanks).join(own)))
    return [*rows, (n * 3, None), (n * 3 + 1, ""), (n * 3 + 2, " \n ")]
