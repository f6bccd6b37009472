"""Plain restatements of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

NO_ID = 2**63 - 1


def fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def substrings(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    docs = [(NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, b in docs:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, NO_ID), i)
    out = []
    for (i, b), (own, _) in zip(docs, rows, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((own, len(b), sum(gone), spans, sha(bytes(x for x, y in zip(b, gone, strict=True) if not y))))
    return out


def words(rows, length=20):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text)."""
    docs = [(NO_ID if i is None else i, t or "", re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    first: dict = {}
    own: dict = {}
    for i, t, w in docs:
        for p in range(len(w) - length + 1):
            x = tuple(w[p : p + length])
            first[x] = min(first.get(x, NO_ID), i)
            own[i, t, x] = min(own.get((i, t, x), NO_ID), p)
    out = []
    for (i, t, w), (real, _) in zip(docs, rows, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            x = tuple(w[p : p + length])
            if first[x] < i or own[i, t, x] < p:
                gone[p : p + length] = [True] * length
        out.append((real, len(w), sum(gone), sha(b" ".join(a for a, g in zip(w, gone, strict=True) if not g))))
    return out


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fingerprints: list[int]) -> dict[int, int]:
    """Smallest fingerprint reachable over links of at most four differing bits."""
    known = np.array(sorted(set(fingerprints)), np.uint64)
    parent = {int(x): int(x) for x in known}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(known):
        for y in known[k + 1 :][np.bitwise_count(known[k + 1 :] ^ x) <= 4]:
            a, b = find(int(x)), find(int(y))
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def component_ids(rows) -> list[tuple[int | None, int, int | None]]:
    """(doc_id, fingerprint, component_id) of (doc_id, text)."""
    fps = [fingerprint(t) for _, t in rows]
    root = classes(fps)
    least: dict[int, int] = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            least[root[f]] = min(least.get(root[f], NO_ID), i)
    return [(i, f, least.get(root[f])) for (i, _), f in zip(rows, fps, strict=True)]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text or ""))


def similarity(passage: list[str], item: list[str]) -> float:
    """Smith-Waterman, +1 and -1, against the item's length."""
    row, best = [0] * (len(passage) + 1), 0
    for y in item:
        new = [0]
        for j, x in enumerate(passage, 1):
            new.append(max(0, row[j - 1] + (1 if x == y else -1), row[j] - 1, new[-1] - 1))
        row, best = new, max(best, max(new))
    return (best / len(item) + 1) / 2
