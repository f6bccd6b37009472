"""Merge tables of a byte-level BPE file, and merging of many pre-tokens at once."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np

from weirflow.llm.pretokens import Words, split
from weirflow.llm.ragged import positions, starts_of

NEVER = np.int32(2**31 - 1)


class Vocabulary(NamedTuple):
    """Symbols are token ids. ``table`` finds a merge by its pair: left id in the upper, right id in the lower half."""

    byte_ids: np.ndarray
    table: tuple[np.ndarray, np.ndarray]
    ranks: np.ndarray
    merged: np.ndarray
    #: Per id: rank of the merge that makes it (-1: a byte), its left and its right part.
    made_at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    #: Bytes of every id, flat.
    pool: np.ndarray
    pool_starts: np.ndarray
    pool_lengths: np.ndarray
    special: tuple[tuple[str, int], ...]


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids, letters = content["model"]["vocab"], _byte_letters()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    size = max([*ids.values(), *added.values()]) + 1
    made_at, left, right = (np.full(size, -1, np.int32) for _ in range(3))
    keys, merged = np.empty(len(merges), np.int64), np.empty(len(merges), np.int32)
    for rank, (a, b) in enumerate(merges):
        whole = ids[a + b]
        keys[rank], merged[rank] = (ids[a] << 32) | ids[b], whole
        made_at[whole], left[whole], right[whole] = rank, ids[a], ids[b]
    contents: list[bytes] = [b""] * size
    for token, i in ids.items():
        contents[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    for token, i in added.items():
        contents[i] = token.encode()
    lengths = np.array([len(c) for c in contents], np.int64)
    byte_ids = np.empty(256, np.int32)
    for letter, byte in letters.items():
        byte_ids[byte] = ids[letter]
    return Vocabulary(
        byte_ids, hash_table(keys), np.arange(len(keys), dtype=np.int32), merged, made_at, left, right,
        np.frombuffer(b"".join(contents), np.uint8), starts_of(lengths), lengths, tuple(sorted(added.items())),
    )


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def hash_table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with linear steps: slots with a key or -1, and the place of each key."""
    bits = max(4, int(len(keys)).bit_length() + 2)
    slots, place = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
    at, left = _slot(keys, bits), np.arange(len(keys))
    while len(left):
        free = slots[at[left]] < 0
        slots[at[left[free]]] = keys[left[free]]
        place[at[left[free]]] = left[free]
        left = left[slots[at[left]] != keys[left]]
        at[left] = (at[left] + 1) & ((1 << bits) - 1)
    return slots, place


def look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Place of every key, or -1."""
    slots, place = table
    bits = len(slots).bit_length() - 1
    at = _slot(keys, bits)
    seen = slots[at]
    out = np.where(seen == keys, place[at], -1)
    left = np.flatnonzero((seen != keys) & (seen >= 0))
    at = at[left]
    while len(left):
        at = (at + 1) & (len(slots) - 1)
        seen, wanted = slots[at], keys[left]
        hit = seen == wanted
        out[left[hit]] = place[at[hit]]
        go = ~hit & (seen >= 0)
        left, at = left[go], at[go]
    return out


def pair_index(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge of every pair, or -1."""
    return look_up(v.table, (a.astype(np.int64) << 32) | b)


def merge_all(v: Vocabulary, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact token ids of every pre-token, flat, and how many each has.

    Rank-synchronous: in every round each pre-token applies its own lowest-ranked pair, at all
    its places at once (from the left where places overlap). A pre-token without a
    mergeable pair leaves the working set. The number of rounds is bounded by
    the longest chain of merges, not by the number of pre-tokens.
    """
    count = np.zeros(len(starts), np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    symbols, lengths = v.byte_ids[data[positions(starts, lengths)]], lengths.astype(np.int64)
    rows = np.arange(len(starts))
    at = pair_index(v, symbols[:-1], symbols[1:]) if len(symbols) else np.zeros(0, np.int64)
    while len(rows):
        begin = starts_of(lengths)
        rank = np.full(len(symbols), NEVER, np.int32)
        hit = at >= 0
        rank[:-1][hit] = v.ranks[at[hit]]
        rank[begin + lengths - 1] = NEVER  # no pair across two pre-tokens
        lowest = np.minimum.reduceat(rank, begin)
        open_rows = lowest < NEVER
        if not open_rows.all():
            closed = np.repeat(~open_rows, lengths)
            done.append((rows[~open_rows], lengths[~open_rows], symbols[closed]))
            keep = ~closed
            symbols, rank = symbols[keep], rank[keep]
            at = np.append(at, -1)[keep]
            rows, lengths, lowest = rows[open_rows], lengths[open_rows], lowest[open_rows]
            if not len(rows):
                break
        else:
            at = np.append(at, -1)
        take = rank == np.repeat(lowest, lengths)
        # Overlapping places (a, a, a): every second one of a run of neighbours, from the left.
        overlap = take[1:] & take[:-1]
        if overlap.any():
            places = np.flatnonzero(take)
            new_run = np.ones(len(places), bool)
            new_run[1:] = np.diff(places) > 1
            run_start = places[new_run][np.cumsum(new_run) - 1]
            take[places[(places - run_start) % 2 == 1]] = False
        places = np.flatnonzero(take)
        symbols = symbols.copy()
        symbols[places] = v.merged[at[places]]
        gone = np.zeros(len(symbols), bool)
        gone[places + 1] = True
        owner = np.repeat(np.arange(len(rows)), lengths)
        lengths = lengths - np.bincount(owner[places], minlength=len(rows))
        keep = ~gone
        now = np.cumsum(keep)[places] - 1  # where the merged symbols stand after removal
        symbols, at = symbols[keep], at[keep][:-1]
        fresh = np.unique(np.concatenate([now, now - 1]))
        fresh = fresh[(fresh >= 0) & (fresh < len(at))]
        at[fresh] = pair_index(v, symbols[fresh], symbols[fresh + 1])
    for which, n, _ in done:
        count[which] = n
    out = np.empty(int(count.sum()), np.int32)
    begin = starts_of(count)
    for which, n, values in done:
        out[positions(begin[which], n)] = values
    return out, count


class Segments(NamedTuple):
    """Pre-tokens of a chunk of texts, and the special tokens between them."""

    words: Words
    #: Text, rank within the order of pre-tokens (it stands before that one) and id of every special token.
    special_text: np.ndarray
    special_before: np.ndarray
    special_id: np.ndarray


def segments(v: Vocabulary, data: np.ndarray, lengths: np.ndarray) -> Segments:
    """Splits texts; a special token's string inside a text is that token, as the library does by default."""
    none = np.zeros(0, np.int64)
    raw = data.tobytes()
    if not any(s.encode() in raw for s, _ in v.special):
        return Segments(split(data, lengths), none, none, none.astype(np.int32))
    ids = {s.encode(): i for s, i in v.special}
    pattern = re.compile(b"|".join(re.escape(s) for s in sorted(ids, key=len, reverse=True)))
    pieces, owner, specials = [], [], []
    begin = 0
    for text, n in enumerate(lengths):
        body, at = raw[begin : begin + n], 0
        for m in pattern.finditer(body):
            pieces.append(body[at : m.start()])
            owner.append(text)
            specials.append((text, len(pieces), ids[m.group()]))
            at = m.end()
        pieces.append(body[at:])
        owner.append(text)
        begin += n
    words = split(np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int64))
    text, piece, token = (np.array(x, np.int64) for x in zip(*specials, strict=True))
    before = np.searchsorted(words.text, piece, side="left")
    return Segments(words._replace(text=np.array(owner)[words.text]), text, before, token.astype(np.int32))
