"""Splitting of texts into the pre-tokens of a byte-level tokenizer, without a loop over characters.

The split is that of the well-known pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
runs of letters, of numbers and of other characters, each with one space before it; a run of
white space gives its last character up to what follows; a contraction is cut off
where an apostrophe begins a pre-token.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import regex

from weirflow.llm.ragged import positions, starts_of

OTHER, LETTER, NUMBER, SPACE = range(4)
#: What may follow an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            codes = np.frombuffer(run.group().encode("utf-32-le"), np.uint32)
            table[codes] = kind
    return table


class Words(NamedTuple):
    """Pre-tokens of a chunk of texts, in order. ``text`` has the number of the text of each."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray


def split(data: np.ndarray, lengths: np.ndarray) -> Words:
    """Pre-tokens of UTF-8 texts that lie one after the other in ``data``."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return Words(data, none, none, none)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # byte offset of every character
    kind = character_classes()[points]
    n = len(points)
    # First character of every text that has one; a boundary no pre-token crosses.
    text_at = np.searchsorted(at, starts_of(lengths)[lengths > 0])
    first = np.zeros(n + 1, bool)
    first[text_at] = True
    first[n] = True
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    # A run of white space before something else in the same text gives up its last character.
    space = kind == SPACE
    last_space = space & ~first[1:]
    last_space[:-1] &= ~space[1:]
    last_space[n - 1] = False
    gives = np.flatnonzero(last_space)
    cut[gives] = True
    joined = gives[points[gives] == 0x20] + 1
    cut[joined] = False
    # Contractions: an apostrophe that begins a pre-token.
    marks = np.flatnonzero((points[:-1] == 0x27) & cut[: n - 1] & ~first[1:n]) if n > 1 else none
    if len(marks):
        for tail in CONTRACTIONS:
            codes, width = [ord(c) for c in tail], len(tail)
            fits = marks[marks + width < n]
            for k, code in enumerate(codes, 1):
                fits = fits[(points[fits + k] == code) & ~first[fits + k]]
            cut[fits + 1] = False
            ends = fits + width + 1
            cut[ends[ends < n]] = True
    begins = np.flatnonzero(cut)
    starts = at[begins]
    widths = np.diff(np.append(starts, len(data)))
    ends = np.cumsum(lengths)
    return Words(data, starts, widths, np.searchsorted(ends, starts, side="right"))


@lru_cache(maxsize=1)
def byte_mixers() -> tuple[np.ndarray, np.uint64]:
    random = np.random.default_rng(20240917)
    return random.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15)


def hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of every slice: sum of mixed bytes times powers of an odd base, and the length.

    Slices with equal hashes need not be equal: from 1,024 bytes on some regular ones collide.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    table, base = byte_mixers()
    inside = positions(np.zeros(len(starts), np.int64), lengths)
    longest = int(lengths.max())
    powers = np.ones(longest, np.uint64)
    powers[1:] = base
    np.multiply.accumulate(powers, out=powers)
    contiguous = int(lengths.sum()) == len(data)
    values = table[data if contiguous else data[positions(starts, lengths)]] * powers[inside]
    sums = np.add.reduceat(values, starts_of(lengths)) ^ lengths.astype(np.uint64)
    sums ^= sums >> np.uint64(29)
    return sums * np.uint64(0xBF58476D1CE4E5B9)


#: Bytes whose places are mixed at a time.
_SLAB = 1 << 20


def place_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of every slice: sum of its bytes, each mixed with its place, and the length.

    Mixing byte and place together leaves no algebra between places, so regular texts collide as rarely as random ones.
    """
    out = lengths.astype(np.uint64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _SLAB, side="right")))
        n = lengths[first:last]
        place = positions(np.zeros(len(n), np.int64), n).view(np.uint64)
        some = n > 0
        if some.any():
            mixed = data[positions(starts[first:last], n)].astype(np.uint64) | (place << np.uint64(8))
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                mixed += np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
            mixed ^= mixed >> np.uint64(31)
            out[first:last][some] += np.add.reduceat(mixed, starts_of(n)[some])
        first = last
    return out


def same_bytes(
    one: np.ndarray, one_starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether slices of the same lengths hold the same bytes."""
    out = np.ones(len(lengths), bool)
    some = np.flatnonzero(lengths > 0)
    if len(some):
        n = lengths[some]
        differ = one[positions(one_starts[some], n)] != other[positions(other_starts[some], n)]
        out[some] = ~np.logical_or.reduceat(differ, starts_of(n))
    return out


def distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and one occurrence of every distinct pre-token, and each occurrence's place in that list.

    A hash only proposes that two are equal; their bytes decide. Different ones of one hash stand in the list side by side.
    """
    every = hashes(words.data, words.starts, words.lengths)
    order = np.argsort(every)
    in_order = every[order]
    new = np.ones(len(order), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    found, example = in_order[new], order[new]
    others = np.flatnonzero(example[of] != np.arange(len(of)))
    like, n = example[of[others]], words.lengths[others]
    equal = words.lengths[like] == n
    equal[equal] = same_bytes(words.data, words.starts[others[equal]], words.data, words.starts[like[equal]], n[equal])
    if not equal.all():
        more: dict[bytes, int] = {}
        for k in others[~equal].tolist():
            text = words.data[words.starts[k] : words.starts[k] + words.lengths[k]].tobytes()
            if text not in more:
                more[text] = len(example)
                found, example = np.append(found, every[k]), np.append(example, k)
            of[k] = more[text]
    return found, example, of


class Known:
    """What has been found for pre-tokens so far; forgets all beyond ``limit`` of them or ``BYTES`` of their text.

    They are looked up by hash and compared by bytes. Of different ones with one hash the first is kept, the others
    are made anew each time.
    """

    BYTES = 64 << 20

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = self.lengths = self.text_starts = self.text_lengths = np.zeros(0, np.int64)
        self.values, self.text = np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def _look(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(wanted), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, at, -1)

    def resolve(
        self, words: Words, wanted: np.ndarray, example: np.ndarray,
        make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray]:
        """Start and length within ``values`` of every wanted pre-token, given by hash and an occurrence; ``make`` gives the
        flat values of those not known."""
        starts, lengths = words.starts[example], words.lengths[example]
        at = self._look(wanted)
        known = at >= 0
        known[known] = self.text_lengths[at[known]] == lengths[known]
        hit = at[known]
        known[known] = same_bytes(words.data, starts[known], self.text, self.text_starts[hit], lengths[known])
        missing = np.flatnonzero(~known)
        full = len(self.hashes) + len(missing) > self.limit or len(self.text) + int(lengths[missing].sum()) > self.BYTES
        if len(self.hashes) and full:
            self._forget()
            at, known, missing = np.full(len(wanted), -1), np.zeros(len(wanted), bool), np.arange(len(wanted))
        out_starts, out_lengths = np.empty(len(wanted), np.int64), np.empty(len(wanted), np.int64)
        out_starts[known], out_lengths[known] = self.starts[at[known]], self.lengths[at[known]]
        if len(missing):
            values, n = make(missing)
            out_starts[missing], out_lengths[missing] = starts_of(n) + len(self.values), n
            self.values = np.concatenate([self.values, values])
            self._keep(words, wanted, starts, lengths, missing[at[missing] < 0], out_starts, out_lengths)
        return out_starts, out_lengths

    def _keep(self, words, wanted, starts, lengths, new, out_starts, out_lengths) -> None:
        """Adds pre-tokens of hashes that are not known yet, one of each hash."""
        new = new[np.unique(wanted[new], return_index=True)[1]]
        every = np.concatenate([self.hashes, wanted[new]])
        order = np.argsort(every)
        self.hashes = every[order]
        n = lengths[new]
        self.starts = np.concatenate([self.starts, out_starts[new]])[order]
        self.lengths = np.concatenate([self.lengths, out_lengths[new]])[order]
        self.text_starts = np.concatenate([self.text_starts, starts_of(n) + len(self.text)])[order]
        self.text_lengths = np.concatenate([self.text_lengths, n])[order]
        self.text = np.concatenate([self.text, words.data[positions(starts[new], n)]])
