"""Cheapest edits of a role sequence, by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in initials of roles. While it is read from its end, four numbers say all that
matters: what the rest costs if the part before it has produced nothing, a system turn, a user turn or an
assistant turn. Less their minimum, only few such vectors occur at all. So the effect of any ``BLOCK`` symbols on any vector
is a table made once: the vector it becomes and what it adds. A conversation is read block by block with one lookup each. Then
the blocks are opened again, from the last one looked up to the first: the vector behind a block gives those inside it, and
with them the edit that is least in ASCII among all that keep the cost. Every choice sees exact costs, so ties are safe.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np

BLOCK = 4
# What an edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SYSTEM, USER, ASSISTANT, OTHER = range(4)
#: What stands behind the part read so far: nothing, or a turn of that role.
NOTHING, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: A row is whole, cut short, blank, or a duplicate; its code is the role's number plus four times this.
WHOLE, CUT, BLANK, DUPLICATE = range(4)
SYMBOLS = 8
_NEXT = {NOTHING: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}
_FAR = 1 << 20


def next_role(state: int) -> str:
    """The role that an inserted turn or one of a new role takes."""
    return "assistant" if state == AFTER_USER else "user"


def after_new(state: int) -> int:
    return _NEXT[state]


def after_kept(state: int, role: int) -> int | None:
    """The state behind a kept turn; None where it may not stand."""
    if role == SYSTEM:
        return AFTER_SYSTEM if state == NOTHING else None
    if role == USER:
        return AFTER_USER if state != AFTER_USER else None
    return AFTER_ASSISTANT if role == ASSISTANT and state == AFTER_USER else None


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = _with_inserts([0, _FAR, _FAR, 0])


def before(symbol: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of a row, from those behind it."""
    role, extra = symbol % 4, TRUNCATED if symbol // 4 == CUT else 0
    costs = []
    for s in range(4):
        kept = after_kept(s, role)
        keep = _FAR if kept is None else extra + rest[kept]
        costs.append(min(DELETE + rest[s], keep, REROLE + extra + rest[_NEXT[s]]))
    return _with_inserts(costs)


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]  # normalised
    step: list[list[tuple[int, int]]]  # [vector][symbol] -> vector, added cost
    block: list[int]  # [vector * blocks + block] -> vector
    added: list[int]  # the cost it adds


@lru_cache(maxsize=1)
def tables() -> Tables:
    vectors, known, step, at = [END], {END: 0}, [], 0
    while at < len(vectors):
        row = []
        for symbol in range(SYMBOLS):
            costs = before(symbol, vectors[at])
            least = min(costs)
            normal = tuple(c - least for c in costs)
            if normal not in known:
                known[normal] = len(vectors)
                vectors.append(normal)
            row.append((known[normal], least))
        step.append(row)
        at += 1
    goes, adds = (np.array([[cell[k] for cell in row] for row in step]) for k in (0, 1))
    ends, total = goes, adds  # blocks of one symbol
    for _ in range(BLOCK - 1):  # one symbol more in front
        total = np.stack([total + adds[ends, symbol] for symbol in range(SYMBOLS)], axis=2).reshape(len(vectors), -1)
        ends = np.stack([goes[ends, symbol] for symbol in range(SYMBOLS)], axis=2).reshape(len(vectors), -1)
    return Tables(vectors, step, ends.ravel().tolist(), total.ravel().tolist())


def block_number(symbols: bytes) -> int:
    """Number of a block; its last symbol weighs most."""
    number = 0
    for symbol in reversed(symbols):
        number = number * SYMBOLS + symbol
    return number


@lru_cache(maxsize=1 << 16)
def _open(symbols: bytes, behind: int, state: int) -> tuple[tuple[str, ...], int]:
    """Edits of every row of a block, inserted turns in front of their row, and the state behind the block."""
    t = tables()
    rests = [behind]
    for symbol in reversed(symbols):
        rests.append(t.step[rests[-1]][symbol][0])
    rests.reverse()
    out = []
    for k, symbol in enumerate(symbols):
        added = t.step[rests[k + 1]][symbol][1]
        here = [added + c for c in t.vectors[rests[k]]]
        rest, extra, edits = t.vectors[rests[k + 1]], TRUNCATED if symbol // 4 == CUT else 0, ""
        while True:
            kept = after_kept(state, symbol % 4)
            if DELETE + rest[state] == here[state]:
                edits += "D"
            elif INSERT + here[_NEXT[state]] == here[state]:
                edits += "I"
                state = _NEXT[state]
                continue
            elif kept is not None and extra + rest[kept] == here[state]:
                edits, state = edits + "K", kept
            else:
                edits, state = edits + "R", _NEXT[state]
            break
        out.append(edits)
    return tuple(out), state


def cheapest(symbols: bytes) -> tuple[int, list[str]]:
    """Cost, and the edits of every row; the last item holds the turns inserted behind all rows."""
    t, blocks = tables(), SYMBOLS**BLOCK
    full = len(symbols) // BLOCK
    tail = symbols[full * BLOCK :]
    vector, cost = 0, 0
    for symbol in reversed(tail):
        vector, added = t.step[vector][symbol]
        cost += added
    behind = array("H", [0]) * (full + 1)
    behind[full] = vector
    for k in range(full - 1, -1, -1):
        cell = behind[k + 1] * blocks + block_number(symbols[k * BLOCK : (k + 1) * BLOCK])
        behind[k] = t.block[cell]
        cost += t.added[cell]
    cost += t.vectors[behind[0]][NOTHING]
    edits, state = [], NOTHING
    for k in range(full):
        some, state = _open(symbols[k * BLOCK : (k + 1) * BLOCK], behind[k + 1], state)
        edits += some
    some, state = _open(tail, 0, state)
    edits += some
    last = ""
    while state not in (NOTHING, AFTER_ASSISTANT):
        last, state = last + "I", _NEXT[state]
    return cost, [*edits, last]


class Repair(NamedTuple):
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str


#: Neighbouring roles that may stand: su, ua, au.
_LEGAL = np.zeros(16, bool)
_LEGAL[[SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER]] = True


def repair(codes: bytes) -> Repair:
    """Faults and cheapest edits of a conversation, one code per row.

    Blank rows and duplicates have to go: they shift all costs alike, so the tables need only know the other rows.
    """
    every = np.frombuffer(codes, np.uint8)
    kind, role = every // 4, every % 4
    stays = kind <= CUT
    cost, edits = cheapest(every[stays].tobytes())
    gone = np.flatnonzero(~stays)
    if len(gone):
        whole, left, place = [], iter(edits), 0
        for at in gone.tolist():
            whole += [next(left) for _ in range(at - place)]
            whole.append("D")
            place = at + 1
        edits = [*whole, *left]
    illegal = int((~_LEGAL[role[:-1] * 4 + role[1:]]).sum())
    counts = (int((kind == k).sum()) for k in (BLANK, DUPLICATE, CUT))
    return Repair(*counts, illegal, cost + DELETE * len(gone), "".join(edits))


repair_short = lru_cache(maxsize=1 << 15)(repair)


def symbol_blocks() -> list[bytes]:
    """All blocks, for tests."""
    return [bytes(b) for b in product(range(SYMBOLS), repeat=BLOCK)]
