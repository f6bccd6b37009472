"""Conversation repair against a plain restatement."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest

from weirflow.llm import block_tables as B
from weirflow.llm import turn_repair as T

ROW = "conv_id long, turn long, role string, text string, code int, position string, gaps int"
EMPTY = sha256(b"").hexdigest()


def plain_edits(symbols):
    """(cost, audit) of least cost, then least in ASCII, by trying all."""

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "")] if i == len(symbols) and state in (B.NOTHING, B.AFTER_ASSISTANT) else []
        if i < len(symbols):
            initial, fault = symbols[i]
            cost, rest = best(i + 1, state, 0)
            options.append((cost + 2, "D" + rest))
            if fault != "gone":
                extra = 5 if fault == "cut" else 0
                legal = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
                for edit, role, price in (("K", initial, 0), ("R", "a" if state == 2 else "u", 1)):
                    if (role, state) in legal:
                        cost, rest = best(i + 1, legal[role, state], 0)
                        options.append((cost + price + extra, edit + rest))
        if inserted < 3:
            cost, rest = best(i, 3 if state == 2 else 2, inserted + 1)
            options.append((cost + 5, "I" + rest))
        return min(options) if options else (10**9, "")

    return best(0, 0, 0)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        shown = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(shown.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain_repair(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).digest()))
    seen, symbols, counts = set(), [], {"blank": 0, "duplicate": 0, "cut": 0}
    for _, _, role, text in rows:
        bare, fault = re.sub(r"[\x20\x09-\x0D]+\Z", "", text), None
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif bare[-1] not in ".!?":
            fault = "cut"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols.append((role[:1], "gone" if fault in ("blank", "duplicate") else fault))
    cost, audit = plain_edits(tuple(symbols))
    lines, at = [], iter(rows)
    for edit in audit:
        new = "user" if len(lines) == 0 or not lines[-1].startswith("u") else "assistant"
        if edit == "I":
            lines.append(f"{new}:")
            continue
        _, _, role, text = next(at)
        if edit != "D":
            lines.append(f"{role if edit == 'K' else new}:{text}")
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [s for s, _ in symbols]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["cut"], illegal, cost, audit, digest)


def plain(rows, ids=None):
    ids = {r[0] for r in rows} if ids is None else ids
    none = (0, 0, 0, 0, 0, 0, "", EMPTY)
    return sorted(
        ((i, *(plain_repair(own) if (own := [r for r in rows if r[0] == i]) else none)) for i in ids), key=str
    )


def random_rows(n, seed=1):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", "  ", "a\n.", "ü…", "end. \t", "x" * 5000 + ".", None]
    rows = []
    for conv in [*range(n), None]:
        for k in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "sir", None])
            turn = rng.choice([k, k, k, k, rng.randint(-2, 12), None])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}."))
    return rows + rng.sample(rows, 10)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROW).repartition(3)


def got(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_block_tables_equal_steps():
    """A lookup is the same as its symbols one after the other, from every vector."""
    t, blocks = B.tables(), B.SYMBOLS**B.BLOCK
    assert len(t.block) == len(t.vectors) * blocks
    for block in B.symbol_blocks()[::37]:
        for v in range(len(t.vectors)):
            vector, cost = v, 0
            for symbol in reversed(block):
                vector, added = t.step[vector][symbol]
                cost += added
            cell = v * blocks + B.block_number(block)
            assert (t.block[cell], t.added[cell]) == (vector, cost)


def test_edits_equal_brute_force():
    rng = random.Random(5)
    for n in [*range(10)] * 60 + [35] * 5:
        symbols = [(rng.choice("suauao"), rng.choice([None, None, None, "cut", "gone"])) for _ in range(n)]
        kinds = {None: B.WHOLE, "cut": B.CUT, "gone": rng.choice([B.BLANK, B.DUPLICATE])}
        found = B.repair(bytes("suao".find(s) + 4 * kinds[fault] for s, fault in symbols))
        assert (found.cost, found.audit) == plain_edits(tuple(symbols))


def test_repairs_equal_brute_force(spark):
    rows = [tuple(" " if v is None and k > 1 else v for k, v in enumerate(r)) for r in random_rows(60)]
    assert got(T.repairs(frame(spark, rows))) == plain(rows)


def test_nulls_read_as_a_space(spark):
    rows = random_rows(25, seed=2)
    read = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(T.repairs(frame(spark, rows))) == plain(read)


def test_conversations_across_chunks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BITS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, t, r or " ", x or " ") for c, t, r, x in random_rows(12, seed=3)]
        rows += [(77, k % 31, ("user", "assistant")[k % 2], f"line {k % 40}" + "." * (k % 3)) for k in range(90)]
        assert got(T.repairs(frame(spark, rows))) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_damage_and_the_query(spark, tmp_path):
    rows = random_rows(120, seed=4)
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert got(T.op11_turns(spark, str(tmp_path))) == plain(plain_damage(rows), {r[0] for r in rows})


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(T.op11_turns(spark, sf_dir))
    assert found == plain(plain_damage(rows), {r[0] for r in rows})
    assert any(r[6] for r in found)


@pytest.mark.parametrize("query", [T.repairs, T.damage])
def test_empty(spark, query):
    assert query(frame(spark, [])).collect() == []
