"""The Merkle manifest against a plain restatement."""

import zlib
from hashlib import sha256

import pytest

from tests.compare import difference, sql_frame
from weirflow.llm import manifest, queries

ROW = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx int, digest string"


def H(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(r, more=0):
    doc_id, text, lang, source, n_chars = r
    values = [doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests):
    """Root, and the siblings (side, digest) of every leaf."""
    ways, level = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 2):
            pair = level[k : k + 2]
            if len(pair) == 2:
                for side, (me, other) in (("R", pair), ("L", pair[::-1])):
                    for i in me[1]:
                        ways[i].append((side, other[0]))
            else:  # hashed alone, without a sibling
                for i in pair[0][1]:
                    ways[i].append(("-", ""))
            above.append((H("".join(d for d, _ in pair)), [i for _, members in pair for i in members]))
        level = above
    return level[0][0], ways


def plain_manifest(rows):
    languages = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    members = {v: sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for v in languages}
    low = {v: plain_tree([plain_leaf(r) for r in members[v]]) for v in languages}
    root, high = plain_tree([low[v][0] for v in languages])
    out = []
    for k, v in enumerate(languages):
        for r, way in zip(members[v], low[v][1]):
            whole = way + high[k]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = plain_leaf(r, 1) if bad else plain_leaf(r)
            for side, d in whole:
                folded = H({"L": d + folded, "R": folded + d, "-": folded}[side])
            out.append((r[0], plain_leaf(r), low[v][0], root, H("".join(d for _, d in whole)), folded, folded == root))
    return sorted(out, key=str)


def build(spark, rows):
    wide = [(*r, "x", 1, "y") for r in rows]
    return sorted((tuple(r) for r in manifest.manifest(spark.createDataFrame(wide, ROW)).collect()), key=str)


def some_rows(n):
    rows = [(i * 3 % 101, f"text {i}", ["en", "de", None, "é", ""][i % 7 % 5], f"s{i % 3}", i) for i in range(n)]
    return [*rows, rows[0], rows[0], (None, None, None, None, None), (None, "", "en", "", 0), (5, "x" * 300_000, "en", None, None),
            (7, "ü:1-", "only", "-", 2**63 - 1)]


@pytest.mark.parametrize("levels,shared", [(10, 4096), (2, 2)])
def test_equals_brute_force(spark, monkeypatch, levels, shared):
    monkeypatch.setattr(manifest, "PASS_LEVELS", levels)
    monkeypatch.setattr(manifest, "SHARED", shared)
    rows = some_rows(150)
    assert build(spark, rows) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_small_trees(spark, n):
    rows = [(i, "t", "en", "s", 1) for i in range(n)]
    assert build(spark, rows) == plain_manifest(rows)


def test_empty(spark):
    assert build(spark, []) == []


def test_tampering_shows(spark, sf_dir):
    got = manifest.op13_manifest(spark, sf_dir).toPandas()
    bad = got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 7 == 0)
    assert bad.any() and (got["verified"] == ~bad).all()


def test_equals_sql(spark, sf_dir):
    got = manifest.op13_manifest(spark, sf_dir).toPandas()
    assert difference(got, sql_frame(sf_dir, queries.statements()["op13_manifest"])) is None
