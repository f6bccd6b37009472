"""The Jaccard join against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from tests.compare import difference, sql_frame
from tests.llm import brute
from tests.llm.conftest import by_id
from weirflow.llm import queries
from weirflow.llm import shingle_join as J


def plain_set(text):
    words = brute.fold(text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def plain_links(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        known = smallest.get(find(i))
        smallest[find(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return by_id([(d, len(s), smallest[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))])


def copies(n, seed=1):
    """Groups of near copies of every size, some just above and some just below the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 7, 9, 12, 16, 20, 30, 60, 150]))]
        for _ in range(rng.randint(1, 5)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text += [rng.choice(vocabulary)] * rng.randint(1, 3)
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(text)))
    return rows


EDGES = [
    (9000, None), (9001, ""), (9002, " \n\t"), (None, "a b c d e"), (None, None), (9003, "one"), (9004, "ONE"), (9005, "one two three"),
    (9006, "É b c d e f"), (9007, "é b c d e f"), (9008, "x y " * 40_000), (9009, "x y " * 30_000), (9010, "p q r s t u v w " * 20_000 + "z"),
    (9011, "p q r s t u v w " * 20_000), (7, "a b c d e"), (7, "k l m n o p q"), (9012, "a b c d e f g"),
]


def test_equals_all_pairs(frame):
    rows = copies(70) + EDGES
    rows += random.Random(2).sample(rows, 12)
    assert by_id(J.linked(frame(rows)).collect()) == plain_links(rows)


@pytest.mark.parametrize("b", [1, 6, 17, 10_000])
def test_any_boundary_gives_the_same(frame, monkeypatch, b):
    monkeypatch.setattr(J, "boundary", lambda sets: b)
    rows = copies(30, seed=b)
    assert by_id(J.linked(frame(rows)).collect()) == plain_links(rows)


def test_hot_lists_blocks_and_rounds(frame, monkeypatch):
    """One large group of near copies, about a third of the pairs linked, in lists dealt over blocks."""
    monkeypatch.setattr(J, "BLOCK", 40)
    monkeypatch.setattr(J, "GROWTH", 3)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(rng.choice([1, 1, 2, 4])):
            text[rng.randrange(60)] = f"n{k}-{rng.randrange(1000)}"
        rows.append((k, " ".join(text)))
    want = plain_links(rows)
    assert by_id(J.linked(frame(rows)).collect()) == want
    assert 2 < len({w[2] for w in want}) < 120


def test_boundary_follows_the_cost(spark):
    """Small sets with elements that many share are cheaper as subsets, large ones as list entries."""
    rows = [(10, 3.0, 500.0)] * 5 + [(400, 1900.0, 62.0)] * 5
    sets = spark.createDataFrame(rows, "n long, light double, heavy double")
    assert J.boundary(sets) == 11 and not J.in_lists(10, 11)


def test_needed_overlap_and_keys():
    """Linked sets share a key, for every size and boundary."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(2, 60))
        extra, lost = (int(rng.integers(0, 1 + n // 6)) for _ in range(2))
        one = rng.permutation(1000)[:n].astype(np.uint64)
        other = np.concatenate([one[lost:], np.arange(2000, 2000 + extra, dtype=np.uint64)])
        both = n - lost
        if len(other) < 2 or 100 * both < 85 * (n + extra):
            continue
        order = rng.permutation(3000)
        keys = []
        for s in (one, other):
            first = len(s) - J.needed(len(s)) + 2
            keys.append(sorted(s.tolist(), key=lambda v: order[v])[:first])
        for b in (1, 5, 12, 30, 99):
            found = [set(J.keys_of(np.array(k, np.uint64), len(s), b).tolist()) for k, s in zip(keys, (one, other))]
            assert found[0] & found[1]


def test_frequent_shingles_have_higher_levels(frame):
    rows = [(i, f"the same four words and then {i} a{i} b{i} c{i}") for i in range(64)]
    levels = J.frequency_levels(frame(rows).select("doc_id", "text"))
    bucket = J._bucket(J.hashes({b"the same four words"}), len(levels))
    assert len(levels) == J.FEWEST_BUCKETS and levels[bucket][0] == 48 and (levels == 48).sum() <= 4  # 8 * log2(65)


def test_the_filter_loses_no_document(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("if(id = 7, null, id) as doc_id", "'x' as text")
    ids = spark.createDataFrame([(None,), *((i,) for i in range(0, 3000, 13))], "first long")
    for bits in (1 << 25, 1 << 15, 40):
        monkeypatch.setattr(J, "FILTER_BITS", bits)
        kept = {r["doc_id"] for r in J._wanted(docs, ids).collect()}
        assert kept >= {None, *range(0, 3000, 13)} and (bits == 40 or len(kept) < 400)


def test_empty(frame):
    assert J.linked(frame([])).collect() == []
    assert by_id(J.linked(frame([(1, None), (2, "")])).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_query_equals_sql(spark, sf_dir):
    got = queries.queries()["op12_jaccard"](spark, sf_dir).toPandas()
    assert difference(got, sql_frame(sf_dir, queries.statements()["op12_jaccard"])) is None
