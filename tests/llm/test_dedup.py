"""Substring and fingerprint deduplication against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.conftest import by_id
from weirflow.llm import debruijn, queries, repeats, simhash, substrings, suffixes
from weirflow.llm.components import components


@pytest.mark.parametrize("size,symbols", [(1, 1), (10, 2), (60, 1), (300, 2), (500, 5), (3000, 26), (3000, 250)])
def test_suffix_array(size, symbols, monkeypatch):
    rng = random.Random(size)
    for limit in (0, 512):  # names sorted by doubling, and by induced sorting again
        monkeypatch.setattr(suffixes, "SYMBOLS", limit)
        for _ in range(5):
            t = [rng.randint(1, symbols) for _ in range(size)] + [0]
            order = suffixes.suffix_array(np.array(t, np.uint16), symbols + 1)
            assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_repeated_prefixes():
    text = np.frombuffer(b"abcdefghijkl--abcdefghijkX", np.uint8)
    order = suffixes.suffix_array(np.append(text.astype(np.uint16) + 1, 0), 258)[1:]
    found = suffixes.repeated_prefix(text, order, 11)
    assert found.sum() == 1 and found[[0, 14]].any()


def test_substrings_equal_brute_force(frame, mixed):
    got = substrings.substring_digests(frame(mixed)).collect()
    assert by_id(got) == by_id(brute.substrings(mixed))


def test_word_windows_equal_brute_force(frame, mixed):
    got = debruijn.word_digests(frame(mixed)).collect()
    assert by_id(got) == by_id(brute.words(mixed))


@pytest.mark.parametrize("name,plain", [("op3_substrings", brute.substrings), ("op10_debruijn", brute.words)])
def test_whole_tables(spark, sf_dir, rows, name, plain):
    assert by_id(queries.queries()[name](spark, sf_dir).collect()) == by_id(plain(rows))


@pytest.fixture(scope="module")
def passage():
    """One passage in every text, each with a context of its own."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    shared = " ".join(word() for _ in range(60))
    return [(i, " ".join([*(word() for _ in range(30)), shared, *(word() for _ in range(30))])) for i in range(300)]


@pytest.mark.parametrize("module,digests,plain", [(substrings, substrings.substring_digests, brute.substrings), (debruijn, debruijn.word_digests, brute.words)])
def test_crowded_minimizers_equal_brute_force(spark, frame, mixed, passage, monkeypatch, module, digests, plain):
    monkeypatch.setattr(repeats, "CROWD", 2)
    monkeypatch.setattr(repeats, "CROWD_IN_BLOCK", 1)
    rows = mixed + [(i + 5000, t) for i, t in passage[:40]] + passage[40:60] * 2
    assert len(repeats.crowded(repeats.addressed(frame(rows)), module.KIND)) > 10
    assert by_id(digests(frame(rows)).collect()) == by_id(plain(rows))


@pytest.mark.parametrize("module", [substrings, debruijn])
def test_a_passage_in_every_text_is_dealt_out(module, passage):
    """No bucket receives the edges of the passage from all texts."""
    kind, buckets = module.KIND, 4096
    texts = pa.RecordBatch.from_arrays([pa.array([i for i, _ in passage]), pa.array([i for i, _ in passage]), pa.array([t for _, t in passage])],
                                       ["lead", "key", "text"])
    ((_, _, items, counts),) = repeats.each_chunk(iter([texts]), kind)
    r = repeats.find_runs(items, counts, kind)
    (found,) = repeats._crowds(kind, 100)(iter([texts]))
    crowds = np.sort(found.column(0).to_numpy().view(np.uint64))
    assert len(crowds) >= 2
    first = np.zeros(len(r.text), bool)
    first[np.unique(np.stack([r.minimizer, r.content], 1), axis=0, return_index=True)[1]] = True
    opened = [[r.place[(r.text == k) & first].astype(np.uint32).tobytes()] for k in range(len(passage))]
    asked = texts.append_column("open", pa.array(opened, pa.list_(pa.binary())))

    def largest(crowds):
        runs = {}
        for batch in repeats._send(kind, buckets, crowds)(iter([asked])):
            for bucket, leads in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs[bucket] = max(runs.get(bucket, 0), len(set(np.frombuffer(leads, np.int64))))
        return max(runs.values())

    assert largest(crowds[:0]) > len(passage) * 0.9 and largest(crowds) < len(passage) / 10

    def largest_judged(crowds):
        (packed,) = repeats._pack(kind, buckets, crowds)(iter([texts]))
        own = packed.filter(pa.compute.invert(packed.column(1)))
        return max(len(set(np.frombuffer(x.as_py(), np.int64))) for x in own.column(4))

    assert largest_judged(crowds[:0]) > len(passage) * 0.9 and largest_judged(crowds) < len(passage) / 10


def test_paths_are_compacted(spark):
    pieces = [(9, 1, 0, 5, 2, 2, 100), (9, 1, 5, 8, 2, 2, 105), (9, 1, 8, 9, 3, 3, 7), (9, 1, 20, 22, 2, 2, 120)]
    df = spark.createDataFrame(pieces, "lead long, key long, begin long, end long, s_lead long, s_key long, s_begin long")
    got = {tuple(r)[2:] for r in debruijn.compacted(df).collect()}
    assert got == {(0, 8, 2, 2, 100), (8, 9, 3, 3, 7), (20, 22, 2, 2, 120)}


def test_fingerprints_and_components(frame, mixed, rows):
    every = mixed + rows[:60]
    got = simhash.simhash_components(frame(every)).select("doc_id", "fp", "component_id").collect()
    want = [(i, f - (1 << 64) if f >> 63 else f, c) for i, f, c in brute.component_ids(every)]
    assert by_id(got) == by_id(want)


def test_any_four_positions_hold_a_listed_triple():
    from itertools import combinations

    triples = [set(t) for t in simhash.triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Thousands of fingerprints around one, dealt over many blocks: the same classes, few links."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rng = np.random.default_rng(0)
    values = set(rng.integers(0, 2**63, 50, dtype=np.uint64).tolist())
    centre = int(rng.integers(0, 2**63, dtype=np.uint64))
    for _ in range(1500):
        x = centre
        for bit in rng.integers(0, 64, 3):
            x ^= 1 << int(bit)
        values.add(x)
    signed = {x: x - (1 << 64) if x >> 63 else x for x in values}
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"))
    assert links.count() < 400 * len(values)
    root = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute.classes(list(values))
    found = {(want[x], root.get(s, s)) for x, s in signed.items()}
    assert len(found) == len({a for a, _ in found}) == len({b for _, b in found})


def test_components_of_a_long_path(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert set(got.values()) == {0} and len(got) == 200


@pytest.mark.parametrize("run", [substrings.substring_digests, debruijn.word_digests, simhash.simhash_components])
def test_empty_tables(frame, spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert run(frame([(None, None)])).count() == 1


def test_words_that_collide_are_different_words(frame):
    """Two texts of 20 words each, alike but for the exchange of two letters in long words."""
    bits = [bin(k).count("1") % 2 for k in range(4096)]
    rows = []
    for doc, letters in enumerate(("ab", "ba")):
        words = ["".join(letters[b] for b in bits[: 1024 + 64 * k]) for k in range(20)]
        rows.append((doc, " ".join(words)))
    got = debruijn.word_digests(frame(rows)).collect()
    assert by_id(got) == by_id(brute.words(rows)) and all(r["n_removed"] == 0 for r in got)
