import random

import pytest


@pytest.fixture(scope="session")
def rows(spark, sf_dir):
    """(doc_id, text) of the smallest table."""
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"]) for r in found]


@pytest.fixture(scope="session")
def mixed(rows):
    """Texts cut and joined from a few others, with nulls, empties, ties, repeated rows and long periodic texts."""
    rng, base = random.Random(1), [t for _, t in rows[:20]]
    out = []
    for n in range(100):
        parts = []
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(base)
            a = rng.randrange(len(s))
            parts.append(s[a : a + rng.randint(1, 400)])
        out.append((rng.choice([n, n, n, 5, None]), " ".join(parts)))
    out += [(1000, None), (1001, ""), (1002, "a " * 2500), (1003, "a" * 4000), (1004, "ab cd " * 800), (1005, "ab cd " * 30)]
    return [*out, (3, out[7][1]), (7, out[7][1]), (7, out[7][1]), (None, None), (1006, " ".join(base[3].split()[:60] * 3))]


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text) with further columns whose names the operators use themselves."""

    def make(rows):
        wide = [(i, t, "x", 1, 2) for i, t in rows]
        return spark.createDataFrame(wide, "doc_id long, text string, lead string, n_tokens int, fp int")

    return make


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))
