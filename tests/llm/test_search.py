"""Nearest neighbours, licences, privacy, decontamination and quality against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from weirflow.llm import decontamination, neighbours, private_spans, quality, queries

# --- nearest neighbours --------------------------------------------------------------------------


def exact(vectors, asked, k):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors])
    out = {}
    for q in asked:
        score = x @ x[ids == q][0]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [int(ids[j]) for j in order]
    return out


def test_recall_on_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = exact([(r[0], np.array(r[1], np.float64)) for r in rows], [r[0] for r in rows if r[0] % 20 == 0], 20)
    got = queries.queries()["op5_neighbours"](spark, sf_dir).toPandas()
    found = {q: list(g.sort_values("rank")["vec_id"]) for q, g in got.groupby("query_id")}
    assert {q: len(v) for q, v in found.items()} == {q: 20 for q in want}
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_few_vectors_ties_and_bad_ones(spark):
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(12)] + [(20, [1.0, 0, 0, 0, 0]), (21, [1.0, 0, 0, 0, 0])]
    good = [(i, [float(c) for c in v]) for i, v in good]
    bad = [(30, None), (31, [0.0] * 5), (32, [1.0, None, 0.0, 0.0, 0.0]), (33, [float("nan")] * 5), (34, [float("inf")] * 5), (None, [1.0] * 5), (35, [])]
    other = [(40, [1.0, 2.0]), (60, [3.0, -1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad + other], "vec_id long, embedding array<float>, rank string, score int")
    got = neighbours.neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    single = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in good]
    want = exact(single, [0, 20], 20)
    found = {q: [r["vec_id"] for r in got if r["query_id"] == q] for q in (0, 20, 40, 60)}
    assert found == {**want, 40: [60], 60: [40]}
    assert [r["rank"] for r in got if r["query_id"] == 0] == list(range(1, 14))
    assert neighbours.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_vectors_tie_to_the_smaller_id(spark):
    df = spark.range(3_000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    got = neighbours.neighbours(df, F.col("vec_id").isin(0, 1500)).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got] == [*range(1, 21), *range(20)]


# --- privacy -------------------------------------------------------------------------------------

SCRAPS = [
    "a@b.c", "@", "a", ".", "1.2.3.4", "999", "5", " ", "-", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 123-4567", "+", "(",
    "é", "😀", "%x@y.z", "\x01", "\x02", "000", "256", "mail: ", "x@y.z@w.v ",
]


def spans_of(df):
    found = private_spans.private_spans(df).select("doc_id", private_spans.joined(F.col("base")), private_spans.joined(F.col("spans")))
    return {r[0]: (r[1], r[2]) for r in found.collect()}


def text_of(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_equal_plain_expressions(frame, rows):
    rng = random.Random(3)
    made = [(i, "".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 25)))) for i in range(600)]
    hard = [(2000, None), (2001, ""), (2002, "1" * 20_000), (2003, "a@b" + ".c" * 3_000), (2004, "a@b.cd " * 700), (2005, "1 " * 5_000)]
    texts = made + hard + [(i + 10_000, t) for i, t in rows]
    got = spans_of(frame(texts))
    assert {i: got[i][0] for i, _ in texts} == {i: text_of(brute.base_spans(t)) for i, t in texts}


def test_loose_spans_are_added_where_the_labelers_agree(frame):
    sure = [(i, f"please call our phone {200 + i}-555-{1000 + i} now") for i in range(60)]
    strict = [(100 + i, f"phone +1 (555) 010-{1000 + i} here") for i in range(60)]
    against = [(300 + i, f"order section {200 + i}-777-{1000 + i} now") for i in range(60)]
    got = spans_of(frame(sure + strict + against))
    assert all(got[i][0] == got[i][1] for i in range(300, 360))
    assert all(set(base.split(",")) - {""} <= set(spans.split(",")) for base, spans in got.values())


def test_posteriors_follow_the_votes():
    votes = [("ip", (1, -1, 1), 50), ("ip", (1, -1, -1), 300), ("ip", (0, 0, -1), 40), ("ip", (0, -1, 0), 60)]
    p = private_spans.reliabilities(votes)
    assert p["ip", (1, -1, 1)] > 0.9 and p["ip", (1, -1, -1)] > 0.9 and p["ip", (0, 0, -1)] < 0.1 and p["ip", (0, -1, 0)] < 0.1


def test_the_privacy_plan_has_no_python(spark, sf_dir):
    plan = queries.queries()["op8_private_spans"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- decontamination -----------------------------------------------------------------------------


def test_leaks_equal_plain_alignment(spark, frame, sf_dir, rows):
    rng, items = random.Random(5), spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()
    fill, docs = brute.plain_words(rows[0][1]), []
    for b in items:
        for share in (0, 0.1, 0.2, 0.25):
            x = brute.plain_words(b["text"])
            for _ in range(int(share * len(x))):
                p, kind = rng.randrange(len(x)), rng.choice("rid")
                if kind == "r":
                    x[p] = rng.choice(fill)
                elif kind == "i":
                    x.insert(p, rng.choice(fill))
                else:
                    del x[p]
            around = [rng.choice(fill) for _ in range(rng.randint(0, 60))]
            docs.append((len(docs), b["item_id"], b["text"], " ".join([*around, *x, *around[::-1]])))
    want = {}
    for i, item, text, passage in docs:
        value = brute.similarity(brute.plain_words(passage), brute.plain_words(text))
        if value >= 0.8 - 1e-9:
            want[i, item] = value
    extra = [(5000, None), (5001, ""), (None, docs[0][3]), (0, docs[0][3])]
    df = frame([(i, p) for i, _, _, p in docs] + extra)
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "word")], "item_id long, text string")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").union(odd)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.leaks(df, bench).collect()}
    assert got.pop((None, docs[0][1])) == 1.0
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert decontamination.leaks(df.limit(0), bench).count() == decontamination.leaks(df, bench.limit(0)).count() == 0


# --- quality -------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()["op4_quality"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    known = got.merge(labels, on="doc_id")
    held = known[known["held_out"]]
    assert len(got) == 1000 and len(held) > 50 and got["score"].between(0, 1).all()
    assert (held["predicted"] == held["quality"]).mean() > 0.93


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = quality.Network(*(p.astype(np.float64) for p in quality._first(1)))
    codes, counts, labels = rng.integers(0, 257, (5, quality.CHUNK)), np.array([2, 3]), np.array([0.0, 1.0])

    def loss(n):
        p = quality._sigmoid(quality._combined(quality.responses(n, codes), counts) @ n.weights + n.bias)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = quality._gradients(net, codes, counts, labels)
    for k, name in enumerate(net._fields):
        at = tuple(rng.integers(0, s) for s in net[k].shape)
        up, down = net[k].copy(), net[k].copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        want = (loss(net._replace(**{name: up})) - loss(net._replace(**{name: down}))) / 2e-5
        assert slopes[k][at] == pytest.approx(want, abs=2e-4)


def test_quality_edges(spark, frame, mixed):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    df = frame(mixed)
    net = quality.train(df, labels)
    assert quality.scored(df, net).count() == len(mixed)
    assert quality.scored(df.limit(0), net).count() == 0
    unknown = quality.train(df, labels.limit(0))
    assert {r["score"] for r in quality.scored(df, unknown).select("score").collect()} == {0.5}
