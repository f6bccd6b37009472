"""The pipeline's stages, each against a plain restatement on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import by_id
from weirflow.llm import quality
from weirflow.llm.tables import table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, labels = docs.columns, table(spark, sf_dir, "labels")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, name)
        before = docs
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = (before.collect(), docs.collect())
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            net = quality.train(before, labels)
            kept = quality.scored(before.select("doc_id", "text"), net).filter("score >= 0.7").select("doc_id").collect()
            assert by_id(kept) == by_id((r["doc_id"],) for r in seen[name][1])

    before, after = seen["near_dedup"]
    ids = brute.component_ids([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {c for _, _, c in ids} and len(after) < len(before)

    before, after = seen["decontamination"]
    items = [brute.plain_words(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    joined = [" ".join(x) for x in items]
    leaked = {r["doc_id"] for r in before if any(j in " ".join(brute.plain_words(r["text"])) for j in joined)}
    assert leaked and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - leaked

    before, after = seen["privacy"]
    clean = {}
    for r in before:
        text, spans = r["text"], sorted((a, b, k) for k, a, b in brute.base_spans(r["text"]))
        out, at = "", 0
        for a, b, k in spans:
            if a >= at:
                out += text[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        clean[r["doc_id"]] = out + text[at:]
    assert {r["doc_id"]: r["text"] for r in after} == clean
    assert all(r["n_chars"] == len(r["text"]) for r in after) and any(clean[r["doc_id"]] != r["text"] for r in before)

    before, after = seen["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in before}
    assert {r["doc_id"]: r["ids"] for r in after} == want and all(r["round_trip"] for r in after)


def test_edge_rows_pass_through(spark, sf_dir, frame, mixed):
    docs = frame([*mixed, (7, mixed[7][1])]).selectExpr("*", "'en' as lang", "'s' as source", "cast(0 as long) as n_chars")
    for _, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, "edge")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() <= len(mixed)


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, "empty")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0
