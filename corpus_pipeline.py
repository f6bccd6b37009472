"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``; ``run`` writes each
result to the shared folder and reads it again as the next stage's documents, so a lost executor never
reaches back further than one stage. An empty input gives an empty result. Nulls, repeated rows and further columns are
treated as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import decontamination, private_spans, quality, simhash, token_codec
from weirflow.llm.tables import table
from weirflow.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the labelled ones among them that are not held out.

    Null and empty texts are scored like any other; repeated rows get one score and stay or go together.
    """
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "text")
    return quality.scored(whole, net).filter(quality.predicted() == 1).select("document.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: that of the smallest id.

    Null and empty texts have fingerprint zero and are one group with what is near it. Of equal ids the text decides, of
    repeated rows one stays. A null id is larger than any other.
    """
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    A document goes by its id and text together, so of rows with one id only those with the passage go; repeated rows go or stay
    together. Null and empty texts, also of items, hold no passage.
    """
    found = decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("leaked_id"), F.col("text_key").alias("leaked_key")).distinct()
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(leaked["leaked_id"]) & (key == leaked["leaked_key"])
    return docs.join(leaked, same, "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind.

    Every row is treated on its own: repeated rows stay, a null text stays null, an empty one empty.
    """
    return private_spans.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of every document left; a null text has no tokens, repeated rows a result each."""
    encoded = token_codec.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("privacy", redact),
    ("tokens", tokenize),
]

#: SQL can express neither the network nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
