"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirflow.llm import manifest, notices, shingle_join
from weirflow.llm.debruijn import op10_debruijn
from weirflow.llm.decontamination import op1_leaks
from weirflow.llm.manifest import op13_manifest
from weirflow.llm.neighbours import op5_neighbours
from weirflow.llm.notices import op9_licences
from weirflow.llm.private_spans import op8_private_spans
from weirflow.llm.quality import op4_quality
from weirflow.llm.shingle_join import op12_jaccard
from weirflow.llm.simhash import op7_simhash
from weirflow.llm.substrings import op3_substrings
from weirflow.llm.token_codec import op6_token_codec
from weirflow.llm.token_counts import op2_token_counts
from weirflow.llm.turn_repair import op11_turns

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    every = (
        op1_leaks, op2_token_counts, op3_substrings, op4_quality, op5_neighbours, op6_token_codec, op7_simhash, op8_private_spans,
        op9_licences, op10_debruijn, op11_turns, op12_jaccard, op13_manifest,
    )
    return {query.__name__: query for query in every}


def statements() -> dict[str, str]:
    return {"op9_licences": notices.SQL, "op12_jaccard": shingle_join.SQL, "op13_manifest": manifest.SQL}
