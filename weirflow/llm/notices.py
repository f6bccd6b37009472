"""Licence scans: phrases, and an exact set-similarity join of windows of words with notice wordings.

A block is any run of consecutive words of a text, wherever its
lines break, of at most as many words as the wording has, divided by the threshold. A wording is contained in a block if the
block has at least ``threshold`` of its distinct words, all words that tell it from similar wordings, and none
that make it another licence's. A label's score is its largest share in a block.

Words are ordered by how often the corpus holds them, rarest first: one map and an aggregate of as many rows as the wordings have words.
A second map joins. A block that reaches the threshold holds a word of the wording's short prefix in that order
(prefix filter), or its rarest telling word. A text with too few words is skipped (length filter), and so is a place of a prefix word
with too few of the wording's words around it (positional filter). Around what passes, blocks are counted exactly.

Null and empty texts: no words, no labels, score 0. Null ``doc_id``: the row stays, its id null. Repeated
rows: one result row each. Columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.bytepair import hash_table, look_up
from weirflow.llm.licences import PHRASES, THRESHOLD, Words, _chunks, _word_hashes, needed, word_counts
from weirflow.llm.tables import table


class Notice(NamedTuple):
    label: str
    text: str
    #: Words without which it is not this licence, and words with which it is another.
    telling: tuple[str, ...] = ()
    barred: tuple[str, ...] = ()


#: Wordings, own short forms of what such notices say; a label may have several.
NOTICES = (
    Notice("agpl", "licensed under the gnu affero general public license", ("affero",)),
    Notice("apache-2", "licensed under the apache license version 2 0", ("apache", "2")),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    Notice(
        "cc-by-4", "licensed under a creative commons attribution 4 0 international license", ("creative", "attribution", "4"),
        ("noncommercial", "sharealike", "noderivatives", "noderivs"),
    ),
    Notice("cc-by-nc-4", "licensed under cc by nc 4 0", ("cc", "nc", "4"), ("sa", "nd")),
    Notice("cc-by-sa-4", "licensed under cc by sa 4 0", ("cc", "sa", "4"), ("nc", "nd")),
    Notice("gpl-3", "this work is licensed under the gnu general public license version 3", ("general", "3"), ("lesser", "affero")),
    Notice(
        "gpl-any", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation", ("general",), ("lesser", "affero"),
    ),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("fee",)),
    Notice("lgpl", "licensed under the gnu lesser general public license", ("lesser",)),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("mit", "released under the mit license", ("mit",)),
    Notice("mit", "under the terms of the mit license", ("mit",)),
    Notice("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla", "2")),
    Notice("public-domain", "released into the public domain", ("public", "domain")),
    Notice("public-domain", "this is free and unencumbered software released into the public domain", ("unencumbered",)),
)


def width(text: str, threshold: float) -> int:
    """Words of the longest block."""
    return int(np.ceil(len(text.split()) / threshold - 1e-9))


def prefix(notice: Notice, counts: dict[str, int], threshold: float) -> list[str]:
    """Words of which any block that contains the notice has one: its rarest, or its rarest telling word if that is rarer than they are."""

    def often(word: str) -> tuple[int, str]:
        return counts.get(word, 0), word

    own = sorted(set(notice.text.split()), key=often)
    rarest = own[: len(own) - needed(notice.text, threshold) + 1]
    best = min(notice.telling, key=often, default=None)
    return [best] if best and counts.get(best, 0) <= sum(counts.get(w, 0) for w in rarest) else rarest


def _shares(
    words: Words, at: np.ndarray, number: np.ndarray, vocabulary: list[str], notice: Notice, first: list[str], threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Texts and shares of the blocks that contain a notice; ``at`` and ``number`` are the places of the vocabulary's words,
    ``first`` is the notice's prefix."""
    own = sorted(set(notice.text.split()))
    places, longest, need = np.array([vocabulary.index(w) for w in own]), width(notice.text, threshold), needed(notice.text, threshold)
    telling = [vocabulary.index(w) for w in notice.telling]
    seeds = at[np.isin(number, [vocabulary.index(w) for w in first])]
    seeds = seeds[words.per_text[words.text[seeds]] >= need]
    around = at[np.isin(number, places)]
    near_by = np.searchsorted(around, seeds + longest) - np.searchsorted(around, seeds - longest, side="right")
    seeds = seeds[near_by >= need]
    if not len(seeds):
        return np.zeros(0, np.int64), np.zeros(0)
    mine = np.flatnonzero(np.isin(number, [*places, *(vocabulary.index(w) for w in notice.barred)]))
    here, word = at[mine], number[mine]
    after = np.searchsorted(seeds, here)
    near = here - seeds[np.maximum(after - 1, 0)] < longest
    near |= np.abs(seeds[np.minimum(after, len(seeds) - 1)] - here) < longest
    barrier = np.isin(word, [vocabulary.index(w) for w in notice.barred])
    near |= barrier
    here, word, barrier = here[near], word[near], barrier[near]
    # The longest block that ends at a word begins behind the last barred word, in the same text.
    begin = np.maximum(here - longest + 1, here - words.number[here])
    begin = np.maximum(begin, np.maximum.accumulate(np.where(barrier, here, -1)) + 1)
    found, whole = np.zeros(len(here), np.int64), ~barrier
    for w in places:
        holds = np.maximum.accumulate(np.where(word == w, here, -1)) >= begin
        found += holds
        if w in telling:
            whole &= holds
    hit = whole & (found >= need)
    return words.text[here[hit]], found[hit] / len(own)


def _vocabulary(notices: tuple[Notice, ...]) -> list[str]:
    own = {w for n in notices for w in (*n.text.split(), *n.telling, *n.barred)}
    return sorted(own | {w for phrase in PHRASES for w in phrase.split()})


def _scanner(notices: tuple[Notice, ...], counts: dict[str, int], threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    phrases = [phrase.split() for phrase in PHRASES]
    vocabulary, prefixes = _vocabulary(notices), [prefix(n, counts, threshold) for n in notices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = hash_table(_word_hashes(vocabulary))
        for rows, words in _chunks(batches):
            n = len(rows)
            known = look_up(lookup, words.hashes)
            at = np.flatnonzero(known >= 0)
            number = known[at]
            n_base, first, last = np.zeros(n, np.int64), np.full(n, 2**62), np.full(n, -1)
            base: list[set[str]] = [set() for _ in range(n)]
            for phrase, label in zip(phrases, PHRASES.values(), strict=True):
                want = [vocabulary.index(w) for w in phrase]
                start = at[number == want[0]]
                for k in range(1, len(want)):
                    start = start[start + k < len(known)]
                    start = start[(known[start + k] == want[k]) & (words.text[start + k] == words.text[start])]
                text = words.text[start]
                n_base += np.bincount(text, minlength=n)
                np.minimum.at(first, text, words.number[start])
                np.maximum.at(last, text, words.number[start])
                for t in np.unique(text):
                    base[t].add(label)
            score, labels = np.where(n_base > 0, 1.0, 0.0), [set(b) for b in base]
            for notice, rarest in zip(notices, prefixes, strict=True):
                text, share = _shares(words, at, number, vocabulary, notice, rarest, threshold)
                np.maximum.at(score, text, share)
                for t in np.unique(text):
                    labels[t].add(notice.label)
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), pa.array(words.per_text.astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([",".join(sorted(b)) for b in base]), pa.array([",".join(sorted(x)) for x in labels]), pa.array(score),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


_SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def notices(docs: DataFrame, wordings: tuple[Notice, ...] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: words, phrase places, labels of the phrases, labels of phrases and notices, and the best score."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = word_counts(narrow, _vocabulary(tuple(wordings)))
    return narrow.mapInArrow(_scanner(tuple(wordings), counts, threshold), _SCANNED)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """Every block that ends at a word of a wording, by a join of the places of its words."""
    def words(notice: Notice) -> list[str]:
        own = [f"('{w}', {str(w in notice.telling).lower()}, false)" for w in sorted(set(notice.text.split()))]
        return own + [f"('{w}', false, true)" for w in notice.barred]

    vocabulary = " UNION ALL ".join(
        f"SELECT {k} AS k, * FROM (VALUES {', '.join(words(n))}) v(word, telling, barred)" for k, n in enumerate(NOTICES)
    )
    sizes = ", ".join(
        f"({k}, '{n.label}', {len(set(n.text.split()))}, {needed(n.text, THRESHOLD)}, {width(n.text, THRESHOLD)}, {len(n.telling)})"
        for k, n in enumerate(NOTICES)
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tests = {
        label: " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split())) for phrase, label in PHRASES.items()
    }
    return f"""
WITH x AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, i - 1 AS place, CASE {" ".join(f"WHEN {t} THEN '{label}'" for label, t in tests.items())} END AS label
    FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM x) WHERE {" OR ".join(f"({t})" for t in tests.values())}),
b AS (SELECT r, count(*) AS n, min(place) AS f, max(place) AS l, list(DISTINCT label) AS labels FROM p GROUP BY r),
v AS ({vocabulary}),
s AS (SELECT * FROM (VALUES {sizes}) s(k, label, size, need, longest, n_telling)),
held AS (SELECT r, k, i, word, telling, barred, max(CASE WHEN barred THEN i END) OVER (PARTITION BY r, k ORDER BY i) AS bar
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM x) JOIN v USING (word)),
blocks AS (SELECT e.r, e.k, e.i, count(DISTINCT o.word) AS found, count(DISTINCT CASE WHEN o.telling THEN o.word END) AS told
    FROM held e JOIN s USING (k) JOIN held o ON o.r = e.r AND o.k = e.k AND o.i <= e.i AND o.i > e.i - longest AND o.i > coalesce(e.bar, 0)
    WHERE NOT e.barred AND NOT o.barred GROUP BY e.r, e.k, e.i),
g AS (SELECT r, list(DISTINCT label) AS labels, max(found / size) AS share FROM blocks JOIN s USING (k)
    WHERE found >= need AND told = n_telling GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(f AS BIGINT) AS first_word,
CAST(l AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, g.labels))), ','), '') AS labels,
CAST(greatest(CASE WHEN n > 0 THEN 1 ELSE 0 END, coalesce(share, 0)) AS DOUBLE) AS score
FROM x LEFT JOIN b USING (r) LEFT JOIN g USING (r)
"""


SQL = _sql()
