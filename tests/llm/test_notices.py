"""Licence notices in windows of words, against brute force."""

import math
import random

import pytest

from tests.compare import difference, sql_frame
from tests.llm import brute
from tests.llm.conftest import by_id
from weirflow.llm import licences, notices, queries


def contained(text, notice, threshold=0.8):
    """Best share of the notice in any run of at most ``width`` words; 0 below the threshold."""
    words, own = brute.plain_words(text), set(notice.text.split())
    longest, need = math.ceil(len(notice.text.split()) / threshold - 1e-9), math.ceil(threshold * len(own) - 1e-9)
    best = 0.0
    for a in range(len(words)):
        for b in range(a + 1, min(len(words), a + longest) + 1):
            block = set(words[a:b])
            if len(block & own) >= need and block >= set(notice.telling) and not block & set(notice.barred):
                best = max(best, len(block & own) / len(own))
    return best


def expected(rows):
    out = []
    for i, text in rows:
        shares = {}
        for n in notices.NOTICES:
            share = contained(text or "", n)
            if share:
                shares[n.label] = max(share, shares.get(n.label, 0))
        words = " ".join(brute.plain_words(text))
        base = {label for phrase, label in licences.PHRASES.items() if f" {phrase} " in f" {words} "}
        out.append((i, ",".join(sorted(base)), ",".join(sorted(base | set(shares))), max([*shares.values(), 1.0 if base else 0.0])))
    return out


def labelled(df):
    return [(r["doc_id"], r["base_labels"], r["labels"], r["score"]) for r in notices.notices(df).collect()]


BSD = "redistribution and use in source and binary forms with or without modification are permitted"
WORDINGS = {
    "Licensed under the Apache License, Version 2.0.": "apache-2",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3",
    "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4",
    "All rights reserved.": "reserved",
}


def test_every_wording_that_occurs(frame):
    got = {i: labels for i, _, labels, _ in labelled(frame(list(enumerate(WORDINGS))))}
    assert got == dict(enumerate(WORDINGS.values()))


WRAPPED = [
    ("Redistribution and use in source and binary forms, with or without\n# modification, are permitted", "bsd"),
    ("// Subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy", "mpl-2"),
    ("Redistributions of source code must retain the above copyright\n notice, this list of conditions and the following disclaimer.", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this\nsoftware for any purpose with or without fee is hereby granted", "isc"),
    ("licensed under the terms\nof the MIT license", "mit"),
    ("Permission is hereby granted, free of charge, to any\n * person obtaining a copy\n * of this software", "mit"),
]


def test_wrapped_notices(frame):
    got = {i: labels for i, _, labels, _ in labelled(frame([(i, t) for i, (t, _) in enumerate(WRAPPED)]))}
    assert got == {i: label for i, (_, label) in enumerate(WRAPPED)}


def test_words_scattered_over_a_long_line_are_no_notice(frame):
    words = BSD.split()
    scattered = " ".join(w + " x" * 40 for w in words)
    inside = "x " * 3000 + BSD + " x" * 3000
    assert [r[2:] for r in sorted(labelled(frame([(1, scattered), (2, inside)])))] == [("", 0.0), ("bsd", 1.0)]


SIMILAR = {
    "This work is licensed under the GNU Lesser General Public License, version 3.": "gpl,lgpl",
    "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4",
    "Licensed under CC BY 4.0.": "cc-by",
    "Licensed under CC BY-ND 4.0.": "cc-by",
    "Licensed under the GNU Affero General Public License": "agpl,gpl",
    "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4",
    "Licensed under the Eclipse Public License, version 2.0": "",
    "Subject to the terms of the Eclipse Public License v. 2.0": "",
    "This work is licensed under the GNU General Public License, version 2.": "gpl",
    "Released under the Apache License": "",
    "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.": "cc-by,cc-by-nc-4,cc-by-sa-4",
}


def test_similar_wordings_are_told_apart(frame):
    got = {i: labels for i, _, labels, _ in labelled(frame(list(enumerate(SIMILAR))))}
    assert got == dict(enumerate(SIMILAR.values()))


def test_equal_to_brute_force(frame, mixed):
    rng = random.Random(5)
    texts = [*WORDINGS, *SIMILAR, *(t for t, _ in WRAPPED), *(n.text for n in notices.NOTICES), "sa nd lesser affero", "a b c é", "\n"]
    made = [(5000 + i, None if i % 50 == 0 else _spoiled(rng, [rng.choice(texts) for _ in range(rng.randint(0, 3))])) for i in range(400)]
    rows = [*mixed[:60], *made, (9000, " ".join(_spoiled(rng, texts) for _ in range(20)))]
    assert by_id(labelled(frame(rows))) == by_id(expected(rows))


def _spoiled(rng, parts):
    """Texts one after the other, with some words dropped, doubled or changed and lines broken anywhere."""
    out = []
    for w in " ".join(parts).split():
        out.append(rng.choice([w] * 12 + ["", w + "\n" + w, "x", "the", w + "\n"]))
    return " ".join(out)


@pytest.mark.parametrize("chunk", [1, 4 << 20])
def test_chunks_do_not_matter(frame, monkeypatch, chunk):
    monkeypatch.setattr(licences, "CHUNK_BYTES", chunk)
    rows = [(i, "Released under the\nMIT License." if i % 3 else "Released under the") for i in range(30)]
    batches = [r for r in frame(rows).select("doc_id", "text").toArrow().to_batches()]
    got = [r["labels"] for b in notices._scanner(notices.NOTICES, {}, 0.8)(iter(batches)) for r in b.to_pylist()]
    assert got == ["mit" if i % 3 else "" for i in range(30)]


def test_query_equals_sql(spark, sf_dir):
    got = queries.queries()["op9_licences"](spark, sf_dir).toPandas()
    assert difference(got, sql_frame(sf_dir, queries.statements()["op9_licences"])) is None
    assert got["labels"].map(lambda v: "mit" in v).any()


def test_prefixes_follow_the_corpus():
    notice = notices.Notice("x", "a b c d e")
    assert notices.prefix(notice, {"a": 9, "b": 1, "c": 5, "d": 2, "e": 7}, 0.8) == ["b", "d"]
    assert notices.prefix(notice._replace(telling=("c",)), {"a": 9, "b": 3, "c": 5, "d": 3, "e": 7}, 0.8) == ["c"]


def test_empty_table_and_nulls(spark, frame):
    assert notices.notices(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = {r["doc_id"]: tuple(r)[1:] for r in notices.notices(frame([(2, None), (None, ""), (3, "cc by" * 3000)])).collect()}
    assert got[2] == got[None] == (0, 0, None, None, "", "", 0.0) and got[3][0] == 3001
