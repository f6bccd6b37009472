"""Token counts and codec against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import by_id
from weirflow.llm import bytepair, pretokens, queries, token_codec, token_counts
from weirflow.llm.pretokens import Known

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", "'re", "'ll", "x", "é", "ß", "1", "23", "²", "Ⅷ", "!", "...", "<|endoftext|>",
    "日本", " ", "　", "\x1c", "\x85", "’", "é", "😀", "aaaa", "    ", "\r\n", "'T", "'ve", "_", "-", "\0",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts(rows):
    rng = random.Random(1)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return ["", "<|endoftext|><|endoftext|> x", "a" * 5000, "ab" * 4000, " " * 3000, *made, *(t for _, t in rows)]


def ragged(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)


def mirrored(one, other, size):
    """A word of two letters and the same with the letters exchanged, in the order of Thue and Morse: polynomial hashes
    modulo a power of two cannot tell them apart."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join((one, other)[b] for b in bits), "".join((other, one)[b] for b in bits)


MIRRORED = [w for size in (1024, 2048, 4096) for pair in ("ab", "an", "on", "se") for w in mirrored(*pair, size)]


def test_words_that_collide_keep_their_own_ids(library):
    """In one chunk, in chunks one after the other, and with a memory that forgets."""
    v, t = bytepair.load(PATH), token_codec.trie(PATH)
    data, lengths = ragged(MIRRORED)
    assert len(np.unique(pretokens.hashes(data, np.append(0, np.cumsum(lengths)[:-1]), lengths))) < len(MIRRORED)
    want = [e.ids for e in library.encode_batch(MIRRORED, add_special_tokens=False)]
    ids, _ = token_codec.encode_chunk(v, t, Known(), data, lengths)
    assert ids.tolist() == [i for x in want for i in x]
    assert token_counts.count_chunk(v, Known(), data, lengths).tolist() == [len(x) for x in want]
    for limit in (2, 1 << 20):
        known, counted = Known(limit), Known(limit)
        for _ in range(2):
            for text, x in zip(MIRRORED, want):
                got, _ = token_codec.encode_chunk(v, t, known, *ragged([text, "ab"]))
                assert got.tolist()[: len(x)] == x
                assert token_counts.count_chunk(v, counted, *ragged([text]))[0] == len(x)


def test_counts_equal_the_library(library, texts):
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_chunk(bytepair.load(PATH), Known(), *ragged(texts)).tolist() == want


@pytest.mark.parametrize("limit", [50, 1 << 20])
def test_ids_and_digests_equal_the_library(library, texts, limit):
    v, known = bytepair.load(PATH), Known(limit)  # with a small limit the known words are forgotten again and again
    for k in range(0, len(texts), 500):
        part = texts[k : k + 500]
        ids, count = token_codec.encode_chunk(v, token_codec.trie(PATH), known, *ragged(part))
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert np.split(ids, np.cumsum(count)[:-1])[7].tolist() == want[7] and ids.tolist() == [i for x in want for i in x]
        of_ids, of_text = token_codec.digests(v, ids, count)
        assert of_ids == [brute.sha(",".join(map(str, x)).encode()) for x in want]
        assert of_text == [brute.sha(library.decode(x, skip_special_tokens=False).encode()) for x in want]


def test_speculation_is_checked(rows):
    v, t = bytepair.load(PATH), token_codec.trie(PATH)
    words = sorted({f" {w}" for _, text in rows[:50] for w in text.split()})
    data, lengths = ragged(words)
    starts = np.cumsum(lengths) - lengths
    ids, count, failed = token_codec.encode_words(v, t, data, starts, lengths)
    exact, n = bytepair.merge_all(v, data, starts, lengths)
    assert ids.tolist() == exact.tolist() and count.tolist() == n.tolist() and 0 < failed < len(words)


def test_queries_cover_the_table(spark, sf_dir, rows, library):
    encoded = [e.ids for e in library.encode_batch([t for _, t in rows], add_special_tokens=False)]
    counts = queries.queries()["op2_token_counts"](spark, sf_dir).collect()
    want = [(i, len(t.encode()), len(e), len(e) > 512) for (i, t), e in zip(rows, encoded, strict=True)]
    assert by_id(counts) == by_id(want)
    codec = queries.queries()["op6_token_codec"](spark, sf_dir).collect()
    want = [(i, len(e), brute.sha(",".join(map(str, e)).encode()), brute.sha(t.encode())) for (i, t), e in zip(rows, encoded, strict=True)]
    assert by_id(codec) == by_id(want)


def test_edges_and_round_trip(spark, frame, mixed):
    df = frame(mixed)
    assert token_counts.token_counts(df, PATH).count() == len(mixed)
    encoded = token_codec.encode(df, PATH)
    assert encoded.filter("round_trip").count() == len(mixed)
    assert by_id(token_codec.decode(encoded, PATH).collect()) == by_id((i, t or "") for i, t in mixed)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(empty, PATH).count() == token_codec.encode_digests(empty, PATH).count() == 0
