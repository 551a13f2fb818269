import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from webglean.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text):
    data = bpe.encode_text(text, PATH, PATTERN)
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_same_ids_as_the_library(known, text):
    assert ids(text) == known.encode_ordinary(text)


def test_hard_texts(known):
    rng = random.Random(3)
    parts = ["the", "ab", "\n\n", "  ", "é", "漢字", "\x1c", "\x85", "'ll", "1234", "!!!", "aaaa", "🙂"]
    texts = ["".join(rng.choices(parts, k=300)) for _ in range(40)] + ["a" * 5000, " " * 3000, ""]
    for text in texts:
        assert ids(text) == known.encode_ordinary(text)


def test_append_and_edit_equal_a_fresh_encoding():
    pairs, rng = bpe.load_ranks(PATH), random.Random(5)
    letters = b"theanring o"
    encoder = bpe.PrefixEncoder(pairs)
    data = b""
    for _ in range(60):
        more = bytes(rng.choices(letters, k=rng.randrange(9)))
        encoder.append(more)
        data += more
        assert encoder.ids() == bpe.PrefixEncoder(pairs, data).ids()
    for _ in range(60):
        start = rng.randrange(len(data) + 1)
        end = min(len(data), start + rng.randrange(6))
        new = bytes(rng.choices(letters, k=rng.randrange(6)))
        encoder.edit(start, end, new)
        data = data[:start] + new + data[end:]
        assert encoder.data == data
        assert encoder.last == bpe.PrefixEncoder(pairs, data).last


def test_an_edit_far_from_the_end_is_local():
    pairs = bpe.load_ranks(PATH)
    encoder = bpe.PrefixEncoder(pairs, b"the rain in spain " * 400)
    assert encoder.edit(10, 12, b"xy") < 1500


def test_column_with_nulls_and_clashing_names(spark, known):
    long = "word " * 40_000
    rows = [(1, "Hello there", "a"), (None, None, "b"), (3, "", "c"), (3, "", "c"), (4, long, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "token_ids", "n_tokens", "decoded"]
    for row in got:
        text = row.text or ""
        assert bytes(row.decoded) == text.encode()
        assert row.n_tokens == len(known.encode_ordinary(text))
    assert spark.createDataFrame([], df.schema).transform(bpe.encode, PATH, PATTERN).count() == 0
    assert hashlib.sha256(bytes(got[0].token_ids)).hexdigest()
