"""BPE round trip: tree concatenation against the tokenizers library itself."""
import array
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import bpe
from shelfspark.llm.queries import tokenizer_path

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "''", "1", "23", ".", "!!", "é", "日本", "語。", "\U0001F600",
          "<|endoftext|>", "<|endof", "text|>", "\xa0", " x", "\r\n", "\x0b", "​", "　"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(tokenizer_path())


def library(codec, text):
    return codec.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=150), st.integers(1, 40), st.sampled_from([1, 2, 8, 64]))
def test_any_cuts_join_exactly(codec, pieces, leaf, size):
    text = "".join(pieces)
    parts = [codec.encode(text[i:i + leaf]) for i in range(0, len(text), leaf)]
    while len(parts) > 1:
        joined = [codec.join(parts[i], parts[i + 1], size) for i in range(0, len(parts) - 1, 2)]
        parts = joined + parts[len(joined) * 2:]
    ids = parts[0] if parts else []
    assert ids == library(codec, text)
    assert codec.decode(ids) == codec.library.decode(ids, skip_special_tokens=False) == text


def test_fast_path_is_the_library_on_every_character(codec):
    assert codec.fast is not None
    for low in range(0, 0x110000, 8192):
        chars = [chr(c) for c in range(low, low + 8192) if not 0xD800 <= c < 0xE000]
        for form in ("a%sb", "1%s2", " %s ", "'%s"):
            text = "\n".join(form % c for c in chars)
            assert codec.encode(text) == library(codec, text) or len(text) > bpe.LONG_WINDOW


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 40_000 + "x", "ab1" * 20_000, "日本語" * 9_000, "word " * 9_000, "\n" * 30_000])
def test_unbroken_runs(codec, text):
    leaf = 5000
    assert codec.tree([codec.encode(text[i:i + leaf]) for i in range(0, len(text), leaf)]) == library(codec, text)


def test_query_rows(spark, codec):
    rng = random.Random(1)
    texts = [None, "", "x", "<|endoftext|> a<|endoftext|>", "".join(rng.choice(PIECES) for _ in range(30_000)), "y " * 20_000, "x"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "x", "z"), (2, "x", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = sorted((tuple(r) for r in bpe.round_trip(df, tokenizer_path(), leaf=1000).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = library(codec, t or "")
        want.append((i, len(ids), hashlib.sha256(array.array("I", ids).tobytes()).hexdigest(),
                     hashlib.sha256(codec.library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_time_grows_with_the_length_of_a_text(spark):
    """Leaves are cut in one pass: a text of eight times the length takes no more than about eight times as long."""
    import time

    def seconds(n):
        df = spark.createDataFrame([(1, "some words, " * (n // 12))], "doc_id long, text string")
        start = time.perf_counter()
        bpe.round_trip(df, tokenizer_path()).collect()
        return time.perf_counter() - start

    seconds(100_000)
    short = max(seconds(1_000_000), 1.0)
    assert seconds(8_000_000) < 16 * short


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
