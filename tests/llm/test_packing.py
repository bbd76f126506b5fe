"""Best-fit packing: ids against the tokenizers library, the plan against placing piece by piece."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import packing
from shelfspark.llm.queries import word_tokenizer_path

PIECES = ["a", "The", " ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "12", ".", "!!", "é", "é", "日本", "ΑΣ", "İ", "ﬁ", "<|endoftext|>", "<|startof",
          "text|>", "\xa0", "\x1c", "\x85", " ", "​", "̈", "​", "　", "\U0001F600", "\x00"]


@pytest.fixture(scope="module")
def made():
    return packing.Encoder(word_tokenizer_path())


def library(made, text):
    return made.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=80))
def test_words_are_encoded_as_the_whole_text(made, parts):
    assert made.by_word
    text = "".join(parts)
    assert np.frombuffer(made.packed([text])[0], dtype="<u4").tolist() == library(made, text)


def test_every_character_beside_blanks(made):
    for low in range(0, 0x30000, 4096):
        text = " ".join("a" + chr(c) + " " + chr(c) for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(made.packed([text])[0], dtype="<u4").tolist() == library(made, text)


def test_plain_words_are_merged_as_the_library_does(made):
    assert made.fast is not None
    rng = random.Random(4)
    letters = "etaoinshrdlu'.-é" * 3 + "bcfgkmpvwyzqxjßàöüçñœŒÀÉ0123456789!?\"#$%&()*+,/:;<=>@[]^_`{|}~ABCDEFGHIJ"
    vocabulary = [t.removesuffix("</w>") for t in made.library.get_vocab()]
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(60_000)]
    words += [a + b for a, b in zip(vocabulary, reversed(vocabulary))]
    plain = [w for w in words if made.fast(w) is not None]
    assert len(plain) > 80_000
    for w, e in zip(plain, made.library.encode_batch(plain, add_special_tokens=False)):
        assert made.fast(w) == e.ids, w


def one_by_one(lengths, size):
    spaces = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, s in enumerate(spaces) if s >= x]
        if not fits:
            spaces.append(size)
            fits = [len(spaces) - 1]
        i = min(fits, key=lambda j: spaces[j])
        spaces[i] -= x
    return sorted(spaces)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.integers(30, 60))
def test_plan_is_best_fit(lengths, size):
    histogram = {x: lengths.count(x) for x in lengths}
    runs = packing.plan(histogram, size)
    used, ranks = {}, {}
    ends = {}
    for i, (length, rank, *_) in enumerate(runs):
        later = [r[1] for r in runs[i + 1:] if r[0] == length]
        ends[i] = later[0] if later else histogram[length]
        assert rank == ranks.get(length, 0)
        ranks[length] = ends[i]
    assert ranks == histogram
    for i, (length, rank, first, each, offset) in enumerate(runs):
        for j in range(ends[i] - rank):
            used.setdefault(first + j // each, []).append((offset + j % each * length, length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(size - sum(x for _, x in p) for p in used.values()) == one_by_one(lengths, size)


def test_query_rows(spark, made):
    rng = random.Random(3)
    texts = [None, "", "x", " \n ", "y " * 500, "<|endoftext|>", "a" * 3000] + ["same words here"] * 60
    texts += [" ".join(rng.choice(["one", "Two", "thrée", "4", "fi-ve"]) for _ in range(rng.randrange(1, 90))) for _ in range(200)]
    rows = [(i, t, 7, 7) for i, t in enumerate(texts)] + [(None, "x", 7, 7), (2, "x", 7, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long, task int").repartition(5)
    got = packing.packed(df, word_tokenizer_path(), size=64).collect()
    want = []
    for i, t, *_ in rows:
        ids = [*library(made, t or ""), 1]
        for n, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want.append((i, n, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) == len(one_by_one([w[3] for w in want], 64))


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), word_tokenizer_path()).count() == 0
