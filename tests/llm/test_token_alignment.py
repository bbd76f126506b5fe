"""Token alignment: a text, and the query, against brute force over all pairs."""
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfspark.llm import token_alignment as T
from shelfspark.llm.queries import piece_model_path, tokenizer_path

PIECES = ["a", "the", "Wörter", " ", "  ", "\n", "\t", "'s", "12", ".", "!!", "é", "日本語", "。", "\U0001F600", "<|endoftext|>", "<s>", "<0x41>",
          "▁", "\xa0", "\x1c", "\r\n", "ﬁ", "​", "　", "ize", "\x00"]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def brute(tools, text):
    """(ids of A, ids of B, groups as pairs of id lists) by comparing all ends, or None."""
    a, b = tools
    if not text:
        return None
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    letters = T.bpe._byte_letters()
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return None
    ends_a = [sum(map(len, bytes_a[:i + 1])) for i in range(len(ids_a))]
    ends_b = [sum(map(len, bytes_b[:i + 1])) for i in range(len(ids_b))]
    both = sorted(set(ends_a) & set(ends_b))
    return ids_a, ids_b, [([i for i, e in zip(ids_a, ends_a) if low < e <= high], [i for i, e in zip(ids_b, ends_b) if low < e <= high])
                          for low, high in zip([0, *both], both)]


def said(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), min_size=1, max_size=60), st.sampled_from([0, 10**6]))
def test_a_text(tools, parts, made_one_by_one):
    text, before = "".join(parts), T.MADE
    T.MADE = made_one_by_one
    got = T.aligner(tokenizer_path(), piece_model_path()).measured(text)
    T.MADE = before
    want = brute(tools, text)
    if want is None:
        assert got is None
        return
    links = Counter(x << 32 | y for xs, ys in want[2] for x in xs for y in ys)
    assert got[:4] == (len(want[0]), len(want[1]), len(want[2]), said(want[2]))
    assert dict(zip(got[4].tolist(), got[5].tolist())) == links


@pytest.mark.parametrize("hot", [0, 5, 10**6])  # all pairs by shuffle, some or all by broadcast
def test_query_rows(spark, tools, hot):
    rng = random.Random(5)
    texts = [None, "", "x", " ", "a▁b", "<|endoftext|> <s>", "same text here"] + ["same text here"] * 30 + ["z" * 4000, "né " * 300]
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1), (2, "x", 1)]
    got = T.alignment(spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(3), tokenizer_path(), piece_model_path(), hot)
    assert got.columns == ["doc_id", *T.NUMBERS, "groups_sha256"]
    found = [brute(tools, t) for _, t, _ in rows]
    links = [f and Counter((x, y) for xs, ys in f[2] for x in xs for y in ys) for f in found]
    count = Counter(p for f in links if f for p in f)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    want = []
    for (i, _, _), f, pairs in zip(rows, found, links):
        want.append((i, 0, 0, 0, 0, 0, 0, "") if f is None else (
            i, len(f[0]), len(f[1]), len(f[2]), sum(pairs.values()), sum(n for p, n in pairs.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in pairs.items()), hashlib.sha256(said(f[2]).encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert T.alignment(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path(), piece_model_path()).count() == 0
