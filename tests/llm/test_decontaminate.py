"""Spaced seeds: every tolerated window is hit, and overlaps match brute force."""
import itertools
import random
import re

import pytest

from shelfspark.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, doc_id int"


def test_masks_hit_every_window_with_two_substitutions():
    on = [[i for i, b in enumerate(m) if b == "1"] for m in D.MASKS]
    allowed = D.WINDOW - (-int(-D.AGREE * D.WINDOW // 1))
    assert allowed == 2
    for k in range(allowed + 1):
        for wrong in itertools.combinations(range(D.WINDOW), k):
            assert any(not any(s + i in wrong for i in o) for m, o in zip(D.MASKS, on) for s in range(D.WINDOW - len(m) + 1))


def brute(docs, items):
    """(doc_id, item_id) pairs, one per document row and item."""
    def words(t):
        return re.findall(r"\w+", (t or "").lower())
    found = []
    for d, t, *_ in docs:
        a = words(t)
        for i, u, *_ in items:
            b = words(u)
            size = min(D.WINDOW, len(b))
            least = size if len(b) < D.WINDOW else 11
            if len(b) >= D.MIN_TOKENS and any(
                    sum(a[x + k] == b[y + k] for k in range(size)) >= least
                    for x in range(len(a) - size + 1) for y in range(len(b) - size + 1)):
                found.append((d, i))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(6, 50)), 1) for i in range(25)]
    items += [(90, "too short", 1), (91, None, 1), (92, "", 1), (None, text(20), 1), (3, items[3][1], 1)]
    docs = []
    for d in range(120):
        body = text(rng.randrange(5, 150)).split()
        item = rng.choice(items)[1] or ""
        part = item.split()
        for _ in range(rng.randrange(6)):
            if part:
                part[rng.randrange(len(part))] = "swapped"
        if rng.random() < 0.3:
            part = part[rng.randrange(len(part) or 1):]
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at] + part + body[at:]).replace(" w1 ", ", W1! "), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (7, docs[7][1], "x"), (None, items[0][1], "x"), (502, text(20_000) + " " + items[5][1], "x")]
    return docs, items


@pytest.mark.parametrize("bits", [8, 26])  # a full map lets everything pass: same result
def test_overlaps_match_brute_force(spark, case, bits):
    docs, items = case
    got = D.overlaps(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), bits=bits).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == brute(docs, items)
    for r in got:
        assert 0 <= r.start < r.stop and r.same <= r.overlap <= r.item_tokens and r.same >= 0.8 * r.overlap - 1e-9


def test_clean_keeps_the_others_whole(spark, case):
    docs, items = case
    df = spark.createDataFrame(docs, DOCS)
    kept = D.clean(df, spark.createDataFrame(items, ITEMS))
    bad = {d for d, _ in brute(docs, items)}
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in docs if r[0] not in bad), key=str)


def test_empty_tables(spark, case):
    docs, items = case
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert D.overlaps(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert D.overlaps(spark.createDataFrame(docs, DOCS), no_items).count() == 0
    assert D.clean(spark.createDataFrame(docs, DOCS), no_items).count() == len(docs)


def test_short_masks_hit_every_tolerated_substitution():
    for n in range(1, D.WINDOW):
        wrong = n - D.least(n, D.AGREE)
        assert wrong == (0 if n < D.TOLERANT else int(n * 0.2 + 1e-9))
        for bad in itertools.combinations(range(n), wrong):
            assert any(not any(m[i] == "1" for i in bad) for m in D.short_masks(n, D.AGREE)), (n, bad)


def test_short_items_and_unspaced_scripts(spark):
    ten = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [(1, "What is 7 times 8?", 1), (2, "six words make a short item", 1), (3, ten, 1), (4, "日本の首都はどこですか", 1), (5, "yes", 1), (6, "名前?", 1)]
    docs = [(1, "So: what is 7 times 8? Fifty-six.", "x"), (2, "what is 7 times 9", "x"),  # below 6 tokens exact
            (3, "x six words make one short item x", "x"), (4, "x six words make one long item x", "x"),  # 1 of 6 may differ
            (5, "x " + ten.replace("beta", "b").replace("theta", "t"), "x"), (6, ten.replace("beta", "b").replace("theta", "t").replace("zeta", "z"), "x"),
            (7, "問題。日本の首都はどこですか。答え", "x"), (8, "問題。日本の通貨は何ですか。", "x"), (9, "Yes!", "x"), (10, "yes indeed", "x"), (11, "お名前は", "x")]
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = D.overlaps(df, bench, short_agree=D.AGREE).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 2), (5, 3), (7, 4), (9, 5), (11, 6)}
    assert {r.doc_id for r in D.clean(df, bench, D.AGREE).collect()} == {2, 4, 6, 8, 10}
