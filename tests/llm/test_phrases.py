"""Phrase mining: counts and scores against brute force, with good and useless samples."""
import random
import re
from collections import Counter

import pytest

from shelfspark.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, rank string, a int"


def corpus(n=300):
    rng = random.Random(9)
    words = ["the", "The", "of", "new", "york", "city", "straße", "日本", "\xa0x", "a\x1cb", "--", "x"]
    out = []
    for i in range(n):
        t = []
        for _ in range(rng.randrange(0, 25)):
            t.append(rng.choice(words) if rng.random() < 0.7 else rng.choice(["New York City", "of the new\tworld order", "x x x x x x", "a. b", "c,d"]))
        out.append((i, rng.choice([" ", "  ", "\t"]).join(t) + rng.choice(["", ".", "\n", "\r\n"]), rng.choice(["en", "en", "de", None]), "z", 1))
    return out + [(900, None, "en", "z", 1), (901, "", None, "z", 1), (None, out[0][1], "en", "z", 1), (3, out[3][1], out[3][2], "z", 1),
                  *[(1000 + i, "copied words stand here again", "fr", "z", 1) for i in range(40)]]


def brute(rows, min_count, top):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cand.items():
        longer = [b for (m, v), b in cand.items() if m == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= 100 * a for b in longer):
            continue
        n = total[lang]
        score, _, left, right = min((1000 * a * n // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, left, right, n, score))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(own[:top])]
    return sorted(ranked)


@pytest.mark.parametrize("sample,lowered,top", [(1, 1.0, 2000), (8, 0.4, 2000), (100_000, 0.4, 7), (1, 1000.0, 2000)])
def test_query_rows(spark, monkeypatch, sample, lowered, top):
    monkeypatch.setattr(P, "TOGETHER", 500)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = P.collocations(df, min_count=20, top=top, sample=sample, lowered=lowered)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, top)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.createDataFrame([("en", 0, "", big * 1000), ("en", 1, "x", big), ("en", 1, "y", big), ("en", 2, "x y", big - 1)],
                                  "lang string, words int, phrase string, n long")
    row = P.scored(found).collect()[0]
    assert row.score == 1000 * (big - 1) * (big * 1000) // (big * big) and row.a == big - 1


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    import numpy as np
    at = np.array([1, 2, 0, 3, 4, 0, 1, 2, 0])
    first, n = P._same(at, np.array([0, 3, 6]), 2, np.array([7, 7, 7], dtype=np.uint64))
    assert sorted(zip(first.tolist(), n.tolist())) == [(0, 2), (3, 1)]


def test_full_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "MAP_BITS", 8)  # nearly all bits are set
    rows = corpus(120)
    got = P.collocations(spark.createDataFrame(rows, SCHEMA), min_count=10, sample=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 2000)


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def plan_nodes(df):
    """Nodes of the plan that was run."""
    def walk(node):
        yield node
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    df.collect()
    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_counted_hashes_are_short(spark):
    n = 300_000
    text = " ".join(f"w{i}" for i in range(n))
    got = P.hash_counts(spark.createDataFrame([("en", text)], "lang string, text string").coalesce(1), only=1)
    written = [m.get().value() for node in plan_nodes(got) if (m := node.metrics().get("shuffleBytesWritten")).isDefined()]
    assert got.count() == n and 0 < sum(written) < 7 * n  # a row for each of them takes over 11 bytes


def test_packed_hashes_come_back():
    import numpy as np
    for h in ([0], [2**40 - 1], [0, 1, 2**28 - 1, 2**28, 2**40 - 1], list(range(0, 2**40, 2**24 + 1))):
        h, n = np.array(h, dtype=np.uint64), np.arange(1, len(h) + 1) ** 3
        back = [P._unpacked(*row) for row in P._packed(h, n)]
        assert (np.concatenate([x for x, _ in back]) == h).all() and (np.concatenate([x for _, x in back]) == n).all()


def test_only_phrases_that_reach_the_threshold_travel_as_text(spark):
    rows = [("en", "a b c")] * 5 + [("en", f"x{i} y{i}") for i in range(50)] + [("de", "a b")]
    df = spark.createDataFrame(rows, "lang string, text string")
    all_of_them = P.proposals(P.hash_counts(df))
    often = P.proposals(P.hash_counts(df, all_of_them, least=5))
    got = sorted(map(tuple, P.phrase_counts(df, all_of_them, often).collect()))  # without a threshold: all that was sent
    assert got == sorted([("en", 0, "", 115), ("de", 0, "", 2), *[("en", len(p.split()), p, 5) for p in ("a", "b", "c", "a b", "b c", "a b c")]])


def test_words_and_rows_that_a_task_lets_go(spark, monkeypatch):
    monkeypatch.setattr(P, "TOGETHER", 50)
    monkeypatch.setattr(P, "REMEMBERED", 20)
    rows = corpus(120)
    got = P.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(1), min_count=10, sample=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 2000)


def test_totals_are_not_dealt_by_language(spark):
    found = spark.createDataFrame([("en", 0, "", 9), ("en", 1, "x", 3), ("en", 1, "y", 3), ("en", 2, "x y", 3)], "lang string, words int, phrase string, n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = [x.nodeName() for x in plan_nodes(P.scored(found))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert names.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in names
