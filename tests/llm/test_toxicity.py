"""Toxicity: exact neighbours, calibration on held-out rows, edge cases."""
import random
import zlib

import numpy as np
import pytest

from shelfspark.llm import toxicity as T

DOCS, LABELS = "doc_id long, text string, toxicity string", "doc_id long, toxic int"


@pytest.mark.parametrize("dense", [0, 20, 2048])
def test_block_max_search_is_exact(monkeypatch, dense):
    rng = random.Random(2)
    vocabulary = {f"w:{i}": i for i in range(80)}
    idf = [1 + rng.random() * 4 for _ in vocabulary]
    rows = [{rng.randrange(80): rng.randrange(1, 4) for _ in range(rng.randrange(0, 12))} for _ in range(700)]
    monkeypatch.setattr(T, "DENSE", dense)
    index = T.Index(vocabulary, idf, rows, [rng.random() < 0.3 for _ in rows], list(range(700)), block=16)
    assert len(index.dense) == min(dense, (np.bincount([t for r in rows for t in r], minlength=80) > 16).sum())
    full_rows = np.zeros((700, 80))
    for at, i in enumerate(index.ids.tolist()):
        t, w = index._unit(rows[i])
        full_rows[at, t] = w
    for _ in range(200):
        q = {rng.randrange(80): rng.randrange(1, 3) for _ in range(rng.randrange(0, 10))}
        near, where = index.query(q, 15)
        t, w = index._unit(q)
        full = full_rows[:, t] @ w if len(t) else np.zeros(700)
        best = np.sort(full[full > 0])[::-1][:15]
        assert np.allclose(near, best) and np.allclose(full[where], near)


def corpus(n=700):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    bad = ["vileword", "nastyword", "awfulword", "horridword"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        t = [rng.choice(words) for _ in range(rng.randrange(10, 60))] + (rng.sample(bad, 2) if toxic else [])
        rng.shuffle(t)
        docs.append((i, " ".join(t), "x"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_scores_of_held_out_rows(spark):
    docs, labels = corpus()
    extra = [(9000, None, "x"), (9001, "", "x"), (None, "vileword nastyword", "x"), (5, docs[5][1], "x"), (9002, "word1 " * 40_000, "x")]
    truth = dict(labels)
    noisy = labels + [(None, 1), (3, None), (labels[0][0], labels[0][1])]
    df = spark.createDataFrame(docs + extra, DOCS)
    scorer = T.fit(df.drop("toxicity"), spark.createDataFrame(noisy, LABELS))
    got = T.scored(df.drop("toxicity"), scorer).select("doc_id", "text", "toxicity.score", "toxicity.evidence").collect()
    assert len(got) == len(docs) + len(extra) and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum((r.score >= T.THRESHOLD) == bool(truth[r.doc_id]) for r in unseen)
    assert len(unseen) > 100 and right / len(unseen) > 0.97
    for r in got:  # evidence never names a held-out row
        assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in r.evidence)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text, r.score) == r.score
    assert T.scored(df, scorer).columns == df.columns  # a column of that name is replaced
    kept = T.acceptable(df, spark.createDataFrame(noisy, LABELS))
    assert kept.columns == df.columns
    low = sorted(((r.doc_id, r.text) for r in got if r.score < T.THRESHOLD), key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == low


def test_labels_of_one_kind_or_none(spark):
    docs, _ = corpus(30)
    df = spark.createDataFrame(docs, DOCS).drop("toxicity")
    for labels in ([], [(i, 0) for i in range(30)]):
        scorer = T.fit(df, spark.createDataFrame(labels, LABELS))
        scores = {r.toxicity.score for r in T.scored(df, scorer).collect()}
        assert len(scores) == 1 and 0 < scores.pop() <= 0.5


def test_empty_table(spark):
    docs, labels = corpus(50)
    none = spark.createDataFrame([], DOCS)
    assert T.acceptable(none, spark.createDataFrame(labels, LABELS)).count() == 0


def test_every_term_counts(spark):
    """Neighbours are those of the cosine over all terms, rare and unseen ones too."""
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    docs = [(i, " ".join([f"only{i}x"] + [rng.choice(words) for _ in range(20)] + (["vileword"] if i % 3 == 0 else []))) for i in range(400)]
    labels = [(i, int(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    scorer = T.fit(df, spark.createDataFrame(labels, LABELS))
    texts, examples = dict(docs), scorer.index.ids.tolist()
    assert set(scorer.index.vocabulary) == {t for i in examples for t in T.terms(texts[i])}  # no term is left out
    held, n = {}, len(examples)
    for i in examples:
        for t in T.terms(texts[i]):
            held.setdefault(t, []).append(i % 3 == 0)
    pos = sum(i % 3 == 0 for i in examples)

    def weight(t):
        a, m = sum(held.get(t, [])), len(held.get(t, []))
        chi = n * (a * (n - pos) - (m - a) * pos)**2 / (m * (n - m) * pos * (n - pos)) if 0 < m < n else 0
        return (np.log((1 + n) / (1 + m)) + 1) * (1 + chi)

    weights = {t: weight(t) for i in range(400) for t in T.terms(texts[i])}

    def vector(text):
        v = {t: (1 + np.log(c)) * weights.get(t, np.log(1 + n) + 1) for t, c in T.terms(text).items()}
        length = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: vector(texts[i]) for i in examples}
    for text in [texts[i] for i in range(60)] + ["word1 neverseen", f"only{examples[0]}x", "neverseen"]:
        q = vector(text)
        full = sorted((s for s in (sum(x * v.get(t, 0) for t, x in q.items()) for v in vectors.values()) if s > 0), reverse=True)
        _, near, _ = scorer.features(text)
        assert np.allclose(near, full[:T.NEIGHBOURS])
    assert scorer.score(f"only{examples[0]}x")[2][0] == examples[0]
