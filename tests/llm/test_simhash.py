"""SimHash near-duplicates against brute force: fingerprints, links, components."""
import itertools
import random

import pytest
import xxhash

from shelfspark.llm import simhash

SCHEMA = "doc_id long, text string"


def fingerprint(text, words=3):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    tokens = [w for w in t.split(" ") if w]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def smallest(ids, roots):
    out = {}
    for i, r in zip(ids, roots):
        if i is not None:
            out[r] = min(i, out.get(r, i))
    return [out.get(r) for r in roots]


TEXTS = [None, "", " \t\n", "one", "one two", "One TWO three", "one two three", "ÉÀ été Ünï code", "a\x0bb\x0cc d",
         "a b c d " * 3000, "nbsp stays in a word", "\U0001F600 x y z"]


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(12)]
    texts = list(TEXTS)
    for b in base:
        for _ in range(5):
            t = b.split()
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, texts[-1]), (None, "alone and unnamed here")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", fp int")
    found = simhash.near_duplicates(df, hot=3).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    fps = [fingerprint(t) for _, t in rows]
    want = zip([i for i, _ in rows], [f"{f:016x}" for f in fps], smallest([i for i, _ in rows], components(fps, 3)))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_links_keep_the_components_of_all_pairs(spark, bits, hot):
    rng = random.Random(bits)
    fps = set()
    for _ in range(6):  # dense groups, in which half values crowd
        c = rng.getrandbits(64)
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randrange(4)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, bits, hot)
    for a, b in edges.collect():
        assert a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= bits
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    roots = components(fps, bits)
    group = {}
    for f, r in zip(signed, roots):
        group.setdefault(r, []).append(f)
    want = {f: min(g) for g in group.values() if len(g) > 1 for f in g}
    assert found == want


def test_long_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(200)]
    found = simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert len(found) == 201 and {r.root for r in found} == {0}


def test_keep_one_keeps_a_row_of_every_group(spark):
    rows = [(5, "x y z", "a"), (2, "x y z", "b"), (2, "x y z", "b"), (None, "lonely one here", "c"), (None, "other text entirely", "d"),
            (9, None, "e"), (8, "", "f"), (2, "a different text with the same id", "g")]
    df = spark.createDataFrame(rows, SCHEMA + ", component_id string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(2, "x y z", "b"), (None, "lonely one here", "c"), (None, "other text entirely", "d"), (8, "", "f"),
         (2, "a different text with the same id", "g")], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0
