"""Exact dedup: the directory, chains, hot texts and results against brute force."""
import hashlib
import random
import re

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from shelfspark.llm import exact_dedup
from shelfspark.llm.exact_dedup import Directory, normalise

SCHEMA = "doc_id long, text string"


def plain(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@given(st.text(alphabet=st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85 aé"), max_size=12))
def test_normalise(t):
    assert normalise(t) == plain(t).encode()


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(body.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), first and i == keep, sha))
            first = False
    return sorted(out, key=str)


def rows():
    rng = random.Random(3)
    texts = [f"text  number {i}\n" + "word " * rng.randrange(40) for i in range(60)]
    found = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "\t", "  "]))) for i in range(200)]
    found += [(1000 + i, "the hot text") for i in range(150)]
    found += [(7, "twice"), (7, "twice"), (None, "twice"), (None, "no id"), (None, "no id"), (900, None), (901, ""), (902, " "),
              (903, "\n\t"), (904, "long " * 60_000), (905, "long\t" * 60_000)]
    rng.shuffle(found)
    return found


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA + ", keep_id string").repartition(5)
    assert sorted(map(tuple, exact_dedup.duplicates(df).collect()), key=str) == want(data)


def test_small_buckets_split_and_hot_ones_are_shared(spark, monkeypatch):
    data = rows()
    monkeypatch.setattr(exact_dedup, "FOLD_BYTES", 300)  # many entries of the hot text
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert sorted(map(tuple, exact_dedup.duplicates(df, bucket_bytes=64).collect()), key=str) == want(data)


def test_colliding_keys_are_chained():
    entries = [(0, 5, b"a"), (1, 5, b"b"), (2, 5, b"a"), (3, 6, b"a"), (4, 6, b"a")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries), (pa.int64(), pa.int64(), pa.binary()))],
                                       ["entry", "key", "body"])
    got = [tuple(r.values()) for b in exact_dedup._own(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()]
    assert got == [(0, 0, 0, 5), (1, 1, 1, 5), (2, 0, 0, 5), (3, 3, 0, 6), (4, 3, 0, 6)]


def test_directory_splits_and_doubles():
    depth = 6
    load = {p: 10 for p in range(64)}
    load[37] = 1000  # cannot split further
    d = Directory(load, depth, 40)
    assert len(d.slots) == 1 << d.bits and d.bits == depth
    assert d.slots == sorted(d.slots)  # buckets are numbered in key order
    assert sum(d.loads) == sum(load.values())
    assert all(v <= 40 for b, v in enumerate(d.loads) if b != d.slots[37])
    one = Directory({}, 1, 40)
    assert one.bits == 0 and one.slots == [0]


def test_keep_first(spark):
    data = rows()
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], SCHEMA + ", kept long")
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    names = [(r.doc_id, plain(r.text)) for r in kept.collect()]
    least = {}
    for i, t in data:
        least[plain(t)] = min(least.get(plain(t), (True, 0)), (i is None, i or 0))
    assert sorted(names, key=str) == sorted([(None if none else i, t) for t, (none, i) in least.items()], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicates(df).count() == 0 and exact_dedup.keep_first(df).count() == 0
