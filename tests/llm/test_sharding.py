"""Feistel sharding: a permutation, its inverse, the rows law, reproducibility."""
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfspark.llm.sharding import Feistel, shard

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
@pytest.mark.parametrize("key", [0, 1, 12345])
def test_permutation_and_inverse(n, key):
    f = Feistel(n, key)
    y = f.forward(np.arange(n, dtype=np.uint64))
    assert sorted(y.tolist()) == list(range(n))
    assert f.inverse(y).tolist() == list(range(n))


def test_keys_give_different_orders():
    x = np.arange(1000, dtype=np.uint64)
    assert (Feistel(1000, 1).forward(x) != Feistel(1000, 2).forward(x)).mean() > 0.9


def test_rows_law_and_columns(spark):
    texts = [None, "", "é\U0001F600", "x" * 50_000] + ["same"] * 300
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, "x" * 50_000, 1), (None, "n", 1), (None, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA + ", shard int")
    got = shard(df, 24).collect()
    assert len(got) == len(rows)
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sizes == want
    per = Counter(r.shard for r in got)
    assert set(per) <= set(range(24)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.row_number)]
    assert ids[-2:] == [None, None] and ids[:-2] == sorted(ids[:-2])
    p = Feistel(len(rows)).forward(np.array([r.row_number for r in got], dtype=np.uint64))
    assert [(int(x) % 24, int(x) // 24) for x in p] == [(r.shard, r.slot) for r in got]


def test_same_result_at_any_partitioning(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(500)], SCHEMA)
    a = {tuple(r) for r in shard(df.repartition(7)).collect()}
    assert a == {tuple(r) for r in shard(df.coalesce(1)).collect()}


def test_empty_table(spark):
    assert shard(spark.createDataFrame([], SCHEMA)).count() == 0
