import os
import tempfile

from pyspark.sql import functions as F

from shelfspark.operators import publish
from shelfspark.operators.incremental import delete_insert, load_delete_insert, read_table, upsert

SCHEMA = "k int, m int, v string"


def _rows(df, cols=("k", "m", "v")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_delete_insert_semantics(spark):
    target = spark.createDataFrame([(1, 1, "old"), (2, 1, "keep"), (None, 1, "nullkey")], SCHEMA)
    batch = spark.createDataFrame([(1, 1, "new"), (1, 1, "dup"), (None, 1, "nullbatch")], SCHEMA)
    out = delete_insert(target, batch, ["k", "m"])
    # re-sent key replaced, absent key kept, NULL key never matches, batch duplicates stay
    assert _rows(out) == sorted([(1, 1, "new"), (1, 1, "dup"), (2, 1, "keep"), (None, 1, "nullkey"),
                                 (None, 1, "nullbatch")], key=repr)


def test_delete_insert_schema_evolution(spark):
    target = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    extra = spark.createDataFrame([(2, 1, "b", 9)], SCHEMA + ", novo int")
    out = delete_insert(target, extra, ["k"])
    assert set(out.columns) == {"k", "m", "v", "novo"}
    assert sorted((r.k, r.novo) for r in out.collect()) == [(1, None), (2, 9)]
    missing = spark.createDataFrame([(3, 1)], "k int, m int")
    out2 = delete_insert(target, missing, ["k"])
    assert sorted((r.k, r.v) for r in out2.collect()) == [(1, "a"), (3, None)]


def test_upsert_last_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    rows = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], "k int, v string, seq int")
    out = upsert(target, rows, ["k"], [F.col("seq").desc()]).select("k", "v")
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b2"), (3, "c")]


def test_load_delete_insert_on_disk(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-inc-"), "fact")
    first = spark.createDataFrame([(1, 202401, "a"), (2, 202401, "b"), (3, 202402, "c")], SCHEMA)
    load_delete_insert(spark, path, first, ["k"], "m")
    # key 1 moves to another month, key 3 corrected in place, key 4 new
    batch = spark.createDataFrame([(1, 202403, "a2"), (3, 202402, "c2"), (4, 202403, "d")], SCHEMA)
    load_delete_insert(spark, path, batch, ["k"], "m")
    expected = [(1, 202403, "a2"), (2, 202401, "b"), (3, 202402, "c2"), (4, 202403, "d")]
    assert _rows(read_table(spark, path)) == sorted(expected, key=repr)
    load_delete_insert(spark, path, batch, ["k"], "m")  # replay: same table
    assert _rows(read_table(spark, path)) == sorted(expected, key=repr)
    # a month whose only row moves away disappears
    load_delete_insert(spark, path, spark.createDataFrame([(2, 202402, "b2")], SCHEMA), ["k"], "m")
    assert _rows(read_table(spark, path)) == sorted([(1, 202403, "a2"), (2, 202402, "b2"), (3, 202402, "c2"),
                                                     (4, 202403, "d")], key=repr)
    assert not any("/m=202401/" in f for f in publish.newest(spark, path).files)


def test_null_month_is_a_partition_like_any_other(spark):
    first = [(1, 202401, "a"), (2, None, "old"), (3, None, "keep")]
    for batch, want in (([(2, 202401, "new"), (4, None, "n")], [(1, 202401, "a"), (2, 202401, "new"), (3, None, "keep"), (4, None, "n")]),
                        ([(2, 202401, "new")], [(1, 202401, "a"), (2, 202401, "new"), (3, None, "keep")]),
                        ([(2, 202401, "x"), (3, 202402, "y")], [(1, 202401, "a"), (2, 202401, "x"), (3, 202402, "y")])):
        path = os.path.join(tempfile.mkdtemp(prefix="shelf-null-"), "fact")
        load_delete_insert(spark, path, spark.createDataFrame(first, SCHEMA), ["k"], "m")
        for _ in range(2):  # applied again: the same table, but for the rows whose key never matches
            load_delete_insert(spark, path, spark.createDataFrame(batch, SCHEMA), ["k"], "m")
            assert _rows(read_table(spark, path)) == sorted(want, key=repr)
        assert any("/m=__HIVE_DEFAULT_PARTITION__/" in f for f in publish.newest(spark, path).files) == any(m is None for _, m, _ in want)


def test_stream_keeps_rows_whose_key_has_a_null_part(spark):
    from shelfspark.streaming.hot import latest_run_per_key
    rows = spark.createDataFrame([(1, 1, "old", 1), (1, 1, "new", 2), (None, 1, "n1", 1), (None, 1, "n2", 2)],
                                 "a int, b int, v string, lote int")
    assert sorted(r.v for r in latest_run_per_key(rows, ["a", "b"]).collect()) == ["n1", "n2", "new"]


def test_since_batch_start_only_on_later_loads(spark):
    import datetime as dt
    from shelfspark.operators.incremental import since_batch_start
    stg = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1)), (3, None)], "k int, d date")
    raw = spark.createDataFrame([(dt.date(2024, 1, 15),), (dt.date(2024, 3, 1),)], "rd date")
    assert since_batch_start(stg, raw, "d", F.col("rd"), first_load=True).count() == 3
    later = since_batch_start(stg, raw, "d", F.col("rd"), first_load=False)
    assert [r.k for r in later.collect()] == [2]          # NULL dates are dropped on later loads


def test_rows_without_a_month_are_spread_over_write_tasks(spark):
    from shelfspark.operators.incremental import laid_out
    rows = spark.range(4000).selectExpr("cast(null as int) AS k", "cast(null as int) AS m", "cast(id as string) AS v")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for n in laid_out(rows, "m", ["k"]).rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert sum(sizes) == 4000 and max(sizes) < 2000
