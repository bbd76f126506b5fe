"""Commit records: a writer that stops anywhere leaves the old table or the new one, whole."""
import os
import tempfile

import pytest

from shelfspark.operators import publish
from shelfspark.operators.incremental import existing_table, load_delete_insert, read_table

SCHEMA = "k int, m int, v string"


class Stopped(Exception):
    pass


def table(spark, rows):
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-pub-"), "fact")
    load_delete_insert(spark, path, spark.createDataFrame(rows, SCHEMA), ["k"], "m", sort_cols=("k",))
    return path


def rows(spark, path):
    return sorted(map(tuple, read_table(spark, path).collect()), key=repr)


OLD = [(1, 202401, "a"), (2, 202401, "b"), (3, 202402, "c")]
BATCH = [(1, 202403, "a2"), (3, 202402, "c2")]
NEW = [(1, 202403, "a2"), (2, 202401, "b"), (3, 202402, "c2")]


@pytest.mark.parametrize("step", ["write_files", "commit", "half record", "after"])
def test_a_stopped_merge_leaves_a_whole_table(spark, monkeypatch, step):
    path = table(spark, OLD)
    whole, taken = publish.commit, []

    def stop_before(*a, **b):
        raise Stopped

    def stop_after(*a, **b):
        taken.append(whole(*a, **b))
        raise Stopped

    def half(spark, path, base, *a, **b):
        with open(f"{path}/_commits/{base.number + 1:010d}.json", "w") as f:
            f.write('{"files": ["load=v')
        raise Stopped

    name = "write_files" if step == "write_files" else "commit"
    with monkeypatch.context() as m:
        m.setattr(publish, name, {"after": stop_after, "half record": half}.get(step, stop_before))
        with pytest.raises(Stopped):
            load_delete_insert(spark, path, spark.createDataFrame(BATCH, SCHEMA), ["k"], "m")
    assert rows(spark, path) == sorted(NEW if step == "after" else OLD, key=repr)
    load_delete_insert(spark, path, spark.createDataFrame(BATCH, SCHEMA), ["k"], "m")  # the retry
    assert rows(spark, path) == sorted(NEW, key=repr)


def test_overwrite_may_read_the_table_and_is_never_seen_half(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-pub-"), "adjust")
    assert existing_table(spark, path) is None
    with monkeypatch.context() as m:
        m.setattr(publish, "commit", lambda *a, **b: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            publish.overwrite(spark.createDataFrame(OLD, SCHEMA), path)
    assert existing_table(spark, path) is None  # a first write that stopped is no table
    publish.overwrite(spark.createDataFrame(OLD, SCHEMA), path)
    publish.overwrite(read_table(spark, path).where("k > 1"), path)
    assert rows(spark, path) == OLD[1:]
    publish.overwrite(read_table(spark, path).limit(0), path)
    assert rows(spark, path) == [] and read_table(spark, path).columns == ["k", "m", "v"]


def test_only_files_with_a_key_are_rewritten(spark):
    path = table(spark, [(k, 202401 + k % 3, "x") for k in range(300)])
    load_delete_insert(spark, path, spark.createDataFrame([(1000 + k, 202401, "y") for k in range(5)], SCHEMA), ["k"], "m")
    before = set(publish.newest(spark, path).files)
    load_delete_insert(spark, path, spark.createDataFrame([(7, 202409, "z")], SCHEMA), ["k"], "m")  # a key that moves month
    after = set(publish.newest(spark, path).files)
    holding = {r[0].rsplit("/load=", 1)[1] for r in publish.scan(spark, path, publish._record(spark, path, 2)).where("k = 7")
               .selectExpr("_metadata.file_path").collect()}
    assert {f.removeprefix("load=") for f in before - after} == holding and len(holding) == 1
    assert len(rows(spark, path)) == 305 and (7, 202409, "z") in rows(spark, path)


def test_second_writer_is_refused_and_vacuum_keeps_what_is_listed(spark):
    path = table(spark, OLD)
    base = publish.newest(spark, path)
    files = publish.write_files(spark.createDataFrame(BATCH, SCHEMA), path, "m")
    publish.commit(spark, path, base, files, base.schema)
    with pytest.raises(publish.CommitRefused):
        publish.commit(spark, path, base, base.files, base.schema)
    assert rows(spark, path) == sorted(BATCH, key=repr)
    assert publish.vacuum(spark, path, keep=2) == []
    assert publish.vacuum(spark, path, keep=1) == sorted(base.files)
    assert rows(spark, path) == sorted(BATCH, key=repr)


def test_new_columns_and_replayed_batches(spark):
    from shelfspark.streaming import hot
    path = table(spark, OLD)
    load_delete_insert(spark, path, spark.createDataFrame([(9, 202401, "n", 5)], SCHEMA + ", extra int"), ["k"], "m", batches={"s": 3})
    got = {r.k: r.extra for r in read_table(spark, path).collect()}
    assert got == {1: None, 2: None, 3: None, 9: 5}
    number = publish.newest(spark, path).number
    apply = hot.merge_runs(path, lambda b: b, ["k"], "s")
    apply(spark.createDataFrame([(9, 202401, "replayed", 1)], SCHEMA + ", lote int"), 3)
    assert publish.newest(spark, path).number == number  # recognised: nothing written


DATED = "d date, m int, v string"


def dated(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(d and dt.date.fromisoformat(d), m, v) for d, m, v in rows], DATED)


def test_a_backfill_replaces_exactly_its_range(spark):
    import datetime as dt

    from shelfspark.operators.incremental import load_range
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-pub-"), "lines")
    day = dt.date
    publish.overwrite(dated(spark, [("2024-01-31", 202401, "a"), ("2024-02-01", 202402, "b"), ("2024-02-02", 202402, "gone"),
                                    ("2024-02-03", 202402, "c"), (None, None, "undated")]).repartition("m"), path, "m")
    before = publish.newest(spark, path)
    fresh = dated(spark, [("2024-02-01", 202402, "b2"), ("2024-02-01", 202402, "b2")])  # repeated lines stay repeated
    for _ in range(2):
        load_range(spark, path, fresh, "d", day(2024, 2, 1), day(2024, 2, 2), "m")
        found = sorted(((str(r.d), r.v) for r in read_table(spark, path).collect()))
        assert found == [("2024-01-31", "a"), ("2024-02-01", "b2"), ("2024-02-01", "b2"), ("2024-02-03", "c"), ("None", "undated")]
    after = publish.newest(spark, path)
    untouched = {f for f in before.files if "m=202402" not in f}
    assert untouched and untouched <= set(after.files)  # files without a row of the range keep their names
    load_range(spark, path, dated(spark, []), "d", day(2024, 2, 1), day(2024, 2, 2), "m")  # the source has none any more
    assert sorted(r.v for r in read_table(spark, path).collect()) == ["a", "c", "undated"]


@pytest.mark.parametrize("stray", ["2024-02-03", None])
def test_a_backfill_row_outside_the_range_is_refused(spark, stray):
    import datetime as dt

    from shelfspark.operators.incremental import load_range
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-pub-"), "lines")
    publish.overwrite(dated(spark, [("2024-02-01", 202402, "a")]), path, "m")
    with pytest.raises(ValueError):
        load_range(spark, path, dated(spark, [(stray, 202402, "x")]), "d", dt.date(2024, 2, 1), dt.date(2024, 2, 2), "m")
    assert [r.v for r in read_table(spark, path).collect()] == ["a"]


def test_a_backfill_stopped_before_its_record_changes_nothing(spark, monkeypatch):
    import datetime as dt

    from shelfspark.operators.incremental import load_range
    path = os.path.join(tempfile.mkdtemp(prefix="shelf-pub-"), "lines")
    publish.overwrite(dated(spark, [("2024-02-01", 202402, "a")]), path, "m")

    def stop(*a, **b):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(publish, "commit", stop)
        with pytest.raises(Stopped):
            load_range(spark, path, dated(spark, [("2024-02-01", 202402, "x")]), "d", dt.date(2024, 2, 1), dt.date(2024, 2, 2), "m")
    assert [r.v for r in read_table(spark, path).collect()] == ["a"]
