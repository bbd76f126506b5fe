"""Declared expectations on small tables: NULLs, keys, lists of values, absent columns, empty tables."""
from shelfspark.plans.quality import Expectation, violations


def _run(df, *expectations):
    return {(r.teste, r.colunas): r.violacoes for r in violations(df, expectations).collect()}


ALL = (Expectation("t", "not_null", ("a",)), Expectation("t", "accepted_values", ("s",), ("X", "Y")),
       Expectation("t", "unique", ("a",)), Expectation("t", "unique", ("a", "s")))


def test_counts_per_expectation(spark):
    df = spark.createDataFrame([(1, "X"), (1, "Z"), (None, "Y"), (None, "Y"), (2, None)], "a int, s string")
    got = _run(df, *ALL)
    # one repeated id (NULL ids are not compared); in the grain of two columns (NULL, Y) occurs twice; NULL passes a list
    assert got == {("not_null", "a"): 2, ("accepted_values", "s"): 1, ("unique", "a"): 1, ("unique", "a,s"): 1}


def test_empty_table_passes(spark):
    assert set(_run(spark.createDataFrame([], "a int, s string"), *ALL).values()) == {0}


def test_absent_column_is_reported(spark):
    df = spark.createDataFrame([(1,)], "A int")
    got = _run(df, Expectation("t", "not_null", ("a",)), Expectation("t", "not_null", ("b",)))
    assert got == {("not_null", "a"): 0, ("not_null (absent)", "b"): 1}


def test_one_scan_for_all_column_expectations(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "X", 2.0)], "a int, s string, z double").write.parquet(path)
    plan = violations(spark.read.parquet(path), ALL[:2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "z" not in plan.split("ReadSchema: ")[1].split(">")[0]
