from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfspark.functions.columns import abc_class, decode, half_even_int, padded, share_pct


def test_abc_thresholds_exact(spark):
    rows = [(D("80.00"), D("100.00")), (D("80.01"), D("100.00")), (D("95.00"), D("100.00")),
            (D("95.01"), D("100.00")), (D("5.00"), D("0.00")), (D("-80.00"), D("-100.00")),
            (D("-96.00"), D("-100.00")), (None, D("10.00"))]
    df = spark.createDataFrame(rows, "a decimal(18,2), t decimal(18,2)")
    got = [r[0] for r in df.select(abc_class(F.col("a"), F.col("t"))).collect()]
    assert got == ["A", "B", "B", "C", "C", "A", "C", "C"]


def test_share_pct_null_on_zero_total(spark):
    df = spark.createDataFrame([(D("1.00"), D("0.00")), (D("1.00"), D("3.00"))], "a decimal(18,2), t decimal(18,2)")
    assert [r[0] for r in df.select(share_pct(F.col("a"), F.col("t"))).collect()] == [None, 0.3333]


def test_decode_defaults(spark):
    df = spark.createDataFrame([("l",), ("M",), ("z",), (None,)], "c string")
    got = [r[0] for r in df.select(decode(F.col("c"), {"L": "LOJA", "M": "MATRIZ"})).collect()]
    assert got == ["LOJA", "MATRIZ", "Z", None]
    got = [r[0] for r in df.select(decode(F.col("c"), {"L": "LOJA"}, default="OUTRO")).collect()]
    assert got == ["LOJA", "OUTRO", "OUTRO", "OUTRO"]


def test_lpad_truncates_like_postgres(spark):
    df = spark.createDataFrame([(1234567,), (42,)], "x long")
    assert [r[0] for r in df.select(padded(F.col("x"), 6)).collect()] == ["123456", "000042"]


def test_double_to_int_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.4,)], "x double")
    assert [r[0] for r in df.select(half_even_int(F.col("x"))).collect()] == [2, 4, -2, 2]
