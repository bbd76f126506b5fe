import random
from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.operators.running_total import ranged_lag, running_sum


def test_ranged_prefix_sum_equals_window(spark):
    rnd = random.Random(7)
    rows = [(i, D(rnd.randint(-50, 500)) / 10) for i in range(3000)]  # many ties in value
    df = spark.createDataFrame(rows, "id int, v decimal(18,1)").checkpoint()
    order = [F.col("v").desc(), F.col("id").asc()]
    expect = df.withColumn("c", F.sum("v").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    expect = expect.withColumn("t", F.sum("v").over(Window.partitionBy()))
    for got in (running_sum(df, [], order, "v", "c", "t", partitions=7),
                running_sum(df, [], order, "v", "c", "t")):
        a = {r.id: (r.c, r.t) for r in got.collect()}
        b = {r.id: (r.c, r.t) for r in expect.collect()}
        assert a == b


def test_ranged_prefix_sum_with_groups_equals_window(spark):
    rnd = random.Random(11)
    # one hot group holding most rows, many small ones, ties inside groups
    rows = [(i, 0 if i < 2000 else None if i < 2600 else rnd.randint(1, 60), D(rnd.randint(-20, 300)) / 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, g int, v decimal(18,1)").checkpoint()
    order = [F.col("v").desc(), F.col("id").asc()]
    w = Window.partitionBy("g").orderBy(*order)
    expect = (df.withColumn("c", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("t", F.sum("v").over(Window.partitionBy("g"))))
    b = {r.id: (r.c, r.t) for r in expect.collect()}
    for got in (running_sum(df, ["g"], order, "v", "c", "t", partitions=9),
                running_sum(df, ["g"], order, "v", "c", "t")):
        assert {r.id: (r.c, r.t) for r in got.collect()} == b


def test_ranged_lag_equals_window_with_null_group(spark):
    rnd = random.Random(3)
    rows = [(i, None if i % 3 else rnd.randint(1, 5), rnd.randint(0, 99)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, g int, v int").checkpoint()
    expect = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("id")))
    got = ranged_lag(df, ["g"], "id", "v", "p", partitions=7)
    assert {r.id: r.p for r in got.collect()} == {r.id: r.p for r in expect.collect()}
