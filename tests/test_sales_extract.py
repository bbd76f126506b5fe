"""Joins of the sales extract on hand-made rows: unmatched lines fall out, a missing surcharge does not."""
import datetime as dt
from decimal import Decimal as D

from shelfspark.plans import extracts

DAY = dt.date(2024, 5, 1)


def test_joins_and_net_cost(spark):
    lines = spark.createDataFrame(
        [(1, 1, 800, 10, 10, D(3), D(0), None), (1, 1, 800, 11, 10, D(2), D(0), D("1.10")), (1, 1, 800, 12, 12, D(1), D(0), None),
         (2, 1, 800, 10, 10, D(1), D(0), None), (1, 2, 800, 10, 10, D(1), D(0), None), (1, 1, 999, 10, 10, D(1), D(0), None),
         (1, 1, 202, 11, 11, D(0), D(1), None)],
        "nroempresa int, nrodivisao int, codgeraloper int, seqproduto int, seqprodutocusto int, qtditem decimal(18,3), "
        "qtddevolitem decimal(18,3), acresccustorelac decimal(6,4)")
    lines = lines.selectExpr("*", f"DATE '{DAY}' AS dtavda", "cast(6 as decimal(18,3)) AS qtdembalitem",
                             "cast(0 as decimal(18,2)) AS vlrdescacordoverbapdv", "'N' AS acmcompravenda")
    # the cost of product 10 is that of store 7, which store 1 takes its costs from; product 12 has none on the day
    costs = spark.createDataFrame([(10, 7, DAY, D(10)), (11, 7, DAY, D(20)), (10, 1, DAY, D(99)), (12, 7, DAY - dt.timedelta(1), D(5))],
                                  "seqproduto int, nroempresa int, dtaentradasaida date, cmdiavlrnf decimal(18,4)")
    zeros = ("cmdiaipi", "cmdiacredicms", "cmdiacredpis", "cmdiacredcofins", "cmdiacredipi", "cmdiaicmsst", "cmdiadespnf", "cmdiadespforanf",
             "cmdiadctoforanf")
    costs = costs.selectExpr("*", *[f"cast(0 as decimal(18,4)) AS {z}" for z in zeros], "cast(0 as decimal(18,3)) AS qtdverbavda",
                             "cast(0 as decimal(18,2)) AS vlrverbavda", "cast(1 as decimal(18,3)) AS qtdvda", "cast(0 as decimal(18,2)) AS vlrverbavdaacr")
    products = spark.createDataFrame([(10, 1, 5, None, None), (11, 1, None, 5, D("0.5")), (12, 1, None, None, None)],
                                     "seqproduto int, seqfamilia int, seqprodutobase int, seqprodutobaseantigo int, propqtdprodutobase decimal(9,4)")
    divisions_of = spark.createDataFrame([(1, 1)], "seqfamilia int, nrodivisao int")
    packs = spark.createDataFrame([(1, 1), (1, 6)], "seqfamilia int, qtdembalagem int")
    stores = spark.createDataFrame([(1, 7, 1)], "nroempresa int, nroempcustoabc int, nrodivisao int")
    divisions = spark.createDataFrame([(1, "S")], "nrodivisao int, utilacresccustprodrelac string")
    surcharges = spark.createDataFrame([(10, DAY, D("1.02")), (11, DAY - dt.timedelta(1), D(3))],
                                       "seqproduto int, dtamovimentacao date, percacresccustorelacvig decimal(6,4)")
    joined = extracts.sales_lines(lines, costs, products, divisions_of, packs, stores, divisions, surcharges)
    got = {r.produto_id: (r.vlrctoliqvda, r.qtd_liquida) for r in extracts.sales_net_cost(joined).collect()}
    # product 10: 3 x 10 x 1.02; product 11: 2 x 10 x 1.10 x 0.5 sold, 1 x 20 x 0.5 returned
    assert got == {10: (D("30.60"), D(3)), 11: (D("1.00"), D(1))}
    assert joined.count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sums_per_product_move_the_joined_lines_no_further(spark):
    from shelfspark import catalog
    for name in ("sales_net_cost", "hourly_sales_preagg"):
        top = _plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001")).split("HashAggregate(keys=[")
        # the final and the partial sum follow each other without an exchange
        assert "Exchange" not in top[1]


def test_catalogue_tables_of_sales_stay_off_the_driver(spark):
    from shelfspark import session
    session.apply_conf(spark)
    n = 200_000  # a few MB each, but ten times that as tables of the driver
    products = spark.range(n).selectExpr("CAST(id AS INT) AS seqproduto", "CAST(id AS INT) AS seqfamilia", "CAST(1 AS DECIMAL(9,4)) AS propqtdprodutobase",
                                         "CAST(id AS INT) AS seqprodutobase", "CAST(id AS INT) AS seqprodutobaseantigo")
    of_family = lambda col: spark.range(n).selectExpr("CAST(id AS INT) AS seqfamilia", col)
    costs = spark.range(n).selectExpr("CAST(id AS INT) AS seqproduto", "7 AS nroempresa", f"DATE '{DAY}' AS dtaentradasaida", "id AS cmdiavlrnf")
    surcharges = spark.range(n).selectExpr("CAST(id AS INT) AS seqproduto", f"DATE '{DAY}' AS dtamovimentacao", "id AS percacresccustorelacvig")
    stores = spark.createDataFrame([(1, 7, 1), (2, 7, None)], "nroempresa int, nroempcustoabc int, nrodivisao int")
    divisions = spark.createDataFrame([(1, "S")], "nrodivisao int, utilacresccustprodrelac string")
    lines = spark.createDataFrame([(1, 1, 800, 10, 11), (2, 1, 800, 10, 11), (1, 1, 800, 10, n)],
                                  "nroempresa int, nrodivisao int, codgeraloper int, seqproduto int, seqprodutocusto int")
    joined = extracts.sales_lines(lines.selectExpr("*", f"DATE '{DAY}' AS dtavda"), costs, products, of_family("1 AS nrodivisao"),
                                  of_family("1 AS qtdembalagem"), stores, divisions, surcharges)
    tables = _plan(joined).split("BroadcastExchange")[1:]  # what each holds, down to its first shuffle
    assert tables and not any("Range (0, 200000" in t.split("Exchange hashpartitioning")[0] for t in tables)
    assert [(r.seqproduto, r.cmdiavlrnf, r.percacresccustorelacvig) for r in joined.collect()] == [(10, 11, 10)]
    session.apply_conf(spark)
