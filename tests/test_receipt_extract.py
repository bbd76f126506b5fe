"""Joins and costs of the receipt extract on hand-made rows; no table that grows with the catalogue is broadcast."""
import datetime as dt
from decimal import Decimal as D

import pytest

from shelfspark import session
from shelfspark.plans import extracts
from shelfspark.sources import standin

DAY = dt.date(2024, 5, 1)
CODES = "nroempresa int, seqproduto int, nrodocto long, nrodivisao int, nrosegmentoprinc int, vlritem decimal(18,2), dvlritem decimal(18,2)"


@pytest.fixture
def conf(spark):
    yield
    session.apply_conf(spark)


def _lines(spark, rows):
    lines = spark.createDataFrame(rows, CODES)
    one = {"qtditem": "1"}
    zeros = [f"CAST({one.get(d + n, '0')} AS {'DECIMAL(18,3)' if n.startswith('qtd') else 'DECIMAL(18,2)'}) AS {d + n}"
             for n in standin._NF_PARTS for d in ("", "d") if n != "vlritem"]
    return lines.selectExpr("*", f"DATE '{DAY}' AS dtaentrada", f"DATE '{DAY}' AS dtaemissao", "7 AS seqpessoa", "1 AS codgeraloper",
                            "CAST(NULL AS STRING) AS operador", "'N' AS lancamentost", "25 AS tipocalcicmsfisci", "'N' AS indsomafcpicmscusto",
                            "CAST(30 AS DECIMAL(18,2)) AS prazomediopag", "CAST(0 AS DECIMAL(18,2)) AS vlricmsstnf", *zeros)


def _masters(spark):
    products = spark.createDataFrame([(10, 1, 5, D("1.02")), (11, 1, None, None), (12, None, None, None)],
                                     "seqproduto int, seqfamilia int, seqprodutobase int, percacresccustorelacvig decimal(6,4)")
    divisions_of = spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "seqfamilia int, nrodivisao int")
    segments = spark.createDataFrame([(1, 1), (None, 1)], "seqfamilia int, nrosegmento int")
    packs = spark.createDataFrame([(1, 1, "S"), (1, 6, "S"), (1, 12, "N"), (None, 1, "S")], "seqfamilia int, qtdembalagem int, padraovenda string")
    stores = spark.createDataFrame([(1,), (2,)], "nroempresa int")
    divisions = spark.createDataFrame([(1, "S"), (2, "N")], "nrodivisao int, utilacresccustprodrelac string")
    costs = spark.createDataFrame([(10, 1, D(4), D(1)), (11, 1, D(2), None), (11, 1, D(2), None), (12, 1, D(1), None)],
                                  "seqproduto int, nroempresa int, cmultcusliquidoemp decimal(18,6), cmultdctoforanfemp decimal(18,6)")
    return products, divisions_of, segments, packs, stores, divisions, costs


def test_joins_and_costs(spark, conf):
    rows = [(1, 10, 100, 1, 1, D(50), D(10)), (1, 10, 100, 1, 1, D(30), D(0)),  # the surcharge factor counts, two packs
            (1, 10, 101, 2, 1, D(50), D(10)),    # division without the factor
            (1, 11, 102, 1, 1, D(20), D(0)),     # two cost rows of the product
            (1, 12, 103, 1, 1, D(20), D(0)),     # product without a family
            (2, 10, 104, 1, 1, D(20), D(0)),     # no costs in the store
            (3, 10, 105, 1, 1, D(20), D(0)),     # unknown store
            (1, 10, 106, 3, 1, D(20), D(0)), (1, 10, 107, 1, 2, D(20), D(0)), (1, 10, 108, None, 1, D(20), D(0))]
    out = extracts.receipt_costs(extracts.receipt_lines(_lines(spark, rows), *_masters(spark)))
    got = sorted((r.nrodocto, r.qtdembalagem, r.quantidade, r.vlrentrada, r.vlrcustobruto, r.vlrcustoliquido, r.vlrtotalnf,
                  r.custofiscaltotalentrada, r.prazomediopag) for r in out.collect())
    both = (D(2), D(70), D("71.40"), D("69.80"), D(70), D(6), 30.0)
    plain = (D(1), D(40), D(40), D(40), D(40), D(3), 30.0)
    twice = (D(2), D(40), D(40), D(40), D(40), D(4), 30.0)
    assert got == [(100, 1, *both), (100, 6, *both), (101, 1, *plain), (101, 6, *plain), (102, 1, *twice), (102, 6, *twice)]


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def _catalogue(spark, n):
    """``n`` products, each a family of its own: a few MB, but ten times that as tables of the driver."""
    ids = spark.range(n).selectExpr("CAST(id AS INT) AS seqproduto", "CAST(id AS INT) AS seqfamilia", "CAST(id AS INT) AS seqprodutobase",
                                    "CAST(1 AS DECIMAL(6,4)) AS percacresccustorelacvig", "CAST(id AS INT) AS seqprodutobaseantigo",
                                    "CAST(1 AS DECIMAL(9,4)) AS propqtdprodutobase")
    per_family = lambda *cols: spark.range(n).selectExpr("CAST(id AS INT) AS seqfamilia", *cols)
    return ids, per_family


def test_catalogue_tables_of_receipts_stay_off_the_driver(spark, conf):
    session.apply_conf(spark)
    _, _, _, _, stores, divisions, _ = _masters(spark)
    ids, per_family = _catalogue(spark, 200_000)
    costs = spark.range(200_000).selectExpr("CAST(id AS INT) AS seqproduto", "1 AS nroempresa", "CAST(4 AS DECIMAL(18,6)) AS cmultcusliquidoemp",
                                            "CAST(1 AS DECIMAL(18,6)) AS cmultdctoforanfemp")
    joined = extracts.receipt_lines(_lines(spark, [(1, 10, 100, 1, 1, D(50), D(10))]).limit(1), ids, per_family("1 AS nrodivisao"),
                                    per_family("1 AS nrosegmento"), per_family("1 AS qtdembalagem", "'S' AS padraovenda"), stores, divisions, costs)
    out = extracts.receipt_costs(joined)
    assert _broadcasts(out) == 2  # stores and divisions
    assert [(r.seqproduto, r.vlrentrada) for r in out.collect()] == [(10, D(40))]
