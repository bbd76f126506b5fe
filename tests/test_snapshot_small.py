"""Product x store snapshot on hand-made rows: lookups, repeated and missing keys; its wide rows stay where they are."""
import datetime as dt
from decimal import Decimal as D

import pytest

from shelfspark import session
from shelfspark.plans import dims, silver

DAY = dt.date(2024, 5, 1)


@pytest.fixture
def conf(spark):
    session.apply_conf(spark)
    yield
    session.apply_conf(spark)


def _snapshot(spark, base):
    prices = silver.prices(spark.createDataFrame(
        [(10, 1, 1, D(1), D(5)), (10, 1, 2, D(1), D(6)), (10, 1, 1, D(6), D(7)), (11, 2, 2, D(1), D(8)), (None, 1, 1, D(1), D(9))],
        "seqproduto int, nroempresa int, nrosegmento int, qtdembalagem decimal(18,3), precovalidnormal decimal(18,2)"))
    stores = spark.createDataFrame([(1, "ATIVA", 1), (2, "INATIVA", 2)], "empresa_id int, status_empresa string, segmento_principal int")
    # two main suppliers give two rows, a product listed twice one
    products = spark.createDataFrame([(10, 71), (10, 72), (11, 73), (11, 73)], "produto_id int, fornecedor_principal_id int")
    last = spark.createDataFrame([(10, 1, 81), (11, 2, 82), (None, 1, 83)], "produto_id int, empresa_id int, fornecedor_ultima_entrada_id int")
    delivery = spark.createDataFrame([(81, 1, D("2.5"), 0.5), (82, 1, D("9.9"), 0.9)],
                                     "fornecedor_id int, empresa_id int, media_tempo_entrega decimal(18,1), desvio_padrao_tempo_entrega double")
    abc = spark.createDataFrame([(10, 1, "A", "B", "C")], "produto_id int, empresa_id int, curva_abc_valor_empresa string, "
                                "curva_abc_valor_categoria string, curva_abc_valor_rede string")
    promo = spark.createDataFrame([(10, 1, 1, 5, D(4), D(1), DAY, DAY + dt.timedelta(2)), (11, 2, 1, 6, D(4), D(1), DAY, DAY)],
                                  "produto_id int, empresa_id int, segmento_id int, promocao_id int, preco_promocional decimal(18,2), "
                                  "perc_desconto decimal(18,2), dta_inicio_promoc date, dta_fim_promoc date")
    return dims.product_store_snapshot(silver.product_store(base, DAY), stores, prices, products, last, delivery, abc, promo, DAY)


def test_lookups_of_the_snapshot(spark, conf):
    base = spark.createDataFrame([(10, 1, D(3)), (10, 1, D(4)), (11, 2, D(5)), (12, 1, D(6)), (10, 9, D(7)), (None, 1, D(8)), (11, None, D(9))],
                                 "seqproduto int, nroempresa int, estqloja decimal(18,3)")
    got = [(r.produto_id, r.empresa_id, int(r.estoque_loja), r.status_empresa, r.fornecedor_principal_id, r.fornecedor_ultima_entrada_id,
            r.media_tempo_entrega, r.curva_abc_valor_rede, r.preco_valido_normal, r.promocao_vigente_id, r.dias_restantes_promoc)
           for r in _snapshot(spark, base).collect()]
    ten = ("ATIVA", 71, 81, D("2.5"), "C", D(5), 5, 2), ("ATIVA", 72, 81, D("2.5"), "C", D(5), 5, 2)
    none = (None,) * 5
    assert sorted(got, key=str) == sorted([
        *[(10, 1, stock, *t) for stock in (3, 4) for t in ten],
        (11, 2, 5, "INATIVA", 73, 82, None, None, D(8), None, None),  # delivery is known for another store only
        (12, 1, 6, "ATIVA", None, None, *none), (10, 9, 7, None, 71, None, *none), (10, 9, 7, None, 72, None, *none),
        (None, 1, 8, "ATIVA", None, None, *none), (11, None, 9, None, 73, None, *none)], key=str)


def test_rows_that_lie_by_product_and_store_do_not_move(spark, conf):
    base = spark.range(300_000).selectExpr("CAST(id % 1000 AS INT) AS seqproduto", "CAST(id % 300 AS INT) AS nroempresa").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _snapshot(spark, base)._jdf.queryExecution().executedPlan().toString()
    before, stores = plan.split("BroadcastHashJoin")  # down the left side of the joins, to the stores
    assert before.count("SortMergeJoin") == 5 and "Exchange" not in before
    assert stores.count("BroadcastExchange") == 1
