"""Golden fixtures for shares, allocation, the reference series and the checks."""
import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfspark.operators import checks
from shelfspark.plans import targets

SALES = "data_venda date, empresa_id int, produto_id int, valor_venda_liquido decimal(18,2)"
STORES = "empresa_id int, status_empresa string"
PRODUCTS = "produto_id int, categoria_id int, categoria_id_nome string"


def _shares(spark, sales_rows, first_month):
    stores = spark.createDataFrame([(1, "ATIVA"), (2, "ATIVA"), (3, "ATIVA"), (4, "INATIVA"), (5, "ATIVA")], STORES)
    prods = spark.createDataFrame([(10, 100, "A"), (11, 200, "B"), (12, 300, "C")], PRODUCTS)
    sales = spark.createDataFrame(sales_rows, SALES)
    rows = targets.participation(sales, prods, stores, first_month).collect()
    return {(r.mes, r.anos_historico, r.empresa_id, r.categoria_id): r for r in rows}


def test_participation_fallbacks(spark):
    m = dt.date(2024, 3, 1)
    y1, y2 = dt.date(2023, 3, 10), dt.date(2022, 3, 10)
    rows = [
        (y1, 2, 10, D("60.00")), (y1, 2, 11, D("20.00")), (y1, 2, 12, D("-5.00")),   # C negative in store 2
        (y1, 3, 10, D("20.00")),                                                   # store 3 lacks B
        (y2, 2, 10, D("100.00")),                                                  # 2 years back: only store 2
        (y1, 1, 10, D("999.00")), (y1, 4, 10, D("999.00")),                        # HQ and inactive: ignored
    ]
    got = _shares(spark, rows, m)
    # one year back: store 2 has 75 of 100 (C counts in the store total), store 3 has 20; store 5 is new
    s2, s3, s5 = (got[(m, 1, e, 100)].participacao_loja_normalizada for e in (2, 3, 5))
    raw = [75 / 95, 20 / 95, 1 / 3]
    assert abs(s2 - raw[0] / sum(raw)) < 1e-9 and abs(s5 - raw[2] / sum(raw)) < 1e-9
    assert abs(s2 + s3 + s5 - 1) < 1e-9
    # store 2: A 60/75, B 20/75; C is negative and dropped; renormalised
    assert abs(got[(m, 1, 2, 100)].participacao_categoria_normalizada - 60 / 80) < 1e-9
    assert (m, 1, 2, 300) not in got
    # store 3 lacks B: network mean of B (only store 2: 20/75) fills in before renormalising
    b = 20 / 75
    assert abs(got[(m, 1, 3, 200)].participacao_categoria_normalizada - b / (1 + b)) < 1e-9
    # the new store takes every category's network mean
    assert (m, 1, 5, 100) in got and (m, 1, 5, 200) in got
    # no store 1 (HQ) and no inactive store 4
    assert not any(k[2] in (1, 4) for k in got)
    # two years back adds 2022 to 2023 for the same calendar month
    assert abs(got[(m, 2, 2, 100)].participacao_loja_normalizada
               - (175 / 195) / (175 / 195 + 20 / 195 + 1 / 3)) < 1e-9
    # the spine runs 13 months ahead, but only target months whose reference
    # months had sales get category rows (March 2024 and, from 2023, March 2025)
    assert {k[0] for k in got} == {dt.date(2024, 3, 1), dt.date(2025, 3, 1)}
    assert {k[1] for k in got if k[0] == dt.date(2025, 3, 1)} == {2, 3}


def test_allocation_defaults_and_reconciliation(spark):
    m = dt.date(2024, 3, 1)
    shares = spark.createDataFrame([(m, 2, 2, 1, "A", 0.5, 1.0), (m, 2, 3, 1, "A", 0.5, 0.6), (m, 2, 3, 2, "B", 0.5, 0.4)],
                                   "mes date, anos_historico int, empresa_id int, categoria_id int, categoria_id_nome string, "
                                   "participacao_loja_normalizada double, participacao_categoria_normalizada double")
    params = targets.target_params(spark.createDataFrame([(m, D("1000.00"), None, None)],
                                                         "mes date, meta_grupo_padrao_valor decimal(18,2), "
                                                         "meta_grupo_desafio_valor decimal(18,2), anos_historico int"))
    p = params.first()
    assert p.meta_grupo_desafio_valor == D("1000.00") and p.anos_historico == 2     # NULL defaults
    adj = spark.createDataFrame([(m, 2, D("10.00"), None), (m, 3, D("-10.00"), None)],
                                "mes date, empresa_id int, ajuste_padrao_valor decimal(18,2), ajuste_desafio_valor decimal(18,2)")
    alloc = targets.allocation(shares, params, targets.store_adjustments(adj))
    got = {(r.empresa_id, r.categoria_id): r for r in alloc.collect()}
    assert got[(2, 1)].meta_padrao_valor == D("510.00") and got[(2, 1)].meta_desafio_valor == D("500.00")
    assert got[(3, 1)].meta_padrao_valor == D("294.00") and got[(3, 2)].meta_padrao_valor == D("196.00")
    assert checks.reconciles(alloc, params, ["mes"], [("meta_padrao_valor", "meta_grupo_padrao_valor")]).count() == 0
    assert checks.sums_to_zero(targets.store_adjustments(adj), ["mes"], "ajuste_padrao_valor").count() == 0
    bad = spark.createDataFrame([(m, 2, D("10.00"), None)], adj.schema)
    assert checks.sums_to_zero(targets.store_adjustments(bad), ["mes"], "ajuste_padrao_valor").count() == 1


def test_group_reference_series(spark):
    stores = spark.createDataFrame([(2, "ATIVA"), (3, "INATIVA")], STORES)
    rows = []
    for i in range(15):                                   # Jan 2023 .. Mar 2024, gap in May 2023
        d = dt.date(2023 + i // 12, i % 12 + 1, 5)
        if (d.year, d.month) != (2023, 5):
            rows.append((d, 2, 1, D(100 + 10 * i)))
        rows.append((d, 3, 1, D("999.00")))               # inactive store: not like-for-like
    sales = spark.createDataFrame(rows, SALES)
    ind = spark.createDataFrame(
        [(dt.date(2023, mo, 1), "IPCA_ALIMENTOS_BEBIDAS", D("0.5"), "BCB") for mo in range(1, 13) if mo != 6]
        + [(dt.date(2024, 1, 1), "PMC_HIPER_SUPER_VAR_ANUAL", D("2.0"), "IBGE")],
        "data_referencia date, indicador string, valor decimal(18,4), fonte string")
    got = {r.mes: r for r in targets.group_reference(sales, stores, ind).collect()}
    assert len(got) == 16                                 # spine up to the month after the last sale
    assert got[dt.date(2023, 5, 1)].faturamento_realizado is None
    assert got[dt.date(2024, 3, 1)].tipo_linha == "EM ANDAMENTO" and got[dt.date(2024, 4, 1)].tipo_linha == "PROJEÇÃO"
    assert got[dt.date(2024, 3, 1)].crescimento_yoy_mensal is None            # incomplete month
    jan = got[dt.date(2024, 1, 1)]
    assert jan.faturamento_ano_anterior == D("100.00")
    assert jan.crescimento_yoy_mensal == round((220 / 100 - 1) * 100, 2)
    assert jan.crescimento_yoy_medio_6m is None                               # no growth in the 6 months before
    assert jan.pmc_var_anual_setor == D("2.00")
    assert got[dt.date(2023, 12, 1)].ipca_alimentos_acumulado_12m == D("5.50")   # 11 rows (June missing)


def test_checks_one_violation_each(spark):
    df = spark.createDataFrame([(1, "A", None), (1, "B", 2), (2, None, 3), (3, "Z", 4)], "k int, s string, v int")
    assert {(r.coluna, r.qtd_nulos) for r in checks.not_null(df, ["k", "s", "v"]).collect()} == {("s", 1), ("v", 1)}
    assert [(r.k, r.qtd) for r in checks.unique(df, ["k"]).collect()] == [(1, 2)]
    assert [r.s for r in checks.accepted_values(df, "s", ["A", "B"], ["k"]).collect()] == ["Z"]   # NULL passes
    assert checks.unique(df, ["k", "s"]).count() == 0


def test_marts_on_empty_input(spark):
    from shelfspark.plans import marts
    empty_sales = spark.createDataFrame([], SALES + ", qtd_venda_liquida decimal(18,3)")
    cats = spark.createDataFrame([], "produto_id int, familia_id int, categoria_id int")
    assert marts.abc_curve(empty_sales, cats).count() == 0
    assert marts.abc_network(empty_sales).count() == 0
    receipts = spark.createDataFrame([], "fornecedor_id int, empresa_id int, dta_entrada date, cod_geral_oper int, "
                                         "tempo_entrega_dias int, vlr_total_nf decimal(18,2)")
    assert marts.delivery_time(receipts).count() == 0
    stores = spark.createDataFrame([(2, "ATIVA")], STORES)
    prods = spark.createDataFrame([], PRODUCTS)
    assert targets.participation(spark.createDataFrame([], SALES), prods, stores, None).count() == 0
    ind = spark.createDataFrame([], "data_referencia date, indicador string, valor decimal(18,4), fonte string")
    assert targets.group_reference(spark.createDataFrame([], SALES), stores, ind).count() == 0
