import datetime as dt
from decimal import Decimal as D

from shelfspark.plans import marts

SALES = ("empresa_id int, produto_id int, data_venda date, valor_venda_liquido decimal(18,2), "
         "qtd_venda_liquida decimal(18,3)")


def test_abc_golden(spark):
    end = dt.date(2024, 6, 30)
    start = dt.date(2023, 6, 30)
    rows = [
        (2, 1, end, D("50.00"), D("1")), (2, 2, end, D("30.00"), D("1")),     # 50 %, then exactly 80 %
        (2, 3, end, D("15.00"), D("1")),                                    # exactly 95 %
        (2, 4, start, D("5.00"), D("-2")),                                  # first day of the window
        (2, 5, dt.date(2023, 6, 29), D("99.00"), D("1")),                   # the day before: outside
        (2, 6, end, D("10.00"), D("1")), (2, 6, end, D("-12.00"), D("0")),  # net <= 0: excluded
    ]
    sales = spark.createDataFrame(rows, SALES)
    cats = spark.createDataFrame([(1, 10, 100), (2, 10, 100), (3, 10, 200)], "produto_id int, familia_id int, categoria_id int")
    got = {r.produto_id: r for r in marts.abc_curve(sales, cats).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert [got[p].curva_abc_valor_empresa for p in (1, 2, 3, 4)] == ["A", "A", "B", "C"]
    assert [got[p].pct_acum_valor_empresa for p in (1, 2, 3, 4)] == [0.5, 0.8, 0.95, 1.0]
    assert got[4].categoria_id is None and got[4].familia_id is None
    assert got[3].curva_abc_valor_categoria == "C"                  # alone in its category: 100 %
    assert got[4].curva_abc_qtd_empresa == "C"                      # negative quantity last
    assert got[1].periodo_inicio == start and got[1].periodo_fim == end


RECEIPTS = ("fornecedor_id int, empresa_id int, dta_entrada date, cod_geral_oper int, tempo_entrega_dias int, "
            "vlr_total_nf decimal(18,2)")


def test_delivery_time_golden(spark):
    d = dt.date(2024, 1, 10)
    rows = [(1, 2, d, 1, t, D("10.00")) for t in (-1, 0, 180, 181, 3, 4)]   # -1 and 181 clipped
    rows += [(2, 2, d, 11, 7, D("0.00"))]                                 # single row, zero value
    rows += [(3, 2, d, 999, 5, D("1.00"))]                                # not a purchase
    got = {r.fornecedor_id: r for r in marts.delivery_time(spark.createDataFrame(rows, RECEIPTS)).collect()}
    assert sorted(got) == [1, 2]
    a = got[1]
    assert (a.qtd_notas, a.min_tempo_entrega, a.max_tempo_entrega) == (4, 0, 180)
    assert a.media_tempo_entrega == D("46.8")            # 187 / 4 = 46.75 -> half up
    assert a.mediana_tempo_entrega == 4                  # (3 + 4) / 2 = 3.5 -> half to even
    b = got[2]
    assert b.desvio_padrao_tempo_entrega is None and b.media_tempo_entrega_ponderado is None
