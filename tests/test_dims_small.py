"""Golden fixtures for dimensions and staging (FIXTURES.md §3 edge rows)."""
import datetime as dt
from decimal import Decimal as D

from shelfspark.plans import dims, facts, silver
from shelfspark.sources import seeds

STORE_RAW = "nroempresa int, cidade string, status string, nrosegmentoprinc decimal(18,0), nrocgc string, digcgc decimal(18,0)"


def test_store_labels_and_overrides(spark):
    raw = spark.createDataFrame([
        (1, "sede", "A", D(1), "1", D(5)),          # head office, same city as store 5
        (5, "sede", "A", D(1), "5", D(7)),          # city: HQ + one store -> no suffix
        (2, "alfa", "A", D(1), "2", D(11)), (7, "alfa", "A", D(2), "7", D(3)),   # two stores -> L1, L2
        (3, "beta", "A", D(1), "3", D(1)),          # closed by the manual override
        (9, "gama", "I", D(1), "9", D(2)),          # single store, inactive at the source
    ], STORE_RAW)
    pdv = spark.createDataFrame([(2, 1, 1, "S"), (2, 2, 1, "s"), (2, 3, 1, "N"), (5, 1, 1, "S")],
                                "nroempresa int, nrocheckout int, nrosegmento int, ativo string")
    seg = spark.createDataFrame([(1, 1, "varejo", "A")], "nrodivisao int, nrosegmento int, descsegmento string, status string")
    out = {r.empresa_id: r for r in dims.store_dim(silver.stores(raw), silver.checkouts(pdv), silver.segments(seg),
                                                   seeds.closed_stores(spark)).collect()}
    assert out[1].loja == "001 - MATRIZ" and out[5].loja == "005 - SEDE"
    assert (out[2].loja, out[7].loja) == ("002 - ALFA L1", "007 - ALFA L2")
    assert out[9].loja == "009 - GAMA" and out[9].status_empresa == "INATIVA"
    assert out[3].status_empresa == "INATIVA" and out[3].dta_fechamento_fiscal == dt.date(2026, 1, 31)
    assert out[2].total_pdv_ativo == 2 and out[7].total_pdv_ativo is None
    assert out[2].segmento_id_nome == "001 - VAREJO" and out[7].segmento_id_nome is None
    assert out[2].cnpj == "000000000002-11"


def test_product_defaults_barcodes_and_category_priority(spark):
    prod = spark.createDataFrame([(10, "arroz", 1), (11, "feijao", None), (12, "sal", 2), (13, "acucar", 3)],
                                 "seqproduto int, desccompleta string, seqfamilia int")
    fam = spark.createDataFrame([(1, "graos", None, "S", "N"), (2, "temperos", 4, "N", "N"), (3, "doces", 4, "N", "S")],
                                "seqfamilia int, familia string, seqmarca int, pesavel string, pmtdecimal string")
    brand = spark.createDataFrame([(4, "marca x", "A")], "seqmarca int, marca string, status string")
    cat_cols = ("seqfamilia int, nrodivisao int, skcategoria int, categoriacompleta string, seqcategorian1 int, "
                "categorian1 string, seqcategorian2 int, categorian2 string, seqcategorian3 int, categorian3 string")
    cat = spark.createDataFrame([
        (1, 2, 9, "x", 20, "div dois", None, None, None, None),
        (1, 1, 8, "y", 1978, "div um", 5, "sub", 6, "grp"),          # division 1 wins, perishable id
        (3, 3, 7, "z", 30, "so div tres", None, None, None, None),  # only division 3
    ], cat_cols)
    codes = spark.createDataFrame([(10, 1, "B", "2000"), (10, 1, "E", "789"), (10, 1, "E", "123"),
                                   (10, 6, "D", "DUN1"), (10, 1, "E", None)],
                                  "seqproduto int, qtdembalagem int, tipcodigo string, codacesso string")
    out = {r.produto_id: r for r in dims.product_dim(silver.products(prod), silver.families(fam), silver.brands(brand),
                                                     silver.categories(cat), silver.barcodes(codes)).collect()}
    a = out[10]
    assert a.codigo_acesso == "123 ; 789 ; 2000"                # EANs first, then by code; DUN and NULL out
    assert (a.categoria_id, a.categoria, a.perecivel) == (1978, "DIV UM", "PERECÍVEL")
    assert (a.subcategoria_id_nome, a.grupo_id_nome) == ("0005 - SUB", "0006 - GRP")
    assert (a.marca_id, a.marca) == (0, "NÃO DEFINIDA")         # family without brand
    b = out[11]                                                  # no family at all
    assert (b.familia_id, b.categoria_id, b.categoria_id_nome, b.perecivel) == (None, 0, "0000 - NÃO DEFINIDA", "NÃO")
    assert out[12].categoria == "NÃO DEFINIDA" and out[12].marca == "MARCA X"
    assert out[13].categoria_id == 30 and out[13].grupo_id_nome == "0000 - NÃO DEFINIDO"


def test_taxpayer_id_and_address(spark):
    raw = spark.createDataFrame([
        (1, "ana", "F", "123", "4", "rua a", None),
        (2, "empresa", "J", "4567", "89", "rua b", "10"),
        (3, "sem digito", "J", "4567", None, None, "1"),
        (4, "tipo estranho", "X", "99", "1", "rua c", "2"),
    ], "seqpessoa int, nomerazao string, fisicajuridica string, nrocgccpf string, digcgccpf string, "
       "logradouro string, nrologradouro string")
    out = {r.pessoa_id: r for r in silver.persons(raw).collect()}
    assert out[1].cnpj_cpf == "00000012304" and out[1].pessoa_tipo == "FÍSICA"
    assert out[2].cnpj_cpf == "00000000456789" and out[2].pessoa_tipo == "JURÍDICA"
    assert out[3].cnpj_cpf is None and out[4].cnpj_cpf is None and out[4].pessoa_tipo == "JURÍDICA"
    assert out[1].endereco == "RUA A - S/N" and out[3].endereco == "1"
    assert out[2].nome_razao_id_nome == "00002 - EMPRESA"


def test_purchase_order_edges(spark):
    h = spark.createDataFrame([(100, 2, "L", "C", "F", dt.date(2024, 1, 1), "cabecalho"),
                               (101, 2, "m", "Q", "z", dt.date(2024, 1, 5), None)],
                              "nropedidosuprim long, nroempresa int, centralloja string, tippedidosuprim string, "
                              "situacaoped string, dtaemissao date, motivopendencia string")
    i = spark.createDataFrame([(100, 2, 7, 1, "A", None, "falta"), (100, 2, 8, 2, "C", dt.date(2024, 1, 9), None),
                               (101, 2, 7, 1, "P", dt.date(2024, 1, 4), None),
                               (999, 2, 7, 1, "A", None, None)],   # item without header: dropped
                              "nropedidosuprim long, nroempresa int, seqproduto int, seqitem int, statusitem string, "
                              "dtarecebtoitem date, motivopendencia string").selectExpr("*", "'L' AS centralloja")
    rows = {(r.pedido_id, r.produto_id): r for r in facts.purchase_order_fact(
        silver.order_headers(h), silver.order_items(i)).collect()}
    assert set(rows) == {(100, 7), (100, 8), (101, 7)}
    assert rows[(100, 7)].dias_lead_time_emissao_recebimento is None and rows[(100, 7)].motivo_pendencia == "FALTA"
    assert rows[(100, 8)].dias_lead_time_emissao_recebimento == 8 and rows[(100, 8)].motivo_pendencia == "CABECALHO"
    assert rows[(101, 7)].dias_lead_time_emissao_recebimento == -1                    # not clipped
    assert (rows[(101, 7)].central_loja, rows[(101, 7)].tip_pedido_suprim, rows[(101, 7)].situacao_ped) == ("MATRIZ", "Q", "Z")
    assert rows[(100, 7)].situacao_ped == "FATURADO" and rows[(100, 8)].status_item == "CANCELADO"


def test_stock_signs_and_unknown_location(spark):
    ledger = spark.createDataFrame([(1, 2, "e", D("5"), D("10.00"), 1), (2, 2, "S", D("3"), D("6.00"), 9),
                                    (3, 2, "x", D("4"), D("8.00"), 1)],
                                   "seqmovtoestq long, nroempresa int, tiplancto string, qtdlancto decimal(18,3), "
                                   "valorvlrnf decimal(18,2), local int")
    ledger = ledger.selectExpr("*", "DATE '2024-01-01' AS dtaentradasaida", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS dtahorlancto",
                               "10 AS seqproduto", "800 AS codgeraloper", "'v' AS tipusocgo")
    loc = spark.createDataFrame([(2, 1, "loja", "L", "A")], "nroempresa int, seqlocal int, local string, tiplocal string, status string")
    out = {r.movimento_id: r for r in facts.stock_movement_fact(silver.stock_ledger(ledger), silver.locations(loc)).collect()}
    assert (out[1].qtd_lancto, out[2].qtd_lancto, out[3].qtd_lancto) == (D("5.000"), D("-3.000"), D("0.000"))
    assert out[2].vlr_nf_lancto == D("-6.00") and out[2].descricao_local is None and out[1].descricao_local == "LOJA"


def test_days_since_edges(spark):
    raw = spark.createDataFrame([
        (1, 2, D("10"), D("0"), None, None, dt.date(2024, 1, 1)),
        (2, 2, D("10"), None, dt.date(2024, 1, 5), None, None),
        (3, 2, D("10"), D("4"), None, dt.date(2024, 1, 8), None),
        (4, 2, D("9"), D("4"), dt.date(2024, 1, 2), dt.date(2024, 1, 6), dt.date(2023, 12, 1)),
    ], "seqproduto int, nroempresa int, estqloja decimal(18,3), medvdiageral decimal(18,3), dtaultvenda date, "
       "dtaultmoventrada date, dtaultcompra date")
    out = {r.produto_id: r for r in silver.product_store(raw, dt.date(2024, 1, 10)).collect()}
    assert out[1].dias_estoque is None and out[2].dias_estoque is None and out[3].dias_estoque == D("2.5")
    assert out[4].dias_estoque == D("2.3")                                # 9 / 4 = 2.25 -> half up
    assert out[1].dias_sem_venda_desde_ultima_entrada is None               # both dates NULL
    assert out[2].dias_sem_venda_desde_ultima_entrada == 5 and out[3].dias_sem_venda_desde_ultima_entrada == 2
    assert out[4].dias_sem_venda_desde_ultima_entrada == 4 and out[4].dias_sem_compra == 40
    assert out[2].dias_sem_venda == 5 and out[1].dias_sem_venda is None
