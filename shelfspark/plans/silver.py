"""Silver layer: one function per raw table, ``DataFrame -> DataFrame``.

Each is a projection (rename, cast, decode, light derivation) that Catalyst
inlines into whatever reads it, so filters and column pruning of the gold
plans reach the parquet scan. The only one with a shuffle is
``categories`` (first division row per family).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.columns import (NO, YES, decode, id_label, opt, padded, yes_no)

MONEY = "decimal(18,2)"
QTY = "decimal(18,3)"
NUM = "decimal(18,6)"

# Fixed values that must equal the source system's code tables.
PURCHASE_ORDER_TYPES = {
    "X": "TRANSFERÊNCIA EXPEDIR",
    "T": "TRANSFERÊNCIA A RECEBER",
    "C": "COMPRA",
    "B": "BONIF INCIDÊNCIA CUSTO",
    "E": "BONIF SEM INCID CUSTO",
    "I": "BRINDE",
    "M": "IMPORTAÇÃO DIRETA",
}
PURCHASE_ORDER_STATES = {
    "L": "LIBERADO", "A": "ANÁLISE", "R": "ROTEIRIZAÇÃO", "S": "SEPARAÇÃO", "F": "FATURADO",
    "C": "CANCELADO", "D": "DIGITAÇÃO", "P": "PRÉ-SEPARAÇÃO", "W": "SEPARADO",
}
STORE_OR_HQ = {"L": "LOJA", "M": "MATRIZ"}
ITEM_STATES = {"A": "ABERTO", "C": "CANCELADO", "P": "PENDENTE"}
BARCODE_TYPES = {"I": "TRANSIÇÃO", "E": "EAN", "B": "BALANÇA", "F": "FORNECEDOR", "D": "DUN"}
PERISHABLE_CATEGORY_IDS = [1978, 2690, 2685, 1980, 1982]


def _loaded(df: DataFrame):
    return opt(df, "_loaded_at", "timestamp_ntz").alias("carregado_em")


# --------------------------------------------------------------------------- facts' sources

_SALES_SOURCE_COLUMNS = {"datahora", "nroempresa", "nrodocto", "seriedocto", "checkout", "nroformapagto",
                         "nrosegmento", "codgeraloper", "seqproduto", "seqoperador", "qtditem", "qtddevolitem",
                         "vlritem", "vlrdevolitem", "vlrdescitem", "vlrvendapromoc", "vlrlucro", "ctobrutovda",
                         "vlrctoliqvda", "_loaded_at"}


def sales_lines(src: DataFrame) -> DataFrame:
    """Hourly sales lines with the document key, the operator sentinel and net measures."""
    ts = F.col("datahora").cast("timestamp_ntz")
    return src.select(
        ts.alias("datahora_venda"),
        ts.cast("date").alias("data_venda"),
        F.hour(ts).alias("hora_venda"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("nrodocto").cast("bigint").alias("documento_numero"),
        F.col("seriedocto").cast("string").alias("serie_documento"),
        F.col("checkout").cast("int").alias("checkout_id"),
        F.concat(padded(F.col("nroempresa"), 2), F.lit("-"), padded(F.col("nrodocto"), 9), F.lit("-"),
                 F.col("seriedocto").cast("string"), F.lit("-"), padded(F.col("checkout"), 2)
                 ).alias("documento_chave"),
        F.col("nroformapagto").cast("int").alias("forma_pagto_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"),
        F.col("codgeraloper").cast("int").alias("cod_operacao"),
        F.col("seqproduto").cast("int").alias("produto_id"),
        # -1 instead of NULL: a NULL key part never matches in delete+insert
        F.coalesce(F.col("seqoperador").cast("int"), F.lit(-1)).alias("operador_id"),
        F.col("qtditem").cast(QTY).alias("qtd_venda"),
        F.col("qtddevolitem").cast(QTY).alias("qtd_devolvido"),
        (F.col("qtditem").cast(QTY) - F.col("qtddevolitem").cast(QTY)).alias("qtd_venda_liquida"),
        F.col("vlritem").cast(MONEY).alias("valor_venda"),
        F.col("vlrdevolitem").cast(MONEY).alias("valor_devolvido"),
        (F.col("vlritem").cast(MONEY) - F.col("vlrdevolitem").cast(MONEY)).alias("valor_venda_liquido"),
        opt(src, "vlrdescitem", MONEY).alias("valor_desconto"),
        opt(src, "vlrvendapromoc", MONEY).alias("valor_venda_promocao"),
        opt(src, "vlrlucro", MONEY).alias("valor_lucro"),
        opt(src, "ctobrutovda", MONEY).alias("valor_custo_bruto"),
        opt(src, "vlrctoliqvda", MONEY).alias("valor_custo_liquido"),
        _loaded(src),
        # columns added to the source later are carried through as they are
        *[F.col(c) for c in src.columns if c not in _SALES_SOURCE_COLUMNS],
    )


def receipt_lines(src: DataFrame) -> DataFrame:
    """Goods receipts with the issue-to-receipt delivery time in days."""
    entrada = F.col("dtaentrada").cast("date")
    emissao = F.col("dtaemissao").cast("date")
    return src.select(
        F.col("nroempresa").cast("int").alias("empresa_id"),
        entrada.alias("dta_entrada"),
        emissao.alias("dta_emissao"),
        F.datediff(entrada, emissao).alias("tempo_entrega_dias"),
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.col("nrodocto").cast("bigint").alias("nro_docto"),
        F.col("seqfornecedor").cast("int").alias("fornecedor_id"),
        F.col("nrodocumento").cast("string").alias("nro_documento"),
        F.col("codgeraloper").cast("int").alias("cod_geral_oper"),
        F.col("operador").cast("string").alias("operador"),
        F.col("qtdembalagem").cast(QTY).alias("qtd_embalagem"),
        F.col("quantidade").cast(QTY).alias("quantidade"),
        opt(src, "vlrentrada", MONEY).alias("vlr_entrada"),
        opt(src, "vlrcustobruto", MONEY).alias("vlr_custo_bruto"),
        opt(src, "vlrcustoliquido", MONEY).alias("vlr_custo_liquido"),
        opt(src, "vlrproduto", MONEY).alias("vlr_produto"),
        opt(src, "vlrtotalnf", MONEY).alias("vlr_total_nf"),
        opt(src, "vlrdescontos", MONEY).alias("vlr_descontos"),
        opt(src, "custofiscaltotalentrada", MONEY).alias("vlr_custo_fiscal_total"),
        opt(src, "prazomediopag", MONEY).alias("prazo_medio_pagamento"),
        _loaded(src),
    )


def stock_ledger(src: DataFrame) -> DataFrame:
    """Stock movements with quantity and value signed by entry (E) / exit (S)."""
    kind = F.upper(F.col("tiplancto"))
    sign = F.when(kind == "E", 1).when(kind == "S", -1).otherwise(0)
    return src.select(
        F.col("seqmovtoestq").cast("bigint").alias("movimento_id"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("dtaentradasaida").cast("date").alias("dta_movimento"),
        F.col("dtahorlancto").cast("timestamp_ntz").alias("dta_hor_lancto"),
        F.col("seqproduto").cast("int").alias("produto_id"),
        opt(src, "seqprodutobase", "int").alias("produto_base_id"),
        F.col("local").cast("int").alias("local_id"),
        F.col("codgeraloper").cast("int").alias("cod_geral_oper"),
        F.upper(F.col("tipusocgo")).alias("tip_uso_cgo"),
        kind.alias("tip_lancto"),
        (sign * F.col("qtdlancto").cast(QTY)).cast(QTY).alias("qtd_lancto"),
        (sign * F.col("valorvlrnf").cast(MONEY)).cast(MONEY).alias("vlr_nf_lancto"),
        opt(src, "nrodocumento", "string").alias("nro_documento"),
        F.upper(opt(src, "motivomovto", "string")).alias("motivo_movto"),
        opt(src, "seqloteestoque", "int").alias("lote_estoque_id"),
        opt(src, "historico", "string").alias("historico"),
        _loaded(src),
    )


def stock_daily(src: DataFrame) -> DataFrame:
    """Daily stock custody; closing = opening + in - out."""
    q = lambda c: F.col(c).cast(QTY)
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.col("dtaentradasaida").cast("date").alias("dta_movimento"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        q("qtdestqinicial").alias("qtd_estoque_inicial"),
        q("qtdentrada").alias("qtd_entrada"),
        q("qtdsaida").alias("qtd_saida"),
        (q("qtdestqinicial") + q("qtdentrada") - q("qtdsaida")).cast(QTY).alias("qtd_estoque_final"),
        opt(src, "qtdcompra", QTY).alias("qtd_compra"),
        opt(src, "vlrtotalcompra", MONEY).alias("vlr_total_compra"),
        opt(src, "qtdvda", QTY).alias("qtd_venda"),
        opt(src, "vlrtotalvda", MONEY).alias("vlr_total_venda"),
        opt(src, "vlrcusliquidovda", MONEY).alias("vlr_custo_liquido_venda"),
        opt(src, "vlrcusbrutovda", MONEY).alias("vlr_custo_bruto_venda"),
        opt(src, "qtddevol", QTY).alias("qtd_devolucao"),
        opt(src, "vlrtotaldevol", MONEY).alias("vlr_total_devolucao"),
        opt(src, "vlrcusliquidodevol", MONEY).alias("vlr_custo_liquido_devolucao"),
        opt(src, "cmdiavlrnf", MONEY).alias("custo_medio_dia_nf"),
        opt(src, "cmdiacusliquidoemp", MONEY).alias("custo_medio_dia_liquido"),
        _loaded(src),
    )


def locations(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("seqlocal").cast("int").alias("local_id"),
        F.upper(F.col("local")).alias("descricao_local"),
        F.upper(F.col("tiplocal")).alias("tipo_local"),
        F.upper(F.col("status")).alias("status_local"),
        _loaded(src),
    )


def _label(c, mapping, humanize: bool):
    return decode(c, mapping) if humanize else F.upper(c)


def order_headers(src: DataFrame, humanize: bool = True) -> DataFrame:
    """Purchase-order headers. ``humanize=False`` keeps the raw upper-cased codes,
    which is what rows loaded before the code labels existed hold."""
    up = lambda c: F.upper(opt(src, c, "string"))
    return src.select(
        F.col("nropedidosuprim").cast("bigint").alias("pedido_id"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        _label(F.col("centralloja"), STORE_OR_HQ, humanize).alias("central_loja"),
        opt(src, "seqcomprador", "int").alias("comprador_id"),
        opt(src, "seqfornecedor", "int").alias("fornecedor_id"),
        _label(F.col("tippedidosuprim"), PURCHASE_ORDER_TYPES, humanize).alias("tip_pedido_suprim"),
        _label(F.col("situacaoped"), PURCHASE_ORDER_STATES, humanize).alias("situacao_ped"),
        F.col("dtaemissao").cast("date").alias("dta_emissao"),
        opt(src, "dtaemissaooriginal", "date").alias("dta_emissao_original"),
        opt(src, "dtarecebto", "date").alias("dta_recebto"),
        opt(src, "dtarecebtooriginal", "date").alias("dta_recebto_original"),
        opt(src, "dtalimiterecebto", "date").alias("dta_limite_recebto"),
        opt(src, "dtahorinclusao", "timestamp_ntz").alias("dta_hor_inclusao"),
        opt(src, "dtaaprovacao", "date").alias("dta_aprovacao"),
        up("usuaprovacao").alias("usu_aprovacao"),
        opt(src, "justificativaaprovacao", "string").alias("justificativa_aprovacao"),
        up("pzopagamento").alias("pzo_pagamento"),
        up("condicaofrete").alias("condicao_frete"),
        opt(src, "txvendor", NUM).alias("tx_vendor"),
        up("nropedfornecedor").alias("nro_ped_fornecedor"),
        up("observacao").alias("observacao"),
        *[opt(src, f"qtdtot{state}", QTY).alias(f"qtd_tot_{state}")
          for state in ("solicitada", "recebida", "cancelada", "transito", "aprovada")],
        opt(src, "vlrtotpedido", MONEY).alias("vlr_tot_pedido"),
        opt(src, "vlrtotcancelado", MONEY).alias("vlr_tot_cancelado"),
        opt(src, "vlrtotrecebido", MONEY).alias("vlr_tot_recebido"),
        opt(src, "codgeraloper", "int").alias("cod_geral_oper"),
        opt(src, "seqtransportador", "int").alias("transportador_id"),
        up("motivopendencia").alias("motivo_pendencia"),
        opt(src, "codigopendencia", "int").alias("codigo_pendencia"),
        opt(src, "diasprorrogacao", "int").alias("dias_prorrogacao"),
        opt(src, "nropedsuprimorig", "bigint").alias("nro_ped_suprim_orig"),
        opt(src, "nroempresaorig", "int").alias("empresa_orig_id"),
        _label(opt(src, "centrallojaorig", "string"), STORE_OR_HQ, humanize).alias("central_loja_orig"),
        up("tipopedvenda").alias("tipo_ped_venda"),
        up("indtransfempsec").alias("ind_transf_emp_sec"),
        opt(src, "nrorequisicao", "bigint").alias("nro_requisicao"),
        _loaded(src),
    )


def order_items(src: DataFrame, humanize: bool = True) -> DataFrame:
    """Purchase-order items still to be received, or received."""
    up = lambda c: F.upper(opt(src, c, "string"))
    return src.select(
        F.col("nropedidosuprim").cast("bigint").alias("pedido_id"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        _label(F.col("centralloja"), STORE_OR_HQ, humanize).alias("central_loja"),
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.col("seqitem").cast("int").alias("item_seq"),
        opt(src, "qtdsolicitada", QTY).alias("qtd_solicitada"),
        opt(src, "qtdsolicitadaoriginal", QTY).alias("qtd_solicitada_original"),
        opt(src, "qtdembalagem", QTY).alias("qtd_embalagem"),
        opt(src, "qtdaprovada", QTY).alias("qtd_aprovada"),
        opt(src, "qtdtotrecebida", QTY).alias("qtd_tot_recebida"),
        opt(src, "qtdtotcancelada", QTY).alias("qtd_tot_cancelada"),
        opt(src, "qtdtottransito", QTY).alias("qtd_tot_transito"),
        _label(F.col("statusitem"), ITEM_STATES, humanize).alias("status_item"),
        opt(src, "dtaaprovacao", "date").alias("dta_aprovacao"),
        opt(src, "dtarecebtoitem", "date").alias("dta_recebto_item"),
        opt(src, "vlrunitario", MONEY).alias("vlr_unitario"),
        opt(src, "vlrembitem", MONEY).alias("vlr_emb_item"),
        opt(src, "vlrembipi", MONEY).alias("vlr_emb_ipi"),
        opt(src, "vlrembicmsst", MONEY).alias("vlr_emb_icmsst"),
        opt(src, "vlrembverbacompra", MONEY).alias("vlr_emb_verba_compra"),
        opt(src, "estoque", QTY).alias("estoque"),
        up("observacaoitem").alias("observacao_item"),
        up("motivopendencia").alias("motivo_pendencia"),
        opt(src, "dtaalteracao", "date").alias("dta_alteracao"),
        up("usualteracao").alias("usu_alteracao"),
        _loaded(src),
    )


# --------------------------------------------------------------------------- master data

# A store's operation codes, source column -> name.
STORE_OPERATION_CODES = {
    "cgobaixasaidapdv": "cgo_baixa_saida_pdv",
    "cgotransflocori": "cgo_transf_loc_ori",
    "cgotransflocdest": "cgo_transf_loc_dest",
    "cgobaixaproducao": "cgo_baixa_producao",
    "cgoentrproducao": "cgo_entr_producao",
    "cgobaixainventario": "cgo_baixa_inventario",
    "cgoentrinventario": "cgo_entr_inventario",
    "cgoemissnfvenda": "cgo_emiss_nf_venda",
    "cgoenttransf": "cgo_entr_transf",
    "cgodevfornec": "cgo_dev_fornec",
    "cgoenttransfprod": "cgo_entr_transf_prod",
    "cgosaitransfprod": "cgo_sai_transf_prod",
    "cgobaixaperda": "cgo_baixa_perda",
    "cgoajustecusto": "cgo_ajuste_custo",
    "cgoajustecustoredu": "cgo_ajuste_custo_redu",
}


def stores(src: DataFrame) -> DataFrame:
    up = lambda c: F.upper(opt(src, c, "string"))
    return src.select(
        F.col("nroempresa").cast("int").alias("empresa_id"),
        opt(src, "nrodivisao", "int").alias("divisao_id"),
        up("razaosocial").alias("razao_social"),
        F.concat(padded(opt(src, "seqpessoaemp", "string"), 5), F.lit(" - "), up("razaosocial")).alias("pessoa_id_razao"),
        up("endereco").alias("logradouro"),
        up("bairro").alias("bairro"),
        opt(src, "cep", "string").alias("cep"),
        up("cidade").alias("cidade"),
        up("uf").alias("uf"),
        F.concat_ws(" - ", up("endereco"), up("bairro"), up("cep"), up("cidade"), up("uf")).alias("endereco"),
        F.concat(padded(opt(src, "nrocgc", "string"), 12), F.lit("-"),
                 padded(opt(src, "digcgc", "decimal(18,0)"), 2)).alias("cnpj"),
        up("inscricaoestadual").alias("inscricao_estadual"),
        opt(src, "nrometro2loja", "decimal(18,2)").alias("metro_quadrado"),
        opt(src, "seqpessoaemp", "decimal(18,0)").alias("pessoa_id"),
        opt(src, "nrosegmentoprinc", "decimal(18,0)").cast("int").alias("segmento_principal"),
        yes_no(opt(src, "indabertsabado", "string")).alias("aberto_sabado"),
        yes_no(opt(src, "indabertdomingo", "string")).alias("aberto_domingo"),
        F.when(F.upper(F.col("status")) == "A", "ATIVA").otherwise("INATIVA").alias("status_empresa"),
        opt(src, "metagermargemlucro", "decimal(18,2)").alias("meta_margem_lucro"),
        opt(src, "metagerdiaestq", "decimal(18,2)").alias("meta_dia_estoque"),
        opt(src, "dtafechafiscal", "date").alias("dta_fechamento_fiscal"),
        opt(src, "dtainiciomovestoque", "date").alias("inicio_estoque"),
        opt(src, "nronsunf", "int").alias("nsu_nf"),
        *[opt(src, c, "int").alias(name) for c, name in STORE_OPERATION_CODES.items()],
        _loaded(src),
    )


def checkouts(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("nrocheckout").cast("int").alias("checkout_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"),
        F.when(F.upper(F.col("ativo")) == "S", YES).otherwise(NO).alias("pdv_ativo"),
        _loaded(src),
    )


def segments(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("nrodivisao").cast("int").alias("divisao_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"),
        F.upper(F.col("descsegmento")).alias("segmento"),
        id_label(F.col("nrosegmento"), F.col("descsegmento"), 3).alias("segmento_id_nome"),
        F.when(F.upper(F.col("status")) == "A", "ATIVO").otherwise("INATIVO").alias("status"),
        _loaded(src),
    )


def products(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.upper(F.col("desccompleta")).alias("produto"),
        id_label(F.col("seqproduto"), F.col("desccompleta"), 6).alias("produto_id_nome"),
        F.col("seqfamilia").cast("int").alias("familia_id"),
        opt(src, "dtahorinclusao", "date").alias("data_inclusao"),
        _loaded(src),
    )


def families(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("seqfamilia").cast("int").alias("familia_id"),
        F.upper(F.col("familia")).alias("familia"),
        id_label(F.col("seqfamilia"), F.col("familia"), 6).alias("familia_id_nome"),
        F.coalesce(F.col("seqmarca").cast("int"), F.lit(0)).alias("marca_id"),
        yes_no(opt(src, "pesavel", "string")).alias("pesavel"),
        yes_no(opt(src, "pmtdecimal", "string")).alias("permite_decimal"),
        _loaded(src),
    )


def brands(src: DataFrame) -> DataFrame:
    st = F.upper(F.col("status"))
    return src.select(
        F.col("seqmarca").cast("int").alias("marca_id"),
        F.upper(F.col("marca")).alias("marca"),
        id_label(F.col("seqmarca"), F.col("marca"), 4).alias("marca_id_nome"),
        F.when(st == "A", "ATIVA").when(st == "I", "INATIVA").otherwise("NÃO INFORMADA").alias("status_marca"),
        _loaded(src),
    )


def categories(src: DataFrame) -> DataFrame:
    """Category hierarchy, one row per family: division 1 wins, else the lowest division.

    Dedup is a ``row_number`` over a family window; Spark plans it as a
    ``WindowGroupLimit`` so each task keeps one row per family before the sort.
    Ties inside a division are broken by the category key.
    """
    n3 = F.col("seqcategorian3")
    w = Window.partitionBy("seqfamilia").orderBy(
        F.when(F.col("nrodivisao") == 1, 0).otherwise(1), F.col("nrodivisao").asc_nulls_last(),
        F.col("skcategoria").asc_nulls_last())
    ranked = src.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return ranked.select(
        F.col("nrodivisao").cast("int").alias("divisao_id"),
        F.col("seqfamilia").cast("int").alias("familia_id"),
        F.col("skcategoria").cast("int").alias("sk_categoria"),
        F.upper(F.col("categoriacompleta")).alias("categoria_completa"),
        id_label(F.col("skcategoria"), F.col("categoriacompleta"), 4).alias("categoria_completa_id_nome"),
        F.col("seqcategorian1").cast("int").alias("categoria_id"),
        F.upper(F.col("categorian1")).alias("categoria"),
        id_label(F.col("seqcategorian1"), F.col("categorian1"), 4).alias("categoria_id_nome"),
        F.col("seqcategorian2").cast("int").alias("subcategoria_id"),
        F.upper(F.col("categorian2")).alias("subcategoria"),
        F.when(F.col("seqcategorian2").isNull(), "0000 - NÃO DEFINIDA")
         .otherwise(id_label(F.col("seqcategorian2"), F.col("categorian2"), 4)).alias("subcategoria_id_nome"),
        F.when(n3.isNull(), 0).otherwise(n3.cast("int")).alias("grupo_id"),
        F.when(n3.isNull(), "NÃO DEFINIDO").otherwise(F.upper(F.col("categorian3"))).alias("grupo"),
        F.when(n3.isNull(), "0000 - NÃO DEFINIDO")
         .otherwise(id_label(n3, F.col("categorian3"), 4)).alias("grupo_id_nome"),
        F.when(F.col("seqcategorian1").isin(PERISHABLE_CATEGORY_IDS), "PERECÍVEL")
         .otherwise("NÃO PERECÍVEL").alias("perecivel"),
        _loaded(ranked),
    )


def barcodes(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.col("qtdembalagem").cast("int").alias("qtd_embalagem"),
        decode(F.col("tipcodigo"), BARCODE_TYPES).alias("tipo_codigo"),
        F.col("codacesso").cast("string").alias("codigo_acesso"),
        _loaded(src),
    )


def family_suppliers(src: DataFrame) -> DataFrame:
    ind = F.upper(F.col("indindenizavaria"))
    return src.select(
        F.col("seqfamilia").cast("int").alias("familia_id"),
        F.col("seqfornecedor").cast("int").alias("fornecedor_id"),
        yes_no(F.col("principal")).alias("fornecedor_principal"),
        F.when(ind == "S", YES).when(ind == "N", NO).otherwise("NÃO INFORMADO").alias("indeniza_avaria"),
        _loaded(src),
    )


def persons(src: DataFrame) -> DataFrame:
    """People and companies; the taxpayer id is root (9 or 12 digits) + 2 check digits."""
    up = lambda c: F.upper(opt(src, c, "string"))
    kind = up("fisicajuridica")
    root = F.when(kind == "F", padded(F.col("nrocgccpf"), 9)).when(kind == "J", padded(F.col("nrocgccpf"), 12))
    digits = F.when(F.col("digcgccpf").isNotNull(), padded(F.col("digcgccpf"), 2))
    return src.select(
        F.col("seqpessoa").cast("int").alias("pessoa_id"),
        up("nomerazao").alias("nome_razao"),
        id_label(F.col("seqpessoa"), F.col("nomerazao"), 5).alias("nome_razao_id_nome"),
        up("fantasia").alias("nome_fantasia"),
        F.when(up("status") == "A", "ATIVO").otherwise("INATIVO").alias("status"),
        F.when(kind == "F", "FÍSICA").otherwise("JURÍDICA").alias("pessoa_tipo"),
        up("logradouro").alias("logradouro"),
        up("nrologradouro").alias("numero"),
        up("bairro").alias("bairro"),
        up("cidade").alias("cidade"),
        up("cep").alias("cep"),
        up("uf").alias("uf"),
        up("pais").alias("pais"),
        F.concat_ws(" - ", up("logradouro"), F.coalesce(up("nrologradouro"), F.lit("S/N")), up("bairro"),
                    up("cep"), up("cidade"), up("uf"), up("pais")).alias("endereco"),
        F.concat(root, digits).alias("cnpj_cpf"),
        up("inscricaorg").alias("inscricao_rg"),
        up("email").alias("email"),
        yes_no(opt(src, "indcontribicms", "string")).alias("contribuinte_icms"),
        yes_no(opt(src, "indprodrural", "string")).alias("produtor_rural"),
        yes_no(opt(src, "indcontribipi", "string")).alias("contribuinte_ipi"),
        up("cnae").alias("cnae"),
        opt(src, "dtainclusao", "date").alias("data_inclusao"),
        _loaded(src),
    )


def supplier_divisions(src: DataFrame) -> DataFrame:
    st = F.upper(F.col("statusgeral"))
    return src.select(
        F.col("nrodivisao").cast("int").alias("divisao_id"),
        F.col("seqfornecedor").cast("int").alias("fornecedor_id"),
        opt(src, "pzomedvisitarep", MONEY).alias("prazo_medio_visita_representante"),
        opt(src, "pzomedentrega", MONEY).alias("prazo_med_entrega"),
        opt(src, "pzomedatraso", MONEY).alias("prazo_med_atraso"),
        opt(src, "pzopagamento", "string").alias("prazo_pagamento"),
        opt(src, "nrocondpagdev", "int").alias("condicao_pagamento_id"),
        opt(src, "nroformapagtodev", "int").alias("forma_pagamento_id"),
        F.when(st == "A", "ATIVO").when(st == "I", "INATIVO").otherwise("OUTRO").alias("status_fornecedor"),
        _loaded(src),
    )


# --------------------------------------------------------------------------- product x store

ACTIVE_INACTIVE = {"A": "ATIVO", "I": "INATIVO"}


def _status(c):
    return decode(c, ACTIVE_INACTIVE, default="NÃO INFORMADO")


def _yes_no_unknown(c):
    return decode(c, {"S": YES, "N": NO}, default="NÃO INFORMADO")


def product_store(src: DataFrame, as_of) -> DataFrame:
    """Stock, pending orders, sales means, costs and last movements per product x store,
    with days of stock and days since.

    ``as_of`` stands for the current date of the run. A mean of zero or NULL has no days of stock.
    """
    today = F.lit(as_of).cast("date")
    mean = opt(src, "medvdiageral", QTY)
    last_sale, last_in = opt(src, "dtaultvenda", "date"), opt(src, "dtaultmoventrada", "date")
    floor = F.lit("1900-01-01").cast("date")
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"),
        F.col("nroempresa").cast("int").alias("empresa_id"),
        _status(opt(src, "statuscompra", "string")).alias("status_compra"),
        opt(src, "locentrada", "int").alias("local_entrada_id"),
        opt(src, "locsaida", "int").alias("local_saida_id"),
        *[opt(src, f"estq{place}", QTY).alias(f"estoque_{place}")
          for place in ("loja", "deposito", "troca", "almoxarifado", "outro", "empresa")],
        opt(src, "qtdpendpedcompra_depreciada", QTY).alias("qtd_pedido_compra_pendente"),
        opt(src, "qtdpendpedexped_depreciada", QTY).alias("qtd_pedido_expedicao_pendente"),
        opt(src, "qtdpedrectransito_depreciada", QTY).alias("qtd_recebimento_transito"),
        mean.alias("media_venda_diaria"),
        opt(src, "medvdiaforapromoc", QTY).alias("media_venda_diaria_fora_promo"),
        F.when(mean.isNull() | (mean == 0), F.lit(None))
         .otherwise(F.round(opt(src, "estqloja", QTY) / mean, 1)).cast("decimal(18,1)").alias("dias_estoque"),
        opt(src, "cmultcusliquidoemp", MONEY).alias("ultimo_custo_liquido"),
        opt(src, "cmultvlrnf", MONEY).alias("ultimo_valor_nf"),
        _yes_no_unknown(opt(src, "indgeraruptura", "string")).alias("gera_ruptura"),
        opt(src, "dtaultmovtacao", "date").alias("dta_ultima_movimentacao"),
        last_in.alias("dta_ultima_movimentacao_entrada"),
        opt(src, "dtaultmovsaida", "date").alias("dta_ultima_movimentacao_saida"),
        opt(src, "dtaultentrada", "date").alias("dta_ultima_entrada"),
        opt(src, "qtdultentrada", QTY).alias("qtd_ultima_entrada"),
        opt(src, "dtaultcompra", "date").alias("dta_ultima_compra"),
        opt(src, "qtdultcompra", QTY).alias("qtd_ultima_compra"),
        F.datediff(today, opt(src, "dtaultcompra", "date")).alias("dias_sem_compra"),
        last_sale.alias("dta_ultima_venda"),
        opt(src, "qtdultvenda", QTY).alias("qtd_ultima_venda"),
        F.datediff(today, last_sale).alias("dias_sem_venda"),
        F.when(last_sale.isNull() & last_in.isNull(), F.lit(None))
         .otherwise(F.datediff(today, F.greatest(F.coalesce(last_sale, floor), F.coalesce(last_in, floor))))
         .alias("dias_sem_venda_desde_ultima_entrada"),
        opt(src, "dtaultinvfisico", "date").alias("dta_ultimo_inventario"),
        opt(src, "qtdultimoinventario", QTY).alias("qtd_ultimo_inventario"),
        _loaded(src),
    )


def prices(src: DataFrame) -> DataFrame:
    """Prices per product x pack x segment x store: in force, promotional and scheduled, with their reasons and dates."""
    up = lambda c: F.upper(opt(src, c, "string"))
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"), F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"), F.col("qtdembalagem").cast(QTY).alias("qtd_embalagem"),
        _status(opt(src, "statusvenda", "string")).alias("status_venda"),
        opt(src, "precobasenormal", MONEY).alias("preco_base_normal"),
        opt(src, "precogernormal", MONEY).alias("preco_ger_normal"),
        opt(src, "precovalidnormal", MONEY).alias("preco_valido_normal"),
        opt(src, "precogerpromoc", MONEY).alias("preco_ger_promoc"),
        opt(src, "precovalidpromoc", MONEY).alias("preco_valido_promoc"),
        opt(src, "precoemitidopromoc", MONEY).alias("preco_emitido_promoc"),
        opt(src, "margemlucroprodempseg", MONEY).alias("margem_lucro"),
        opt(src, "vlrcustoliqdiaprecif", MONEY).alias("custo_liq_precificacao"),
        up("motivoprecobase").alias("motivo_preco_base"),
        up("motivoprecogerado").alias("motivo_preco_gerado"),
        up("motivoprecovalido").alias("motivo_preco_valido"),
        opt(src, "dtageracaopreco", "date").alias("dta_geracao_preco"),
        opt(src, "dtavalidacaopreco", "date").alias("dta_validacao_preco"),
        opt(src, "dtaalteracao", "date").alias("dta_alteracao"),
        opt(src, "datahoraalteracao", "timestamp_ntz").alias("dta_hora_alteracao_preco"),
        opt(src, "dtahoraltstatusvda", "timestamp_ntz").alias("dta_hora_alt_status_venda"),
        opt(src, "precogernormalprog", MONEY).alias("preco_ger_programado"),
        opt(src, "dtageracaoprecoprog", "date").alias("dta_preco_programado"),
        _yes_no_unknown(opt(src, "indrevisaopreco", "string")).alias("ind_revisao_preco"),
        opt(src, "seqpromocao", "int").alias("promocao_id"),
        _loaded(src),
    )


def promotions(src: DataFrame) -> DataFrame:
    """Promotion headers per store and segment."""
    up = lambda c: F.upper(opt(src, c, "string"))
    return src.select(
        F.col("seqpromocao").cast("int").alias("promocao_id"), F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"), opt(src, "nrodivisao", "int").alias("divisao_id"),
        F.upper("centralloja").alias("central_loja"), up("promocao").alias("promocao"),
        up("tipopromoc").alias("tipo_promoc"),
        F.col("dtainicio").cast("date").alias("dta_inicio"), F.col("dtafim").cast("date").alias("dta_fim"),
        _yes_no_unknown(opt(src, "indprevalecepreco", "string")).alias("ind_prevalece_preco"),
        _yes_no_unknown(opt(src, "indsegmentoprinc", "string")).alias("ind_segmento_princ"),
        opt(src, "seqencarte", "int").alias("encarte_id"),
        opt(src, "dtageracaopromoc", "date").alias("dta_geracao"),
        opt(src, "dtahorainclusao", "timestamp_ntz").alias("dta_hora_inclusao"),
        opt(src, "dtahoraalteracao", "timestamp_ntz").alias("dta_hora_alteracao"),
        up("usuinclusao").alias("usuario_inclusao"), up("usualteracao").alias("usuario_alteracao"),
        _loaded(src),
    )


def promotion_items(src: DataFrame) -> DataFrame:
    """Promotion items; their own dates, if any, override the header's."""
    return src.select(
        F.col("seqproduto").cast("int").alias("produto_id"), F.col("qtdembalagem").cast(QTY).alias("qtd_embalagem"),
        F.col("seqpromocao").cast("int").alias("promocao_id"), F.col("nroempresa").cast("int").alias("empresa_id"),
        F.col("nrosegmento").cast("int").alias("segmento_id"), F.upper("centralloja").alias("central_loja"),
        opt(src, "precopromocional", MONEY).alias("preco_promocional"),
        opt(src, "precosugerido", MONEY).alias("preco_sugerido"),
        _status(F.col("status")).alias("status"),
        opt(src, "percdescpromoc", MONEY).alias("perc_desconto"),
        opt(src, "dtainicioprom", "date").alias("dta_inicio_item"),
        opt(src, "dtafimprom", "date").alias("dta_fim_item"),
        opt(src, "qtdprevistavda", QTY).alias("qtd_prevista_venda"),
        opt(src, "qtdtotalvda", QTY).alias("qtd_total_vendida"),
        opt(src, "vlrtotalvda", MONEY).alias("vlr_total_vendido"),
        opt(src, "qtdmediavdapromoc", QTY).alias("media_venda_promoc"),
        opt(src, "nroacordo", "int").alias("acordo_id"),
        opt(src, "dtainclusao", "date").alias("dta_inclusao"),
        opt(src, "dtageracao", "date").alias("dta_geracao"),
        opt(src, "dtahoraalteracao", "timestamp_ntz").alias("dta_hora_alteracao"),
        F.upper(opt(src, "usualteracao", "string")).alias("usuario_alteracao"),
        _loaded(src),
    )


def code_table(src: DataFrame, code_col: str, desc_col: str, id_name: str, label_name: str) -> DataFrame:
    """Small code -> description tables of the order module."""
    return src.select(F.col(code_col).cast("string").alias(id_name),
                      F.upper(F.col(desc_col).cast("string")).alias(label_name), _loaded(src))
