"""Data tests over a warehouse: the declared expectations of the silver and gold models.

``run`` returns one row per expectation (table, test, columns, violations);
a test passes when its count is 0. Gold tables are read as stored, silver
ones as the staging plans over the raw tables of the run.

All ``not_null`` and ``accepted_values`` expectations of a table are counted
by one aggregate over one scan of the columns they name, so the number of
scans does not grow with the number of expectations. A ``unique``
expectation groups by its key, combined map-side before its shuffle; in a
key of one column NULLs are not compared, in a grain of several columns NULL
is a value like any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import checks
from shelfspark.plans import enrich, silver, targets
from shelfspark.plans.warehouse import Warehouse

RESULT = "tabela string, teste string, colunas string, violacoes bigint"


@dataclass(frozen=True)
class Expectation:
    table: str
    test: str                  # not_null | unique | accepted_values
    columns: tuple[str, ...]
    values: tuple = ()


def _declared(table: str, not_null: str = "", unique: Sequence[str] = (), **accepted: tuple) -> list[Expectation]:
    """Expectations of one table: required columns (space-separated), keys, and lists of values by column."""
    return ([Expectation(table, "not_null", (c,)) for c in not_null.split()]
            + [Expectation(table, "unique", tuple(k.split())) for k in unique]
            + [Expectation(table, "accepted_values", (c,), v) for c, v in accepted.items()])


# Domains of decoded columns.
YES_NO = ("SIM", "NÃO")
STATES = ("ATIVO", "INATIVO")
STATES_OR_UNKNOWN = ("ATIVO", "INATIVO", "NÃO INFORMADO")
TAX_REGIMES = ("MEI", "SIMPLES NACIONAL", "REGIME NORMAL (REAL/PRESUMIDO)", "NÃO INFORMADO")
INDICATORS = ("IPCA_GERAL", "IPCA_ALIMENTOS_BEBIDAS", "PMC_HIPER_SUPER_INDICE", "PMC_HIPER_SUPER_VAR_ANUAL")

# The expectations declared for the gold models.
GOLD = [
    *_declared("fato_entrada", "empresa_id dta_entrada dta_emissao produto_id fornecedor_id nro_documento cod_geral_oper "
                               "carregado_em"),
    *_declared("fato_venda", "datahora_venda data_venda empresa_id documento_numero documento_chave cod_operacao produto_id "
                             "carregado_em", cod_operacao=(800, 810, 820, 828, 202)),
    *_declared("mart_tempo_entrega_fornecedor", "fornecedor_id empresa_id carregado_em"),
    *_declared("mart_meta_participacao_historica", "mes anos_historico empresa_id participacao_loja_normalizada "
               "participacao_categoria_normalizada carregado_em", ["mes anos_historico empresa_id categoria_id"]),
    *_declared("mart_meta_comercial", "meta_padrao_valor meta_desafio_valor carregado_em", ["mes empresa_id categoria_id"]),
    *_declared("mart_meta_referencia_grupo", "mes carregado_em", ["mes"],
               tipo_linha=("REALIZADO", "EM ANDAMENTO", "PROJEÇÃO")),
    *_declared("mart_curva_abc", "empresa_id produto_id carregado_em", ["empresa_id produto_id"]),
    *_declared("dim_empresa_info", "empresa_id loja status_empresa carregado_em", ["empresa_id", "loja"],
               status_empresa=("ATIVA", "INATIVA")),
    *_declared("dim_produto_info", "produto_id produto familia_id carregado_em", ["produto_id"]),
    *_declared("dim_produto_empresa", "produto_id empresa_id status_compra carregado_em",
               status_compra=STATES_OR_UNKNOWN),
    *_declared("dim_fornecedor_info", "fornecedor_id carregado_em", ["fornecedor_id"]),
    *_declared("dim_fornecedor_tributario", "fornecedor_id carregado_em", ["fornecedor_id"], regime_tributario=TAX_REGIMES),
    *_declared("fato_estoque_movimento", "movimento_id empresa_id dta_movimento produto_id carregado_em", ["movimento_id"]),
    *_declared("fato_pedido_compra", "pedido_id empresa_id produto_id dta_emissao carregado_em"),
    *_declared("fato_estoque_saldo_diario", "dta_movimento empresa_id produto_id carregado_em"),
]

# The expectations declared for the silver models, by raw table.
SILVER = [
    *_declared("maxv_abcentradabase", "empresa_id dta_entrada dta_emissao produto_id fornecedor_id nro_documento "
                                      "cod_geral_oper carregado_em"),
    *_declared("maxv_abcdistribbase", "datahora_venda data_venda hora_venda empresa_id documento_numero documento_chave "
                                      "cod_operacao produto_id carregado_em"),
    *_declared("max_empresa", "empresa_id razao_social status_empresa carregado_em", ["empresa_id"],
               status_empresa=("ATIVA", "INATIVA")),
    *_declared("vw_pdv", "empresa_id checkout_id pdv_ativo carregado_em", pdv_ativo=YES_NO),
    *_declared("map_produto", "produto_id produto produto_id_nome familia_id carregado_em", ["produto_id"]),
    *_declared("map_familia", "familia_id familia familia_id_nome carregado_em", ["familia_id"]),
    *_declared("map_marca", "marca_id marca status_marca carregado_em", ["marca_id"]),
    *_declared("map_prodcodigo", "produto_id tipo_codigo carregado_em"),
    *_declared("etlv_categoria", "familia_id divisao_id carregado_em", ["familia_id"]),
    *_declared("ge_pessoa", "pessoa_id nome_razao status pessoa_tipo carregado_em", ["pessoa_id"],
               status=STATES, pessoa_tipo=("FÍSICA", "JURÍDICA")),
    *_declared("mrl_promocao", "promocao_id empresa_id segmento_id dta_inicio dta_fim carregado_em"),
    *_declared("mrl_promocaoitem", "produto_id qtd_embalagem promocao_id empresa_id segmento_id status carregado_em",
               status=STATES_OR_UNKNOWN),
    *_declared("mrl_prodempseg", "produto_id qtd_embalagem segmento_id empresa_id status_venda carregado_em",
               status_venda=STATES_OR_UNKNOWN),
    *_declared("mrl_produtoempresa", "produto_id empresa_id status_compra carregado_em", status_compra=STATES_OR_UNKNOWN),
    *_declared("maf_fornecdivisao", "divisao_id fornecedor_id status_fornecedor carregado_em",
               status_fornecedor=(*STATES, "OUTRO")),
    *_declared("map_famfornec", "familia_id fornecedor_id fornecedor_principal carregado_em", fornecedor_principal=YES_NO),
    *_declared("mad_segmento", "divisao_id segmento_id segmento status carregado_em", status=STATES),
    *_declared("madv_origempedido", "origempedido_id origempedido carregado_em", ["origempedido_id"]),
    *_declared("madv_situacaoped", "situacaoped_id situacaoped carregado_em", ["situacaoped_id"]),
    *_declared("madv_tippedido", "tippedido_id tippedido carregado_em", ["tippedido_id"]),
    *_declared("mrl_local", "empresa_id local_id carregado_em"),
    *_declared("mrl_lanctoestoque", "movimento_id empresa_id dta_movimento produto_id carregado_em", ["movimento_id"],
               tip_lancto=("E", "S")),
    *_declared("msu_pedidosuprim", "pedido_id empresa_id dta_emissao carregado_em", ["pedido_id"]),
    *_declared("msu_psitemreceber", "pedido_id empresa_id produto_id carregado_em"),
    *_declared("mrl_custodia", "produto_id dta_movimento empresa_id carregado_em"),
    *_declared("cnpj_dados_receita", "cnpj carregado_em", ["cnpj"], regime_tributario=TAX_REGIMES),
    *_declared("indicadores_mercado_externo", "data_referencia indicador valor", indicador=INDICATORS),
    *_declared("meta_parametros", "mes meta_grupo_padrao_valor", ["mes"]),
    *_declared("meta_ajustes_loja", "mes empresa_id"),
]


def _code(name: str):
    """Staging of an order-module code table."""
    return lambda src: silver.code_table(src, src.columns[0], src.columns[1], f"{name}_id", name)


def silver_tables(w: Warehouse) -> dict[str, DataFrame]:
    """The staged form of every raw table that has expectations."""
    as_of = w.run_ts.date() if w.run_ts else dt.date.today()
    staging = {
        "maxv_abcentradabase": silver.receipt_lines, "maxv_abcdistribbase": silver.sales_lines,
        "max_empresa": silver.stores, "vw_pdv": silver.checkouts, "map_produto": silver.products,
        "map_familia": silver.families, "map_marca": silver.brands, "map_prodcodigo": silver.barcodes,
        "etlv_categoria": silver.categories, "ge_pessoa": silver.persons, "mrl_promocao": silver.promotions,
        "mrl_promocaoitem": silver.promotion_items, "mrl_prodempseg": silver.prices,
        "mrl_produtoempresa": lambda src: silver.product_store(src, as_of),
        "maf_fornecdivisao": silver.supplier_divisions, "map_famfornec": silver.family_suppliers,
        "mad_segmento": silver.segments, "madv_origempedido": _code("origempedido"),
        "madv_situacaoped": _code("situacaoped"), "madv_tippedido": _code("tippedido"), "mrl_local": silver.locations,
        "mrl_lanctoestoque": silver.stock_ledger, "msu_pedidosuprim": silver.order_headers,
        "msu_psitemreceber": silver.order_items, "mrl_custodia": silver.stock_daily,
    }
    plans = {name: stage(w.raw(name)) for name, stage in staging.items()}
    plans["meta_parametros"] = targets.target_params(w.raw("meta_parametros"))
    plans["meta_ajustes_loja"] = targets.store_adjustments(w.raw("meta_ajustes_loja"))
    plans["cnpj_dados_receita"] = enrich.registry_silver(w.raw("cnpj_dados_receita"))
    plans["indicadores_mercado_externo"] = w.raw("indicadores_mercado_externo")
    return plans


def _violation(e: Expectation):
    column = F.col(e.columns[0])
    bad = column.isNull() if e.test == "not_null" else ~column.isin(list(e.values))   # NULL is accepted by a list
    return F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long")


def _row(table: str, test: str, columns: Sequence[str]):
    return [F.lit(table).alias("tabela"), F.lit(test).alias("teste"), F.lit(",".join(columns)).alias("colunas")]


def violations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation on ``df``. A declared column that the table lacks is an
    ``absent`` row with one violation instead: it neither passes nor stops the run."""
    present = {c.lower() for c in df.columns}
    absent = [e for e in expectations if not {c.lower() for c in e.columns} <= present]
    held = [e for e in expectations if e not in absent]
    parts = []
    by_column = [e for e in held if e.test != "unique"]
    if by_column:
        counts = df.agg(*[_violation(e).alias(f"v{i}") for i, e in enumerate(by_column)])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(*_row(e.table, e.test, e.columns), F.col(f"v{i}").alias("violacoes"))
            for i, e in enumerate(by_column)]))))
    for e in held:
        if e.test == "unique":
            keyed = df.dropna(subset=list(e.columns)) if len(e.columns) == 1 else df
            parts.append(checks.unique(keyed, list(e.columns)).agg(F.count(F.lit(1)).alias("violacoes"))
                         .select(*_row(e.table, e.test, e.columns), "violacoes"))
    if absent:
        rows = [(e.table, f"{e.test} (absent)", ",".join(e.columns), 1) for e in absent]
        parts.append(df.sparkSession.createDataFrame(rows, RESULT))
    return reduce(DataFrame.unionByName, parts)


def _by_table(expectations: Sequence[Expectation]) -> dict[str, list[Expectation]]:
    tables: dict[str, list[Expectation]] = {}
    for e in expectations:
        tables.setdefault(e.table, []).append(e)
    return tables


def run_silver(w: Warehouse) -> DataFrame:
    """The expectations of the staged tables, plus the zero-sum of the store adjustments."""
    tables = silver_tables(w)
    parts = [violations(tables[name], declared) for name, declared in _by_table(SILVER).items()]
    unbalanced = checks.sums_to_zero(tables["meta_ajustes_loja"], ["mes"], "ajuste_padrao_valor")
    parts.append(unbalanced.agg(F.count(F.lit(1)).alias("violacoes")).select(
        *_row("meta_ajustes_loja", "zero_sum", ["ajuste_padrao_valor"]), "violacoes"))
    return reduce(DataFrame.unionByName, parts).select(
        F.lit("silver").alias("camada"), "tabela", "teste", "colunas", "violacoes")


def run_gold(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The expectations of the gold tables present in ``out``, plus the reconciliation of the allocation."""
    from shelfspark.operators.incremental import existing_table
    parts = []
    for name, declared in _by_table(GOLD).items():
        stored = existing_table(spark, f"{out}/gold/{name}")
        if stored is not None:
            parts.append(violations(stored, declared))
    alloc = existing_table(spark, f"{out}/gold/mart_meta_comercial")
    if alloc is not None:
        params = targets.target_params(Warehouse(spark, sf_dir).raw("meta_parametros"))
        missed = checks.reconciles(alloc, params, ["mes"], [("meta_padrao_valor", "meta_grupo_padrao_valor"),
                                                             ("meta_desafio_valor", "meta_grupo_desafio_valor")])
        parts.append(missed.agg(F.count(F.lit(1)).alias("violacoes")).select(
            *_row("mart_meta_comercial", "reconciliation", ["meta_padrao_valor", "meta_desafio_valor"]), "violacoes"))
    result = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RESULT)
    return result.select(F.lit("gold").alias("camada"), "tabela", "teste", "colunas", "violacoes")


def run(spark: SparkSession, sf_dir: str, out: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per expectation: the staged tables of the run and the stored gold tables of ``out``."""
    ts = run_ts or dt.datetime.now().replace(microsecond=0)
    return run_silver(Warehouse(spark, sf_dir, run_ts=ts)).unionByName(run_gold(spark, sf_dir, out))
