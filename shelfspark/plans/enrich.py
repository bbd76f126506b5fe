"""Enrichment jobs over landed API payloads: company registry and market indicators.

The calls to the public APIs are not made here; their answers are landed as
rows (id, source, HTTP status, JSON text) and parsed with ``from_json`` and
explicit schemas, then merged with ``upsert``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import opt
from shelfspark.operators.dedup import first_per_key
from shelfspark.operators.incremental import upsert

# Registry sources in the order they are asked; markers of a
# missing value in the statistics office's series.
REGISTRY_SOURCES = ["minha_receita", "brasilapi"]
MISSING_MARKERS = ["", "..", "-"]
IPCA = "IPCA_ALIMENTOS_BEBIDAS"
PMC = "PMC_HIPER_SUPER_VAR_ANUAL"

REGISTRY_SCHEMA = ("situacao_cadastral LONG, descricao_situacao_cadastral STRING, opcao_pelo_simples BOOLEAN, "
                   "opcao_pelo_mei BOOLEAN, porte STRING, descricao_porte STRING, data_opcao_pelo_simples STRING, "
                   "data_opcao_pelo_mei STRING, capital_social DECIMAL(18,2), "
                   "data_inicio_atividade STRING, cnae_fiscal LONG, cnae_fiscal_descricao STRING")
BCB_SCHEMA = "data STRING, valor STRING"
IBGE_SCHEMA = "id STRING, resultados ARRAY<STRUCT<series: ARRAY<STRUCT<serie: MAP<STRING, STRING>>>>>"

REGISTRY_COLUMNS = ["cnpj", "situacao_cadastral", "descricao_situacao_cadastral", "opcao_pelo_simples",
                    "opcao_pelo_mei", "data_opcao_pelo_simples", "data_opcao_pelo_mei", "porte", "descricao_porte", "capital_social", "data_inicio_atividade", "cnae_fiscal",
                    "cnae_fiscal_descricao", "fonte_api"]


def pending_registry(supplier_dimension: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Distinct 14-digit legal-entity ids to look up: all (full run) or not yet stored."""
    ids = (supplier_dimension.where((F.col("pessoa_tipo") == "JURÍDICA") & (F.length("cnpj_cpf") == 14))
           .select(F.col("cnpj_cpf").alias("cnpj")).distinct())
    return ids if stored is None else ids.join(stored.select("cnpj"), "cnpj", "left_anti")


def registry_rows(answers: DataFrame) -> DataFrame:
    """One registry row per id: the first source (in asking order) that answered;
    a re-sent answer of the same source replaces the earlier one."""
    ok = answers.where(F.col("status_http") == 200)
    prio = F.array_position(F.array(*map(F.lit, REGISTRY_SOURCES)), F.col("fonte_api"))
    best = first_per_key(ok.withColumn("_prio", prio), ["cnpj"], [F.col("_prio").asc(), F.col("seq").desc()])
    p = F.from_json("payload", REGISTRY_SCHEMA)
    return best.select(
        "cnpj",
        p["situacao_cadastral"].cast("string").alias("situacao_cadastral"),
        p["descricao_situacao_cadastral"].alias("descricao_situacao_cadastral"),
        p["opcao_pelo_simples"].alias("opcao_pelo_simples"),
        p["opcao_pelo_mei"].alias("opcao_pelo_mei"),
        F.to_date(p["data_opcao_pelo_simples"]).alias("data_opcao_pelo_simples"),
        F.to_date(p["data_opcao_pelo_mei"]).alias("data_opcao_pelo_mei"),
        p["porte"].alias("porte"), p["descricao_porte"].alias("descricao_porte"),
        p["capital_social"].alias("capital_social"),
        F.to_date(p["data_inicio_atividade"]).alias("data_inicio_atividade"),
        p["cnae_fiscal"].cast("string").alias("cnae_fiscal"),
        p["cnae_fiscal_descricao"].alias("cnae_fiscal_descricao"),
        "fonte_api")


def refresh_registry(stored: DataFrame, answers: DataFrame) -> DataFrame:
    # registry_rows has one row per id already
    return upsert(stored.select(*REGISTRY_COLUMNS), registry_rows(answers), ["cnpj"], [F.col("fonte_api")])


def registry_silver(registry: DataFrame) -> DataFrame:
    """Tax regime by precedence: MEI, then SIMPLES, then normal regime, else unknown."""
    mei, simples = F.col("opcao_pelo_mei"), F.col("opcao_pelo_simples")
    regime = (F.when(mei.eqNullSafe(True), "MEI").when(simples.eqNullSafe(True), "SIMPLES NACIONAL")
               .when(simples.eqNullSafe(False), "REGIME NORMAL (REAL/PRESUMIDO)").otherwise("NÃO INFORMADO"))
    return registry.select(
        "cnpj", F.upper("situacao_cadastral").alias("situacao_cadastral"),
        F.upper("descricao_situacao_cadastral").alias("descricao_situacao_cadastral"), "opcao_pelo_simples", "opcao_pelo_mei",
        regime.alias("regime_tributario"), F.col("data_opcao_pelo_simples").cast("date").alias("data_opcao_pelo_simples"),
        F.col("data_opcao_pelo_mei").cast("date").alias("data_opcao_pelo_mei"), F.upper("porte").alias("porte"),
        F.col("capital_social").cast("decimal(18,2)").alias("capital_social"),
        F.col("data_inicio_atividade").cast("date").alias("data_inicio_atividade"),
        "cnae_fiscal", F.upper("cnae_fiscal_descricao").alias("cnae_fiscal_descricao"),
        F.upper("fonte_api").alias("fonte_api"), opt(registry, "_loaded_at", "timestamp_ntz").alias("carregado_em"))


def supplier_tax_dim(supplier_dimension: DataFrame, registry: DataFrame) -> DataFrame:
    """Legal-entity suppliers with their registry data (inner join on the taxpayer id)."""
    sup = supplier_dimension.where(F.col("pessoa_tipo") == "JURÍDICA").select("fornecedor_id", "cnpj_cpf")
    r = registry_silver(registry)
    return sup.join(r, sup["cnpj_cpf"] == r["cnpj"]).select(
        "fornecedor_id", "cnpj", "descricao_situacao_cadastral", "regime_tributario", "data_opcao_pelo_simples", "data_opcao_pelo_mei",
        "porte", "capital_social", "data_inicio_atividade", "cnae_fiscal", "cnae_fiscal_descricao")


def _value(c) -> F.Column:
    return F.when(~c.isin(MISSING_MARKERS), c.cast("decimal(18,4)"))


def indicator_rows(payloads: DataFrame) -> DataFrame:
    """Central-bank and statistics-office payloads to (load sequence, month, indicator, value, source).

    Central-bank rows are {data: dd/MM/yyyy, valor}; statistics-office rows nest
    results -> series -> a map period (YYYYMM) -> value, walked with
    ``explode``. Missing-value markers are skipped.
    """
    bcb = (payloads.where(F.col("fonte") == "BCB").select("seq", F.from_json("payload", BCB_SCHEMA).alias("p"))
           .select("seq", F.to_date(F.col("p.data"), "dd/MM/yyyy").alias("data_referencia"), F.lit(IPCA).alias("indicador"),
                   F.col("p.valor").alias("v"), F.lit("BCB").alias("fonte")))
    ibge = (payloads.where(F.col("fonte") == "IBGE").select("seq", F.from_json("payload", IBGE_SCHEMA).alias("p"))
            .select("seq", F.explode("p.resultados").alias("r"))
            .select("seq", F.explode("r.series").alias("s"))
            .select("seq", F.explode("s.serie").alias("periodo", "v"))
            .select("seq", F.to_date(F.concat("periodo", F.lit("01")), "yyyyMMdd").alias("data_referencia"),
                    F.lit(PMC).alias("indicador"), "v", F.lit("IBGE").alias("fonte")))
    both = bcb.unionByName(ibge)
    return both.where(~F.col("v").isin(MISSING_MARKERS) & F.col("v").isNotNull()).select(
        "seq", "data_referencia", "indicador", _value(F.col("v")).alias("valor"), "fonte")


def refresh_indicators(stored: DataFrame, payloads: DataFrame) -> DataFrame:
    """Upsert by month and indicator; of several loads the last wins (the larger value if one load repeats itself)."""
    return upsert(stored.select("data_referencia", "indicador", "valor", "fonte"), indicator_rows(payloads),
                  ["data_referencia", "indicador"], [F.col("seq").desc(), F.col("valor").desc()]).drop("seq")
