"""Build the warehouse into a folder, layer by layer (the nightly "cold" run).

``MODELS`` lists the gold tables in dependency order with their tags (facts
first: the marts and the calendar read the stored facts); a run writes each
selected table under ``<out>/gold/<name>``:

* facts are merged into month-partitioned tables with the keyed
  delete+insert (first run: plain write), so history outside the extract
  window is kept; on later runs only rows dated on or after the earliest
  date of the raw extract are taken;
* dimensions and marts are rebuilt (overwrite);
* models tagged ``monthly`` (ABC, delivery time) are skipped by default, as
  in the daily schedule, and built when selected;
* the target allocation reads the *stored* participation table, so
  re-allocating a new target never scans the sales fact.

This is a plain ordered list of Spark jobs, not a scheduler: each table is
one Spark job planned by Catalyst/AQE; models of one wave may be submitted
concurrently from a small thread pool.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import publish
from shelfspark.operators.incremental import (existing_table, full_refresh, load_delete_insert, read_table, since_batch_start,
                                              table_exists)
from shelfspark.plans import calendar as cal
from shelfspark.plans import dims, enrich, extracts, facts, marts, silver, targets
from shelfspark.plans.warehouse import UNSTAMPED, Warehouse
from shelfspark.session import checkpoint_dir
from shelfspark.sources import seeds

MONTH_COL = "mes_part"
FACT_SORT = ("empresa_id", "produto_id")  # row-group statistics for store / product filters


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Warehouse, str], DataFrame]
    tags: tuple[str, ...] = ()
    key: tuple[str, ...] = ()          # set for incremental facts
    date_col: str | None = None        # month partition source for facts
    window_only_source: bool = False   # refuse a full rebuild
    partition_from_key: bool = False   # the month is a function of the key
    source_date: tuple[str, str] | None = None   # (raw table, raw date column) for the incremental filter
    wave: int = 0                      # models of one wave do not read each other (built concurrently)


def _month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH_COL, (F.year(date_col) * 100 + F.month(date_col)).cast("int"))


def _stored(w: Warehouse, out: str, name: str) -> DataFrame:
    return read_table(w.spark, f"{out}/gold/{name}")


def _allocation(w: Warehouse, out: str) -> DataFrame:
    return targets.allocation(_stored(w, out, "mart_meta_participacao_historica"),
                              targets.target_params(w.raw("meta_parametros")),
                              targets.store_adjustments(w.raw("meta_ajustes_loja")))


def _participation(w: Warehouse, out: str) -> DataFrame:
    first = w.sales_fact.agg(F.trunc(F.max("data_venda"), "MM").alias("m")).first()["m"]
    return targets.shares(w.sales_fact, w.product_category, w.store_dim, first)


def _writeback(w: Warehouse, out: str) -> DataFrame:
    """Post-step of the allocation: update the planning adjustments table.

    Reads the stored adjustments (the raw table on the first run), applies the
    write-back with the stored allocation and materialises the result, so the
    table can then be overwritten in place."""
    current = existing_table(w.spark, f"{out}/gold/meta_ajustes_loja")
    if current is None:
        current = w.raw("meta_ajustes_loja")
    new = targets.writeback(_stored(w, out, "mart_meta_comercial"), targets.target_params(w.raw("meta_parametros")),
                            current)
    checkpoint_dir(w.spark)
    return new.checkpoint(eager=True)


def product_store(w: Warehouse, delivery: DataFrame, abc: DataFrame) -> DataFrame:
    """Product x store snapshot as of the newest sale, from the given delivery-time and ABC marts."""
    as_of = w.sales_fact.agg(F.max("data_venda").alias("d")).first()["d"]
    return dims.product_store_snapshot(
        silver.product_store(w.raw("mrl_produtoempresa"), as_of), w.store_dim, silver.prices(w.raw("mrl_prodempseg")),
        w.product_dim, dims.last_receipt_supplier(w.receipts_fact, marts.PURCHASE_OPERATIONS), delivery, abc,
        dims.active_promotion(silver.promotion_items(extracts.unit_packs(w.raw("mrl_promocaoitem"))),
                              silver.promotions(w.raw("mrl_promocao")), as_of), as_of)


def _product_store(w: Warehouse, out: str) -> DataFrame:
    """Reads the monthly marts as stored; before their first build they are computed."""
    delivery = existing_table(w.spark, f"{out}/gold/mart_tempo_entrega_fornecedor")
    abc = existing_table(w.spark, f"{out}/gold/mart_curva_abc")
    return product_store(w, marts.delivery_time(w.receipts_fact, w.supplier_dim) if delivery is None else delivery,
                         marts.abc_curve(w.sales_fact, w.product_category) if abc is None else abc)


def _upserted(name: str, refresh: Callable, landed: str) -> Callable[[Warehouse, str], DataFrame]:
    """A table that landed rows are merged into: read as stored (the raw one on the first run), then replaced by one commit."""
    def run(w: Warehouse, out: str) -> DataFrame:
        current = existing_table(w.spark, f"{out}/gold/{name}")
        return refresh(w.raw(name) if current is None else current, w.raw(landed))
    return run


MODELS: list[Model] = [
    Model("fato_venda", lambda w, o: w.sales_fact, key=tuple(facts.SALES_KEY), date_col="data_venda",
          partition_from_key=True, source_date=("maxv_abcdistribbase", "datahora")),
    Model("fato_entrada", lambda w, o: w.receipts_fact, key=tuple(facts.RECEIPTS_KEY), date_col="dta_entrada",
          partition_from_key=True, source_date=("maxv_abcentradabase", "dtaentrada")),
    Model("fato_estoque_movimento", lambda w, o: facts.stock_movement_fact(w.stock_ledger, w.locations),
          key=tuple(facts.STOCK_MOVEMENT_KEY), date_col="dta_movimento",
          source_date=("mrl_lanctoestoque", "dtaentradasaida")),
    Model("fato_estoque_saldo_diario", lambda w, o: facts.stock_balance_fact(w.stock_daily),
          key=tuple(facts.STOCK_BALANCE_KEY), date_col="dta_movimento", partition_from_key=True,
          source_date=("mrl_custodia", "dtaentradasaida")),
    Model("fato_pedido_compra", lambda w, o: facts.purchase_order_fact(w.order_headers, w.order_items),
          key=tuple(facts.PURCHASE_ORDER_KEY), date_col="dta_emissao", window_only_source=True,
          source_date=("msu_pedidosuprim", "dtaemissao")),
    Model("dim_calendario", lambda w, o: cal.calendar_from_facts(w.spark, w.sales_fact, seeds.fixed_holidays(w.spark)),
          wave=1),
    Model("dim_hora", lambda w, o: cal.hour_dim(w.spark), wave=1),
    Model("dim_empresa_info", lambda w, o: w.store_dim, wave=1),
    Model("dim_produto_info", lambda w, o: w.product_dim, wave=1),
    Model("dim_fornecedor_info", lambda w, o: w.supplier_dim, wave=1),
    Model("cnpj_dados_receita", _upserted("cnpj_dados_receita", enrich.refresh_registry, "cnpj_respostas"), wave=1),
    Model("indicadores_mercado_externo", _upserted("indicadores_mercado_externo", enrich.refresh_indicators, "indicadores_payload"),
          wave=1),
    Model("dim_fornecedor_tributario", lambda w, o: enrich.supplier_tax_dim(w.supplier_dim, _stored(w, o, "cnpj_dados_receita")),
          wave=2),
    Model("dim_produto_empresa", _product_store, wave=3),
    Model("mart_tempo_entrega_fornecedor", lambda w, o: marts.delivery_time(w.receipts_fact, w.supplier_dim),
          tags=("monthly",), wave=2),
    Model("mart_curva_abc", lambda w, o: marts.abc_curve(w.sales_fact, w.product_category), tags=("monthly",),
          wave=2),
    Model("mart_meta_participacao_historica", _participation, wave=2),
    Model("mart_meta_comercial", _allocation, wave=3),
    Model("meta_ajustes_loja", _writeback, wave=4),
    Model("mart_meta_referencia_grupo", lambda w, o: targets.group_reference(
        w.sales_fact, w.store_dim, _stored(w, o, "indicadores_mercado_externo")), wave=2),
]


def selected(select: Iterable[str] | None, exclude_tags: Iterable[str]) -> list[Model]:
    names = set(select) if select else None
    skip = set(exclude_tags)
    return [m for m in MODELS
            if (names is not None and m.name in names) or (names is None and not (skip & set(m.tags)))]


def _build_one(spark: SparkSession, sf_dir: str, out: str, m: Model, refresh: set[str],
               run_ts: dt.datetime | None = None) -> str:
    # facts come from the current extract; every later model reads the stored facts
    if m.key:
        w = Warehouse(spark, sf_dir, run_ts=run_ts)
    else:  # dimensions are built from the sources; later waves read the stored dimensions
        w = Warehouse(spark, sf_dir, stored=out, stored_dims=m.wave >= 2, run_ts=run_ts)
    df = m.build(w, out)
    if run_ts is not None and m.name not in UNSTAMPED and not m.key:
        df = df.withColumn("carregado_em", F.lit(run_ts).cast("timestamp_ntz"))
    path = f"{out}/gold/{m.name}"
    if m.key:
        first_load = not exists(spark, out, m.name)
        if m.source_date:
            raw_table, raw_col = m.source_date
            df = since_batch_start(df, w.raw(raw_table), m.date_col, F.to_date(raw_col), first_load)
        rows = _month(df, m.date_col)
        if m.name in refresh:
            full_refresh(spark, path, rows, MONTH_COL, m.window_only_source, FACT_SORT)
        else:
            load_delete_insert(spark, path, rows, list(m.key), MONTH_COL, partition_from_key=m.partition_from_key,
                               sort_cols=FACT_SORT)
    else:
        publish.overwrite(df, path)
    return m.name


def build(spark: SparkSession, sf_dir: str, out: str, select: Iterable[str] | None = None,
          exclude_tags: Iterable[str] = ("monthly",), full_refresh_models: Iterable[str] = (),
          parallelism: int = 1, run_ts: dt.datetime | None = None) -> list[str]:
    """Build the selected models into ``out``; returns the names written.

    Models run wave by wave (facts, dimensions, marts, allocation); inside a
    wave up to ``parallelism`` models are submitted as concurrent Spark jobs
    from a thread pool (the reference builds four models at a time).
    ``run_ts`` is the load time that every row written by the run carries in
    ``carregado_em``; without it the column is NULL in facts and absent elsewhere.
    """
    refresh = set(full_refresh_models)
    models = selected(select, exclude_tags)
    done: list[str] = []
    for wave in sorted({m.wave for m in models}):
        batch = [m for m in models if m.wave == wave]
        if parallelism > 1 and len(batch) > 1:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                done += list(pool.map(lambda m: _build_one(spark, sf_dir, out, m, refresh, run_ts), batch))
        else:
            done += [_build_one(spark, sf_dir, out, m, refresh, run_ts) for m in batch]
    return done


def table_paths(out: str) -> dict[str, str]:
    return {m.name: f"{out}/gold/{m.name}" for m in MODELS}


def exists(spark: SparkSession, out: str, name: str) -> bool:
    return table_exists(spark, f"{out}/gold/{name}")
