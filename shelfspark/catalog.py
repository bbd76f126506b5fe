"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL."""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import oracle
from shelfspark.operators import checks, incremental
from shelfspark.operators.incremental import read_table
from shelfspark.plans import build
from shelfspark.plans import calendar as cal
from shelfspark.plans import dims, enrich, extracts, facts, logs, marts, silver, targets
from shelfspark.plans.marts import PURCHASE_OPERATIONS
from shelfspark.plans.warehouse import Warehouse
from shelfspark.session import apply_conf, checkpoint_dir, scratch_path
from shelfspark.sources import seeds
from shelfspark.streaming import hot

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(Warehouse(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("abc_full", oracle.ABC)
def abc_full(w: Warehouse) -> DataFrame:
    """ABC mart: store, store x category and network classes by value and quantity."""
    return marts.abc_curve(w.sales_fact, w.product_category)


@register("abc_missing_products", oracle.ABC_MISSING_PRODUCTS)
def abc_missing_products(w: Warehouse) -> DataFrame:
    """ABC mart when the product master lacks some of the products sold: their NULL category is a group of its own."""
    entered = dims.product_dim(silver.products(w.raw("map_produto_incompleto")), w.families, w.brands, w.categories)
    return marts.abc_curve(w.sales_fact, entered)


@register("delivery_time", oracle.DELIVERY)
def delivery_time(w: Warehouse) -> DataFrame:
    """Supplier x store delivery-time statistics over the trailing year of receipts."""
    return marts.delivery_time(w.receipts_fact, w.supplier_dim)


# ---------------------------------------------------------------- facts


def _no_stamp(df: DataFrame) -> DataFrame:
    return df.drop("carregado_em")


@register("sales_fact", oracle.SALES_FACT)
def sales_fact(w: Warehouse) -> DataFrame:
    """Sales fact: operation filter, document key, operator sentinel, net measures."""
    return _no_stamp(w.sales_fact)


@register("receipts_fact", oracle.RECEIPTS_FACT)
def receipts_fact(w: Warehouse) -> DataFrame:
    """Receipts fact with issue-to-receipt delivery days."""
    return _no_stamp(w.receipts_fact)


@register("stock_movement", oracle.STOCK_MOVEMENT)
def stock_movement(w: Warehouse) -> DataFrame:
    """Signed stock movements enriched with the store location."""
    return _no_stamp(facts.stock_movement_fact(w.stock_ledger, w.locations))


@register("stock_balance", oracle.STOCK_BALANCE)
def stock_balance(w: Warehouse) -> DataFrame:
    """Daily stock balance: closing = opening + in - out."""
    return _no_stamp(facts.stock_balance_fact(w.stock_daily))


@register("purchase_order", oracle.PURCHASE_ORDER)
def purchase_order(w: Warehouse) -> DataFrame:
    """Purchase-order items joined to headers; lead time; pending-reason precedence."""
    return _no_stamp(facts.purchase_order_fact(w.order_headers, w.order_items))


# ---------------------------------------------------------------- dimensions

@register("store_dim", oracle.STORE_DIM)
def store_dim(w: Warehouse) -> DataFrame:
    """Store dimension: city-ordinal labels, active checkouts, closed-store override."""
    return w.store_dim


@register("product_dim", oracle.PRODUCT_DIM)
def product_dim(w: Warehouse) -> DataFrame:
    """Product dimension with defaults, category hierarchy, barcodes and main supplier."""
    return w.product_dim


@register("supplier_dim", oracle.SUPPLIER_DIM)
def supplier_dim(w: Warehouse) -> DataFrame:
    """Supplier dimension: first family link, preferred commercial terms, person data."""
    return w.supplier_dim


@register("barcode_list", oracle.BARCODE_LIST)
def barcode_list(w: Warehouse) -> DataFrame:
    """Ordered string aggregation of each product's EAN / scale codes."""
    return dims.barcode_list(w.barcodes)


@register("priority_dedup", oracle.PRIORITY_DEDUP)
def priority_dedup(w: Warehouse) -> DataFrame:
    """Category row per family by division priority (row_number = 1)."""
    return w.categories.drop("carregado_em")


@register("hours", oracle.HOURS)
def hours(w: Warehouse) -> DataFrame:
    """Hour-of-day dimension (24 rows, day period, AM/PM) with the number of sales-fact
    lines in each hour (left join of the dimension to a partial aggregate of the fact)."""
    per_hour = w.sales_fact.groupBy(F.col("hora_venda").alias("hora_num")).agg(F.count(F.lit(1)).alias("qtd_linhas"))
    return cal.hour_dim(w.spark).join(per_hour, "hora_num", "left").select(
        "hora_num", "hora_texto", "periodo", "am_pm", F.coalesce("qtd_linhas", F.lit(0)).alias("qtd_linhas"))


@register("calendar", oracle.CALENDAR)
def calendar(w: Warehouse) -> DataFrame:
    """Day dimension over the sales data's years: holidays (fixed + Easter-based), ISO
    week, business days, month bands and per-month open-day sequence / countdown."""
    return cal.calendar_from_facts(w.spark, w.sales_fact, seeds.fixed_holidays(w.spark))


# ---------------------------------------------------------------- target planning


def _plan_month(w: Warehouse):
    """Month being planned = month of the newest sale (stands in for today's month)."""
    return w.sales_fact.agg(F.trunc(F.max("data_venda"), "MM").alias("m")).first()["m"]


def _shares(w: Warehouse) -> DataFrame:
    return targets.shares(w.sales_fact, w.product_category, w.store_dim, _plan_month(w))


def _params(w: Warehouse) -> DataFrame:
    return targets.target_params(w.raw("meta_parametros"))


def _stored(df: DataFrame) -> DataFrame:
    """Materialise a mart that later steps read more than once (as the stored table
    they read in production), via a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _allocation(w: Warehouse) -> DataFrame:
    return targets.allocation(_stored(_shares(w)), _params(w), targets.store_adjustments(w.raw("meta_ajustes_loja")))


@register("participation", oracle.PARTICIPATION)
def participation(w: Warehouse) -> DataFrame:
    """Historical store and category shares per target month and history depth, to ten places."""
    return targets.participation(w.sales_fact, w.product_category, w.store_dim, _plan_month(w))


@register("target_allocation", oracle.ALLOCATION)
def target_allocation(w: Warehouse) -> DataFrame:
    """Group target allocated to store x category (standard and challenge)."""
    return _allocation(w)


@register("target_writeback", oracle.WRITEBACK)
def target_writeback(w: Warehouse) -> DataFrame:
    """Adjustments table after updating calculated columns and inserting missing stores."""
    return targets.writeback(_stored(_allocation(w)), _params(w), w.raw("meta_ajustes_loja"))


@register("group_reference", oracle.GROUP_REFERENCE)
def group_reference(w: Warehouse) -> DataFrame:
    """Monthly like-for-like revenue, YoY growth, 6-month mean, suggestion and market context."""
    return targets.group_reference(w.sales_fact, w.store_dim, w.raw("indicadores_mercado_externo"))


# ---------------------------------------------------------------- incremental loads


WINDOW_DAYS = 90       # re-extracted window of the batch
HISTORY_LAG_DAYS = 30  # the stored history ends this many days before the newest sale


def _incremental_inputs(w: Warehouse):
    as_of = w.sales_fact.agg(F.max("data_venda").alias("m")).first()["m"]
    target = w.sales_fact.where(F.col("data_venda") <= F.date_sub(F.lit(as_of), HISTORY_LAG_DAYS))
    batch_lines = silver.sales_lines(
        w.raw("maxv_abcdistribbase_corrigida")
         .where(F.col("datahora") >= F.date_sub(F.lit(as_of), WINDOW_DAYS).cast("timestamp_ntz")))
    batch = facts.sales_fact(batch_lines)
    return _no_stamp(target), _no_stamp(batch)


@register("delete_insert", oracle.DELETE_INSERT)
def delete_insert(w: Warehouse) -> DataFrame:
    """Sales history merged with a corrected, re-sent window (delete+insert on the fact key,
    new column appended)."""
    target, batch = _incremental_inputs(w)
    return incremental.delete_insert(target, batch, facts.SALES_KEY)


@register("delete_insert_twice", oracle.DELETE_INSERT)
def delete_insert_twice(w: Warehouse) -> DataFrame:
    """The same batch applied twice gives the same table as once (idempotent load)."""
    target, batch = _incremental_inputs(w)
    once = incremental.delete_insert(target, batch, facts.SALES_KEY)
    return incremental.delete_insert(once, batch, facts.SALES_KEY)


# ---------------------------------------------------------------- data-quality checks

@register("dq_not_null", oracle.DQ_NOT_NULL)
def dq_not_null(w: Warehouse) -> DataFrame:
    """NULL count of every sales-fact column (single aggregate pass)."""
    return checks.null_counts(_no_stamp(w.sales_fact))


@register("dq_unique", oracle.DQ_UNIQUE)
def dq_unique(w: Warehouse) -> DataFrame:
    """Purchase-order grain (order x store x product) keys that occur more than once."""
    return checks.unique(facts.purchase_order_fact(w.order_headers, w.order_items), facts.PURCHASE_ORDER_KEY)


@register("dq_accepted", oracle.DQ_ACCEPTED)
def dq_accepted(w: Warehouse) -> DataFrame:
    """Purchase-order states outside the decoded labels (NULL passes)."""
    po = facts.purchase_order_fact(w.order_headers, w.order_items)
    return checks.accepted_values(po, "situacao_ped", list(silver.PURCHASE_ORDER_STATES.values()),
                                  ["pedido_id", "empresa_id", "produto_id", "item_seq"])


@register("dq_reconcile", oracle.DQ_RECONCILE)
def dq_reconcile(w: Warehouse) -> DataFrame:
    """Months whose allocated targets do not add up to the group target (+-1.0)."""
    return checks.reconciles(_allocation(w), _params(w), ["mes"],
                             [("meta_padrao_valor", "meta_grupo_padrao_valor"),
                              ("meta_desafio_valor", "meta_grupo_desafio_valor")])


@register("dq_reconcile_exact", oracle.DQ_RECONCILE_EXACT)
def dq_reconcile_exact(w: Warehouse) -> DataFrame:
    """Months whose allocated targets miss the group target at all (the cents that rounding leaves)."""
    return checks.reconciles(_allocation(w), _params(w), ["mes"],
                             [("meta_padrao_valor", "meta_grupo_padrao_valor"),
                              ("meta_desafio_valor", "meta_grupo_desafio_valor")], tol=0.0)


@register("dq_zero_sum_part", oracle.DQ_ZERO_SUM_PART)
def dq_zero_sum_part(w: Warehouse) -> DataFrame:
    """The zero-sum check over adjustments whose months do not cancel out."""
    return checks.sums_to_zero(targets.store_adjustments(w.raw("meta_ajustes_abertos")), ["mes"], "ajuste_padrao_valor")


@register("abc_grain_product", oracle.ABC_GRAIN_PRODUCT)
def abc_grain_product(w: Warehouse) -> DataFrame:
    """Duplicates of the ABC mart at the coarser product grain: products with rows in several stores."""
    return checks.unique(marts.abc_curve(w.sales_fact, w.product_category), ["produto_id"])


@register("dq_zero_sum", oracle.DQ_ZERO_SUM)
def dq_zero_sum(w: Warehouse) -> DataFrame:
    """Months whose manual store adjustments do not sum to zero (+-0.01)."""
    return checks.sums_to_zero(targets.store_adjustments(w.raw("meta_ajustes_loja")), ["mes"],
                               "ajuste_padrao_valor")


@register("abc_grain_unique", oracle.ABC_GRAIN)
def abc_grain_unique(w: Warehouse) -> DataFrame:
    """ABC mart grain (store x product) duplicates: must be empty."""
    return checks.unique(marts.abc_curve(w.sales_fact, w.product_category), ["empresa_id", "produto_id"])


# ---------------------------------------------------------------- extracts


def _max_date(df: DataFrame, col: str):
    return df.agg(F.max(F.col(col).cast("date")).alias("m")).first()["m"]


@register("windowed_extract", oracle.WINDOWED_EXTRACT)
def windowed_extract(w: Warehouse) -> DataFrame:
    """Stock-ledger extract of the last 90 days, stock-changing flag ('S' or NULL), load stamp."""
    src = w.raw("mrl_lanctoestoque")
    as_of = _max_date(src, "dtaentradasaida")
    run_ts = _dt.datetime.combine(as_of + _dt.timedelta(days=1), _dt.time(1, 0))
    return extracts.stamp(extracts.stock_ledger_extract(src, as_of, 90), run_ts)


@register("range_extract", oracle.RANGE_EXTRACT)
def range_extract(w: Warehouse) -> DataFrame:
    """Backfill of sales lines in an inclusive date range on a timestamp column."""
    src = w.raw("maxv_abcdistribbase")
    as_of = _max_date(src, "datahora")
    return extracts.range_extract(src, "datahora", as_of - _dt.timedelta(days=60), as_of - _dt.timedelta(days=30))


@register("range_backfill", oracle.RANGE_BACKFILL)
def range_backfill(w: Warehouse) -> DataFrame:
    """Stored sales lines after a backfill of corrected lines has replaced one date range, run twice."""
    path = scratch_path(w.spark, f"backfill-{_uuid.uuid4().hex}/linhas")
    month = F.date_format("datahora", "yyyyMM").cast("int")
    lines = w.raw("maxv_abcdistribbase")
    as_of = _max_date(lines, "datahora")
    start, end = as_of - _dt.timedelta(days=60), as_of - _dt.timedelta(days=30)
    order = ("datahora", "nroempresa")
    incremental.full_refresh(w.spark, path, lines.withColumn("mes_part", month), "mes_part", False, order)
    fresh = extracts.range_extract(w.raw("maxv_abcdistribbase_corrigida"), "datahora", start, end).withColumn("mes_part", month)
    for _ in range(2):
        incremental.load_range(w.spark, path, fresh, "datahora", start, end, "mes_part", order)
    return read_table(w.spark, path).drop("mes_part")


@register("item_by_header_window", oracle.ITEM_BY_HEADER)
def item_by_header_window(w: Warehouse) -> DataFrame:
    """Purchase-order items whose header was issued in the last 180 days (semi join)."""
    headers = w.raw("msu_pedidosuprim")
    as_of = _max_date(headers, "dtaemissao")
    return extracts.items_in_header_window(w.raw("msu_psitemreceber"), headers, ["nropedidosuprim", "nroempresa"],
                                           "dtaemissao", as_of, 180)


@register("checkout_main_segment", oracle.CHECKOUT_SEGMENT)
def checkout_main_segment(w: Warehouse) -> DataFrame:
    """Checkouts restricted to the store's main segment."""
    return extracts.checkouts_of_main_segment(w.raw("vw_pdv"), w.raw("max_empresa"))


@register("unit_pack_promotions", oracle.UNIT_PACK_PROMOTIONS)
def unit_pack_promotions(w: Warehouse) -> DataFrame:
    """Promotion items of unit packs; other packs stay in the source."""
    return extracts.unit_packs(w.raw("mrl_promocaoitem"))


@register("hourly_sales_preagg", oracle.HOURLY_SALES)
def hourly_sales_preagg(w: Warehouse) -> DataFrame:
    """Sales lines with their joins, summed per hour over ten keys, with the net cost of goods sold."""
    return extracts.hourly_sales(_sales_lines(w))


def _sales_lines(w: Warehouse) -> DataFrame:
    raw = w.raw
    return extracts.sales_lines(raw("vendas_linhas"), raw("custo_dia"), raw("nf_produto"), raw("map_famdivisao"), raw("map_famembalagem"),
                                raw("max_empresa"), raw("max_divisao"), raw("map_prodacresccustorelac"))


@register("receipt_costs_net_of_returns", oracle.RECEIPT_COSTS)
def receipt_costs_net_of_returns(w: Warehouse) -> DataFrame:
    """Receipt gross / net / fiscal cost, invoice total, discounts and weighted term, net of returns."""
    raw = w.raw
    joined = extracts.receipt_lines(raw("receipt_lines"), raw("nf_produto"), raw("map_famdivisao"), raw("mad_famsegmento"),
                                    raw("map_famembalagem"), raw("max_empresa"), raw("max_divisao"), raw("nf_custo_loja"))
    return extracts.receipt_costs(joined)


# ---------------------------------------------------------------- intraday stream


@register("merge_null_months", oracle.MERGE_NULL_MONTHS)
def merge_null_months(w: Warehouse) -> DataFrame:
    """On-disk keyed delete+insert where months and key parts may be NULL and keys move between months."""
    path = scratch_path(w.spark, f"merge-{_uuid.uuid4().hex}/carga")
    for name in ("carga_base", "carga_nova"):
        incremental.load_delete_insert(w.spark, path, w.raw(name), ["documento", "linha"], "mes_part")
    return read_table(w.spark, path)


def land_runs(w: Warehouse, landing: str) -> None:
    """Land the intraday extract runs, one folder per run (``lote=<run>``), in one write."""
    w.raw("vendas_intradia").write.partitionBy("lote").parquet(landing)


@register("hot_microbatch", oracle.HOT_MICROBATCH)
def hot_microbatch(w: Warehouse) -> DataFrame:
    """Structured Streaming over landed intraday runs (availableNow), each micro-batch merged
    into the month-partitioned sales fact with keyed delete+insert; returns the final fact."""
    base = scratch_path(w.spark, f"hot-{_uuid.uuid4().hex}")
    landing, target, ckpt = f"{base}/landing", f"{base}/fato_venda", f"{base}/_checkpoint"
    land_runs(w, landing)
    hot.run_hot_path(w.spark, landing, target, ckpt)
    return _no_stamp(read_table(w.spark, target).drop(hot.PARTITION_COL))


# ---------------------------------------------------------------- run logs and enrichment


WORKFLOW = "workflow_cold"


@register("step_timing", oracle.STEP_TIMING)
def step_timing(w: Warehouse) -> DataFrame:
    """Per-pipeline durations parsed from run logs (regex capture, lag per log file)."""
    return logs.step_timing(w.raw("run_log"), WORKFLOW)


@register("step_timing_top5", oracle.STEP_TOP5)
def step_timing_top5(w: Warehouse) -> DataFrame:
    """The five slowest pipelines of the latest execution and their one-line summary."""
    return logs.slowest_of_latest(logs.step_timing(w.raw("run_log"), WORKFLOW))


@register("pending_registry", oracle.PENDING_REGISTRY)
def pending_registry(w: Warehouse) -> DataFrame:
    """14-digit legal-entity supplier ids not yet in the registry table (anti join)."""
    return enrich.pending_registry(w.supplier_dim, w.raw("cnpj_dados_receita"))


@register("upsert_registry", oracle.UPSERT_REGISTRY)
def upsert_registry(w: Warehouse) -> DataFrame:
    """Registry table after parsing landed answers (source precedence, last re-send wins) and upsert."""
    return enrich.refresh_registry(w.raw("cnpj_dados_receita"), w.raw("cnpj_respostas"))


@register("supplier_tax_dim", oracle.SUPPLIER_TAX_DIM)
def supplier_tax_dim(w: Warehouse) -> DataFrame:
    """Legal-entity suppliers with registry data and tax regime by precedence."""
    registry = enrich.refresh_registry(w.raw("cnpj_dados_receita"), w.raw("cnpj_respostas"))
    return enrich.supplier_tax_dim(w.supplier_dim, registry)


@register("indicator_long", oracle.INDICATOR_LONG)
def indicator_long(w: Warehouse) -> DataFrame:
    """Indicator table after parsing central-bank and nested statistics-office payloads and upsert."""
    return enrich.refresh_indicators(w.raw("indicadores_mercado_externo"), w.raw("indicadores_payload"))


# ---------------------------------------------------------------- product x store snapshot


def _as_of(w: Warehouse):
    """The run's "today": the newest sale date."""
    return w.sales_fact.agg(F.max("data_venda").alias("d")).first()["d"]


@register("days_since", oracle.DAYS_SINCE)
def days_since(w: Warehouse) -> DataFrame:
    """Product x store staging: days of stock (safe ratio) and days since last purchase / sale / entry."""
    return silver.product_store(w.raw("mrl_produtoempresa"), _as_of(w)).drop("carregado_em")


@register("active_promotion", oracle.ACTIVE_PROMOTION)
def active_promotion(w: Warehouse) -> DataFrame:
    """Promotion in force per product x store x segment (item dates override header, soonest end wins)."""
    return dims.active_promotion(silver.promotion_items(extracts.unit_packs(w.raw("mrl_promocaoitem"))),
                                 silver.promotions(w.raw("mrl_promocao")), _as_of(w))


@register("last_receipt_supplier", oracle.LAST_RECEIPT_SUPPLIER)
def last_receipt_supplier(w: Warehouse) -> DataFrame:
    """Supplier of the newest purchase receipt per product x store (first row per key)."""
    return dims.last_receipt_supplier(w.receipts_fact, PURCHASE_OPERATIONS)


@register("product_store_snapshot", oracle.PRODUCT_STORE_SNAPSHOT)
def product_store_snapshot(w: Warehouse) -> DataFrame:
    """Product x store snapshot joining stock, prices, promotion, supplier delivery and ABC."""
    return build.product_store(w, marts.delivery_time(w.receipts_fact),
                               marts.abc_curve(w.sales_fact, w.product_category)).drop("carregado_em")


@register("price_staging", oracle.PRICE_STAGING)
def price_staging(w: Warehouse) -> DataFrame:
    """Prices per product x pack x segment x store: in force, promotional and scheduled."""
    return silver.prices(w.raw("mrl_prodempseg")).drop("carregado_em")


@register("promotion_staging", oracle.PROMOTION_STAGING)
def promotion_staging(w: Warehouse) -> DataFrame:
    """Promotion headers with their flags, leaflet and audit columns."""
    return silver.promotions(w.raw("mrl_promocao")).drop("carregado_em")


@register("promotion_item_staging", oracle.PROMOTION_ITEM_STAGING)
def promotion_item_staging(w: Warehouse) -> DataFrame:
    """Promotion items of unit packs with prices, own dates and sales during the promotion."""
    return silver.promotion_items(extracts.unit_packs(w.raw("mrl_promocaoitem"))).drop("carregado_em")


@register("order_header_staging", oracle.ORDER_HEADER_STAGING)
def order_header_staging(w: Warehouse) -> DataFrame:
    """Purchase-order headers, all codes decoded."""
    return w.order_headers.drop("carregado_em")


@register("order_item_staging", oracle.ORDER_ITEM_STAGING)
def order_item_staging(w: Warehouse) -> DataFrame:
    """Purchase-order items, all codes decoded."""
    return w.order_items.drop("carregado_em")


# ---------------------------------------------------------------- label backfill and code tables

BACKFILL_WINDOW_DAYS = 180


@register("label_backfill", oracle.PURCHASE_ORDER)
def label_backfill(w: Warehouse) -> DataFrame:
    """Stored purchase-order fact whose rows outside the 180-day window still hold raw codes,
    re-decoded in place (idempotent)."""
    as_of = _max_date(w.raw("msu_pedidosuprim"), "dtaemissao")
    legacy = facts.purchase_order_fact(silver.order_headers(w.raw("msu_pedidosuprim"), humanize=False),
                                       silver.order_items(w.raw("msu_psitemreceber"), humanize=False))
    # one join for both: rows of the window are stored decoded, as their load decodes them, older ones with their codes
    in_window = F.col("dta_emissao") >= F.date_sub(F.lit(as_of), BACKFILL_WINDOW_DAYS)
    stored = facts.label_backfill(legacy.where(F.col("dta_emissao").isNotNull()), in_window)
    return _no_stamp(facts.label_backfill(stored))


@register("order_code_tables", oracle.ORDER_CODE_TABLES)
def order_code_tables(w: Warehouse) -> DataFrame:
    """Order state, type and origin code tables (code -> upper-cased description)."""
    parts = [("situacao", "madv_situacaoped", "situacaoped", "descsituacaoped"),
             ("tipo", "madv_tippedido", "tippedido", "desctippedido"),
             ("origem", "madv_origempedido", "origempedido", "descorigempedido")]
    out = None
    for tabela, raw, code, desc in parts:
        df = (silver.code_table(w.raw(raw), code, desc, "codigo", "descricao").drop("carregado_em")
                    .withColumn("tabela", F.lit(tabela)))
        out = df if out is None else out.unionByName(df)
    return out


@register("abc_network", oracle.ABC_NETWORK)
def abc_network(w: Warehouse) -> DataFrame:
    """Network-wide ABC classes per product (distributed running sum without a partition key)."""
    return marts.abc_network(w.sales_fact)


@register("holidays", oracle.HOLIDAYS)
def holidays(w: Warehouse) -> DataFrame:
    """Holiday table over the data's years: fixed dates x years plus Easter-based feasts, names merged."""
    years = w.sales_fact.select(F.year("data_venda").alias("ano")).distinct()
    return cal.holidays(w.spark, years, seeds.fixed_holidays(w.spark))


@register("labels_and_keys", oracle.LABELS_AND_KEYS)
def labels_and_keys(w: Warehouse) -> DataFrame:
    """Person/company staging: 'id - name' labels, address with S/N default, taxpayer id
    assembly (9/12-digit root + check digits, NULL when a part is missing), flag decodes."""
    return _no_stamp(w.persons)


@register("sales_net_cost", oracle.SALES_NET_COST)
def sales_net_cost(w: Warehouse) -> DataFrame:
    """Net cost of goods sold per day x store x product from the day costs joined to each line."""
    return extracts.sales_net_cost(_sales_lines(w))


@register("schema_append", oracle.SCHEMA_APPEND)
def schema_append(w: Warehouse) -> DataFrame:
    """Two loads with evolving schemas: a corrected window that adds a column, then the last
    10 days re-sent without the discount column (NULL for those rows, kept for the others)."""
    target, batch = _incremental_inputs(w)
    as_of = w.sales_fact.agg(F.max("data_venda")).first()[0]
    late = (batch.where(F.col("data_venda") >= F.date_sub(F.lit(as_of), 10))
                 .drop("valor_desconto", "vlrembalagem"))
    merged = incremental.delete_insert(target, batch, facts.SALES_KEY)
    return incremental.delete_insert(merged, late, facts.SALES_KEY)
