"""Wires raw tables -> silver -> gold for one data directory.

Every attribute is a lazy DataFrame plan (nothing runs until an action), so
a query only scans the raw tables and columns it needs; Catalyst prunes the
rest. Raw tables come from ``sources.standin`` over the driver's parquet
files; on a real deployment the same silver functions read the landed
extracts instead.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfspark.plans import dims, extracts, facts, silver
from shelfspark.sources import seeds, standin

# Planning tables, API answers and logs: written by their own jobs, not by an extract.
UNSTAMPED = {"meta_parametros", "meta_ajustes_loja", "indicadores_mercado_externo", "indicadores_payload",
             "cnpj_respostas"}


class Warehouse:
    """Lazy plans for one data folder.

    With ``stored`` set (the output folder of a build), the sales and
    receipts facts are read from their stored, history-keeping tables
    (with their ``mes_part`` partition column) instead of being recomputed
    from the current extract; with ``stored_dims`` the store dimension is
    read from its stored table too (for models built after the dimensions).

    ``run_ts`` is the load time of the run: extracted tables that carry none
    of their own are stamped with it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: str | None = None, stored_dims: bool = False,
                 run_ts: dt.datetime | None = None):
        self.spark = spark
        self.run_ts = run_ts
        self.sf_dir = sf_dir
        self.stored = stored
        self.stored_dims = stored_dims

    def _stored_fact(self, name: str) -> DataFrame | None:
        if not self.stored:
            return None
        from shelfspark.operators.incremental import existing_table
        # the month partition column stays, so period filters can prune on it
        return existing_table(self.spark, f"{self.stored}/gold/{name}")

    def raw(self, name: str) -> DataFrame:
        table = standin.spark_table(self.spark, self.sf_dir, name)
        if self.run_ts is None or name in UNSTAMPED or "_loaded_at" in table.columns:
            return table
        return extracts.stamp(table, self.run_ts)

    def driver(self, name: str) -> DataFrame:
        return standin.driver_table(self.spark, self.sf_dir, name)

    # ---- silver
    @cached_property
    def sales_lines(self) -> DataFrame:
        return silver.sales_lines(self.raw("maxv_abcdistribbase"))

    @cached_property
    def receipt_lines(self) -> DataFrame:
        return silver.receipt_lines(self.raw("maxv_abcentradabase"))

    @cached_property
    def stock_ledger(self) -> DataFrame:
        return silver.stock_ledger(self.raw("mrl_lanctoestoque"))

    @cached_property
    def stock_daily(self) -> DataFrame:
        return silver.stock_daily(self.raw("mrl_custodia"))

    @cached_property
    def locations(self) -> DataFrame:
        return silver.locations(self.raw("mrl_local"))

    @cached_property
    def order_headers(self) -> DataFrame:
        return silver.order_headers(self.raw("msu_pedidosuprim"))

    @cached_property
    def order_items(self) -> DataFrame:
        return silver.order_items(self.raw("msu_psitemreceber"))

    @cached_property
    def stores(self) -> DataFrame:
        return silver.stores(self.raw("max_empresa"))

    @cached_property
    def checkouts(self) -> DataFrame:
        return silver.checkouts(self.raw("vw_pdv"))

    @cached_property
    def segments(self) -> DataFrame:
        return silver.segments(self.raw("mad_segmento"))

    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.raw("map_produto"))

    @cached_property
    def families(self) -> DataFrame:
        return silver.families(self.raw("map_familia"))

    @cached_property
    def brands(self) -> DataFrame:
        return silver.brands(self.raw("map_marca"))

    @cached_property
    def categories(self) -> DataFrame:
        return silver.categories(self.raw("etlv_categoria"))

    @cached_property
    def barcodes(self) -> DataFrame:
        return silver.barcodes(self.raw("map_prodcodigo"))

    @cached_property
    def family_suppliers(self) -> DataFrame:
        return silver.family_suppliers(self.raw("map_famfornec"))

    @cached_property
    def persons(self) -> DataFrame:
        return silver.persons(self.raw("ge_pessoa"))

    @cached_property
    def supplier_divisions(self) -> DataFrame:
        return silver.supplier_divisions(self.raw("maf_fornecdivisao"))

    # ---- gold
    @cached_property
    def sales_fact(self) -> DataFrame:
        stored = self._stored_fact("fato_venda")
        return stored if stored is not None else facts.sales_fact(self.sales_lines)

    @cached_property
    def receipts_fact(self) -> DataFrame:
        stored = self._stored_fact("fato_entrada")
        return stored if stored is not None else facts.receipts_fact(self.receipt_lines)

    @cached_property
    def product_category(self) -> DataFrame:
        """Product dimension without barcodes and supplier (enough for marts)."""
        return dims.product_dim(self.products, self.families, self.brands, self.categories)

    @cached_property
    def product_dim(self) -> DataFrame:
        return dims.product_dim(self.products, self.families, self.brands, self.categories,
                                self.barcodes, self.family_suppliers, self.persons)

    @cached_property
    def store_dim(self) -> DataFrame:
        stored = self._stored_fact("dim_empresa_info") if self.stored_dims else None
        if stored is not None:
            return stored
        return dims.store_dim(self.stores, self.checkouts, self.segments, seeds.closed_stores(self.spark))

    @cached_property
    def supplier_dim(self) -> DataFrame:
        return dims.supplier_dim(self.family_suppliers, self.supplier_divisions, self.persons)
