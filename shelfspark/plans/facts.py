"""Gold facts built from silver tables.

The fact builders here produce the rows of one load (the extract window).
How they are merged into the stored history is the job of
``operators.incremental.delete_insert`` with the keys below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed operation codes of the source system.
SALES_OPERATIONS = [800, 810, 820, 828, 202]
RETURN_OPERATION = 202

# Unique keys used by delete+insert. The sales key leaves the operator out on
# purpose: the source fills it in later, which would change the key between loads.
SALES_KEY = ["datahora_venda", "empresa_id", "documento_numero", "serie_documento", "checkout_id",
             "forma_pagto_id", "segmento_id", "cod_operacao", "produto_id"]
RECEIPTS_KEY = ["dta_entrada", "nro_documento", "produto_id", "cod_geral_oper", "operador", "qtd_embalagem"]
STOCK_MOVEMENT_KEY = ["movimento_id"]
STOCK_BALANCE_KEY = ["dta_movimento", "empresa_id", "produto_id"]
PURCHASE_ORDER_KEY = ["pedido_id", "empresa_id", "produto_id"]

SALES_COLUMNS = ["datahora_venda", "data_venda", "hora_venda", "empresa_id", "documento_numero",
                 "serie_documento", "checkout_id", "documento_chave", "forma_pagto_id", "segmento_id",
                 "cod_operacao", "produto_id", "operador_id", "qtd_venda", "qtd_devolvido",
                 "qtd_venda_liquida", "valor_venda", "valor_devolvido", "valor_venda_liquido",
                 "valor_desconto", "valor_venda_promocao", "valor_lucro", "valor_custo_bruto",
                 "valor_custo_liquido", "carregado_em"]


def since(df: DataFrame, date_col: str, min_date) -> DataFrame:
    """Incremental source filter ``date >= min_date`` (only applied on non-first loads)."""
    return df if min_date is None else df.where(F.col(date_col) >= F.lit(min_date))


def sales_fact(sales_silver: DataFrame, min_date=None) -> DataFrame:
    """Sales and returns under the five operation codes of the fact."""
    extra = [c for c in sales_silver.columns if c not in SALES_COLUMNS]
    return since(sales_silver, "data_venda", min_date).where(
        F.col("cod_operacao").isin(SALES_OPERATIONS)).select(*SALES_COLUMNS, *extra)


def receipts_fact(receipts_silver: DataFrame, min_date=None) -> DataFrame:
    """All goods receipts (no operation filter)."""
    return since(receipts_silver, "dta_entrada", min_date)


def stock_movement_fact(ledger: DataFrame, locations: DataFrame, min_date=None) -> DataFrame:
    """Stock movements with their store location's description, type and status.

    Locations are a per-store lookup (stores x a handful of places), so the
    left join is planned as a broadcast hash join by size statistics / AQE.
    """
    loc = locations.select("empresa_id", "local_id", "descricao_local", "tipo_local", "status_local")
    return (since(ledger, "dta_movimento", min_date)
            .join(loc, ["empresa_id", "local_id"], "left")
            .select("movimento_id", "empresa_id", "dta_movimento", "dta_hor_lancto", "produto_id",
                    "produto_base_id", "local_id", "descricao_local", "tipo_local", "status_local",
                    "cod_geral_oper", "tip_uso_cgo", "tip_lancto", "qtd_lancto", "vlr_nf_lancto",
                    "nro_documento", "motivo_movto", "lote_estoque_id", "historico", "carregado_em"))


def stock_balance_fact(daily: DataFrame, min_date=None) -> DataFrame:
    return since(daily, "dta_movimento", min_date)


def purchase_order_fact(headers: DataFrame, items: DataFrame, min_date=None) -> DataFrame:
    """Purchase-order items with their header; order-to-receipt lead time.

    Both sides are large and keyed by (pedido_id, empresa_id): a shuffled
    sort-merge join on those keys. The item's pending reason wins over the
    header's. The join ignores ``central_loja`` exactly like the source model.
    """
    h = since(headers, "dta_emissao", min_date).alias("h")
    i = items.alias("i")
    j = i.join(h, (F.col("h.pedido_id") == F.col("i.pedido_id")) & (F.col("h.empresa_id") == F.col("i.empresa_id")))
    return j.select(
        F.col("h.pedido_id").alias("pedido_id"),
        F.col("h.empresa_id").alias("empresa_id"),
        F.col("i.item_seq").alias("item_seq"),
        F.col("i.produto_id").alias("produto_id"),
        F.col("h.central_loja").alias("central_loja"),
        F.col("h.fornecedor_id").alias("fornecedor_id"),
        F.col("h.comprador_id").alias("comprador_id"),
        F.col("h.transportador_id").alias("transportador_id"),
        F.col("h.tip_pedido_suprim").alias("tip_pedido_suprim"),
        F.col("h.situacao_ped").alias("situacao_ped"),
        F.col("i.status_item").alias("status_item"),
        F.col("h.dta_emissao").alias("dta_emissao"),
        F.col("h.dta_aprovacao").alias("dta_aprovacao"),
        F.col("h.dta_recebto").alias("dta_recebto"),
        F.col("i.dta_recebto_item").alias("dta_recebto_item"),
        F.col("h.dta_limite_recebto").alias("dta_limite_recebto"),
        F.when(F.col("i.dta_recebto_item").isNotNull(),
               F.datediff(F.col("i.dta_recebto_item"), F.col("h.dta_emissao"))
               ).alias("dias_lead_time_emissao_recebimento"),
        F.col("h.dias_prorrogacao").alias("dias_prorrogacao"),
        F.col("i.qtd_solicitada").alias("qtd_solicitada"),
        F.col("i.qtd_solicitada_original").alias("qtd_solicitada_original"),
        F.col("i.qtd_aprovada").alias("qtd_aprovada"),
        F.col("i.qtd_tot_recebida").alias("qtd_tot_recebida"),
        F.col("i.qtd_tot_cancelada").alias("qtd_tot_cancelada"),
        F.col("i.qtd_tot_transito").alias("qtd_tot_transito"),
        F.col("i.vlr_unitario").alias("vlr_unitario"),
        F.col("i.vlr_emb_item").alias("vlr_emb_item"),
        F.coalesce(F.col("i.motivo_pendencia"), F.col("h.motivo_pendencia")).alias("motivo_pendencia"),
        F.col("h.nro_ped_suprim_orig").alias("nro_ped_suprim_orig"),
        F.col("h.empresa_orig_id").alias("empresa_orig_id"),
        F.col("h.observacao").alias("observacao"),
        F.col("i.carregado_em").alias("carregado_em"),
    )


def label_backfill(stored: DataFrame, rows: Column | None = None) -> DataFrame:
    """Re-decode the code columns of stored purchase-order rows (with ``rows``: of those rows only).

    Rows loaded outside the current extract window may still hold raw source
    codes; decoding again turns them into labels and leaves labels as they are
    (a label is not a code and is already upper case), so it can be re-run.
    """
    from shelfspark.plans.silver import ITEM_STATES, PURCHASE_ORDER_STATES, PURCHASE_ORDER_TYPES, STORE_OR_HQ
    from shelfspark.functions.columns import decode
    maps = {"central_loja": STORE_OR_HQ, "tip_pedido_suprim": PURCHASE_ORDER_TYPES,
            "situacao_ped": PURCHASE_ORDER_STATES, "status_item": ITEM_STATES}

    def label(c: str) -> Column:
        decoded = decode(F.col(c), maps[c])
        return (decoded if rows is None else F.when(rows, decoded).otherwise(F.col(c))).alias(c)

    return stored.select(*[label(c) if c in maps else F.col(c) for c in stored.columns])
