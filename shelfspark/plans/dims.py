"""Gold dimensions: product, store, supplier (calendar lives in ``calendar``).

Dimensions are small next to the facts (catalogue, stores, suppliers); their
joins are left to Catalyst's size statistics and AQE to plan as broadcasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.columns import NOT_DEFINED_F, NOT_DEFINED_M, padded
from shelfspark.operators.dedup import first_per_key
from shelfspark.plans.silver import STORE_OPERATION_CODES
from shelfspark.session import join_within_partitions


def barcode_list(barcodes: DataFrame) -> DataFrame:
    """EAN and scale codes per product as one text: EANs first, then by code.

    The ordered string aggregate is ``collect_list`` of (priority, code)
    structs, sorted and joined per product; each list holds one product's
    codes only.
    """
    codes = barcodes.where(F.col("tipo_codigo").isin("EAN", "BALANÇA") & F.col("codigo_acesso").isNotNull())
    prio = F.when(F.col("tipo_codigo") == "EAN", 1).otherwise(2)
    return (codes.groupBy("produto_id")
            .agg(F.array_sort(F.collect_list(F.struct(prio.alias("p"), F.col("codigo_acesso").alias("c"))))
                 .alias("_codes"))
            .select("produto_id", F.array_join(F.transform("_codes", lambda x: x["c"]), " ; ")
                    .alias("codigo_acesso")))


def product_dim(products: DataFrame, families: DataFrame, brands: DataFrame, categories: DataFrame,
                barcodes: DataFrame | None = None, family_suppliers: DataFrame | None = None,
                persons: DataFrame | None = None) -> DataFrame:
    """Product with family, brand, category hierarchy, barcodes and main supplier.

    Missing attributes get the 0 / 'NÃO DEFINIDA' defaults. A family with two
    main suppliers yields two rows per product, as in the source model.
    The barcode and supplier parts are optional so callers that only need
    the category do not pay for them.
    """
    p = products.alias("p")
    f = families.alias("f")
    out = (p.join(f, F.col("f.familia_id") == F.col("p.familia_id"), "left")
            .join(brands.alias("m"), F.col("m.marca_id") == F.col("f.marca_id"), "left")
            .join(categories.alias("c"), F.col("c.familia_id") == F.col("f.familia_id"), "left"))
    def d(col, default):
        return F.coalesce(F.col(col), F.lit(default))
    cols = [
        F.col("p.produto_id").alias("produto_id"), F.col("p.produto").alias("produto"),
        F.col("p.produto_id_nome").alias("produto_id_nome"),
        F.col("f.familia_id").alias("familia_id"), F.col("f.familia").alias("familia"),
        F.col("f.familia_id_nome").alias("familia_id_nome"), F.col("f.pesavel").alias("pesavel"),
        F.col("f.permite_decimal").alias("permite_decimal"),
        d("c.categoria_id", 0).alias("categoria_id"), d("c.categoria", NOT_DEFINED_F).alias("categoria"),
        d("c.categoria_id_nome", "0000 - " + NOT_DEFINED_F).alias("categoria_id_nome"),
        d("c.subcategoria_id", 0).alias("subcategoria_id"), d("c.subcategoria", NOT_DEFINED_F).alias("subcategoria"),
        d("c.subcategoria_id_nome", "0000 - " + NOT_DEFINED_F).alias("subcategoria_id_nome"),
        d("c.grupo_id", 0).alias("grupo_id"), d("c.grupo", NOT_DEFINED_M).alias("grupo"),
        d("c.grupo_id_nome", "0000 - " + NOT_DEFINED_M).alias("grupo_id_nome"),
        d("c.sk_categoria", 0).alias("sk_categoria"),
        d("c.categoria_completa", NOT_DEFINED_M).alias("categoria_completa"),
        d("c.categoria_completa_id_nome", "0000 - " + NOT_DEFINED_M).alias("categoria_completa_id_nome"),
        d("c.perecivel", "NÃO").alias("perecivel"),
        d("m.marca_id", 0).alias("marca_id"), d("m.marca", NOT_DEFINED_F).alias("marca"),
        d("m.marca_id_nome", "0000 - " + NOT_DEFINED_F).alias("marca_id_nome"),
        F.col("p.data_inclusao").alias("data_inclusao"),
    ]
    if barcodes is not None:
        out = out.join(barcode_list(barcodes).alias("pc"), F.col("pc.produto_id") == F.col("p.produto_id"), "left")
        cols.insert(3, F.col("pc.codigo_acesso").alias("codigo_acesso"))
    if family_suppliers is not None:
        main = family_suppliers.where(F.col("fornecedor_principal") == "SIM").alias("fp")
        out = out.join(main, F.col("fp.familia_id") == F.col("f.familia_id"), "left")
        cols.append(d("fp.fornecedor_id", 0).alias("fornecedor_principal_id"))
        if persons is not None:
            out = out.join(persons.alias("g"), F.col("g.pessoa_id") == F.col("fp.fornecedor_id"), "left")
            cols.append(d("g.nome_razao", NOT_DEFINED_M).alias("fornecedor_principal"))
            cols.append(d("g.nome_razao_id_nome", NOT_DEFINED_M).alias("fornecedor_principal_id_nome"))
    return out.select(*cols)


def store_dim(stores: DataFrame, checkouts: DataFrame, segments: DataFrame, closed: DataFrame) -> DataFrame:
    """Store label 'NNN - CITY[ Ln]', active checkouts, segment label, closed-store override.

    The suffix Ln (ordinal of the store in its city, head office included in
    the numbering) is added only when the city has more than one store other
    than the head office (store 1).
    """
    per_city = (stores.where(F.col("empresa_id") != 1).groupBy("cidade")
                .agg(F.count(F.lit(1)).alias("total_lojas_cidade")))
    active_pdv = (checkouts.where(F.col("pdv_ativo") == "SIM").groupBy("empresa_id")
                  .agg(F.count(F.lit(1)).alias("total_pdv_ativo")))
    ranked = stores.withColumn("rank_na_cidade",
                               F.row_number().over(Window.partitionBy("cidade").orderBy("empresa_id")))
    seg = segments.select(F.col("segmento_id").alias("_seg"), "segmento_id_nome")
    cl = closed.select(F.col("empresa_id").alias("_closed_id"), "data_encerramento")
    r = (ranked.join(per_city, "cidade", "left")
               .join(active_pdv, "empresa_id", "left")
               .join(seg, F.col("segmento_principal") == F.col("_seg"), "left")
               .join(cl, F.col("empresa_id") == F.col("_closed_id"), "left"))
    label = (F.when(F.col("empresa_id") == 1, F.lit("001 - MATRIZ"))
              .when(F.col("total_lojas_cidade") > 1,
                    F.concat(padded(F.col("empresa_id"), 3), F.lit(" - "), F.col("cidade"), F.lit(" L"),
                             F.col("rank_na_cidade").cast("string")))
              .otherwise(F.concat(padded(F.col("empresa_id"), 3), F.lit(" - "), F.col("cidade"))))
    return r.select(
        "divisao_id", "empresa_id", label.alias("loja"), "razao_social", "pessoa_id_razao", "cnpj", "inscricao_estadual",
        "logradouro", "bairro", "cep", "cidade", "uf", "endereco", "metro_quadrado", "pessoa_id", "segmento_principal",
        "segmento_id_nome", "aberto_sabado", "aberto_domingo", "meta_margem_lucro", "meta_dia_estoque",
        F.when(F.col("_closed_id").isNotNull(), F.lit("INATIVA")).otherwise(F.col("status_empresa"))
         .alias("status_empresa"),
        F.coalesce(F.col("data_encerramento"), F.col("dta_fechamento_fiscal")).alias("dta_fechamento_fiscal"),
        "inicio_estoque", "nsu_nf", "total_pdv_ativo", *STORE_OPERATION_CODES.values(),
    )


def active_stores(store_dimension: DataFrame) -> DataFrame:
    """Ids of active stores other than the head office (like-for-like comparisons)."""
    return store_dimension.where((F.col("status_empresa") == "ATIVA") & (F.col("empresa_id") != 1)) \
                          .select("empresa_id")


def supplier_dim(family_suppliers: DataFrame, divisions: DataFrame, persons: DataFrame) -> DataFrame:
    """One row per supplier linked to any family, with commercial terms and person data.

    Family link: the row with the lowest family id (the source takes an
    arbitrary one). Terms: division 1 first, then the newest load, then the
    lowest division.
    """
    ff = first_per_key(family_suppliers, ["fornecedor_id"],
                       [F.col("familia_id").asc_nulls_last(), F.col("fornecedor_principal").desc_nulls_last()])
    fd = first_per_key(divisions, ["fornecedor_id"],
                       [F.when(F.col("divisao_id") == 1, 0).otherwise(1), F.col("carregado_em").desc_nulls_first(),
                        F.col("divisao_id").asc_nulls_last()])
    p = persons.alias("p")
    out = (ff.alias("ff").join(fd.alias("fd"), F.col("ff.fornecedor_id") == F.col("fd.fornecedor_id"), "left")
             .join(p, F.col("ff.fornecedor_id") == F.col("p.pessoa_id"), "left"))
    return out.select(
        F.col("ff.fornecedor_id").alias("fornecedor_id"), "p.nome_razao", "p.nome_razao_id_nome", "p.nome_fantasia",
        "p.status", "p.pessoa_tipo", "p.logradouro", "p.numero", "p.bairro", "p.cidade", "p.cep", "p.uf", "p.pais", "p.endereco",
        "p.cnpj_cpf", "p.inscricao_rg", "p.email", "p.contribuinte_icms", "p.produtor_rural", "p.contribuinte_ipi", "p.cnae",
        F.col("ff.fornecedor_principal").alias("fornecedor_principal"),
        F.col("ff.indeniza_avaria").alias("indeniza_avaria"),
        "fd.prazo_medio_visita_representante", "fd.prazo_med_entrega", "fd.prazo_med_atraso", "fd.prazo_pagamento",
        "fd.condicao_pagamento_id", "fd.forma_pagamento_id",
        F.col("fd.divisao_id").alias("divisao_id"),
    )


# --------------------------------------------------------------------------- product x store snapshot

def active_promotion(items: DataFrame, headers: DataFrame, as_of) -> DataFrame:
    """Promotion in force per product x store x segment: the active item whose
    validity (item dates override the header's) contains ``as_of``; the one
    ending soonest wins, ties by promotion id."""
    today = F.lit(as_of).cast("date")
    h = headers.select("promocao_id", "empresa_id", "segmento_id", "central_loja",
                       F.col("dta_inicio").alias("_hi"), F.col("dta_fim").alias("_hf"))
    j = (items.where(F.col("status") == "ATIVO")
              .join(h, ["promocao_id", "empresa_id", "segmento_id", "central_loja"])
              .withColumn("dta_inicio_promoc", F.coalesce("dta_inicio_item", "_hi"))
              .withColumn("dta_fim_promoc", F.coalesce("dta_fim_item", "_hf"))
              .where((F.col("dta_inicio_promoc") <= today) & (F.col("dta_fim_promoc") >= today)))
    first = first_per_key(j, ["produto_id", "empresa_id", "segmento_id"],
                          [F.col("dta_fim_promoc").asc(), F.col("promocao_id").asc()])
    return first.select("produto_id", "empresa_id", "segmento_id", "promocao_id", "preco_promocional",
                        "perc_desconto", "dta_inicio_promoc", "dta_fim_promoc")


def last_receipt_supplier(receipts: DataFrame, purchase_operations) -> DataFrame:
    """Supplier of the newest purchase receipt per product x store (ties: lowest supplier id)."""
    r = receipts.where(F.col("cod_geral_oper").isin(list(purchase_operations)))
    first = first_per_key(r, ["produto_id", "empresa_id"],
                          [F.col("dta_entrada").desc_nulls_first(), F.col("fornecedor_id").asc_nulls_last()])
    return first.select("produto_id", "empresa_id", F.col("fornecedor_id").alias("fornecedor_ultima_entrada_id"))


def product_store_snapshot(product_store: DataFrame, store_dimension: DataFrame, prices: DataFrame,
                           product_dimension: DataFrame, last_supplier: DataFrame, delivery: DataFrame,
                           abc: DataFrame, promo: DataFrame, as_of) -> DataFrame:
    """Product x store snapshot: stock, main-segment pack-1 prices, promotion in force,
    last-receipt supplier with its delivery statistics, and ABC classes.

    Every lookup is keyed on (product, store) or smaller, so each left join
    keeps the snapshot's grain (one row per product x store). The snapshot's
    rows, wide, move at most once, to their (product, store): what is keyed
    otherwise is brought to these keys beforehand, the stores are broadcast."""
    join_within_partitions(product_store.sparkSession)
    today = F.lit(as_of).cast("date")
    e = store_dimension.select("empresa_id", "status_empresa", F.col("segmento_principal").alias("_seg"))
    pr = prices.where(F.col("qtd_embalagem") == 1).drop("carregado_em").withColumnRenamed("segmento_id", "_seg")
    fp = product_dimension.select("produto_id", "fornecedor_principal_id").distinct()
    te = delivery.select(F.col("fornecedor_id").alias("fornecedor_ultima_entrada_id"), "empresa_id",
                         "media_tempo_entrega", "desvio_padrao_tempo_entrega")
    a = abc.select("produto_id", "empresa_id", "curva_abc_valor_empresa", "curva_abc_valor_categoria",
                   "curva_abc_valor_rede")
    pv = promo.withColumnsRenamed({"segmento_id": "_seg", "promocao_id": "_running"})
    keys = ["produto_id", "empresa_id"]
    of_stores = product_store.where(F.col("empresa_id").isNotNull())
    main = of_stores.select(*keys).distinct().join(fp, "produto_id")
    last = last_supplier.join(te, ["fornecedor_ultima_entrada_id", "empresa_id"], "left")
    out = (of_stores.join(F.broadcast(e), "empresa_id", "left")
           .join(main, keys, "left").join(last, keys, "left").join(a, keys, "left")
           .join(pr, [*keys, "_seg"], "left").join(pv, [*keys, "_seg"], "left"))
    # rows without a store have a main supplier, but match no other lookup
    out = out.unionByName(product_store.where(F.col("empresa_id").isNull()).join(fp, "produto_id", "left"), allowMissingColumns=True)
    days_left = F.datediff(F.col("dta_fim_promoc"), today)
    return out.select(
        "produto_id", "empresa_id", "status_empresa", "fornecedor_principal_id", "fornecedor_ultima_entrada_id",
        "media_tempo_entrega", "desvio_padrao_tempo_entrega", "curva_abc_valor_empresa",
        "curva_abc_valor_categoria", "curva_abc_valor_rede", "status_compra", "status_venda", "gera_ruptura",
        F.when(F.col("_running").isNull(), "NÃO").otherwise("SIM").alias("ind_em_promoc"),
        F.col("_running").alias("promocao_vigente_id"), F.col("preco_promocional").alias("preco_promoc_vigente"),
        F.col("perc_desconto").alias("perc_desconto_promoc"), "dta_inicio_promoc", "dta_fim_promoc",
        days_left.alias("dias_restantes_promoc"),
        (F.col("preco_valido_normal") - F.col("preco_promocional")).alias("desconto_absoluto"),
        F.when(F.col("_running").isNotNull() & (days_left <= 3), "SIM").otherwise("NÃO")
         .alias("ind_promoc_encerrando_3dias"),
        "local_entrada_id", "local_saida_id", "estoque_loja", "estoque_deposito", "estoque_troca",
        "estoque_almoxarifado", "estoque_outro", "estoque_empresa", "qtd_pedido_compra_pendente",
        "qtd_pedido_expedicao_pendente", "qtd_recebimento_transito", "media_venda_diaria",
        "media_venda_diaria_fora_promo", "dias_estoque", "preco_base_normal", "preco_ger_normal",
        "preco_valido_normal", "preco_ger_promoc", "preco_valido_promoc", "margem_lucro", "custo_liq_precificacao",
        "motivo_preco_valido", "dta_geracao_preco", "dta_validacao_preco", "dta_hora_alteracao_preco",
        "dta_hora_alt_status_venda", "preco_ger_programado", "dta_preco_programado", "ind_revisao_preco",
        "promocao_id", "ultimo_custo_liquido", "ultimo_valor_nf", "dta_ultima_movimentacao",
        "dta_ultima_movimentacao_entrada", "dta_ultima_movimentacao_saida", "dta_ultima_entrada",
        "qtd_ultima_entrada", "dta_ultima_compra", "qtd_ultima_compra", "dias_sem_compra", "dta_ultima_venda",
        "qtd_ultima_venda", "dias_sem_venda", "dias_sem_venda_desde_ultima_entrada", "qtd_ultimo_inventario",
        "carregado_em",
    )
