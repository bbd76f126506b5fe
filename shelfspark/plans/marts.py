"""Analytic marts over the facts: Pareto (ABC) classes and supplier delivery time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.columns import abc_class, half_even_int, safe_div, share_pct
from shelfspark.operators.running_total import running_sum
from shelfspark.session import checkpoint_dir

PURCHASE_OPERATIONS = [1, 11, 105, 107, 200, 205]  # fixed: receipt codes that are purchases
MAX_DELIVERY_DAYS = 180


def trailing_year(df: DataFrame, date_col: str) -> tuple:
    """(start, end): newest date in ``df`` and the same day 12 months earlier.

    Both ends are inclusive, so the window spans 12 months and one day. The
    two dates come back to the driver as scalars, so the period filter is a
    literal predicate that reaches the scan (and prunes month partitions of
    a stored fact).
    """
    row = df.agg(F.max(date_col).alias("fim")).select(F.add_months("fim", -12).alias("inicio"), "fim").first()
    return row["inicio"], row["fim"]


MONTH_PARTITION = "mes_part"


def month_key(d) -> int:
    return d.year * 100 + d.month


def within(df: DataFrame, period: tuple, date_col: str) -> DataFrame:
    """Rows of ``df`` inside the inclusive ``period``.

    On a stored fact partitioned by month the same range is also stated on
    the partition column, so only the months in the period are listed and read.
    """
    out = df.where(F.col(date_col).between(F.lit(period[0]), F.lit(period[1])))
    if MONTH_PARTITION in df.columns:
        out = out.where(F.col(MONTH_PARTITION).between(month_key(period[0]), month_key(period[1])))
    return out


def with_period(df: DataFrame, period: tuple) -> DataFrame:
    return df.withColumn("periodo_inicio", F.lit(period[0]).cast("date")) \
             .withColumn("periodo_fim", F.lit(period[1]).cast("date"))


def abc_store_product(sales: DataFrame) -> tuple[DataFrame, tuple]:
    """Net revenue and quantity per store x product over the trailing year (all
    operations, returns negative), products with net revenue <= 0 left out;
    materialised, plus the period."""
    period = trailing_year(sales, "data_venda")
    per_store = (within(sales, period, "data_venda")
                 .select("empresa_id", "produto_id", "valor_venda_liquido", "qtd_venda_liquida")
                 .groupBy("empresa_id", "produto_id")
                 .agg(F.sum("valor_venda_liquido").alias("receita_liq"),
                      F.sum("qtd_venda_liquida").alias("quantidade_liq"))
                 .where(F.col("receita_liq") > 0))
    # store x product rows feed four windows and the network curve: materialise
    # them once (reliable checkpoint in the shared folder) instead of
    # re-aggregating the fact for every branch
    checkpoint_dir(sales.sparkSession)
    return per_store.checkpoint(eager=True), period


# Running sums of the curves: scope -> (group columns, measure).
SCOPES = {"valor_empresa": (("empresa_id",), "receita_liq"), "qtd_empresa": (("empresa_id",), "quantidade_liq"),
          "valor_categoria": (("empresa_id", "categoria_id"), "receita_liq"),
          "qtd_categoria": (("empresa_id", "categoria_id"), "quantidade_liq"),
          "valor_rede": ((), "receita_liq_rede"), "qtd_rede": ((), "quantidade_liq_rede")}


def network_totals(per_store: DataFrame) -> DataFrame:
    """Network totals per product: a product enters the network curve once."""
    return per_store.groupBy("produto_id").agg(F.sum("receita_liq").alias("receita_liq_rede"),
                                               F.sum("quantidade_liq").alias("quantidade_liq_rede"))


def _scoped(rows: DataFrame, scopes: list[str]) -> DataFrame:
    """A narrow row per scope: its group, the measure and the row's own store and product."""
    present = set(rows.columns)

    def of(scope: str):
        group, measure = SCOPES[scope]
        return F.struct(F.lit(scope).alias("escopo"),
                        *[(F.col(c) if c in group else F.lit(None)).cast("int").alias(f"g_{c}")
                          for c in ("empresa_id", "categoria_id")],
                        F.col(measure).cast("decimal(38,3)").alias("medida"))

    store = (F.col("empresa_id") if "empresa_id" in present else F.lit(None)).cast("int").alias("empresa_id")
    return rows.select(store, "produto_id", F.explode(F.array(*[of(s) for s in scopes])).alias("e")) \
               .select("empresa_id", "produto_id", "e.*")


def running_curves(rows: DataFrame) -> DataFrame:
    """Running sum and total of every scope in one range-partitioned pass over (scope, group, measure)."""
    return running_sum(rows, ["escopo", "g_empresa_id", "g_categoria_id"],
                       [F.col("medida").desc(), F.col("produto_id").asc()], "medida", "acum", "total")


def _wide(curves: DataFrame, keys: list[str], scopes: list[str]) -> DataFrame:
    """One row per ``keys`` with acum_<scope> and total_<scope>."""
    pick = lambda c, s: F.max(F.when(F.col("escopo") == s, F.col(c))).alias(f"{c}_{s}")
    return curves.where(F.col("escopo").isin(scopes)).groupBy(*keys).agg(*[pick(c, s) for s in scopes for c in ("acum", "total")])


def _curves_of(names: list[str]) -> list:
    return [c for s in names for c in _curve(f"acum_{s}", f"total_{s}", s)]


def _class_columns(names: list[str]) -> list[str]:
    return [c for s in names for c in (f"pct_acum_{s}", f"curva_abc_{s}")]


def _curve(acum: str, total: str, name: str):
    return [share_pct(F.col(acum), F.col(total)).alias(f"pct_acum_{name}"),
            abc_class(F.col(acum), F.col(total)).alias(f"curva_abc_{name}")]


NETWORK = ["valor_rede", "qtd_rede"]
STORE = ["valor_empresa", "qtd_empresa", "valor_categoria", "qtd_categoria"]


def _amounts(*names: str) -> list:
    return [F.col(c).cast("decimal(28,2)" if c.startswith("receita") else "decimal(28,3)").alias(c) for c in names]


def abc_network(sales: DataFrame) -> DataFrame:
    """Network ABC classes per product (one row per product with positive store revenue)."""
    per_store, period = abc_store_product(sales)
    network = network_totals(per_store).checkpoint(eager=True)
    curves = _wide(running_curves(_scoped(network, NETWORK)), ["produto_id"], NETWORK)
    net = with_period(network.join(curves, "produto_id"), period)
    return net.select("produto_id", *_amounts("receita_liq_rede", "quantidade_liq_rede"), *_curves_of(NETWORK),
                      "periodo_inicio", "periodo_fim")


def abc_curve(sales: DataFrame, product_category: DataFrame) -> DataFrame:
    """ABC classes per store, per store x category and network-wide, by value and by quantity.

    Net revenue and quantity per store x product over the trailing year (all
    operations, returns negative); products with net revenue <= 0 are left
    out. A <= 80 %, B <= 95 %, else C, on the running share in descending
    order with the product id as tie-break. Products without a category (or
    missing from the dimension) form one group per store.
    """
    per_store, period = abc_store_product(sales)
    network = network_totals(per_store).checkpoint(eager=True)
    enriched = per_store.join(product_category.select("produto_id", "familia_id", "categoria_id"), "produto_id", "left") \
                        .checkpoint(eager=True)
    curves = running_curves(_scoped(enriched, STORE).unionByName(_scoped(network, NETWORK))).checkpoint(eager=True)
    # the classes travel, not the sums they follow from
    net = network.join(_wide(curves, ["produto_id"], NETWORK).select("produto_id", *_curves_of(NETWORK)), "produto_id")
    store = _wide(curves, ["empresa_id", "produto_id"], STORE).select(
        F.col("empresa_id").alias("_e"), F.col("produto_id").alias("_p"), *_curves_of(STORE))
    same = enriched["empresa_id"].eqNullSafe(store["_e"]) & enriched["produto_id"].eqNullSafe(store["_p"])
    out = with_period(enriched.join(store, same).drop("_e", "_p").join(net, "produto_id"), period)
    return out.select("empresa_id", "produto_id", "familia_id", "categoria_id",
                      *_amounts("receita_liq", "quantidade_liq", "receita_liq_rede", "quantidade_liq_rede"),
                      *_class_columns(STORE), *_class_columns(NETWORK), "periodo_inicio", "periodo_fim")


def delivery_time(receipts: DataFrame, supplier_dimension: DataFrame | None = None) -> DataFrame:
    """Delivery time per supplier x store over the trailing year of receipts.

    Purchase operations only, delivery days clipped to 0..180 (NULL dropped).
    Count, mean, min, max, sample stddev, exact median (rounded half to even),
    invoice total and invoice-value-weighted mean; plus the registered terms.
    """
    period = trailing_year(receipts, "dta_entrada")
    base = (within(receipts, period, "dta_entrada")
            .select("fornecedor_id", "empresa_id", "dta_entrada", "cod_geral_oper", "tempo_entrega_dias",
                    "vlr_total_nf")
            .where(F.col("cod_geral_oper").isin(PURCHASE_OPERATIONS)
                   & F.col("tempo_entrega_dias").between(0, MAX_DELIVERY_DAYS)))
    days = F.col("tempo_entrega_dias")
    agg = base.groupBy("fornecedor_id", "empresa_id").agg(
        F.count(F.lit(1)).alias("qtd_notas"),
        F.round(F.sum(days).cast("decimal(20,0)") / F.count(F.lit(1)).cast("decimal(20,0)"), 1)
         .cast("decimal(18,1)").alias("media_tempo_entrega"),
        F.min(days).alias("min_tempo_entrega"),
        F.max(days).alias("max_tempo_entrega"),
        F.round(F.stddev_samp(days), 1).alias("desvio_padrao_tempo_entrega"),
        half_even_int(F.percentile(days, 0.5)).alias("mediana_tempo_entrega"),
        F.sum("vlr_total_nf").cast("decimal(28,2)").alias("vlr_total_nf"),
        F.round(safe_div(F.sum(days.cast("decimal(10,0)") * F.col("vlr_total_nf")), F.sum("vlr_total_nf")), 1)
         .cast("decimal(18,1)").alias("media_tempo_entrega_ponderado"),
    )
    out = with_period(agg, period)
    cols = ["fornecedor_id", "empresa_id", "qtd_notas", "media_tempo_entrega", "min_tempo_entrega",
            "max_tempo_entrega", "desvio_padrao_tempo_entrega", "mediana_tempo_entrega",
            "media_tempo_entrega_ponderado", "vlr_total_nf"]
    if supplier_dimension is not None:
        terms = supplier_dimension.select("fornecedor_id", F.col("prazo_med_entrega").alias("prazo_cadastrado"),
                                          F.col("prazo_med_atraso").alias("atraso_cadastrado"))
        out = out.join(terms, "fornecedor_id", "left")
        cols += ["prazo_cadastrado", "atraso_cadastrado"]
    return out.select(*cols, "periodo_inicio", "periodo_fim")
