"""Sales-target planning marts.

* ``participation``: for each target month M..M+12 and 1-3 years of history,
  the share of each active store in group revenue (same calendar month in
  earlier years) and the share of each category inside the store, with
  fallbacks (equal share for a store without history, network mean for a
  missing category) and renormalisation.
* ``allocation``: group target x store share (+ manual adjustment) x
  category share, rounded to cents, for the standard and challenge targets.
* ``writeback``: per-store totals written back into the adjustments table
  (update calculated columns, insert missing stores with new ids).
* ``group_reference``: monthly like-for-like revenue, YoY growth, 6-month
  mean growth, suggested target and market context.

Only the first step of ``participation`` and ``group_reference`` touches the
sales fact (a filtered partial aggregate); everything after it is at most
months x stores x categories rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.running_total import running_sum
from shelfspark.plans.dims import active_stores
from shelfspark.session import checkpoint_dir

SHARE_DIGITS = 10

# History depths (years back), months planned ahead of the
# current one, and the two market indicator codes.
HISTORY_YEARS = [1, 2, 3]
PLAN_MONTHS_AHEAD = 12
IPCA = "IPCA_ALIMENTOS_BEBIDAS"
PMC = "PMC_HIPER_SUPER_VAR_ANUAL"


def _ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / den.cast("double")


# --------------------------------------------------------------------------- silver of planning inputs

def target_params(src: DataFrame) -> DataFrame:
    """Challenge target defaults to the standard one; history years default to 2."""
    return src.select(
        F.col("mes").cast("date").alias("mes"),
        F.col("meta_grupo_padrao_valor").cast("decimal(18,2)").alias("meta_grupo_padrao_valor"),
        F.coalesce(F.col("meta_grupo_desafio_valor"), F.col("meta_grupo_padrao_valor")).cast("decimal(18,2)")
         .alias("meta_grupo_desafio_valor"),
        F.coalesce(F.col("anos_historico").cast("int"), F.lit(2)).alias("anos_historico"),
    )


def store_adjustments(src: DataFrame) -> DataFrame:
    """Manual adjustments per month x store; NULL adjustments read as 0."""
    return src.select(
        F.col("mes").cast("date").alias("mes"), F.col("empresa_id").cast("int").alias("empresa_id"),
        F.coalesce(F.col("ajuste_padrao_valor"), F.lit(0)).cast("decimal(18,2)").alias("ajuste_padrao_valor"),
        F.coalesce(F.col("ajuste_desafio_valor"), F.lit(0)).cast("decimal(18,2)").alias("ajuste_desafio_valor"),
    )


# --------------------------------------------------------------------------- participation

def _shift_months(d, n: int):
    """First-of-month date ``n`` months after ``d`` (a first-of-month date)."""
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    return d.replace(year=y, month=m + 1, day=1)


def reference_months(first_month) -> list:
    """Every history month any (target month, depth) pair looks at: the same
    calendar month 1..3 years before each of the 13 target months."""
    return sorted({_shift_months(first_month, m - 12 * k)
                   for m in range(PLAN_MONTHS_AHEAD + 1) for k in range(1, max(HISTORY_YEARS) + 1)})


SHARE = "decimal(20,18)"


def _share(num: Column, den: Column) -> Column:
    """``num / den`` of amounts, exact to 18 places; NULL when ``den`` is 0."""
    den = F.when(den != 0, den)
    return (num.cast("decimal(20,2)") / den.cast("decimal(20,2)")).cast(SHARE)


def _normalised(part: Column, total: Column) -> Column:
    return (part / total.cast("decimal(24,18)")).cast(SHARE)


def monthly_revenue(sales: DataFrame, product_category: DataFrame, stores: DataFrame, months: list) -> DataFrame:
    """Net revenue of active stores per reference month, store and category; materialised.

    The fact is filtered with a literal range plus an IN list, which reach the
    scan, and a month-partitioned fact is pruned to exactly those months. It is
    read once here; everything after works on this table.
    """
    lo, hi = (months[0], _shift_months(months[-1], 1)) if months else (None, None)
    ranged = sales.where((F.col("data_venda") >= F.lit(lo)) & (F.col("data_venda") < F.lit(hi)))
    if "mes_part" in sales.columns and months:  # stored fact: prune month partitions too
        ranged = ranged.where(F.col("mes_part").isin([d.year * 100 + d.month for d in months]))
    return (ranged.select(F.trunc("data_venda", "MM").alias("historico"), "empresa_id", "produto_id", "valor_venda_liquido")
                  .where(F.col("historico").isin(months))
                  .join(stores, "empresa_id", "left_semi")
                  .join(product_category.select("produto_id", "categoria_id", "categoria_id_nome"), "produto_id")
                  .groupBy("historico", "empresa_id", "categoria_id", "categoria_id_nome")
                  .agg(F.sum("valor_venda_liquido").alias("valor")).checkpoint(eager=True))


def shares(sales: DataFrame, product_category: DataFrame, store_dimension: DataFrame, first_month) -> DataFrame:
    """Store and category shares (18 places) per (target month, history depth, store, category).

    A month of history counts for the target months one to three years later,
    at every depth that reaches back so far. The cells store x category of each
    (target month, depth) are laid out once. Totals and means per period, store
    and category are aggregates (combined before their shuffle) joined back to
    the cells: no task holds all cells of a period.
    """
    checkpoint_dir(sales.sparkSession)
    stores = active_stores(store_dimension).select("empresa_id").checkpoint(eager=True)
    months = reference_months(first_month) if first_month is not None else []
    monthly = monthly_revenue(sales, product_category, stores, months)
    last = _shift_months(first_month, PLAN_MONTHS_AHEAD) if first_month is not None else None
    reach = [F.struct(F.add_months("historico", 12 * k).alias("mes"), F.lit(y).alias("anos_historico"))
             for k in HISTORY_YEARS for y in HISTORY_YEARS if y >= k]
    period, category = ["mes", "anos_historico"], ["categoria_id", "categoria_id_nome"]
    counted = (monthly.select("empresa_id", *category, "valor", F.inline(F.array(*reach)))
                      .where(F.col("mes").between(F.lit(first_month), F.lit(last)))
                      .groupBy(*period, "empresa_id", *category).agg(F.sum("valor").alias("valor")))
    n_stores = stores.count()
    known = counted.select(*period, *category).distinct()
    every = stores.select("empresa_id", F.inline(F.array(*_plan(first_month))))
    cells = every.join(known, period).join(counted, [*period, "empresa_id", *category], "left")

    cells = cells.checkpoint(eager=True)
    equal = F.lit(1).cast("decimal(1,0)") / F.lit(n_stores or 1).cast("decimal(10,0)")
    of_store = cells.groupBy(*period, "empresa_id").agg(F.sum("valor").alias("da_loja"))
    of_period = of_store.groupBy(*period).agg(F.sum("da_loja").alias("do_periodo"))
    weights = of_store.join(of_period, period).select(
        *period, "empresa_id", "da_loja", F.coalesce(_share(F.col("da_loja"), F.col("do_periodo")), equal.cast(SHARE)).alias("loja"))
    stores_sum = weights.groupBy(*period).agg(F.sum("loja").alias("lojas"))
    store_shares = weights.join(stores_sum, period).select(
        *period, "empresa_id", "da_loja", _normalised(F.col("loja"), F.col("lojas")).alias("participacao_loja_normalizada"))
    own = cells.join(store_shares, [*period, "empresa_id"]).withColumn(
        "propria", F.when(F.col("da_loja") > 0, _share(F.col("valor"), F.col("da_loja"))))
    mean = own.groupBy(*period, *category).agg(F.avg("propria").cast(SHARE).alias("media"))
    # a cell without category has no own share and no mean, so the join need not find it
    filled = (own.join(mean, [*period, *category], "left")
                 .withColumn("parte", F.coalesce("propria", "media", F.lit(0).cast(SHARE))).where(F.col("parte") > 0)
                 .select(*period, "empresa_id", *category, "participacao_loja_normalizada", "parte"))
    parts_sum = filled.groupBy(*period, "empresa_id").agg(F.sum("parte").alias("partes"))
    return filled.join(parts_sum, [*period, "empresa_id"]).select(
        *period, "empresa_id", *category, "participacao_loja_normalizada",
        _normalised(F.col("parte"), F.col("partes")).alias("participacao_categoria_normalizada"))


def _plan(first_month) -> list:
    """(target month, history depth) pairs as literal structs: 13 x 3 values."""
    return [F.struct(F.add_months(F.lit(first_month), m).alias("mes"), F.lit(y).alias("anos_historico"))
            for m in range(PLAN_MONTHS_AHEAD + 1) for y in HISTORY_YEARS]


def participation(sales: DataFrame, product_category: DataFrame, store_dimension: DataFrame, first_month) -> DataFrame:
    """The shares rounded to ten places."""
    out = shares(sales, product_category, store_dimension, first_month)
    names = ["participacao_loja_normalizada", "participacao_categoria_normalizada"]
    return out.select(*[c for c in out.columns if c not in names],
                      *[F.round(F.col(c).cast("double"), SHARE_DIGITS).alias(c) for c in names])


# --------------------------------------------------------------------------- allocation

def allocation(shares: DataFrame, params: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Store target = group target x store share + adjustment; x category share, to cents. All in decimals."""
    def target(group: str, adjustment: str) -> Column:
        store = (F.col(group) * F.col("participacao_loja_normalizada").cast(SHARE)
                 + F.coalesce(F.col(adjustment), F.lit(0)).cast("decimal(18,2)")).cast("decimal(26,12)")
        return F.round(store * F.col("participacao_categoria_normalizada").cast(SHARE), 2).cast("decimal(18,2)")

    planned = shares.join(params, ["mes", "anos_historico"]).join(adjustments, ["mes", "empresa_id"], "left")
    return planned.select("mes", "empresa_id", "categoria_id", "categoria_id_nome",
                          target("meta_grupo_padrao_valor", "ajuste_padrao_valor").alias("meta_padrao_valor"),
                          target("meta_grupo_desafio_valor", "ajuste_desafio_valor").alias("meta_desafio_valor"))


def writeback(alloc: DataFrame, params: DataFrame, adjustments_raw: DataFrame) -> DataFrame:
    """New state of the adjustments table after the write-back of calculated columns.

    Existing (month, store) rows get their calculated columns updated (manual
    adjustment columns are never touched); stores without a row are inserted
    with zero adjustments and ids continuing after the current maximum, in
    (month, store) order. The positions are running sums over ranges, so no task
    holds all new rows.
    """
    totals = alloc.groupBy("mes", "empresa_id").agg(F.sum("meta_padrao_valor").alias("tp"),
                                                    F.sum("meta_desafio_valor").alias("td"))
    adj = adjustments_raw.select("mes", "empresa_id", "ajuste_padrao_valor", "ajuste_desafio_valor")
    calc = (totals.join(params.select("mes", "meta_grupo_padrao_valor"), "mes")
                  .join(adj, ["mes", "empresa_id"], "left")
                  .select("mes", "empresa_id",
                          (F.col("tp") - F.coalesce("ajuste_padrao_valor", F.lit(0))).cast("decimal(28,2)").alias("sp"),
                          (F.col("td") - F.coalesce("ajuste_desafio_valor", F.lit(0))).cast("decimal(28,2)").alias("sd"),
                          "meta_grupo_padrao_valor"))
    calc = calc.withColumn("pl", F.round(_ratio(F.col("sp"), F.col("meta_grupo_padrao_valor")), SHARE_DIGITS))
    t = adjustments_raw.alias("t")
    updated = (t.join(calc.alias("c"), ["mes", "empresa_id"], "left")
                .select("t.id", "mes", "empresa_id", "t.ajuste_padrao_valor", "t.ajuste_desafio_valor",
                        F.when(F.col("c.sp").isNotNull(), F.col("c.pl")).otherwise(F.col("t.participacao_loja_calculada"))
                         .alias("participacao_loja_calculada"),
                        F.when(F.col("c.sp").isNotNull(), F.col("c.sp")).otherwise(F.col("t.meta_padrao_sem_ajuste"))
                         .cast("decimal(28,2)").alias("meta_padrao_sem_ajuste"),
                        F.when(F.col("c.sp").isNotNull(), F.col("c.sd")).otherwise(F.col("t.meta_desafio_sem_ajuste"))
                         .cast("decimal(28,2)").alias("meta_desafio_sem_ajuste")))
    max_id = adjustments_raw.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).first()[0]
    new = calc.join(adjustments_raw.select("mes", "empresa_id"), ["mes", "empresa_id"], "left_anti")
    checkpoint_dir(adjustments_raw.sparkSession)
    numbered = running_sum(new.withColumn("_um", F.lit(1)).checkpoint(eager=True), [], [F.col("mes"), F.col("empresa_id")], "_um", "_posicao")
    inserted = (numbered.select((F.lit(max_id) + F.col("_posicao")).alias("id"),
                           "mes", "empresa_id",
                           F.lit(0).cast("decimal(18,2)").alias("ajuste_padrao_valor"),
                           F.lit(0).cast("decimal(18,2)").alias("ajuste_desafio_valor"),
                           F.col("pl").alias("participacao_loja_calculada"),
                           F.col("sp").alias("meta_padrao_sem_ajuste"), F.col("sd").alias("meta_desafio_sem_ajuste")))
    return updated.unionByName(inserted)


# --------------------------------------------------------------------------- reference series

def group_reference(sales: DataFrame, store_dimension: DataFrame, indicators: DataFrame) -> DataFrame:
    """Monthly like-for-like revenue of active stores, growth and market context.

    The monthly series has one row per month of data (a few hundred rows), so
    its lag / moving windows run in one small partition.
    """
    checkpoint_dir(sales.sparkSession)
    active = active_stores(store_dimension).select("empresa_id", F.lit(True).alias("ativa"))
    # the fact is read once: a row per month, with the revenue of active stores
    monthly = (sales.select(F.trunc("data_venda", "MM").alias("mes"), "empresa_id", "valor_venda_liquido")
                    .join(active, "empresa_id", "left").groupBy("mes")
                    .agg(F.sum(F.when(F.col("ativa"), F.col("valor_venda_liquido"))).alias("faturamento"))
                    .where(F.col("mes").isNotNull()).checkpoint(eager=True))
    bounds = monthly.agg(F.min("mes").alias("lo"), F.max("mes").alias("incompleto"))
    spine = bounds.select(F.explode(F.sequence("lo", F.add_months("incompleto", 1),
                                               F.expr("INTERVAL 1 MONTH"))).alias("mes"), "incompleto")
    by_month = Window.orderBy("mes")
    base = spine.join(monthly, "mes", "left").withColumn("fat_aa", F.lag("faturamento", 12).over(by_month))
    growth = F.when(F.col("mes") >= F.col("incompleto"), F.lit(None).cast("double")) \
              .when(F.col("faturamento").isNotNull() & (F.col("fat_aa") > 0),
                    (_ratio(F.col("faturamento"), F.col("fat_aa")) - 1) * 100)
    base = base.withColumn("cresc", growth)
    base = base.withColumn("cresc6", F.avg("cresc").over(by_month.rowsBetween(-6, -1)))
    ipca = (indicators.where(F.col("indicador") == IPCA)
                      .select(F.col("data_referencia").alias("mes"), F.col("valor").alias("ipca"))
                      .withColumn("ipca12", F.sum("ipca").over(Window.orderBy("mes").rowsBetween(-11, 0))))
    pmc = indicators.where(F.col("indicador") == PMC).select(F.col("data_referencia").alias("mes"),
                                                            F.col("valor").alias("pmc"))
    out = base.join(ipca, "mes", "left").join(pmc, "mes", "left")
    return out.select(
        "mes",
        F.col("faturamento").cast("decimal(28,2)").alias("faturamento_realizado"),
        F.col("fat_aa").cast("decimal(28,2)").alias("faturamento_ano_anterior"),
        F.round("cresc", 2).alias("crescimento_yoy_mensal"),
        F.round("cresc6", 2).alias("crescimento_yoy_medio_6m"),
        F.round(F.col("fat_aa").cast("double") * (1 + F.col("cresc6") / 100), 2).alias("sugestao_meta_nominal"),
        F.round("ipca12", 2).cast("decimal(18,2)").alias("ipca_alimentos_acumulado_12m"),
        F.round("pmc", 2).cast("decimal(18,2)").alias("pmc_var_anual_setor"),
        F.round(F.col("cresc6") - F.col("ipca12").cast("double"), 2).alias("crescimento_real_estimado"),
        F.round(F.col("cresc6") - F.col("pmc").cast("double"), 2).alias("diferenca_vs_setor"),
        F.when(F.col("mes") > F.col("incompleto"), "PROJEÇÃO").when(F.col("mes") == F.col("incompleto"), "EM ANDAMENTO")
         .otherwise("REALIZADO").alias("tipo_linha"),
    )
