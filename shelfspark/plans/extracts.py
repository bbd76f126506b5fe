"""Source extracts: windows, ranges, header-driven item windows, load stamp,
hourly pre-aggregation of sales and the net-of-returns receipt costs.

All filters are plain predicates on source columns, so on parquet (or JDBC)
they are pushed into the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.plans.facts import SALES_OPERATIONS
from shelfspark.session import join_within_partitions

MONEY = "decimal(18,2)"


def stamp(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Add the load timestamp of the run (one value for every row of the run)."""
    return df.withColumn("_loaded_at", F.lit(run_ts).cast("timestamp_ntz"))


def window_extract(df: DataFrame, date_col: str, as_of: dt.date, days: int) -> DataFrame:
    """Rolling window: ``date_col >= as_of - days``."""
    return df.where(F.col(date_col) >= F.lit(as_of - dt.timedelta(days=days)))


def stock_ledger_extract(df: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Stock-ledger window keeping only movements that change stock: flag 'S' or
    NULL (a NULL flag counts as changing). The flag itself is not extracted."""
    flag = F.col("geralteracaoestq")
    changes = df.where((flag == "S") | flag.isNull())
    return window_extract(changes, "dtaentradasaida", as_of, days).drop("geralteracaoestq")


def range_extract(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Inclusive range ``BETWEEN start AND end``. With a date ``end`` and a
    timestamp column, times after midnight of the last day fall outside, as in
    the source's backfill jobs."""
    return df.where(F.col(date_col).between(F.lit(start), F.lit(end)))


def items_in_header_window(items: DataFrame, headers: DataFrame, keys: list[str], header_date: str,
                           as_of: dt.date, days: int) -> DataFrame:
    """Items have no date of their own: keep those whose header is in the window.

    A left semi join on the header key (unique per header), so items are
    never duplicated; the windowed headers are small next to the items.
    """
    recent = window_extract(headers, header_date, as_of, days).select(*keys)
    return items.join(recent, keys, "left_semi")


def unit_packs(items: DataFrame) -> DataFrame:
    """Promotion items of unit packs only, as the extract takes them."""
    return items.where(F.col("qtdembalagem") == 1)


def checkouts_of_main_segment(checkouts: DataFrame, stores: DataFrame) -> DataFrame:
    """Checkouts whose segment is the store's main segment."""
    main = stores.select(F.col("nroempresa").alias("_e"), F.col("nrosegmentoprinc").cast("int").alias("_s"))
    return checkouts.join(main, (F.col("nroempresa") == F.col("_e")) & (F.col("nrosegmento") == F.col("_s")),
                          "left_semi")


def hourly_sales(joined: DataFrame) -> DataFrame:
    """Joined ``sales_lines`` pre-aggregated to the hour over the ten grouping keys of the extract.

    The discount is net of the
    discount on returned items. A promotional value above zero is net of the
    line's discount; a line without one counts its value less the returned
    value when the product is in a promotion, else nothing.
    """
    hour = F.date_trunc("hour", F.col("datahora")).cast("timestamp_ntz")
    promoted = F.col("vlrvendapromoc")
    discount = F.when(promoted > 0, F.coalesce(F.col("vlrdescitem"), F.lit(0))).otherwise(0)
    in_promotion = F.coalesce(F.col("seqpromoc"), F.lit(0)) != 0
    fallback = F.when(in_promotion, F.round("vlritem", 2) - F.col("vlrdevolitem")).otherwise(0)
    return (joined.groupBy(hour.alias("datahora"), "nroempresa", "nrodocto", "seriedocto", "checkout", "nroformapagto",
                     "nrosegmento", "codgeraloper", "seqproduto", "seqoperador")
            .agg(F.sum("qtditem").alias("qtditem"), F.sum("qtddevolitem").alias("qtddevolitem"),
                 F.sum("vlritem").alias("vlritem"), F.sum("vlrdevolitem").alias("vlrdevolitem"),
                 F.sum(F.col("vlrdescitem") - F.col("vlrdescdevolitem")).cast(MONEY).alias("vlrdescitem"),
                 F.sum(F.coalesce(promoted - discount, fallback)).cast(MONEY).alias("vlrvendapromoc"),
                 F.sum(net_cogs()).cast(MONEY).alias("vlrctoliqvda"), F.count(F.lit(1)).alias("qtdlinhas")))


NO_ADVANCE = (23, 24, 27)  # fixed: fiscal calculation types without advance ICMS


def icms_credit(side: str) -> Column:
    """ICMS credited on a line, ``side`` '' (received) or 'd' (returned part).

    None with tax substitution or a booked ST (C, S). Otherwise the calculated
    ICMS plus the presumed one; plus the advance ICMS unless the calculated
    value is negative or the calculation type has none; without a calculated
    value the invoice's ICMS, with the poverty-fund part where it counts.
    """
    v = lambda name: F.col(side + name)
    advance = F.when(F.col("tipocalcicmsfisci").isin(*NO_ADVANCE), F.lit(0)).otherwise(v("vlricmsantecipado"))
    fund = F.when((F.col("indsomafcpicmscusto") == "S") & (F.col("vlricms") > 0) & (F.col("vlricmsst") == 0),
                  F.coalesce(v("vlrfcpicms"), F.lit(0))).otherwise(0)
    tree = (F.when(v("vlricmscalc").isNull(), v("vlricms") + fund + advance + v("vlricmspresumido"))
             .when(v("vlricmscalc") < 0, v("vlricmscalc") + v("vlricmspresumido"))
             .otherwise(v("vlricmscalc") + advance + v("vlricmspresumido")))
    booked = F.coalesce(F.col("lancamentost").isin("C", "S"), F.lit(False))
    return F.when(v("vlricmsst") == 0, F.when(booked, F.lit(0)).otherwise(tree)).otherwise(0)


def _sum_of(side: str, plus: str, minus: str = "") -> Column:
    total = F.lit(0)
    for n in plus.split():
        total = total + F.col(side + n)
    for n in minus.split():
        total = total - F.col(side + n)
    return total


def receipt_measures(lines: DataFrame) -> DataFrame:
    """Receipt lines with the measures that ``receipt_costs`` sums instead of the values they are made of.

    Those of the received and of the returned part (prefix d) stay apart, as
    each is summed by itself.
    """
    charges = "vlritem vlripi vlricmsdi vlrdesptributitem vlrdespntributitem vlrdespforanf"
    discounts = "vlrdescitem vlrdescfinanceiro vlrdesctransf vlrdescsuframa"
    booked = F.coalesce(F.col("lancamentost") == "S", F.lit(False))

    def st(st_col: str, fund_col: str) -> Column:
        return F.when(booked, F.lit(0)).otherwise(F.col(st_col) + F.col(fund_col))

    def entry(d: str) -> Column:
        return _sum_of(d, charges + " vlricmsst vlrfcpst", "vlrdescitem")

    def gross(d: str) -> Column:
        return _sum_of(d, charges, discounts) + st(f"{d}vlricmsst", f"{d}vlrfcpst")

    def net(d: str) -> Column:
        parts = _sum_of(d, charges.replace("vlricmsdi ", ""), discounts + " vlrimpostopresumcusto vlrpis vlrcofins vlrcredipi")
        return parts + F.col("vlricmsdi") + st(f"{d}vlricmsst", "vlrfcpst") - icms_credit(d)

    invoice = (_sum_of("", "vlritem vlricmsstnf vlripi vlricmsdi vlrdesptributitem vlrdespntributitem vlrfcpst", "vlrdescitem")
               - _sum_of("d", "vlritem vlricmsst vlripi vlrdesptributitem vlrdespntributitem vlrfcpst", "vlrdescitem"))
    return lines.select(
        "nroempresa", "dtaentrada", "dtaemissao", "seqproduto", "nrodocto", "seqpessoa", "codgeraloper", "operador",
        "nrodivisao", "nrosegmentoprinc", (F.col("qtditem") - F.col("dqtditem")).alias("quantidade"),
        *[of(d).alias(f"{d}{name}") for name, of in (("entrada", entry), ("custobruto", gross), ("custoliquido", net)) for d in ("", "d")],
        (F.col("vlritem") - F.col("dvlritem")).alias("produto"), invoice.alias("totalnf"),
        (_sum_of("", discounts + " vlropcontratodesc") - _sum_of("d", discounts + " vlropcontratodesc")).alias("descontos"),
        (invoice * F.col("prazomediopag")).alias("totalnfprazo"))


def receipt_lines(lines: DataFrame, products: DataFrame, family_divisions: DataFrame, family_segments: DataFrame,
                  packs: DataFrame, stores: DataFrame, divisions: DataFrame, costs: DataFrame) -> DataFrame:
    """Measures of the receipt lines joined to product, family division, main segment, default sales pack, store, division and last costs.

    The lines move once, to their product, whose family tables are joined
    beforehand; sums per product and more need no further move.
    """
    join_within_partitions(lines.sparkSession)
    default_pack = packs.where(F.col("padraovenda") == "S").select("seqfamilia", "qtdembalagem")
    segments = family_segments.select("seqfamilia", F.col("nrosegmento").alias("nrosegmentoprinc"))
    own = (products.select("seqproduto", "seqfamilia", "seqprodutobase", "percacresccustorelacvig")
                   .join(default_pack, "seqfamilia").join(family_divisions.select("seqfamilia", "nrodivisao"), "seqfamilia")
                   .join(segments, "seqfamilia"))
    own_stores = receipt_measures(lines).join(F.broadcast(stores.select("nroempresa")), "nroempresa")
    return (own_stores.repartition("seqproduto").join(own, ["seqproduto", "nrodivisao", "nrosegmentoprinc"])
                      .join(F.broadcast(divisions), "nrodivisao").join(costs, ["seqproduto", "nroempresa"]))


def receipt_costs(lines: DataFrame) -> DataFrame:
    """Receipt measures net of returns, per the ten keys of the extract, of joined ``receipt_lines``.

    * entry value = item + IPI + import duty + expenses + ST + fund - discount;
    * gross cost = the same without ST where it is booked ('S') and less the
      financial, transfer and free-zone discounts, times the surcharge factor;
    * net cost = gross parts less presumed tax, the ICMS credit, PIS, COFINS and
      IPI credits; as in the source, the factor multiplies only the returns'
      sum, which takes import duty and ST fund from the received line;
    * fiscal cost = max(0, last net unit cost - off-invoice discount) x net qty;
    * payment term = invoice-value-weighted mean (NULL when the value is 0).
    """
    unit = F.greatest(F.lit(0), F.coalesce(F.col("cmultcusliquidoemp") - F.coalesce(F.col("cmultdctoforanfemp"), F.lit(0)), F.lit(0)))
    # the greatest flag is 'S', as a number: sums beside a text would have to be sorted
    used = F.max(F.when(F.col("utilacresccustprodrelac") > "S", 2).when(F.col("utilacresccustprodrelac") == "S", 1).otherwise(0)) == 1
    factor = F.when(F.max("seqprodutobase").isNotNull() & used,
                    F.coalesce(F.max("percacresccustorelacvig"), F.lit(1))).otherwise(1)
    dated = lines.withColumn("nrodocumento", F.concat(F.col("nroempresa").cast("string"), F.col("nrodocto").cast("string"),
                                                      F.col("seqpessoa").cast("string")))
    money = lambda c: c.cast(MONEY)
    out = dated.groupBy("nroempresa", "dtaentrada", "dtaemissao", "seqproduto", "nrodocto", F.col("seqpessoa").alias("seqfornecedor"),
                        "nrodocumento", "codgeraloper", "operador", "qtdembalagem").agg(
        F.sum("quantidade").cast("decimal(28,3)").alias("quantidade"),
        money(F.sum("entrada") - F.sum("dentrada")).alias("vlrentrada"),
        money((F.sum("custobruto") - F.sum("dcustobruto")) * factor).alias("vlrcustobruto"),
        money(F.sum("custoliquido") - F.sum("dcustoliquido") * factor).alias("vlrcustoliquido"),
        money(F.sum("produto")).alias("vlrproduto"),
        money(F.sum("totalnf")).alias("vlrtotalnf"),
        money(F.sum("descontos")).alias("vlrdescontos"),
        money(F.sum(unit * F.col("quantidade"))).alias("custofiscaltotalentrada"),
        F.sum("totalnfprazo").alias("_vp"), F.sum("totalnf").alias("_v"))
    ratio = F.col("_vp").cast("double") / F.when(F.col("_v") != 0, F.col("_v")).cast("double")
    return out.withColumn("prazomediopag", F.round(ratio, 6)).drop("_vp", "_v")


def sales_lines(lines: DataFrame, day_costs: DataFrame, products: DataFrame, family_divisions: DataFrame, packs: DataFrame,
                stores: DataFrame, divisions: DataFrame, surcharges: DataFrame) -> DataFrame:
    """Sales lines joined to product, family division, unit pack, store, division, cost product, day cost and surcharge.

    The day cost is that of the line's cost product on the day, in the store
    that the line's store takes its costs from. Lines without a match fall out,
    save for the surcharge of the product on the day, which may be missing.
    The lines, many and wide, move twice: to the cost product and its day
    costs, then to the product, whose family tables are joined beforehand, and
    its surcharges. Sums per product and more need no further move.
    """
    join_within_partitions(lines.sparkSession)
    own = products.select("seqproduto", "seqfamilia", "propqtdprodutobase",
                          F.coalesce("seqprodutobase", "seqprodutobaseantigo").alias("seqprodutobase"))
    single = packs.where("qtdembalagem = 1").select("seqfamilia")
    store = stores.select("nroempresa", F.coalesce("nroempcustoabc", "nroempresa").alias("nroempcusto"),
                          F.col("nrodivisao").alias("nrodivisaoempresa"))
    division = divisions.select(F.col("nrodivisao").alias("nrodivisaoempresa"), "utilacresccustprodrelac")
    costed = products.select(F.col("seqproduto").alias("seqprodutocusto"))
    costs = (day_costs.withColumnRenamed("seqproduto", "seqprodutocusto").withColumnRenamed("nroempresa", "nroempcusto")
                      .withColumnRenamed("dtaentradasaida", "dtavda"))
    dated = surcharges.withColumnRenamed("dtamovimentacao", "dtavda")
    divided = own.join(family_divisions.select("seqfamilia", "nrodivisao"), "seqfamilia").join(single, "seqfamilia")
    at_store = F.broadcast(store.join(division, "nrodivisaoempresa"))
    costed_lines = (lines.where(F.col("codgeraloper").isin(SALES_OPERATIONS)).join(at_store, "nroempresa")
                         .join(costed, "seqprodutocusto").join(costs, ["seqprodutocusto", "nroempcusto", "dtavda"]))
    return costed_lines.repartition("seqproduto").join(divided, ["seqproduto", "nrodivisao"]).join(dated, ["seqproduto", "dtavda"], "left")


def _quotient(num: Column, den: Column) -> Column:
    """Quotient rounded half up to 10 places; 0 for a divisor of 0 or NULL, as the ERP's safe divide is assumed to give."""
    exact = num.cast("decimal(20,10)") / den.cast("decimal(12,3)")
    return F.when(den.isNull() | (den == 0), F.lit(0)).otherwise(exact).cast("decimal(22,10)")


def net_cogs() -> Column:
    """Net cost of goods sold of a joined sales line, in decimals: the sum does not depend on the order of tasks.

    Unit day cost net of the accord discount per unit, plus IPI, ICMS-ST and
    invoice / off-invoice expenses, minus the ICMS, PIS, COFINS and IPI credits
    and the off-invoice discount; times the surcharge factor (where the division
    uses it and the product has a base product: the recorded one, else the
    function's, else 1) and the base-product ratio (1 when missing); minus the
    allowance per unit (when an allowance quantity exists) plus the accrued
    allowance per unit (for lines that accrue it); all times the net quantity.
    Quotients have 10 places, the cost of a unit 12.
    """
    v, nothing = F.col, F.lit(0)
    net_qty = v("qtditem") - v("qtddevolitem")
    ratio = F.coalesce("propqtdprodutobase", F.lit(1)).cast("decimal(5,4)")
    factor = F.when((v("utilacresccustprodrelac") == "S") & v("seqprodutobase").isNotNull(),
                    F.coalesce("percacresccustorelacvig", "acresccustorelac", F.lit(1))).otherwise(1).cast("decimal(6,4)")
    accord = _quotient(_quotient(v("vlrdescacordoverbapdv"), net_qty), v("qtdembalitem"))
    credits = sum((F.coalesce(c, nothing) for c in ("cmdiacredpis", "cmdiacredcofins", "cmdiacredipi")), v("cmdiacredicms"))
    unit = (v("cmdiavlrnf") - accord + v("cmdiaipi") - credits + v("cmdiaicmsst") + v("cmdiadespnf")
            + v("cmdiadespforanf") - v("cmdiadctoforanf"))
    sold = F.coalesce("qtdvda", nothing)
    allowance = F.when(v("qtdverbavda") == 0, nothing).otherwise(
        _quotient(v("vlrverbavda") * ratio, F.when(sold == 0, v("qtdverbavda")).otherwise(sold)))
    accrual = F.coalesce("vlrverbavdaacr", nothing)
    accrued = F.when(v("acmcompravenda") == "N", nothing).otherwise(
        _quotient(accrual * ratio, F.when(sold == 0, F.lit(1)).otherwise(sold)))
    each = unit.cast("decimal(20,10)") * factor * ratio - allowance.cast("decimal(20,10)") + accrued.cast("decimal(20,10)")
    return each.cast("decimal(24,12)") * net_qty.cast("decimal(13,3)")


def sales_net_cost(joined: DataFrame) -> DataFrame:
    """Net cost of goods sold and net quantity per day x store x product, of joined ``sales_lines``."""
    return (joined.groupBy(F.col("dtavda").alias("data_venda"), F.col("nroempresa").alias("empresa_id"),
                           F.col("seqproduto").alias("produto_id"))
                  .agg(F.sum(net_cogs()).cast(MONEY).alias("vlrctoliqvda"),
                       F.sum(F.col("qtditem") - F.col("qtddevolitem")).cast("decimal(28,3)").alias("qtd_liquida")))
