"""Calendar and hour dimensions.

The day spine is generated with ``sequence`` + ``explode`` from a one-row
frame; holidays are fixed dates x years plus Easter-based movable feasts;
month metrics are windows partitioned by (year, month), so each window
partition holds at most 31 rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.functions.columns import padded

# Portuguese month and weekday names (ISO weekday 1 = Monday).
MONTH_NAMES = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro",
               "Outubro", "Novembro", "Dezembro"]
MONTH_ABBR = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
WEEKDAY_NAMES = ["Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado",
                 "Domingo"]
WEEKDAY_ABBR = ["Seg", "Ter", "Qua", "Qui", "Sex", "Sáb", "Dom"]
# Movable feasts as day offsets from Easter Sunday.
MOVABLE_FEASTS = [("Carnaval", -47), ("Sexta-feira da Paixão", -2), ("Corpus Christi", 60)]
HOUR_PERIODS = [(6, "MADRUGADA"), (12, "MANHÃ"), (18, "TARDE"), (24, "NOITE")]


def _idiv(a: Column, b) -> Column:
    """Integer division of non-negative values."""
    return F.floor(a / b).cast("int")


def with_easter(years: DataFrame, year_col: str = "ano", out_col: str = "pascoa") -> DataFrame:
    """Add the Gregorian Easter Sunday of each year (Tøndering's formulation).

    Each intermediate is its own projection, so Catalyst keeps them as
    columns instead of inlining the nested formula several times.
    """
    y = F.col(year_col).cast("int")
    df = years.withColumn("_g", y % 19).withColumn("_c", _idiv(y, 100))
    c, g = F.col("_c"), F.col("_g")
    df = df.withColumn("_h", ((c - _idiv(c, 4) - _idiv(8 * c + 13, 25) + 19 * g + 15) % 30).cast("int"))
    h = F.col("_h")
    df = df.withColumn("_i", h - _idiv(h, 28) * (1 - _idiv(F.lit(29), h + 1) * _idiv(21 - g, 11)))
    i = F.col("_i")
    df = df.withColumn("_j", ((y + _idiv(y, 4) + i + 2 - c + _idiv(c, 4)) % 7).cast("int"))
    df = df.withColumn("_l", i - F.col("_j"))
    df = df.withColumn("_m", 3 + _idiv(F.col("_l") + 40, 44))
    df = df.withColumn(out_col, F.make_date(y, F.col("_m"), F.col("_l") + 28 - 31 * _idiv(F.col("_m"), 4)))
    return df.drop("_g", "_c", "_h", "_i", "_j", "_l", "_m")


def day_spine(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("data"))


def holidays(spark: SparkSession, years: DataFrame, fixed: DataFrame) -> DataFrame:
    """One row per holiday date; names of coinciding holidays joined with ' / ' in name order."""
    # the seed is a handful of rows: they become a literal array expanded per year
    seed = [F.struct(F.lit(r["mes"]).alias("mes"), F.lit(r["dia"]).alias("dia"), F.lit(r["nome"]).alias("nome"))
            for r in fixed.select("mes", "dia", "nome").collect()]
    fixed_days = (years.select("ano", F.explode(F.array(*seed)).alias("f"))
                       .select(F.make_date("ano", "f.mes", "f.dia").alias("data"), F.col("f.nome").alias("nome")))
    feasts = F.array(*[F.struct(F.date_add("pascoa", off).alias("data"), F.lit(name).alias("nome"))
                       for name, off in MOVABLE_FEASTS])
    movable = with_easter(years).select(F.inline(feasts))
    both = fixed_days.unionByName(movable)
    return (both.groupBy("data")
            .agg(F.array_join(F.array_sort(F.collect_list("nome")), " / ").alias("nome")))


def calendar_dim(spark: SparkSession, start: Column, end: Column, as_of: Column, fixed: DataFrame) -> DataFrame:
    """Day dimension from ``start`` to ``end``; ``as_of`` stands for today."""
    spine = day_spine(spark, start, end)
    years = spine.select(F.year("data").alias("ano")).distinct()
    hol = holidays(spark, years, fixed)
    d = F.col("data")
    dow = F.dayofweek(d)  # 1 = Sunday
    iso_dow = ((dow + 5) % 7) + 1
    month = F.month(d)
    base = spine.join(hol, "data", "left").select(
        "data",
        F.when(d < as_of, "Passado").when(d == as_of, "Presente").otherwise("Futuro").alias("periodo"),
        F.year(d).alias("ano_num"), F.quarter(d).alias("trimestre_num"), month.alias("mes_num"),
        F.element_at(F.array(*map(F.lit, MONTH_NAMES)), month).alias("mes_nome"),
        F.element_at(F.array(*map(F.lit, MONTH_ABBR)), month).alias("mes_nome_abrev"),
        F.concat(F.element_at(F.array(*map(F.lit, MONTH_ABBR)), month), F.lit("/"), F.date_format(d, "yy"))
         .alias("mes_ano_nome"),
        F.extract(F.lit("YEAROFWEEK"), d).alias("ano_iso_num"),
        F.weekofyear(d).alias("semana_iso_num"),
        F.dayofmonth(d).alias("dia_mes_num"),
        iso_dow.alias("dia_semana_num"),
        F.element_at(F.array(*map(F.lit, WEEKDAY_NAMES)), iso_dow).alias("dia_semana_nome"),
        F.element_at(F.array(*map(F.lit, WEEKDAY_ABBR)), iso_dow).alias("dia_semana_abrev"),
        (iso_dow >= 6).alias("ind_fim_semana"),
        F.col("nome").alias("feriado_nome"),
        F.col("nome").isNotNull().alias("ind_feriado"),
        ((iso_dow <= 5) & F.col("nome").isNull()).alias("dia_util"),
        # the network opens every day except 1 January and 1 May
        (~(((month == 1) & (F.dayofmonth(d) == 1)) | ((month == 5) & (F.dayofmonth(d) == 1)))).alias("dia_util_rede"),
        F.when(F.dayofmonth(d) <= 10, "01-10").when(F.dayofmonth(d) <= 24, "11-24").otherwise("25-FIM")
         .alias("faixa_mes"),
        F.date_sub(d, 364).alias("data_equivalente_aa"),
    )
    w = Window.partitionBy("ano_num", "mes_num").orderBy("data")
    open_day = F.col("dia_util_rede").cast("int")
    return base.select(
        "*",
        F.when(F.col("dia_util_rede"), F.sum(open_day).over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .alias("dia_util_seq_mes"),
        F.sum(open_day).over(Window.partitionBy("ano_num", "mes_num")).alias("dia_util_total_mes"),
        # days after this one, so the last day of the month counts 0
        F.coalesce(F.sum(open_day).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
         .alias("dia_util_restante_mes"),
    )


def hour_dim(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    period = None
    for limit, name in HOUR_PERIODS:
        period = F.when(h < limit, name) if period is None else period.when(h < limit, name)
    return spark.range(24).select(
        h.alias("hora_num"),
        F.concat(padded(h, 2), F.lit("h")).alias("hora_texto"),
        period.alias("periodo"),
        F.when(h < 12, "AM").otherwise("PM").alias("am_pm"),
    )


def data_calendar_bounds(sales: DataFrame) -> DataFrame:
    """One row: first day of the data's first year, the newest date, and that + 5 years."""
    return sales.agg(F.min("data_venda").alias("_min"), F.max("data_venda").alias("as_of")).select(
        F.make_date(F.year("_min"), F.lit(1), F.lit(1)).alias("inicio"), "as_of",
        F.add_months("as_of", 60).alias("fim"))


def calendar_from_facts(spark: SparkSession, sales: DataFrame, fixed: DataFrame) -> DataFrame:
    """Calendar spanning the sales data (first year .. newest sale + 5 years).

    The bounds are one aggregate row read back to the driver as three dates.
    """
    row = data_calendar_bounds(sales).first()
    start, as_of, end = row["inicio"], row["as_of"], row["fim"]
    if start is None:
        start = as_of = end = dt.date.today()
    return calendar_dim(spark, F.lit(start), F.lit(end), F.lit(as_of), fixed)
