import datetime as dt

from pyspark.sql import functions as F

from shelfspark.plans import calendar as cal
from shelfspark.sources import seeds


def test_easter_known_years(spark):
    years = [1954, 1981, 2024, 2025, 2038, 2049, 2076, 2285]
    expected = {1954: dt.date(1954, 4, 18), 1981: dt.date(1981, 4, 19), 2024: dt.date(2024, 3, 31),
                2025: dt.date(2025, 4, 20), 2038: dt.date(2038, 4, 25), 2049: dt.date(2049, 4, 18),
                2076: dt.date(2076, 4, 19), 2285: dt.date(2285, 3, 22)}
    df = spark.createDataFrame([(y,) for y in years], "ano int")
    got = {r["ano"]: r["pascoa"] for r in cal.with_easter(df).collect()}
    assert got == expected
    # always a Sunday between 22 March and 25 April
    many = cal.with_easter(spark.range(1900, 2400).withColumnRenamed("id", "ano")).select(F.col("pascoa").alias("d"))
    bad = many.where((F.dayofweek("d") != 1) | (F.date_format("d", "MMdd") < "0322")
                     | (F.date_format("d", "MMdd") > "0425"))
    assert bad.count() == 0


def test_calendar_attributes(spark):
    df = cal.calendar_dim(spark, F.lit(dt.date(2020, 12, 1)), F.lit(dt.date(2021, 6, 30)),
                          F.lit(dt.date(2021, 1, 15)), seeds.fixed_holidays(spark))
    rows = {r["data"]: r for r in df.collect()}
    d = rows[dt.date(2021, 1, 1)]
    assert (d["ano_iso_num"], d["semana_iso_num"], d["dia_util_rede"], d["dia_util_seq_mes"]) == (2020, 53, False, None)
    assert d["feriado_nome"] == "Ano Novo" and d["periodo"] == "Passado"
    assert rows[dt.date(2021, 1, 31)]["dia_util_restante_mes"] == 0
    assert rows[dt.date(2021, 1, 30)]["dia_util_restante_mes"] == 1
    assert rows[dt.date(2021, 1, 2)]["dia_util_seq_mes"] == 1
    assert rows[dt.date(2021, 1, 31)]["dia_util_total_mes"] == 30
    assert rows[dt.date(2021, 2, 16)]["feriado_nome"] == "Carnaval"
    assert rows[dt.date(2021, 4, 2)]["feriado_nome"] == "Sexta-feira da Paixão"
    assert rows[dt.date(2021, 1, 15)]["periodo"] == "Presente"
    assert [rows[dt.date(2021, 3, x)]["faixa_mes"] for x in (10, 11, 24, 25)] == ["01-10", "11-24", "11-24", "25-FIM"]
    assert rows[dt.date(2021, 3, 10)]["data_equivalente_aa"] == dt.date(2020, 3, 11)


def test_coinciding_holidays_are_merged(spark):
    # 2008: Good Friday fell on 21 March, 2019: no overlap; use a fixed seed that collides with Easter-2
    fixed = spark.createDataFrame([(3, 21, "Outro")], "mes INT, dia INT, nome STRING")
    years = spark.createDataFrame([(2008,)], "ano INT")
    got = {r[0]: r[1] for r in cal.holidays(spark, years, fixed).collect()}
    assert got[dt.date(2008, 3, 21)] == "Outro / Sexta-feira da Paixão"
