"""Seed tables versioned with the project (loaded with an explicit schema)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# National fixed-date holidays (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "Ano Novo"),
    (5, 1, "Dia do Trabalho"),
    (9, 7, "Independência do Brasil"),
    (10, 12, "Nossa Senhora Aparecida"),
    (11, 2, "Finados"),
    (11, 15, "Proclamação da República"),
    (12, 25, "Natal"),
]

# Stores closed by a manual override (store id, closing date, reason).
CLOSED_STORES = [
    (3, dt.date(2026, 1, 31), "Encerramento de atividades"),
    (4, dt.date(2026, 1, 31), "Encerramento de atividades"),
]


def fixed_holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXED_HOLIDAYS, "mes INT, dia INT, nome STRING")


def closed_stores(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CLOSED_STORES, "empresa_id INT, data_encerramento DATE, motivo STRING")


def read_seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Seed CSV with a header and declared column types (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)
