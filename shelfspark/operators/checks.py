"""Data-quality checks. Each returns the violating rows (empty = pass).

* ``not_null``: NULL count per column, one aggregate pass for all columns.
* ``unique``: keys (one or several columns) that occur more than once.
* ``accepted_values``: rows whose value is outside the list (NULL passes).
* ``reconciles``: allocated totals per group that differ from the target by
  more than a tolerance.
* ``sums_to_zero``: groups whose values do not sum to zero within a tolerance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(coluna, qtd_nulos) for every column, from a single aggregate."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return counts.unpivot([], cols, "coluna", "qtd_nulos").select(
        "coluna", F.coalesce("qtd_nulos", F.lit(0)).cast("long").alias("qtd_nulos"))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return null_counts(df, cols).where(F.col("qtd_nulos") > 0)


def unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values found more than once, with their count (partial aggregation per task)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("qtd")).where(F.col("qtd") > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence, key: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).select(*key, col)


def reconciles(alloc: DataFrame, targets: DataFrame, group: Sequence[str], pairs: Sequence[tuple[str, str]],
               tol: float = 1.0) -> DataFrame:
    """Groups where sum(allocated) differs from the target by more than ``tol``.

    ``pairs`` maps each allocated column to its target column.
    """
    sums = alloc.groupBy(*group).agg(*[F.sum(a).alias(a) for a, _ in pairs])
    j = sums.join(targets, list(group))
    bad = None
    for a, t in pairs:
        cond = F.abs(F.col(a) - F.col(t)) > F.lit(tol)
        bad = cond if bad is None else (bad | cond)
    return j.where(bad).select(*group, *[F.col(a) for a, _ in pairs], *[F.col(t) for _, t in pairs])


def sums_to_zero(df: DataFrame, group: Sequence[str], value: str, tol: float = 0.01) -> DataFrame:
    return (df.groupBy(*group).agg(F.sum(value).alias("soma"))
              .where(F.abs(F.col("soma")) > F.lit(tol)))
