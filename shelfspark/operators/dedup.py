"""First row per key under an order (``DISTINCT ON`` / ``ROW_NUMBER() = 1``).

Written as ``row_number() over (partition by key order by ...) = 1``: Spark
plans it as a partial ``WindowGroupLimit`` before the shuffle and a final one
after it, so even a key that holds a third of all rows leaves each map task
as a single row. Callers pass a total order (add a unique tie-break column):
ties are otherwise resolved arbitrarily, as in the source models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
