"""JDBC extract and load for the ERP and the planning database.

Extracts list their columns (so only those cross the wire) and split the
read into parallel range queries on a numeric column; window filters are
added to the WHERE clause so the source database applies them. Loads write
in batches. Connection details come from the caller; nothing is read from
the environment here.

These helpers need a reachable database. None can be started in the test
environment, so they are not exercised by the test suite; the extract logic
they feed (windows, ranges, stamps) is tested on parquet stand-ins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def extract(spark: SparkSession, url: str, table: str, columns: Sequence[str], *, where: str | None = None,
            partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
            partitions: int = 8, fetchsize: int = 1000, properties: dict[str, str] | None = None) -> DataFrame:
    """Column-listed extract, optionally split on ``partition_column`` in ``[lower, upper]``."""
    query = f"(SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {where}" if where else "") + ") src"
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", query)
                        .option("fetchsize", str(fetchsize)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(lower))
                        .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    return reader.load()


def window_predicate(date_col: str, as_of: dt.date, days: int) -> str:
    """``date_col >= as_of - days`` as a SQL predicate for the source database."""
    return f"{date_col} >= DATE '{(as_of - dt.timedelta(days=days)).isoformat()}'"


def load(df: DataFrame, url: str, table: str, *, mode: str = "overwrite", batchsize: int = 50000,
         truncate: bool = True, properties: dict[str, str] | None = None) -> None:
    """Truncate-and-load (default) or append, committing every ``batchsize`` rows."""
    writer = (df.write.format("jdbc").option("url", url).option("dbtable", table)
                .option("batchsize", str(batchsize)).option("truncate", str(truncate).lower()))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
