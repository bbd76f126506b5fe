"""Small helpers shared by the operators: reading tables and cutting lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.session import scratch_path

# Rows of one Arrow batch sent to a Python worker. A document may be very long,
# so batches stay far below the default of 10,000 rows.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    Later jobs start from the files, so a lost executor costs no recomputation
    of what came before, and every job sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def row_key(text=None):
    """Names a row by its doc_id and text, so that null or repeated doc_ids stay apart."""
    text = text_or_empty() if text is None else text
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(text, 256))


def one_per(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row of each group of ``keys``, the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
