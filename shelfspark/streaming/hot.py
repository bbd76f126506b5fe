"""Intraday ("hot") path: landed sales extracts -> sales fact, as a stream.

Each extraction run lands a file set in a folder, tagged with the run's day
(``lote``). A Structured Streaming file source picks up new files
(``trigger(availableNow=True)`` processes what has landed and stops, the way
the scheduled runs do), and ``foreachBatch`` merges every run into the
month-partitioned fact with the keyed delete+insert. Inside one
micro-batch only the newest run's rows of each key are kept (what applying
the runs in ``lote`` order would leave), so a later re-extract of a day
replaces the earlier rows of the same key; a run replayed after a failure
gives the same table (the merge is idempotent), and one checkpoint per query
keeps a single writer. No watermark or state store is needed: late rows are
handled by re-sending the window, not by event-time state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import publish
from shelfspark.operators.incremental import load_delete_insert
from shelfspark.plans import facts, silver

PARTITION_COL = "mes_part"


def with_month_partition(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(PARTITION_COL, (F.year(date_col) * 100 + F.month(date_col)).cast("int"))


def sales_batch_to_fact(raw: DataFrame) -> DataFrame:
    """Raw sales extract rows -> fact rows (silver projection + operation filter), keeping the run tag."""
    return with_month_partition(facts.sales_fact(silver.sales_lines(raw)), "data_venda")


def latest_run_per_key(fact_rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the newest run (``lote``) per key: applying the runs of a micro-batch
    one by one with delete+insert leaves exactly these rows.

    A key with a NULL part never matches in delete+insert, so such rows of
    every run stay. For the others the newest run per key is an aggregate
    (combined map-side, so a hot key does not gather in one task) joined back
    on the key."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    keyed = fact_rows.where(whole)
    newest = keyed.groupBy(*key).agg(F.max("lote").alias("_newest"))
    latest = keyed.join(newest, list(key)).where(F.col("lote") == F.col("_newest")).drop("_newest")
    return latest.unionByName(fact_rows.where(~whole)).drop("lote")


def merge_runs(target_path: str, to_fact: Callable[[DataFrame], DataFrame], key: list[str], stream: str):
    """``foreachBatch`` function: one delete+insert per micro-batch, newest run per key.

    ``stream`` names the query. The table's commit records hold the number of
    its last merged batch, so a batch replayed after a crash is left out.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # a micro-batch of empty files changes nothing
            return
        last = publish.newest(batch.sparkSession, target_path)
        if last is not None and last.batches.get(stream, -1) >= batch_id:
            return
        rows = latest_run_per_key(to_fact(batch), key)
        load_delete_insert(batch.sparkSession, target_path, rows, key, PARTITION_COL, partition_from_key=True,
                           sort_cols=("empresa_id", "produto_id"), batches={stream: batch_id})
    return apply


def run_hot_path(spark: SparkSession, landing_dir: str, target_path: str, checkpoint: str,
                 files_per_trigger: int | None = None) -> None:
    """Process everything that has landed, then stop (``availableNow``).

    Runs may land as plain files or as ``lote=<run>`` folders. Within a
    micro-batch the newest run per key wins whatever the file order; with
    ``files_per_trigger`` set, runs split over several micro-batches must
    land in run order (as sequential extractions do).
    """
    schema = spark.read.parquet(landing_dir).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(landing_dir)
    query = (stream.writeStream
                   .foreachBatch(merge_runs(target_path, sales_batch_to_fact, facts.SALES_KEY, checkpoint))
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()
