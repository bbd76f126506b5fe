"""Incremental sinks: keyed delete+insert, upsert, and their on-disk load.

``delete_insert`` is the merge rule of the incremental facts: every target
row whose key appears in the batch is removed and the whole batch is added
(duplicates inside the batch survive; a NULL key part never matches, as
with SQL equality). New batch columns are added to the table with NULL for
old rows (``unionByName(allowMissingColumns=True)``).

``load_delete_insert`` applies it to a month-partitioned table of commit
records (``publish.py``): only the files that hold one of the batch's keys are
rewritten, and the change becomes visible by one record. Rows with a NULL
partition value form a partition like any other. Applying the same batch again
gives the same table, so a failed run can be retried.

``load_range`` is the sink of a backfill: the batch replaces exactly the rows
of its date range, whatever their keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.operators import publish
from shelfspark.session import scratch_path


def delete_insert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    keys = batch.select(*key).distinct()
    kept = target.join(keys, list(key), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Insert new keys, replace existing ones; inside ``rows`` the first in ``order`` wins."""
    w = Window.partitionBy(*key).orderBy(*[o for o in order])
    latest = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    kept = target.join(latest.select(*key), list(key), "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def since_batch_start(stg: DataFrame, raw_batch: DataFrame, stg_date: str, raw_date: Column,
                      first_load: bool) -> DataFrame:
    """Incremental source filter: ``stg_date >= MIN(raw date)`` except on the first load.

    Rows with a NULL date pass on the first load and are dropped afterwards,
    as the comparison with NULL is never true.
    """
    if first_load:
        return stg
    lo = raw_batch.agg(F.min(raw_date)).first()[0]
    if lo is None:  # empty batch: nothing passes, as in SQL
        return stg.limit(0)
    return stg.where(F.col(stg_date) >= F.lit(lo))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = publish.file_system(spark, path)
    fs.delete(p, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table: a commit, or plain files. A first write that stopped half-way is none."""
    if publish.is_published(spark, path):
        return publish.newest(spark, path) is not None
    fs, p = publish.file_system(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    commit = publish.newest(spark, path)
    if commit is not None:
        return publish.read(spark, path, commit)
    return spark.read.option("mergeSchema", "true").parquet(path)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None when nothing readable is there yet (no folder,
    or a folder left by a load that had no rows)."""
    if not table_exists(spark, path):
        return None
    try:
        return read_table(spark, path)
    except AnalysisException:
        return None


def laid_out(df: DataFrame, partition_col: str, sort_cols: Sequence[str] = ()) -> DataFrame:
    """Write layout of a partitioned table: range-partitioned on (partition, sort
    columns) and sorted within tasks. A month holding a third of the rows is
    spread over many balanced write tasks instead of one, and the sorted
    files carry tight min/max statistics on the sort columns for skipping.
    Rows equal in all of these (say without a month and a key) are spread by a
    hash of the whole row."""
    keys = [partition_col, *sort_cols]
    return df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)


def full_refresh(spark: SparkSession, path: str, df: DataFrame, partition_col: str, window_only_source: bool,
                 sort_cols: Sequence[str] = ()) -> None:
    """Rebuild a table from scratch; refused for facts whose source only holds a window."""
    if window_only_source and table_exists(spark, path):
        raise ValueError(f"{path}: the source holds only a rolling window; a full rebuild would drop history")
    publish.overwrite(laid_out(df, partition_col, sort_cols), path, partition_col)


def load_delete_insert(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str],
                       partition_col: str, partition_from_key: bool = False,
                       sort_cols: Sequence[str] = (), batches: dict[str, int] | None = None) -> None:
    """Merge ``batch`` into the table at ``path`` (partitioned by ``partition_col``).

    ``partition_from_key`` declares that the partition value is a function of
    the key (e.g. the month of a date in the key), so a key never moves
    between partitions and only the batch's own partitions are looked at.
    ``batches`` names streams and the numbers of their batches in this merge.
    Without ``sort_cols`` the files are laid out by the key.
    """
    # the batch is used several times below: evaluate it once
    arrived = scratch_path(spark, f"batch-{uuid.uuid4().hex}")
    batch.write.parquet(arrived)
    stored = spark.read.schema(batch.schema).parquet(arrived)
    publish.merge(path, stored, key, lambda df: laid_out(df, partition_col, sort_cols or key), partition_col,
                  partition_from_key or partition_col in key, batches)
    remove(spark, arrived)


def load_range(spark: SparkSession, path: str, batch: DataFrame, date_col: str, start, end, partition_col: str,
               sort_cols: Sequence[str] = (), batches: dict[str, int] | None = None) -> None:
    """Replace the rows of the table at ``path`` with ``date_col BETWEEN start AND end`` by ``batch``.

    Lines that the source no longer has in the range go, unlike in a keyed
    merge, and a second run of the same backfill changes nothing. The range is
    that of ``extracts.range_extract``: with a date ``end`` and a timestamp
    column, times after midnight of the last day are outside and stay.
    """
    # the batch is used several times below: evaluate it once
    arrived = scratch_path(spark, f"batch-{uuid.uuid4().hex}")
    batch.write.parquet(arrived)
    stored = spark.read.schema(batch.schema).parquet(arrived)
    publish.replace_range(path, stored, date_col, start, end, lambda df: laid_out(df, partition_col, sort_cols), partition_col, batches)
    remove(spark, arrived)
