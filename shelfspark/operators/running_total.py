"""Running totals and lags in a fixed order, with and without a partition key.

A window would put all rows of a group in one task (and, without a key, the
whole table). Here the rows are range-partitioned on (group, order) instead,
so each range holds a contiguous slice of every group it touches and a hot
group is spread over many ranges. A reliable checkpoint fixes the ranges, each
range is summed (one row per range and group), those sums become exclusive
offsets of the groups that span several ranges, and the offsets are added to a
running sum local to each range. NULL group keys form a group of their own, as
in a window. The same steps run at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.session import checkpoint_dir

# Rows per range, about: what one task holds, whatever the table or group size.
ROWS_PER_RANGE = 250_000


def _ranged(df: DataFrame, keys: list[Column], partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``keys`` with a fixed ``_range_id``.

    The range bounds come from sampling, so recomputing the lineage could move
    rows between ranges; the checkpoint rules that out.
    """
    checkpoint_dir(df.sparkSession)
    n = partitions or max(1, -(-df.count() // ROWS_PER_RANGE))
    return (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_range_id", F.spark_partition_id()).checkpoint(eager=True))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], suffix: str) -> Column:
    cond = left["_range_id"] == right[f"_range_id{suffix}"]
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"{c}{suffix}"])
    return cond


def _spanning(per_range: DataFrame, g: list[str], suffix: str) -> DataFrame:
    """Rows of the groups that span several ranges, keys renamed for a join; at most about two rows per range."""
    ranges = F.count(F.lit(1)).over(Window.partitionBy(*g))
    out = per_range.withColumn("_ranges", ranges).where(F.col("_ranges") > 1).drop("_ranges")
    for c in ["_range_id", *g]:
        out = out.withColumnRenamed(c, f"{c}{suffix}")
    return out


def running_sum(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], value: str, cum_col: str,
                total_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``cum_col`` (rows of the group up to and including this one) and optionally the group's total.

    ``order`` must be a total order within a group; without ``group_cols`` the
    whole table is one group. ``df`` should be materialised: it is counted.
    """
    g = list(group_cols)
    ranged = _ranged(df, [F.col(c).asc() for c in g] + list(order), partitions)
    per_range = ranged.groupBy("_range_id", *g).agg(F.sum(value).alias("_range_sum"))
    zero = F.lit(0).cast(per_range.schema["_range_sum"].dataType)
    x = "_x"
    by_group = Window.partitionBy(*[f"{c}{x}" for c in g])
    before = by_group.orderBy(f"_range_id{x}").rowsBetween(Window.unboundedPreceding, -1)
    parts = _spanning(per_range, g, x)
    offsets = parts.select(f"_range_id{x}", *[f"{c}{x}" for c in g],
                           F.coalesce(F.sum("_range_sum").over(before), zero).alias("_offset"),
                           F.sum("_range_sum").over(by_group).alias("_group_total"))
    joined = ranged.join(F.broadcast(offsets), _same(ranged, offsets, g, x), "left")  # about two rows per range
    local = Window.partitionBy("_range_id", *g)
    up_to = local.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined.withColumn(cum_col, F.coalesce(F.col("_offset"), zero) + F.sum(value).over(up_to))
    if total_col:
        out = out.withColumn(total_col, F.coalesce(F.col("_group_total"), F.sum(value).over(local)))
    return out.drop("_range_id", "_offset", "_group_total", f"_range_id{x}", *[f"{c}{x}" for c in g])


def ranged_lag(df: DataFrame, group_cols: Sequence[str], order_col: str, col: str, out_col: str,
               partitions: int | None = None) -> DataFrame:
    """``lag(col) over (partition by group order by order_col)`` without a task per group.

    The first row of a range takes the last value of the previous range of the
    same group. ``order_col`` must be unique within a group.
    """
    g = list(group_cols)
    ranged = _ranged(df, [F.col(c).asc() for c in g] + [F.col(order_col).asc()], partitions)
    last = ranged.groupBy("_range_id", *g).agg(F.max_by(col, order_col).alias("_last"),
                                               F.min(order_col).alias("_first_seq"))
    x = "_x"
    by_group = Window.partitionBy(*[f"{c}{x}" for c in g]).orderBy(f"_range_id{x}")
    carry = _spanning(last, g, x).withColumn("_carry", F.lag("_last").over(by_group)).drop("_last")
    joined = ranged.join(F.broadcast(carry), _same(ranged, carry, g, x), "left")  # about two rows per range
    local = F.lag(col).over(Window.partitionBy("_range_id", *g).orderBy(order_col))
    first_in_range = F.col(order_col) == F.col("_first_seq")
    out = joined.withColumn(out_col, F.when(first_in_range, F.col("_carry")).otherwise(local))
    return out.drop("_range_id", "_first_seq", "_carry", f"_range_id{x}", *[f"{c}{x}" for c in g])
