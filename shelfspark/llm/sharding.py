"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers in the order of doc_id; a keyed Feistel network with
cycle walking permutes 0..n-1, and the permuted number ``p`` gives shard
``p % shards`` and slot ``p // shards``. Where any row goes, and which row
number sits at any shard and slot, is computable from (n, key) alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored

ROUNDS = 6


class Feistel:
    """Keyed permutation of 0..n-1 on numpy uint64 arrays, and its inverse."""

    def __init__(self, n: int, key: int = 0):
        self.n = max(int(n), 1)
        self.half = max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)
        self.key = key

    def _round(self, x, i: int):
        import numpy as np
        # integer hash of (half block, key, round); arithmetic is modulo 2**64
        c = np.uint64(((self.key * ROUNDS + i + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = x + c
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _once(self, x, order):
        import numpy as np
        h, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> h, x & mask
        if order[0] == 0:
            for i in order:
                left, right = right, left ^ self._round(right, i)
        else:
            for i in order:
                left, right = right ^ self._round(left, i), left
        return (left << h) | right

    def _walk(self, x, order):
        import numpy as np
        y = self._once(np.asarray(x, dtype=np.uint64), order)
        out = np.flatnonzero(y >= self.n)
        while out.size:  # the block is below 4n, so few steps are needed; the cycle returns to 0..n-1
            y[out] = self._once(y[out], order)
            out = out[y[out] >= self.n]
        return y

    def forward(self, x):
        return self._walk(x, range(ROUNDS))

    def inverse(self, y):
        return self._walk(y, range(ROUNDS - 1, -1, -1))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Add ``row_number`` (0..n-1 in ``order``, nulls last) without a one-task sort.

    The rows are sorted by ranges, each range counts its own rows, and the
    ranges' counts (one number per partition) give the offsets. Rows alike in
    all of ``order`` are told apart by where they were read, so a value that
    holds many rows is spread over several ranges.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    spread = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie").drop("__tie")
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part, local = F.shiftrightunsigned("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for p, c in counts:
        offsets.append((p, total))
        total += c
    if not total:
        return placed.drop("__at").withColumn("row_number", F.lit(0).cast("long")), 0
    first = rows.sparkSession.createDataFrame(offsets, "__part long, __first long")  # a row per partition
    out = placed.withColumn("__part", part).join(F.broadcast(first), "__part") \
                .withColumn("row_number", F.col("__first") + local)
    return out.drop("__at", "__part", "__first"), total


def permuted(rows: DataFrame, n: int, key: int = 0) -> DataFrame:
    """Add ``position``, the permuted ``row_number``."""
    @F.pandas_udf("long")
    def move(s):
        return s.__class__(Feistel(n, key).forward(s.to_numpy()).astype("int64"))

    return rows.withColumn("position", move("row_number"))


def shard(docs: DataFrame, shards: int = 24, key: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of every row.

    The law is ``rows``: shards differ by at most one row, slots run from 0
    without gaps. Size is the UTF-8 bytes of the text plus 8; null texts count
    as empty. Null doc_ids come last in the numbering; repeated rows each get
    a place. Extra columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"),
                         F.crc32(text).alias("text_crc32"))
    rows, n = numbered(narrow, ["doc_id", "text_crc32", "size"])
    return permuted(rows, n, key).select(
        "doc_id", "size", "text_crc32", "row_number",
        F.expr(f"CAST(position % {int(shards)} AS INT)").alias("shard"),
        F.expr(f"position DIV {int(shards)}").alias("slot"))
