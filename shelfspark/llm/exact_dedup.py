"""Exact deduplication with an extendible-hash index on shared files.

1. Every task folds its own equal texts together (``_entries``) and writes one
   entry per distinct text it holds: key, digest, normalised bytes and the
   doc_ids that carry it. So a text that fills a third of the table reaches
   the index as a few entries per task, not as rows.
2. The load of every key prefix is counted, and a directory is grown from it:
   an overfull bucket splits by the next key bit, and the directory doubles
   when the bucket already uses all of its bits (``Directory``).
3. Entries are dealt to owner tasks by ranges of buckets, in key order. An
   owner chains the different texts of one key, comparing bytes, and writes
   for every entry which row stays and how many rows share the text. A bucket
   that one key overfills cannot split; its entries are first folded in
   several tasks per key.
4. The owners' files are joined back to the entries by entry number, which is
   unique on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import one_per, row_key, small_batches, stored, text_or_empty

# Bytes of distinct text a task holds before it writes its entries.
FOLD_BYTES = 48 * 2**20
# Bytes of text above which a bucket splits.
BUCKET_BYTES = 2**20
# The directory never gets more than 2**DEPTH entries; with so many, buckets just grow.
DEPTH = 20


def normalise(text: str | None) -> bytes:
    """UTF-8 of ``text`` with every run of blanks (space, 0x09-0x0D) as one space."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split on exactly these blanks
    if not words:
        return b" " if raw else b""
    body = b" ".join(words)
    return (b" " if raw[:1].isspace() else b"") + body + (b" " if raw[-1:].isspace() else b"")


ENTRY = "key long, sha string, size long, body binary, first_id long, rows long, ids array<long>"


def _entries(batches: Iterator) -> Iterator:
    """Equal texts among the rows of a task folded into entries, written whenever FOLD_BYTES are held."""
    import hashlib

    import pyarrow as pa
    import xxhash

    def flush(held: dict):
        bodies = list(held)
        ids = list(held.values())
        known = [[i for i in g if i is not None] for g in ids]
        return pa.RecordBatch.from_arrays([
            pa.array([xxhash.xxh64_intdigest(b) - 2**63 for b in bodies], pa.int64()),
            pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
            pa.array([len(b) for b in bodies], pa.int64()), pa.array(bodies, pa.binary()),
            pa.array([min(g, default=None) for g in known], pa.int64()),
            pa.array([len(g) for g in ids], pa.int64()), pa.array(ids, pa.list_(pa.int64())),
        ], ["key", "sha", "size", "body", "first_id", "rows", "ids"])

    held: dict[bytes, list] = {}
    load = 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            body = normalise(text)
            group = held.setdefault(body, [])
            load += 8 if group else len(body) + 200
            group.append(doc_id)
            if load >= FOLD_BYTES:
                yield flush(held)
                held, load = {}, 0
    if held:
        yield flush(held)


class Directory:
    """Extendible-hash directory over unsigned key prefixes of ``depth`` bits.

    ``load`` maps a prefix to its bytes. ``slots[p]`` is the bucket of the
    prefix p of ``bits`` bits; buckets are numbered in key order.
    """

    def __init__(self, load: dict[int, int], depth: int, capacity: int):
        self.bits = 0
        tree = [0] * (2 << depth)
        for p, v in load.items():
            tree[(1 << depth) + p] = v
        for i in range((1 << depth) - 1, 0, -1):
            tree[i] = tree[2 * i] + tree[2 * i + 1]
        slots = [(1, 0)]  # (node of the prefix tree, its depth): one entry per slot
        while True:
            full = {n for n, d in slots if tree[n] > capacity and d < depth}
            if not full:
                break
            if any(d == self.bits for n, d in slots if n in full):  # a bucket that uses every bit: double
                slots = [s for s in slots for _ in range(2)]
                self.bits += 1
            slots = [(2 * n + (at >> (self.bits - 1 - d) & 1), d + 1) if n in full else (n, d)
                     for at, (n, d) in enumerate(slots)]
        names: dict[int, int] = {}
        self.slots = [names.setdefault(n, len(names)) for n, _ in slots]
        self.loads = [tree[n] for n in names]


def _depth(total: int, capacity: int) -> int:
    """Prefix bits counted: enough for buckets at an eighth of the capacity, at most DEPTH."""
    return max(1, min(DEPTH, (8 * total // max(capacity, 1)).bit_length()))


CHAINED = "entry long, head long, link int, key long"


def _own(batches: Iterator) -> Iterator:
    """Entries in key order: every entry gets the first entry with the same bytes (``head``).

    The texts of one key form a chain; only one key's chain is held at a time.
    """
    import pyarrow as pa

    key, chain = None, []
    for b in batches:
        out = []
        for entry, k, body in zip(*(b.column(i).to_pylist() for i in range(3))):
            if k != key:
                key, chain = k, []
            for link, (head, known) in enumerate(chain):
                if known == body:
                    break
            else:
                head, link = entry, len(chain)
                chain.append((entry, body))
            out.append((entry, head, link, k))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                ["entry", "head", "link", "key"])


def _owned(entries: DataFrame, owners: int) -> DataFrame:
    """Owner tasks: entries dealt by ``owner`` (a range of buckets), in key order, chained."""
    dealt = entries.repartitionById(owners, F.col("owner")).sortWithinPartitions("key", "entry")
    return dealt.select("entry", "key", "body").mapInArrow(_own, CHAINED)


def index(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """Entries of ``docs`` and the index over them, both as tables in the shared folder.

    The index has per entry its bucket, key, chain link, the doc_id of the row
    that stays (keep_id), the number of rows with that text, and whether the
    entry holds the row that stays.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folded = docs.select("doc_id", "text").mapInArrow(_entries, ENTRY)
    entries = stored(folded.withColumn("entry", F.monotonically_increasing_id()), "dedup-entries")

    unsigned = F.col("key").bitwiseXOR(F.lit(-2**63))  # stored keys sort as signed; prefixes are of the unsigned key
    total = entries.agg(F.sum("size")).first()[0] or 0
    depth = _depth(total, bucket_bytes)
    prefix = F.shiftrightunsigned(unsigned, 64 - depth)
    load = {r[0]: r[1] for r in entries.groupBy(prefix.alias("p")).agg(F.sum("size")).collect()}  # <= 2**DEPTH rows
    directory = Directory(load, depth, bucket_bytes)
    owners = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Owners get runs of buckets of about equal load; a bucket far above its size is one that could not split.
    before, owner, shares = 0, [], []
    for v in directory.loads:
        owner.append(min(owners - 1, (before + v // 2) * owners // max(total, 1)))
        shares.append(1 + v // (4 * bucket_bytes))
        before += v
    slots = spark.createDataFrame([(p, b, owner[b], shares[b]) for p, b in enumerate(directory.slots)],
                                  "slot long, bucket int, first_owner int, shares long")
    slot = F.shiftrightunsigned(unsigned, 64 - directory.bits) if directory.bits else F.lit(0).cast("long")
    placed = entries.withColumn("slot", slot).join(F.broadcast(slots), "slot") \
                    .select("entry", "key", "body", "first_owner", "shares")  # at most 2**DEPTH slots
    whole = placed.withColumn("owner", F.col("first_owner"))
    if max(shares) > 1:
        # Fold the entries of such a bucket in several tasks first; only the heads go to the owner.
        share = F.pmod(F.col("first_owner") + F.pmod(F.xxhash64("entry"), F.col("shares")), F.lit(owners)).cast("int")
        first = stored(_owned(placed.where("shares > 1").withColumn("owner", share), owners), "dedup-shares")
        heads = whole.where("shares > 1").join(first.where("entry = head").select("entry"), "entry", "left_semi")
        last = stored(_owned(whole.where("shares = 1").unionByName(heads), owners), "dedup-owners")
        through = first.where("entry <> head").select(F.col("entry").alias("folded"), F.col("head").alias("entry"))
        chained = last.unionByName(through.join(last, "entry").select(F.col("folded").alias("entry"), "head", "link", "key"))
    else:
        chained = stored(_owned(whole, owners), "dedup-owners")
    each = chained.join(entries.select("entry", "first_id", "rows"), "entry")
    smallest = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id"), F.col("entry"))).alias("least")
    groups = each.groupBy("head").agg(smallest, F.sum("rows").alias("group_size"))
    named = each.join(groups, "head").select("entry", "key", "link", F.col("least.first_id").alias("keep_id"),
                                             "group_size", (F.col("entry") == F.col("least.entry")).alias("holder"))
    return entries, stored(named, "dedup-index")


def duplicates(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256 of the normalised text.

    Texts are equal when their bytes are after normalisation; null counts as
    empty. Of equal texts the smallest doc_id stays; a null doc_id only where a
    group has no other. Of rows that repeat doc_id and text, one is kept. Extra
    columns are ignored; an empty table gives an empty result.
    """
    entries, named = index(docs, bucket_bytes)
    rows = entries.select("entry", "sha", "ids").join(named, "entry")
    at = F.coalesce(F.array_position("ids", F.col("keep_id")), F.lit(1)) - 1
    return rows.select("keep_id", "group_size", "holder", F.col("sha").alias("text_sha256"), at.alias("at"),
                       F.posexplode("ids").alias("pos", "doc_id")) \
               .select("doc_id", "keep_id", "group_size", (F.col("holder") & (F.col("pos") == F.col("at"))).alias("kept"),
                       "text_sha256")


def keep_first(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts, with all columns."""
    kept = duplicates(docs, bucket_bytes).where("kept").select("doc_id", "text_sha256")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text_sha256"))
    blank = F.regexp_replace(text_or_empty(), "[\\x20\\x09-\\x0D]+", " ")
    tagged = docs.withColumn("__key", row_key(blank))
    held = tagged.join(kept.select(name.alias("__key")), "__key", "left_semi")
    return one_per(held, ["__key"], [F.col("text").asc_nulls_last()]).select(*docs.columns)
