"""SimHash near-duplicates by multi-index hashing.

A text becomes a 64-bit fingerprint: XXH64 of every shingle votes on each
bit. Two fingerprints link when they differ in at most three bits. With the
fingerprint cut into two halves, one half of a linked pair differs in at most
one bit (three bits over two halves). So each half is a table key, every
fingerprint looks up the Hamming ball of radius one around each of its halves,
and the complete distance of every match is counted.

Work is done on distinct fingerprints, so copies of a text never meet as
pairs. Half values that more than ``HOT`` fingerprints share are not paired
either: their members are linked through common neighbours in the other half
(``_hot_links``), which costs a fixed number of rows per fingerprint however
large the group is and leaves the connected components exact.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import one_per, row_key, small_batches, stored

# Fingerprints under one half value that are still compared pair by pair.
HOT = 64
HALF = 32
LOW = (1 << HALF) - 1


def _fingerprint(text: str | None, words: int) -> int:
    import numpy as np
    import xxhash
    tokens = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        line = b" ".join(tokens)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        shingles = [line[a:b] for a, b in zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 4096):  # bounded memory for very long texts
        h = np.array([digest(s, 42) for s in shingles[at:at + 4096]], dtype=">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(shingles))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fp`` (signed 64 bit) of every row; null and empty texts get 0."""
    small_batches(docs.sparkSession)
    kept = docs.select(*keep)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            fps = [_fingerprint(t, words) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fps, pa.int64())], [*keep, "fp"])

    return docs.select(*keep, "text").mapInArrow(run, kept.schema.add("fp", "long"))


def _halves(distinct: DataFrame) -> DataFrame:
    """A row per fingerprint and half: the half's value and the other half's."""
    hi, lo = F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(F.lit(LOW))
    sides = F.array(F.struct(F.lit(0).alias("half"), hi.alias("key"), lo.alias("rest")),
                    F.struct(F.lit(1).alias("half"), lo.alias("key"), hi.alias("rest")))
    return distinct.select("fp", F.explode(sides).alias("s")).select("fp", "s.*")


def _ball(value, flips: int, upward: bool = False):
    """Array of the values within ``flips`` bits; ``upward`` keeps those that only set bits.

    Two keys one bit apart: exactly one of them has that bit unset, so looking
    up only the upward neighbours still meets every such pair, once.
    """
    masks = [0]
    if flips >= 1:
        masks += [1 << i for i in range(HALF)]
    if flips == 2:
        masks += [(1 << i) | (1 << j) for i in range(HALF) for j in range(i)]
    around = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))
    return F.filter(around, lambda v: v >= value) if upward else around


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _pairs(probes: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    index = table.select("half", "key", F.col("fp").alias("other"))
    return (probes.join(index, ["half", "key"])
                  .where((F.col("fp") != F.col("other")) & (_distance("fp", "other") <= bits))
                  .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")))


def _hot_links(hot: DataFrame, bits: int) -> DataFrame:
    """Links inside crowded half values, through common neighbours.

    x and y share a half value and are at most ``bits`` apart exactly when some
    z is within ``inner`` bits of the other half of one and ``bits - inner`` of
    the other's; one bit less for half values one bit apart. All rows that meet
    at (value, z) are tied to one fingerprint within ``inner`` bits of z: each
    tie is a true link, and rows that link directly end up in one component.
    """
    inner = 1 if bits >= 2 else 0
    near = hot.select("half", "key", "fp", F.explode(_ball(F.col("rest"), inner)).alias("z"))
    hubs = near.groupBy("half", "key", "z").agg(F.min("fp").alias("hub"))
    ties = hot.select("half", "key", "fp", F.explode(_ball(F.col("rest"), bits - inner)).alias("z"))
    beside = hot.select("half", F.explode(F.slice(_ball(F.col("key"), 1), 2, HALF)).alias("key"), "fp", "rest") \
                .join(hot.select("half", "key").distinct(), ["half", "key"], "left_semi") \
                .select("half", "key", "fp", F.explode(_ball(F.col("rest"), max(bits - 1 - inner, 0))).alias("z"))
    return (ties.unionByName(beside).join(hubs, ["half", "key", "z"])
                .where((F.col("fp") != F.col("hub")) & (_distance("fp", "hub") <= bits))
                .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct())


def links(distinct: DataFrame, bits: int = 3, hot: int = HOT) -> DataFrame:
    """Links ``a < b`` between distinct fingerprints whose components are those of all pairs within ``bits``.

    ``distinct`` has one row per fingerprint. ``bits`` is at most 3, what
    two halves and balls of one bit cover.
    """
    if not 0 <= bits <= 3:
        raise ValueError("two halves with balls of one bit find distances up to 3")
    if bits == 0:  # distinct fingerprints are at least one bit apart
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    table = stored(_halves(distinct), "simhash-halves")
    crowded = stored(table.groupBy("half", "key").count().where(F.col("count") > hot), "simhash-crowded").select("half", "key")
    calm = table.join(crowded, ["half", "key"], "left_anti")
    probes = table.select("half", F.explode(_ball(F.col("key"), 1, upward=True)).alias("key"), "fp")
    found = _pairs(probes, calm, bits)
    if crowded.isEmpty():
        return found.distinct()
    # A crowded value meets its calm neighbours from both sides: the calm side is found above by
    # upward probes; crowded values above a calm one are met by probing downward from the crowd.
    packed = table.join(crowded, ["half", "key"], "left_semi")
    down = packed.select("half", F.explode(F.filter(_ball(F.col("key"), 1), lambda v: v <= F.col("key"))).alias("key"), "fp")
    return found.unionByName(_pairs(down, calm, bits)).unionByName(_hot_links(packed, bits)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b); root is the component's smallest node.

    Alternating large-star and small-star steps: each is two joins on a node,
    cut by a stored table, and the number of rounds grows with the logarithm
    of the longest chain.
    """
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: each node with its smaller neighbours
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m"), "a", "b")
        small = small.select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")),
                                               F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")) \
                     .select("e.*").where("a <> b").distinct()
        edges = stored(small, "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")) \
                .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3, hot: int = HOT,
                    keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` (doc_id among them), ``fp``, ``root`` and ``component_id`` per row.

    component_id is the smallest doc_id among all rows whose fingerprints are
    connected by links of at most ``bits`` bits (equal fingerprints included);
    root is the component's smallest fingerprint. Null and empty texts share
    fingerprint zero. Null doc_ids take part but are never the smallest unless
    a component has no other. Extra columns are ignored; repeated rows are
    returned as often as they come; an empty table gives an empty result.
    """
    fps = stored(fingerprints(docs, words, keep), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    rooted = distinct.join(components(links(distinct.select("fp"), bits, hot)), F.col("fp") == F.col("node"), "left") \
                     .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select(*keep, "fp", "root", "component_id")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """One row of each component of ``docs`` stays: that with the smallest doc_id (nulls last).

    Rows that share this doc_id are told apart by their text's hash; of rows
    that repeat doc_id and text one stays.
    """
    tagged = docs.withColumn("__key", row_key())
    found = near_duplicates(tagged, words, bits, keep=("doc_id", "__key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key")).alias("first")
    chosen = found.groupBy("root").agg(first).select("first.__key")
    return one_per(tagged.join(chosen, "__key", "left_semi"), ["__key"], [F.lit(1)]).select(*docs.columns)
