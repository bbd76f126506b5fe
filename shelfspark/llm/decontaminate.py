"""Benchmark decontamination with spaced seeds.

A seed hashes the tokens at the set positions of a fixed mask and ignores the
others, so a substituted token under an ignored position does not hide a
match. ``MASKS`` are chosen so that any window of ``WINDOW`` tokens with up to
two substitutions holds a seed that none of them touches (tests/llm checks
every case). Seeds of the benchmark and of the documents are joined, and around
every hit the aligned tokens are compared: a document overlaps an item when
some window of WINDOW aligned tokens agrees in at least 80 %, that is in 11.
Items with fewer tokens than a window must occur whole: those of ``TOLERANT`` and
more tokens may differ in the share that ``short_agree`` leaves (by masks of their
own length), shorter ones are searched as they are, and an item of a single token
is only found in a document that is nothing else. Scripts without spaces between
words are tokens by character.

Of the document seeds only those reach the join whose bit is set in a map of
the benchmark seeds. The map has a fixed size (``MAP_BITS``), whatever the
benchmark's: with a larger benchmark it lets more pass and the join does more,
with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import row_key, small_batches, stored

MASKS = ("11101011", "11001111")
WINDOW = 13
AGREE = 0.8
# Items with fewer tokens must be the whole document, those below TOLERANT match exactly.
MIN_TOKENS = 2
TOLERANT = 6
# Thai to Burmese and Khmer, kana, Han and its extensions.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
MAP_BITS = 26
# Seeds of one hash are dealt to so many tasks; the benchmark's side is repeated for each.
SPREAD = 8


def tokens(text: str | None):
    """64-bit hashes of the lower-cased words of a text, of unspaced scripts the characters."""
    import re

    import numpy as np
    import xxhash
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in re.findall(rf"[^\W{UNSPACED}]+|(?=\w)[{UNSPACED}]", (text or "").lower())], dtype=np.uint64)


def seeds(words, window: int = WINDOW, masks: tuple[str, ...] = MASKS):
    """``(hashes, positions)`` of every mask at every position."""
    import numpy as np
    hashes, at = [], []
    for m, mask in enumerate(masks):
        n = len(words) - len(mask) + 1
        if n > 0:
            h = np.full(n, (m + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1), dtype=np.uint64)
            for k, bit in enumerate(mask):
                if bit == "1":
                    h = _mixed(h ^ words[k:k + n])
            hashes.append(h)
            at.append(np.arange(n))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(at)


def short_masks(length: int, agree: float) -> tuple[str, ...]:
    """Masks of an item shorter than a window: however the tolerated substitutions fall, one is untouched.

    The item is cut into two parts more than substitutions, and every mask holds two of them.
    """
    from itertools import combinations
    wrong = length - least(length, agree)
    if not wrong:
        return ("1" * length,)
    cuts = [length * i // (wrong + 2) for i in range(wrong + 3)]
    parts = [range(a, b) for a, b in zip(cuts, cuts[1:])]
    return tuple("".join("1" if any(i in p for p in two) else "0" for i in range(length)) for two in combinations(parts, 2))


def least(size: int, agree: float) -> int:
    """Equal tokens that ``size`` aligned ones need."""
    return size if size < TOLERANT else -int(-agree * size // 1)


def whole(words, length: int, agree: float):
    """Seeds of every stretch of ``length`` tokens, for items shorter than a window."""
    if length < MIN_TOKENS and len(words) != length:
        return seeds(words[:0])
    return seeds(words, masks=short_masks(length, agree))


def _mixed(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _bit(hashes, bits: int):
    import numpy as np
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _item_rows(benchmark: DataFrame, short_agree: float) -> DataFrame:
    """Per item (benchmark row): tokens and seeds."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            out = []
            for item, item_id, text in zip(*(c.to_pylist() for c in b.columns)):
                words = tokens(text)
                if not len(words):
                    continue
                h, at = seeds(words) if len(words) >= WINDOW else whole(words, len(words), short_agree)
                out.append((item, item_id, words.view(np.int64).tolist(), h.view(np.int64).tolist(), at.tolist()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                    ["item", "item_id", "words", "hashes", "places"])

    numbered = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    return numbered.mapInArrow(run, "item long, item_id long, words array<long>, hashes array<long>, places array<long>")


HIT = "doc long, key string, doc_id long, segment int, first long, words array<long>, hashes array<long>, places array<long>"


def _hits(docs: DataFrame, seed_map, lengths: list[int], bits: int, short_agree: float) -> DataFrame:
    """Stretches of documents around seeds whose bit is set in the map, with these seeds."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(seed_map)  # 2**bits bits

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        known = shared.value

        def stretches(doc, key, doc_id, text):
            words = tokens(text)
            found = [seeds(words), *(whole(words, n, short_agree) for n in lengths)]
            h, at = (np.concatenate(x) for x in zip(*found))
            b = _bit(h, bits)
            on = (known[b >> 3] >> (b & 7).astype(np.uint8) & 1).astype(bool)
            h, at = h[on], at[on]
            if not len(at):
                return
            order = np.argsort(at, kind="stable")
            h, at = h[order], at[order]
            # a window that holds the seed lies within WINDOW tokens on either side
            cuts = np.flatnonzero(np.diff(at) > 2 * WINDOW) + 1
            for s, (hs, ats) in enumerate(zip(np.split(h, cuts), np.split(at, cuts))):
                first = max(int(ats[0]) - WINDOW, 0)
                part = words[first:int(ats[-1]) + 2 * WINDOW]
                yield doc, key, doc_id, s, first, part.view(np.int64).tolist(), hs.view(np.int64).tolist(), ats.tolist()

        for b in batches:
            out = [x for r in zip(*(c.to_pylist() for c in b.columns)) for x in stretches(*r)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3))],
                    [c.split()[0] for c in HIT.split(", ")])

    return docs.select(F.monotonically_increasing_id().alias("doc"), "key", F.col("doc_id").cast("long"), "text").mapInArrow(run, HIT)


def _verified(rows: DataFrame, short_agree: float) -> DataFrame:
    """Best window of every aligned (document stretch, item) candidate that agrees enough."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            out = []
            for doc, key, doc_id, item_id, item, first, shift, words, own in zip(*(c.to_pylist() for c in b.columns)):
                # item token i stands beside document token i + shift
                lo, hi = max(0, first - shift), min(len(own), first + len(words) - shift)
                size = min(WINDOW, len(own))
                if hi - lo < size:
                    continue
                same = np.array(own[lo:hi]) == np.array(words[lo + shift - first:hi + shift - first])
                total = np.concatenate(([0], np.cumsum(same)))
                sums = total[size:] - total[:-size]
                good = np.flatnonzero(sums >= least(size, AGREE if len(own) >= WINDOW else short_agree))
                if len(good):
                    covered = np.zeros(hi - lo, dtype=bool)
                    for g in good.tolist():
                        covered[g:g + size] = True
                    out.append((doc, key, doc_id, item_id, item, lo + shift + int(good[0]), lo + shift + int(good[-1]) + size,
                                int(covered.sum()), int((same & covered).sum()), len(own)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.string(), *[pa.int64()] * 8))], names)

    schema = ("doc long, key string, doc_id long, item_id long, item long, start long, stop long, overlap long, same long, item_tokens long")
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(run, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame, bits: int = MAP_BITS, keyed: bool = False,
             short_agree: float = 1.0) -> DataFrame:
    """A row per overlapping document row and benchmark item.

    doc_id, item_id, start and stop (document tokens, from 0, stop excluded),
    overlap (tokens in agreeing windows), same (those that are equal) and
    item_tokens; of several places the one with most equal tokens, then the
    first. Null and empty texts, on either side, overlap nothing; null ids are
    returned as null; repeated document rows give repeated results; extra
    columns are ignored; an empty table on either side gives an empty result.
    ``short_agree`` is the share of equal tokens that items of TOLERANT to
    WINDOW - 1 tokens need.
    With ``keyed`` the rows have the name of the document row (``row_key``) too.
    """
    import numpy as np
    spark = docs.sparkSession
    small_batches(spark)
    items = stored(_item_rows(benchmark, short_agree), "seeds")
    h = F.col("h")
    index = items.select("item", F.explode(F.arrays_zip(F.col("hashes").alias("h"), F.col("places").alias("at"))).alias("s")) \
                 .select("item", "s.h", "s.at")
    words = index.select(F.shiftrightunsigned(h, 64 - bits).alias("b")) \
                 .groupBy(F.shiftrightunsigned("b", 6).alias("w")) \
                 .agg(F.bit_or(F.expr("shiftleft(1L, CAST(b & 63 AS INT))")).alias("v")).collect()  # 2**(bits-6) rows at most
    table = np.zeros(max(1, 1 << (bits - 6)), dtype="<i8")
    for w, v in words:
        table[w] = v
    lengths = [r[0] for r in items.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().collect()]

    rows = docs.withColumn("key", row_key()) if keyed else docs.withColumn("key", F.lit(None).cast("string"))
    hits = _hits(rows, table.view(np.uint8), sorted(lengths), bits, short_agree)
    hits = stored(hits.withColumn("row", F.monotonically_increasing_id()), "seed-hits")
    probes = hits.select("row", F.explode(F.arrays_zip(F.col("hashes").alias("h"), F.col("places").alias("at"))).alias("s")) \
                 .select("row", "s.h", F.col("s.at").alias("place"), F.pmod("row", F.lit(SPREAD)).alias("deal"))
    deals = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SPREAD)])).alias("deal")
    pairs = probes.join(index.select("item", "h", "at", deals), ["h", "deal"]) \
                  .select("row", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    near = pairs.join(hits.select("row", "doc", "key", "doc_id", "first", "words"), "row") \
                .withColumn("deal", F.pmod("row", F.lit(SPREAD))) \
                .join(items.select("item", "item_id", F.col("words").alias("own"), deals), ["item", "deal"])
    checked = _verified(near.select("doc", "key", "doc_id", "item_id", "item", "first", "shift", "words", "own"), short_agree)
    place = F.struct(-F.col("same"), "start", "stop", "overlap", "same", "item_tokens", "key", "doc_id", "item_id")
    return checked.groupBy("doc", "item").agg(F.min(place).alias("p")).select(
        *(["p.key"] if keyed else []), "p.doc_id", "p.item_id", "p.start", "p.stop", "p.overlap", "p.same", "p.item_tokens")


def clean(docs: DataFrame, benchmark: DataFrame, short_agree: float = 1.0) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all columns; repeated rows included."""
    tagged = docs.withColumn("__key", row_key())
    found = overlaps(docs, benchmark, keyed=True, short_agree=short_agree).select(F.col("key").alias("__key")).distinct()
    return tagged.join(found, "__key", "left_anti").select(*docs.columns)
