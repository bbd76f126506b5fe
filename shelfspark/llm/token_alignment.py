"""Alignment of two tokenizers over a corpus: which ids of one stand for which ids of the other.

Documents are shuffled by their full text, so every distinct text is tokenised
and aligned once and carries its number of copies. Byte offsets where tokens of
both tokenizers end cut a text into groups; every id of tokenizer A in a group
is linked with every id of B in it. How many documents hold a pair of ids
linked is a sum of copies over texts. The measures of a text over its links'
counts come from joining its different pairs with the counted ones, and reach
the documents by a digest of the text.

Pairs that many texts hold would meet in one task of a join. Pairs in at least
``floor`` documents are joined by broadcast instead: ``floor`` is the smallest
power of two that at most ``HOT_PAIRS`` pairs reach. All others are joined by
shuffle on the pair.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import bpe
from shelfspark.llm.common import small_batches, stored

HOT_PAIRS = 200_000
# Links of a text that are made one by one; the repeated ids of a larger group are counted first.
MADE = 4_000_000
BLANK = "▁"

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


class Aligner:
    """Aligns blank + text by a byte-level BPE file (A) with text by a sentencepiece model (B, which adds the blank)."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np
        import sentencepiece
        a = bpe.codec(path_a)
        self.encode_a, self.bytes_a = a.encode_plain, a.bytes_of
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(x) for x in part], dtype=np.int64) for part in (self.bytes_a, self.bytes_b))
        # an id as it is written in a list of groups, by whether it is a group's last of its tokenizer
        self.said = [f"{i}{end}" for ends in (",|", ",;") for i in range(max(len(self.bytes_a), len(names))) for end in ends]

    def measured(self, text: str) -> tuple | None:
        """(n_a, n_b, groups, their text, pairs, links), or None where bytes differ; pairs are ``a << 32 | b``, ascending, each once."""
        import numpy as np
        ids_a, ids_b = self.encode_a(" " + text), self.b.encode(text)
        raw = (" " + text).encode()
        if not b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw == b"".join(map(self.bytes_b.__getitem__, ids_b)):
            return None
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        near = np.searchsorted(end_b, end_a)
        last_a, last_b = end_b[near] == end_a, np.zeros(len(b), dtype=bool)
        last_b[near[last_a]] = True
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # group of each token
        n_a, n_b = np.bincount(of_a), np.bincount(of_b)
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        words = np.empty(len(a) + len(b), dtype=np.int64)
        words[np.arange(len(a)) + first_b[of_a]] = a * 2 + last_a
        words[np.arange(len(b)) + (first_a + n_a)[of_b]] = len(self.said) // 2 + b * 2 + last_b
        said = "".join(map(self.said.__getitem__, words.tolist()))[:-1]
        total = int((n_a * n_b).sum())
        if total > MADE:  # some group is large: count its repeated ids first
            a, of_a, weight_a = _repeated(a, of_a)
            b, of_b, weight_b = _repeated(b, of_b)
            n_b = np.bincount(of_b)
            first_b = np.cumsum(n_b) - n_b
        else:
            weight_a = weight_b = None
        times = n_b[of_a]
        own = np.repeat(np.arange(len(a)), times)
        other = np.arange(len(own)) + np.repeat(first_b[of_a] - (np.cumsum(times) - times), times)
        links = np.ones(len(own), dtype=np.int64) if weight_a is None else weight_a[own] * weight_b[other]
        return len(ids_a), len(ids_b), len(n_a), said, *_summed(a[own] << 32 | b[other], links)


def _repeated(ids, group):
    """Different ids of each group, by group, and how often each occurs."""
    import numpy as np
    key, n = np.unique(group << 32 | ids, return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, n


def _summed(pairs, links):
    """Different pairs, ascending, and the links of each."""
    import numpy as np
    by = np.argsort(pairs)
    pairs, links = pairs[by], links[by]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(links, first)


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


ALIGNED = ("text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "a array<int>, b array<int>, links array<long>")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per distinct text that is not empty and that both tokenizers give back byte by byte.

    ``copies`` is its number of documents; ``a, b, links`` are its different
    linked id pairs with their occurrences.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("text").where("text != ''").groupBy("text").agg(F.count("*").alias("copies"))

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        made = aligner(path_a, path_b)
        for b in batches:
            out = []
            for key, copies, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = made.measured(text)
                if found:
                    n_a, n_b, groups, said, pairs, links = found
                    out.append((key, copies, n_a, n_b, groups, int(links.sum()), hashlib.sha256(said.encode()).hexdigest(),
                                (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), links))
            if out:
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), *[pa.int64()] * 5, pa.string(), ints, ints, pa.list_(pa.int64())))],
                    ["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "links"])

    return texts.select(text_key("text"), "copies", "text").mapInArrow(run, ALIGNED)


def text_key(col: str):
    return F.unhex(F.sha2(F.col(col), 256)).alias("text_key")


def pair_counts(texts: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that hold the pair linked, and whether no pair of the same ``a`` is in more."""
    linked = texts.select("copies", F.explode(F.arrays_zip("a", "b")).alias("p"))
    counts = linked.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("copies").alias("count"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return stored(counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")


def weighed(texts: DataFrame, pairs: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``text_key, n_best, count_sum`` of every text over its links."""
    size = {r[0]: r[1] for r in pairs.groupBy((F.length(F.bin("count")) - 1).alias("p")).count().collect()}  # 64 rows at most
    floor, held = 2**max([*size, 0]) * 2, 0
    for p in sorted(size, reverse=True):
        held += size[p]
        if held > hot_pairs:
            break
        floor = 2**p
    hot = F.broadcast(pairs.where(F.col("count") >= floor))  # hot_pairs rows of 17 bytes at most
    links = texts.select("text_key", F.explode(F.arrays_zip("a", "b", "links")).alias("p")) \
                 .select("text_key", "p.a", "p.b", "p.links").join(hot, ["a", "b"], "left")
    worth = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum")]
    often = links.where("count IS NOT NULL").groupBy("text_key").agg(*worth)
    rest = links.where("count IS NULL").select("text_key", "a", "b", "links") \
                .join(pairs.where(F.col("count") < floor), ["a", "b"]).groupBy("text_key").agg(*worth)
    return often.unionByName(rest).groupBy("text_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def alignment(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, or one whose tokens do not give its bytes back, has
    zeros and an empty ``groups_sha256`` and counts for no pair. Null doc_ids
    and repeated rows come back as they are, each counted as a document; pairs
    tied for an id's highest count are all best; extra columns are ignored; an
    empty table gives an empty result.
    """
    texts = stored(aligned(docs, path_a, path_b), "aligned")
    found = texts.select("text_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256") \
                 .join(weighed(texts, pair_counts(texts), hot_pairs), "text_key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text"))
    return rows.join(found, "text_key", "left").select(
        "doc_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in NUMBERS],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
