"""Best-fit packing of tokenised documents into sequences, planned over the histogram of lengths.

Executors tokenise every document, end it with one id, cut what is longer than
a sequence and number the pieces of each length within their task. Lengths are
at most ``SIZE``, so their histogram has ``SIZE`` rows at most whatever the
corpus holds, and the plan is made over counts: lengths in descending order,
each placed where the least space is left that still holds it. Sequences that
look alike are one interval of sequence numbers, and an interval is filled in
one step. Filling leaves less than half of an interval's space, so an interval
is filled 12 times at most (for 4,096 ids), and a length splits or opens four
at most: the plan has fewer than 13 * 4 * SIZE runs, which bounds its
broadcast. Pieces then take the planned slots by their rank within their
length: their number within the task plus the pieces of that length in the
tasks before.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import small_batches, stored

SIZE = 4096
END = 1
# Words whose ids a Python worker remembers at most; longer words are not remembered.
REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 40
# The pre-tokenizer's fixed pattern: none of its matches holds white space, so words can be encoded one by one.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of these characters, lower-cased, are as the file's normalizer leaves them; its pre-tokenizer parts them like PLAIN_PARTS.
PLAIN = r"[!-~À-ÖØ-öø-ÿŒœ]+"
PLAIN_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[^a-zß-öø-ÿœ0-9]+"

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    Where the file splits at white space whatever stands around it, a text's
    ids are those of its words, and the ids of words are remembered. Words of
    plain letters are merged by tiktoken, which is given the vocabulary as ranks
    where ids follow the merges' order (a blank stands for the mark of a word's
    end and merges first); all others by the tokenizers library. Other files
    encode whole texts.
    """

    def __init__(self, path: str):
        import json
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            parts[0].get("pattern") == {"Regex": PATTERN} and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
            and not spec.get("post_processor") and not spec["model"].get("dropout")
            and not any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word"))
            and not any(c.isspace() for t in spec.get("added_tokens") or [] for c in t["content"]))
        self.known: dict[str, bytes] = {}
        self.fast = self._ranked(spec["model"]) if self.by_word else None

    @staticmethod
    def _ranked(model: dict):
        import re

        import tiktoken

        from shelfspark.llm.bpe import _byte_letters
        vocab, mark = model["vocab"], model.get("end_of_word_suffix")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab["".join(m)] for m in merges]
        if not mark or made != sorted(made) or made[0] < 512:
            return None
        letters, ranks = _byte_letters(), {}
        for token, i in vocab.items():
            ends = token.endswith(mark)
            raw = bytes(letters[c] for c in (token.removesuffix(mark) if ends else token)) + b" " * ends
            if raw != b" ":  # a blank alone is never a token of a word
                ranks[raw] = i
        ranks[b" "] = max(vocab.values()) + 1
        merge = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        plain, parts = re.compile(PLAIN), re.compile(PLAIN_PARTS)

        def encode(word: str) -> list[int] | None:
            """Ids of a word, or None where it is not plain."""
            if word.isascii() and word.isalpha():  # one part
                return merge(word.lower() + " ")
            if not plain.fullmatch(word) or "<|" in word:
                return None
            return merge(" ".join(parts.findall(word.lower())) + " ")

        return encode

    def _words(self, words: list[str]) -> list[bytes]:
        if self.fast is None:
            return self._encode(words)
        found = [self.fast(w) for w in words]
        other = iter(self._encode([w for w, f in zip(words, found) if f is None]))
        return [next(other) if f is None else struct.pack(f"<{len(f)}I", *f) for f in found]

    def _encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def packed(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        words = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") for t in texts]
        new = list(set().union(*words) - self.known.keys())
        self.known.update(zip(new, self._words(new)))
        out = [b"".join(map(self.known.__getitem__, ws)) for ws in words]
        for w in new:
            if len(w) > LONGEST_REMEMBERED:
                del self.known[w]
        return out


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Pieces of every document, each with its number among the task's pieces of its length (``task, nth``)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import zlib
        from collections import defaultdict

        import pyarrow as pa
        from pyspark import TaskContext
        made, task = encoder(path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for b in batches:
            out = []
            for doc_id, ids in zip(b.column(0).to_pylist(), made.packed(b.column(1).to_pylist())):
                ids += end.to_bytes(4, "little")
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    length = len(part) // 4
                    out.append((doc_id, n, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
               .mapInArrow(run, PIECE)


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, first sequence, pieces in each sequence, offset)`` of best fit, longest first.

    The pieces of a run are dealt to consecutive sequences, ``pieces in each``
    to one after the other, from ``offset`` on. The result is that of placing
    piece by piece: after a piece is placed in the tightest sequence, that one
    is still the tightest if it has room for another.
    """
    import bisect
    runs: list[tuple[int, int, int, int, int]] = []
    spaces: dict[int, list[tuple[int, int]]] = {}  # space left -> intervals (first sequence, sequences)
    order: list[int] = []  # spaces that have intervals, ascending
    opened = 0

    def give(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in spaces:
                spaces[space] = []
                bisect.insort(order, space)
            spaces[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                need = -(-left // (size // length))
                give(size, opened, need)
                opened += need
                continue
            space = order[at]
            first, count = spaces[space].pop()
            if not spaces[space]:
                del spaces[space], order[at]
            each = space // length
            full = min(count, left // each)
            if not full:  # the last pieces do not fill a sequence
                full, each = 1, left
            runs.append((length, rank, first, each, size - space))
            give(space - each * length, first, full)
            give(space, first + full, count - full)
            left -= full * each
            rank += full * each
    return runs


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def packed(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document's ids are those of the tokenizer file ``path`` and then ``end``.
    Only documents of more than ``size`` ids are cut. Null and empty texts are
    a piece of one id; null doc_ids and repeated rows each have their pieces;
    extra columns are ignored; an empty table gives an empty result.
    """
    import numpy as np
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, size, end), "pieces")
    # at most a row for each task and length
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r[0]: r[1] for r in first.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    runs = np.array(plan(histogram, size), dtype=np.int64).reshape(-1, 5)
    by = np.lexsort((runs[:, 1], runs[:, 0]))
    shared = spark.sparkContext.broadcast(runs[by])
    ranked = cut.join(first.select("length", "task", "first"), ["length", "task"]) \
                .withColumn("rank", F.col("first") + F.col("nth"))

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        length, rank, sequence, each, offset = shared.value.T
        for b in batches:
            long, nth = (b.column(i).to_numpy() for i in (3, 5))
            low, high = np.searchsorted(length, long), np.searchsorted(length, long, side="right")
            # the run of a piece is the last one of its length that starts at or before its rank
            start, key = np.searchsorted(length, np.arange(size + 2)), np.empty(len(long), dtype=np.int64)
            for x in np.unique(long):
                on = long == x
                key[on] = start[x] + np.searchsorted(rank[start[x]:start[x + 1]], nth[on], side="right") - 1
            assert ((key >= low) & (key < high)).all()
            inside = nth - rank[key]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence[key] + inside // each[key]), pa.array(offset[key] + inside % each[key] * long)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PLACED)
