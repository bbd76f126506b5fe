"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text of up to ``LEAF`` characters is encoded at once. A longer one is cut
into leaves that Spark deals to many tasks; the leaves' ids are then joined
pairwise up a tree. A cut may fall anywhere, so at each join a window around
it is encoded again, and grows until it agrees with the left half's ids before
some point and with the right half's ids after another. Both points must be
places where every encoder splits the text whatever stands around (a blank
after a non-blank, for instance), so what agrees there is exact. Text without
such a place (one unbroken run) makes the window grow to the whole run.

Ids equal those of the tokenizers library for the same file. Merging runs in
tiktoken, which is given the file's vocabulary as ranks when the file's merges
are its ids in order and its pre-tokenizer is the plain byte-level one;
otherwise, and for long unbroken windows, the tokenizers library itself runs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import small_batches

LEAF = 16384
WINDOW = 64
# Windows beyond this many characters are encoded by the tokenizers library, whose merging stays near linear.
LONG_WINDOW = 65536
# The byte-level pre-tokenizer's fixed pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CODECS: dict[str, Codec] = {}


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes are
    themselves, the others follow from 256 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Codec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        vocab = spec["model"]["vocab"]
        plain = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
        top = max([*plain.values(), *added.values()])
        self.bytes_of = [b""] * (top + 1)
        for b, i in plain.items():
            self.bytes_of[i] = b
        for t, i in added.items():
            self.bytes_of[i] = t.encode()
        self.added = sorted(added, key=len, reverse=True)
        self.reach = max(map(len, self.added), default=0)
        pre = spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        in_order = sorted(i for b, i in plain.items() if len(b) > 1) == [vocab["".join(m)] for m in merges]
        simple = not spec.get("normalizer") and not any(
            t.get(k) for t in spec.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word"))
        self.fast = None
        if in_order and simple and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True):
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=plain, special_tokens=added)

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and len(text) <= LONG_WINDOW:
            return self.fast.encode(text, allowed_special="all")
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_plain(self, text: str) -> list[int]:
        """Ids with the strings of added tokens taken as ordinary text."""
        if self.fast is not None and len(text) <= LONG_WINDOW:
            return self.fast.encode_ordinary(text)
        self.library.encode_special_tokens = True
        ids = self.library.encode(text, add_special_tokens=False).ids
        self.library.encode_special_tokens = False
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    # ---- tree concatenation

    def _splits(self, text: str, p: int) -> bool:
        """Whether every encoder of a text around ``p`` splits it there.

        A blank never continues a non-blank piece, nor punctuation a run of
        letters; inside an added token neither counts.
        """
        a, b = text[p - 1], text[p]
        if not (b in " \n\t\r" and (a.isalnum() or "!" <= a <= "~") or a.isalpha() and b in "\u3001\u3002\uff0c.,;:()"):
            return False
        near = text[max(0, p - self.reach):p + self.reach]
        return not any(t in near for t in self.added)

    def _places(self, ids: list[int]) -> dict[int, int]:
        """Character position -> number of ids before it, wherever an id starts a character, and the end."""
        at, chars = {}, 0
        for i, t in enumerate(ids):
            b = self.bytes_of[t]
            if b[0] & 0xC0 != 0x80:
                at[chars] = i
            chars += sum(c & 0xC0 != 0x80 for c in b)
        at[chars] = len(ids)
        return at

    def _starts_inside(self, t: int) -> bool:
        return self.bytes_of[t][0] & 0xC0 == 0x80

    def join(self, left: list[int], right: list[int], size: int = WINDOW) -> list[int]:
        """Ids of the concatenation of two encoded texts (both end and start at whole characters)."""
        if not left or not right:
            return left or right
        while True:
            i = max(len(left) - size, 0)
            while i and self._starts_inside(left[i]):
                i -= 1
            j = min(size, len(right))
            while j < len(right) and self._starts_inside(right[j]):
                j += 1
            tail, head = left[i:], right[:j]
            cut = len(self.decode(tail))
            text = self.decode(tail + head)
            ids = self.encode(text)
            if i == 0 and j == len(right):
                return ids
            here = self._places(ids)
            # the last place before the join, and the first after it, where both split and agree outwards
            before = (0, 0) if i == 0 else next(
                ((here[p], k) for p, k in sorted(self._places(tail).items(), reverse=True)
                 if 0 < p <= cut - self.reach - 2 and p in here and self._splits(text, p) and ids[:here[p]] == tail[:k]), None)
            after = (len(ids), len(head)) if j == len(right) else next(
                ((here[cut + p], k) for p, k in sorted(self._places(head).items())
                 if p >= self.reach + 2 and cut + p < len(text) and cut + p in here
                 and self._splits(text, cut + p) and ids[here[cut + p]:] == head[k:]), None)
            if before and after:
                return left[:i] + tail[:before[1]] + ids[before[0]:after[0]] + head[after[1]:] + right[j:]
            size *= 4

    def tree(self, leaves: list[list[int]]) -> list[int]:
        """Ids of the leaves' whole text: neighbours join pairwise until one is left."""
        while len(leaves) > 1:
            pairs = [self.join(leaves[i], leaves[i + 1]) for i in range(0, len(leaves) - 1, 2)]
            leaves = pairs + leaves[len(pairs) * 2:]
        return leaves[0] if leaves else []


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _digests(c: Codec, ids: list[int]) -> tuple[int, str, str]:
    import array
    import hashlib
    import sys
    packed = array.array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return len(ids), hashlib.sha256(packed.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null texts count as empty; null doc_ids and repeated rows come back as they
    are; extra columns are ignored; an empty table gives an empty result.
    ``path`` names the tokenizer file, which every executor must have.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    length = F.length("text")

    def direct(batches: Iterator) -> Iterator:
        import pyarrow as pa
        c = codec(path)
        for b in batches:
            found = [_digests(c, c.encode(t)) for t in b.column(1).to_pylist()]
            n, ids, text = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(ids, pa.string()), pa.array(text, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                at = range(0, len(text), leaf)
                for few in (at[i:i + 64] for i in range(0, len(at), 64)):
                    n = len(few)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()), pa.array([i // leaf for i in few], pa.int32()),
                         pa.array([text[i:i + leaf] for i in few], pa.string())], ["row", "doc_id", "leaf", "piece"])

    def encode(batches: Iterator) -> Iterator:
        import array

        import pyarrow as pa
        c = codec(path)
        for b in batches:
            packed = [array.array("I", c.encode(t)).tobytes() for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(packed, pa.binary())], ["row", "doc_id", "leaf", "ids"])

    def join(key, table):
        import array

        import pyarrow as pa
        c = codec(path)
        leaves = sorted(zip(table.column("leaf").to_pylist(), table.column("ids").to_pylist()))
        done = _digests(c, c.tree([array.array("I", x).tolist() for _, x in leaves]))
        return pa.table([[table.column("doc_id")[0].as_py()], [done[0]], [done[1]], [done[2]]],
                        schema=pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                                          ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    short = rows.where(length <= leaf).mapInArrow(direct, RESULT)
    cut = rows.where(length > leaf).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    leaves = cut.mapInArrow(split, "row long, doc_id long, leaf int, piece string")
    encoded = leaves.repartition("row", "leaf").mapInArrow(encode, "row long, doc_id long, leaf int, ids binary")
    long = encoded.groupBy("row").applyInArrow(join, RESULT)
    return short.unionByName(long)
