"""Phrase collocation mining by Toivonen's method.

A sample proposes frequent phrases, level by level and with a lowered
threshold. It takes one in ``SAMPLE`` short stretches of words, so that a
phrase that one document repeats is met like any other.
One full pass then counts every proposed phrase and every phrase of the
negative border: those whose first and last words, each one word less, are
proposed while the phrase itself is not (for single words: all of them).
Border phrases that turn out frequent are failures of the sample. A frequent
phrase that the pass did not count has a smallest part that is not proposed;
that part is a border phrase and frequent, so a failure. One expansion pass
over all phrases around the failures therefore closes the search, whatever the
sample held.

The full pass counts by a hash of 40 bits, which can only count too many. Its
phrases that reach the threshold are counted as they are by the expansion pass,
so only those travel as text. Proposals and the phrases that reached the
threshold are kept as maps of ``2**MAP_BITS`` bits, one per hash, whatever their
number: two phrases that share a bit only make a pass count more phrases.
Both passes send many phrases in a row: hashes in order, as steps from one to
the next, and texts joined.

A frequent phrase is scored at its weakest cut into two parts, and dropped if a
phrase one word longer that holds it is as frequent (one much longer implies
one in between).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import small_batches, stored

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
# One stretch of words in SAMPLE is in the sample; a phrase is proposed at LOWERED of its expected count there.
SAMPLE = 8
LOWERED = 0.25
STRETCH = 8
MAP_BITS = 26
# Bits kept of the hash by which a phrase is counted: fewer bytes are shuffled. Phrases that share them may reach the
# threshold together and are then counted once more, as they are; results do not depend on it.
HASH_BITS = 40
# Leading bits of a hash that all hashes of a row have in common.
ROW_BITS = 12
# Word occurrences that are counted together in a Python worker, and words it remembers at most.
TOGETHER = 1_000_000
REMEMBERED = 500_000
# Phrases of a language are counted as text and first ranked in so many shares.
SHARES = 64
# The contract's characters that end a piece (fixed values), as line feeds; tabs and blanks part words.
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class Words(dict):
    """Numbers of words from 1 on, with their hashes."""

    def __init__(self):
        import xxhash
        super().__init__()
        self.names, self.hashes, self._hash = [b""], [0], xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.hashes.append(self._hash(word))
        return n


def numbers(text: bytes, words: Words) -> list[int]:
    """Word numbers of a text, with a 0 after every piece."""
    out: list[int] = []
    number = words.__getitem__
    for piece in text.lower().translate(ENDS).split(b"\n"):  # bytes.lower() changes A-Z only
        found = piece.split()
        if found:
            out.extend(map(number, found))
            out.append(0)
    return out


ODD = 0x9E3779B97F4A7C15
KEPT = 2**HASH_BITS - 1


def _slots(hashes):
    """Places of hashes in a map, by their kept bits."""
    import numpy as np
    kept = hashes & np.uint64(KEPT)
    return ((kept ^ (kept >> np.uint64(32))) * np.uint64(ODD) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _held(bits, hashes):
    """Whether the map holds each hash; no map holds all."""
    import numpy as np
    if bits is None:
        return np.ones(len(hashes), dtype=bool)
    at = _slots(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def candidates(at, seed: int, hashes, proposed, longest: int = LONGEST) -> Iterator[tuple]:
    """Per length: ``(length, places, hashes, held)`` of the candidates.

    ``at`` holds word numbers, 0 after every piece. A phrase is a candidate if
    its first and its last words, each one word less, are candidates that the
    map ``proposed`` holds (``held`` tells this of the phrase itself).
    """
    import numpy as np
    word = hashes[at]
    places = np.flatnonzero(at)
    h = word[places] + np.uint64(seed)
    passed = np.zeros(len(at), dtype=bool)
    for length in range(1, longest + 1):
        held = _held(proposed, h)
        yield length, places, h, held
        if length == longest:
            return
        passed[:] = False
        passed[places[held]] = True
        on = held & passed[places + 1]  # a 0 follows every piece, so there is a next place
        places = places[on]
        h = h[on] * np.uint64(ODD) + word[places + length]


def around(at, seed: int, hashes, proposed, often) -> Iterator[tuple]:
    """Per length: ``(length, places, hashes)`` of the candidates of the map ``often`` and the phrases that hold its border phrases."""
    import numpy as np
    word = hashes[at]
    holds = np.zeros(len(at), dtype=bool)
    inside = at > 0  # a phrase of this length stands here
    for length, places, h, held in candidates(at, seed, hashes, proposed):
        if length > 1:
            inside[:-1] &= inside[1:]
            holds[:-1] |= holds[1:]
            holds &= inside
        reached = _held(often, h)
        holds[places[reached & ~held]] = True
        counted = holds.copy()
        counted[places[reached]] = True
        found = np.flatnonzero(counted)
        own = word[found] + np.uint64(seed)
        for k in range(1, length):
            own = own * np.uint64(ODD) + word[found + k]
        yield length, found, own


def _same(at, places, length: int, h):
    """``(first places, counts)`` of the different phrases at ``places``, by hash; equal hashes are compared word by word."""
    import numpy as np
    _, first, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    own, other = places, places[first[inverse]]
    if all((at[own + k] == at[other + k]).all() for k in range(length)):
        return places[first], n
    _, first, n = np.unique(at[places[:, None] + np.arange(length)], axis=0, return_index=True, return_counts=True)
    return places[first], n


def _added(hashes: list, n: list):
    """Different hashes and the sums of their counts."""
    import numpy as np
    hashes, n = np.concatenate(hashes), np.concatenate(n)
    if not len(hashes):
        return hashes, n
    by = np.argsort(hashes, kind="stable")
    hashes, n = hashes[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(n, first)


def _short(numbers, first) -> list[bytes]:
    """Numbers as bytes, a value for each run that starts at ``first``: as few bytes a number as the run's largest needs."""
    import numpy as np
    wide = [max(1, int(m).bit_length() + 7 >> 3) for m in np.maximum.reduceat(numbers, first)]
    whole = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)
    return [whole[i:end, :w].tobytes() for i, end, w in zip(first, [*first[1:], len(numbers)], wide)]


def _long(short: bytes, size: int):
    """The ``size`` numbers of a value of ``_short``."""
    import numpy as np
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :len(short) // size] = np.frombuffer(short, dtype=np.uint8).reshape(size, -1)
    return out.view("<u8").ravel()


def _packed(hashes, n) -> list[tuple]:
    """``(share, size, steps, times)`` of different hashes in ascending order: a row for all with the same first ROW_BITS bits.

    Steps lead from one hash of the row to the next, times are the counts.
    """
    import numpy as np
    below = HASH_BITS - ROW_BITS
    share = (hashes >> np.uint64(below)).astype(np.int64)
    first = np.flatnonzero(np.diff(share, prepend=-1))
    steps = np.diff(hashes, prepend=np.uint64(0))
    steps[first] = hashes[first] & np.uint64(2**below - 1)
    size, at = np.diff(first, append=len(hashes)), first.tolist()
    return list(zip(share[first].tolist(), size.tolist(), _short(steps, at), _short(n.astype(np.uint64), at)))


def _unpacked(share: int, size: int, steps: bytes, times: bytes) -> tuple:
    """The hashes and counts of a row of ``_packed``."""
    import numpy as np
    return np.cumsum(_long(steps, size)) + np.uint64(share << HASH_BITS - ROW_BITS), _long(times, size).astype(np.int64)


def _together(batches: Iterator, words: Words) -> Iterator[dict]:
    """Word numbers by language, of about TOGETHER words at a time."""
    texts, size = {}, 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = numbers(text, words)
            if found:
                texts.setdefault(lang, []).extend(found)
                size += len(found)
            if size >= TOGETHER:
                yield texts
                texts, size = {}, 0
                if len(words) > REMEMBERED:
                    words.clear()
                    words.names, words.hashes = [b""], [0]
    if texts:
        yield texts


def hash_counts(docs: DataFrame, proposed=None, only: int | None = None, least: int = 1) -> DataFrame:
    """``hash, n`` of the candidates by the map ``proposed`` of ``lang, text``, in at least ``least`` places; ``only`` a length."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(proposed)  # a map of fixed size at most

    def sent(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        bits, words = shared.value, Words()
        found: list = []
        found_n: list = []
        waiting = 0

        def rows():
            packed = _packed(*_added(found, found_n)) if waiting else []
            found.clear()
            found_n.clear()
            for i in range(0, len(packed), 500):
                columns = zip(zip(*packed[i:i + 500]), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["share", "size", "steps", "times"])

        for texts in _together(batches, words):
            hashes = np.array(words.hashes, dtype=np.uint64)
            for lang, at in texts.items():
                at, seed = np.array(at, dtype=np.int64), xxhash.xxh3_64_intdigest(lang.encode())
                for length, _, h, _ in candidates(at, seed, hashes, bits, only or LONGEST):
                    if length < (only or 1):
                        continue
                    h, n = np.unique(h & np.uint64(KEPT), return_counts=True)
                    found.append(h)
                    found_n.append(n)
                    waiting += len(h)
            if waiting >= 4 * TOGETHER:
                yield from rows()
                waiting = 0
        yield from rows()

    def summed(batches: Iterator) -> Iterator:
        """Sums of a partition's shares, which come one after the other."""
        import numpy as np
        import pyarrow as pa
        share, hashes, n, waiting = None, [], [], 0
        ready: list = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[0] != share:
                    if hashes:
                        ready.append(_added(hashes, n))
                    share, hashes, n, waiting = row[0], [], [], 0
                h, k = _unpacked(*row)
                hashes.append(h)
                n.append(k)
                waiting += len(h)
                if waiting >= TOGETHER:
                    h, k = _added(hashes, n)
                    hashes, n, waiting = [h], [k], 0
            if ready:
                yield rows(pa, np, ready)
                ready.clear()
        if hashes:
            yield rows(pa, np, [_added(hashes, n)])

    def rows(pa, np, ready):
        h, n = (np.concatenate(x) for x in zip(*ready))
        return pa.RecordBatch.from_arrays([pa.array(h[n >= least].view(np.int64)), pa.array(n[n >= least])], ["hash", "n"])

    shares = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(sent, "share int, size int, steps binary, times binary")
    return shares.repartition("share").sortWithinPartitions("share").mapInArrow(summed, "hash long, n long")


def phrase_counts(docs: DataFrame, proposed, often, least: int = 1) -> DataFrame:
    """``lang, words, phrase, n`` of ``lang, text``: the phrases ``around`` the maps in at least ``least`` places, and totals (0 words)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((proposed, often))  # two maps of fixed size

    def sent(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        (bits, reached), words = shared.value, Words()
        known: dict = {}

        def rows():
            shares: dict = {}
            for (lang, length), own in known.items():
                for phrase in sorted(own):
                    shares.setdefault((lang, length, xxhash.xxh3_64_intdigest(phrase) % SHARES), []).append((phrase, own[phrase]))
            known.clear()
            packed = []
            for key, some in shares.items():
                phrases, n = zip(*some)
                packed.append((*key, len(n), b"\n".join(phrases), _short(np.array(n, dtype=np.uint64), [0])[0]))
            for i in range(0, len(packed), 500):
                columns = zip(zip(*packed[i:i + 500]), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["lang", "words", "share", "size", "phrases", "times"])

        for texts in _together(batches, words):
            hashes = np.array(words.hashes, dtype=np.uint64)
            for lang, at in texts.items():
                at, seed = np.array(at, dtype=np.int64), xxhash.xxh3_64_intdigest(lang.encode())
                total = known.setdefault((lang, 0), {})
                total[b""] = total.get(b"", 0) + int((at > 0).sum())
                for length, places, h in around(at, seed, hashes, bits, reached):
                    first, n = _same(at, places, length, h)
                    own = known.setdefault((lang, length), {})
                    for p, k in zip(at[first[:, None] + np.arange(length)].tolist(), n.tolist()):
                        phrase = b" ".join([words.names[i] for i in p])
                        own[phrase] = own.get(phrase, 0) + k
            if sum(map(len, known.values())) >= REMEMBERED:
                yield from rows()
        yield from rows()

    def summed(batches: Iterator) -> Iterator:
        """Sums of a partition's shares, which come one after the other."""
        import pyarrow as pa
        share, own = None, {}

        def rows():
            lang, length, _ = share
            some = [(p, k) for p, k in own.items() if k >= least or length == 0]
            for i in range(0, len(some), 100_000):
                phrases, n = zip(*some[i:i + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([length] * len(n), pa.int32()),
                                                  pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["lang", "words", "phrase", "n"])

        for b in batches:
            for lang, length, at, size, phrases, times in zip(*(c.to_pylist() for c in b.columns)):
                if (lang, length, at) != share:
                    if own:
                        yield from rows()
                    share, own = (lang, length, at), {}
                for phrase, k in zip(phrases.split(b"\n"), _long(times, size).tolist()):  # a phrase holds no line feed
                    own[phrase] = own.get(phrase, 0) + k
        if own:
            yield from rows()

    shares = docs.select("lang", F.col("text").cast("binary").alias("text")) \
                 .mapInArrow(sent, "lang string, words int, share int, size int, phrases binary, times binary")
    keys = ["lang", "words", "share"]
    return shares.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(summed, "lang string, words int, phrase string, n long")


def proposals(hashes: DataFrame, known=None):
    """Map with the bits of ``hash`` set, besides those of the map ``known``."""
    import numpy as np
    bits = np.zeros(2**(MAP_BITS - 3), dtype=np.uint8) if known is None else known.copy()
    spark = hashes.sparkSession
    small_batches(spark)

    def slots(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            at = _slots(b.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["slot", "bit"])

    # 64 bits a row: 2**(MAP_BITS - 6) rows at most, whatever the number of phrases
    rows = hashes.select("hash").mapInArrow(slots, "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits.view("<u8")[rows["slot"].to_numpy()] |= rows["bits"].to_numpy().view(np.uint64)
    return bits


def sampled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``lang, text`` of every ``sample``-th stretch of words, by a hash of doc_id and the stretch's place."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        for b in batches:
            texts = []
            for doc_id, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                draw, kept = xxhash.xxh3_64_intdigest(str(doc_id)), []
                for piece in text.translate(ENDS).split(b"\n"):
                    words = piece.split()
                    for i in range(0, len(words), STRETCH):
                        draw = (draw * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)
                        if (draw >> 33) % sample == 0:
                            kept.append(b" ".join(words[i:i + STRETCH + LONGEST - 1]))  # phrases may run over its end
                texts.append(b"\n".join(kept))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["lang", "text"])

    return docs.select("lang", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, text string")


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, sample: int = SAMPLE, lowered: float = LOWERED) -> DataFrame:
    """``lang, words, phrase, n`` of all phrases of 1 to LONGEST words in at least ``min_count`` places, and totals (0 words)."""
    part = stored(sampled(docs, sample), "phrase-sample")
    least = max(2, -int(-min_count * lowered // sample))
    bits = None
    for length in range(1, LONGEST + 1):
        bits = proposals(hash_counts(part, bits, length, least), bits)
    # closed by the second pass: the smallest part of a frequent phrase that is not proposed is a border phrase, so a failure
    return phrase_counts(docs, bits, proposals(hash_counts(docs, bits, least=min_count)), min_count)


def scored(found: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two or more words that no longer one makes superfluous."""
    total = found.where("words = 0").select("lang", F.col("n").alias("n"))  # a row per language
    known = found.where("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    cand = found.where("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    parts = F.split("phrase", " ", -1)
    # phrases that a longer one by a word at either end equals in number
    shorter = F.explode(F.array(F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " ")))
    within = cand.where("words >= 3").select("lang", shorter.alias("phrase"), F.col("a").alias("longer")) \
                 .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = cand.join(within, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").drop("longer")
    cuts = kept.select("*", parts.alias("parts"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
               .select("lang", "phrase", "a", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    both = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
               .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]) \
               .join(F.broadcast(total), "lang")  # dealt by lang, a language's cuts would meet in one task
    # decimals of 38 digits: whole numbers are exact far beyond 64 bits
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    weakest = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("w"))
    return weakest.select("lang", "phrase", "w.*")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sample: int = SAMPLE, lowered: float = LOWERED) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A null lang is ``und``, a null text is empty. Null doc_ids, repeated rows
    and copies count like any other row; ties in score go to the more frequent
    phrase, then to the smaller one in byte order; extra columns are ignored;
    an empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found = stored(frequent(rows, min_count, sample, lowered), "frequent-phrases")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # shares first: a language's phrases never meet in one task, only each share's first `top`
    share = Window.partitionBy("lang", "share").orderBy(*order)
    some = scored(found).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))) \
                        .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top).drop("share", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
