"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Fitting uses bounded samples of labelled rows: ``EXAMPLES`` of each label are
the examples, ``CALIBRATION`` further ones calibrate. Terms are words, all of
them: a term's weight is its TF-IDF among the examples times one plus the
chi-square of its document counts by label, so no term is left out and those
that tell the labels apart count more. Terms that no example holds have a
document count of 0 and lengthen a query's vector. Every document is
then a query: its ``NEIGHBOURS`` nearest examples vote with their squared
similarity, a logistic curve fitted on the calibration sample turns the vote
into a probability, and the nearest examples' doc_ids are returned as evidence.

The index is inverted and in blocks: for every block of ``BLOCK`` examples and
every term in it the postings and their largest weight. The ``DENSE`` most
frequent terms are kept as rows over all examples, and their part of every
similarity is one product. The largest of these parts in a block and the
largest weights of its other terms bound what any example of the block can
reach; blocks are read in the order of their bounds until the next bound cannot
beat the k-th best similarity found, so the neighbours are exactly those of a
full comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import one_per, small_batches, stored

EXAMPLES = 1000  # of each label, at most; different texts
CALIBRATION = 3000  # at most
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4
EVIDENCE = 3
# Terms kept as rows over all examples at most, of single precision: 16 MB with all examples.
DENSE = 2048
# What single precision may lose of a similarity.
SLACK = 1e-5
THRESHOLD = 0.3


def terms(text: str | None) -> dict[str, int]:
    """Counts of a text's words, lower-cased."""
    import re
    from collections import Counter
    return Counter(re.findall(r"\w+", (text or "").lower()))


class Index:
    """Block-max inverted index over weighted term vectors of length one; rows are dicts or ``(terms, counts)`` arrays."""

    def __init__(self, vocabulary: dict[str, int], idf, rows: list, labels, ids, block: int = BLOCK):
        import numpy as np
        self.vocabulary, self.idf = vocabulary, np.asarray(idf, dtype=np.float64)
        vectors = [self._unit(r) for r in rows]
        # examples that share their heaviest term share blocks, which keeps the bounds of other blocks low
        order = sorted(range(len(rows)), key=lambda i: (vectors[i][0][int(np.argmax(vectors[i][1]))] if len(vectors[i][0]) else -1, i))
        self.labels = np.array([labels[i] for i in order], dtype=np.float64)
        self.ids = np.array([-1 if ids[i] is None else ids[i] for i in order], dtype=np.int64)
        self.size, self.blocks = len(rows), -(-len(rows) // block)
        term = np.concatenate([vectors[i][0] for i in order]) if order else np.empty(0, np.int64)
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by = np.argsort(term, kind="stable")
        self.place = place[by]
        self.weight = (np.concatenate([vectors[i][1] for i in order]) if order else np.empty(0))[by]
        often = np.bincount(term, minlength=len(self.idf))
        common = np.argsort(-often, kind="stable")[:DENSE]
        common = common[often[common] > block]
        self.row = np.full(len(self.idf), -1, dtype=np.int64)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.size), dtype=np.float32)
        on = self.row[term[by]] >= 0
        self.dense[self.row[term[by][on]], self.place[on]] = self.weight[on]
        by, self.place, self.weight = by[~on], self.place[~on], self.weight[~on]
        self.edges = np.arange(0, self.size, block)
        self.block = block
        # cells, one for each block that holds a term: only those that exist, so the index is as large as the examples
        cell = term[by] * max(self.blocks, 1) + self.place // block
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.start = np.append(first, len(cell))  # postings of a cell
        self.held = cell[first] % max(self.blocks, 1)  # block of a cell
        self.largest = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.cells = np.searchsorted(cell[first] // max(self.blocks, 1), np.arange(len(self.idf) + 1))  # cells of a term

    def _unit(self, counts, rest: float = 0.0):
        """Terms and weights; ``rest`` is the squared length of the terms that are not in the vocabulary."""
        import numpy as np
        if isinstance(counts, dict):
            t = np.array(sorted(counts), dtype=np.int64)
            counts = np.array([counts[k] for k in t.tolist()], dtype=np.float64)
        else:
            t, counts = counts
        w = (1 + np.log(counts)) * self.idf[t]
        length = float(np.sqrt((w * w).sum() + rest))
        return t, w / length if length else w

    def query(self, counts: dict[int, float], k: int = NEIGHBOURS, rest: float = 0.0):
        """``(similarities, places)`` of the k nearest examples with a similarity above 0, nearest first."""
        import numpy as np
        t, w = self._unit(counts, rest)
        if not len(t) or not self.size:
            return np.empty(0), np.empty(0, np.int64)
        row = self.row[t]
        part = (w[row >= 0].astype(np.float32) @ self.dense[row[row >= 0]]).astype(np.float64)
        cells, times = _ranges(self.cells, t[row < 0])
        wide = np.repeat(w[row < 0], times)
        held = self.held[cells]
        bound = np.bincount(held, weights=self.largest[cells] * wide, minlength=self.blocks) + np.maximum.reduceat(part, self.edges)
        best, where, unread = np.empty(0), np.empty(0, np.int64), bound > 0
        while unread.any():
            # the blocks with the largest bounds first, then every block whose bound the k-th best does not exceed
            chosen = unread.copy()
            if not len(best):
                top = np.argsort(-np.where(unread, bound, -1.0), kind="stable")[:FIRST_BLOCKS]
                chosen[:] = False
                chosen[top] = unread[top]
            elif len(best) >= k:
                chosen &= bound >= best[-1] - SLACK
                if not chosen.any():
                    break
            unread &= ~chosen
            on = chosen[held]
            at, count = _ranges(self.start, cells[on])
            sums = part + np.bincount(self.place[at], weights=self.weight[at] * np.repeat(wide[on], count), minlength=self.size)
            hit = np.flatnonzero(np.repeat(chosen, self.block)[:self.size] & (sums > 0))
            best = np.concatenate([best, sums[hit]])
            where = np.concatenate([where, hit])
            if len(best) > 4 * k:
                near = best >= np.partition(best, -k)[-k] - SLACK
                best, where = best[near], where[near]
            keep = np.lexsort((where, -np.round(best, 6)))[:k]
            best, where = best[keep], where[keep]
        return best, where


def _ranges(starts, which):
    """``(positions, sizes)`` of the stretches from ``starts[i]`` to ``starts[i + 1]``."""
    import numpy as np
    first = starts[which]
    size = starts[which + 1] - first
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size), size


class Scorer:
    """Index and calibration; ``score`` gives (probability, nearest similarity, evidence doc_ids)."""

    def __init__(self, index: Index | None, prior: float, unseen: float = 0.0):
        self.index, self.prior, self.unseen, self.curve = index, prior, unseen, None
        self.sent = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": None}

    def counts(self, text: str | None) -> tuple:
        """Numbers and counts of the index's terms, and the squared length of all others."""
        import numpy as np
        found = terms(text)
        number = self.index.vocabulary.get
        at = np.array([number(w, -1) for w in found], dtype=np.int64)
        n = np.array(list(found.values()), dtype=np.float64)
        return (at[at >= 0], n[at >= 0]), float((((1 + np.log(n[at < 0])) * self.unseen)**2).sum())

    def features(self, text: str | None):
        """Inputs of the calibration curve, with the neighbours they come from."""
        import numpy as np
        counts, rest = self.counts(text)
        near, where = self.index.query(counts, rest=rest)
        if not len(near):
            return np.array([1.0, 0.0, 0.0, 0.0]), near, where
        vote = float((near**2 * self.index.labels[where]).sum() / (near**2).sum())
        return np.array([1.0, 1.0, vote - 0.5, (vote - 0.5) * float(near[0])]), near, where

    def fit_curve(self, inputs: list, labels: list) -> None:
        """Logistic curve over ``features`` by Newton steps, with a small ridge."""
        import numpy as np
        x = np.array(inputs).reshape(len(inputs), 4)
        y = np.asarray(labels, dtype=np.float64)
        beta, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 0.5
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
            beta = beta + step
            if np.abs(step).max() < 1e-8:
                break
        self.curve = beta

    def score(self, text: str | None) -> tuple[float, float, list[int]]:
        import numpy as np
        if self.index is None or self.curve is None:
            return self.prior, 0.0, []
        x, near, where = self.features(text)
        p = float(1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30))))
        return p, float(near[0]) if len(near) else 0.0, [int(i) for i in self.index.ids[where[:EVIDENCE]] if i >= 0]


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def _term_rows(examples: DataFrame) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            found = [terms(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([list(f) for f in found], pa.list_(pa.string())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                ["doc_id", "label", "terms", "counts"])

    return examples.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id long, label int, terms array<string>, counts array<int>")


def _vectors(ex: DataFrame, names) -> DataFrame:
    """``doc_id, label, at, n``: every example's terms by number, ascending, and their counts."""
    shared = ex.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator) -> Iterator:
        import pickle
        import zlib

        import numpy as np
        import pyarrow as pa
        number = {t: i for i, t in enumerate(pickle.loads(zlib.decompress(shared.value)))}
        for b in batches:
            at, n = [], []
            for t, c in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                t = np.array([number[x] for x in t], dtype=np.int32)
                by = np.argsort(t)
                at.append(t[by])
                n.append(np.array(c, dtype=np.int32)[by])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))],
                                             ["doc_id", "label", "at", "n"])

    return ex.mapInArrow(run, "doc_id long, label int, at array<int>, n array<int>")


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, calibration: int = CALIBRATION) -> Scorer:
    """Scorer from the labelled rows that are not held out.

    Samples are the rows with the smallest hash of doc_id: the same at any
    number of partitions. Rows without doc_id or label are no examples; of
    several labels of one doc_id the largest counts, of several rows one text.
    Without labels of both kinds every text gets the smoothed rate of label 1.
    """
    import math
    import pickle
    import zlib

    import numpy as np
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()) \
                   .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")) \
                   .withColumn("draw", F.xxhash64("doc_id"))
    usable = stored(usable, "toxic-labels")
    counts = {r[0]: r[1] for r in usable.where("label IN (0, 1)").groupBy("label").count().collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return Scorer(None, prior)
    # A third of the labels, by hash, is for calibration and keeps the labels' own proportions.
    other = F.pmod(F.xxhash64("draw", F.lit(1)), F.lit(3)) == 0
    parts = [usable.where(~other & (F.col("label") == y)).orderBy("draw", "doc_id").limit(examples)
                   .select("doc_id", "label", F.lit("example").alias("part")) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    rest = usable.where(other & F.col("label").isin(0, 1)).orderBy("draw", "doc_id").limit(calibration) \
                 .select("doc_id", "label", F.lit("calibration").alias("part"))
    sample = stored(chosen.unionByName(rest), "toxic-sample")  # 2 * examples + calibration rows at most
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id") \
                .groupBy("doc_id", "part", "label").agg(F.min("text").alias("text"))
    rows = stored(texts, "toxic-texts")

    ex = one_per(rows.where("part = 'example'"), ["label", "text"], ["doc_id"])  # a copied text is one example
    ex = stored(_term_rows(ex), "toxic-terms")
    size = {r[0]: r[1] for r in ex.groupBy("label").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return Scorer(None, prior)
    df = ex.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    a, b, n = F.col("a").cast("double"), F.col("b").cast("double"), float(pos + neg)
    chi = F.when(a + b < n, (n * F.pow(a * (neg - b) - b * (pos - a), 2)) / ((a + b) * (n - a - b) * float(pos) * float(neg)))
    idf = F.log((1 + n) / (1 + a + b)) + 1
    # every term of the examples: bounded by their number and length
    every = df.select("term", (idf * (1 + F.coalesce(chi, F.lit(0.0)))).alias("weight")).orderBy("term").toArrow()
    names = every["term"].to_pylist()
    known = _vectors(ex, zlib.compress(pickle.dumps(names), 1)).toArrow().sort_by("doc_id")  # at most 2 * examples rows
    vectors = [(t.values.to_numpy().astype(np.int64), c.values.to_numpy().astype(np.float64)) for t, c in zip(known["at"], known["n"])]
    vocabulary = {t: i for i, t in enumerate(names)}
    index = Index(vocabulary, every["weight"].to_numpy(), vectors, known["label"].to_pylist(), known["doc_id"].to_pylist())
    scorer = Scorer(index, prior, math.log(1 + n) + 1)
    del known, vectors, every, names
    inputs = _features(rows.where("part = 'calibration'"), scorer).collect()  # at most `calibration` rows
    inputs.sort(key=lambda r: r["doc_id"])
    scorer.fit_curve([list(r["x"]) for r in inputs], [r["label"] for r in inputs])
    return scorer


def _shared(spark, scorer: Scorer):
    """Loader of the scorer for Python workers: loaded once per task. Its size is bounded by the examples' texts."""
    import zlib
    if scorer.sent is None:  # once: only the curve is added later
        scorer.sent = spark.sparkContext.broadcast(zlib.compress(cloudpickle.dumps(scorer), 1))
    shared, curve, held = scorer.sent, scorer.curve, []

    def load() -> Scorer:
        import pickle
        import zlib
        if not held:
            held.append(pickle.loads(zlib.decompress(shared.value)))
            held[0].curve = curve
        return held[0]

    return load


def _features(rows: DataFrame, scorer: Scorer) -> DataFrame:
    load = _shared(rows.sparkSession, scorer)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            found = [load().features(t)[0].tolist() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.float64()))],
                                             ["doc_id", "label", "x"])

    return rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x array<double>")


RESULT = "score double, similarity double, evidence array<long>"


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` with ``toxicity`` (score, similarity of the nearest example, evidence doc_ids).

    Null and empty texts have no neighbours and get the rate of such texts in
    the calibration sample. Of equally near examples the one that comes first in
    the index counts. Every row is returned, repeated rows too, with all its
    columns but one named ``toxicity``, which is replaced; an empty table gives
    an empty result.
    """
    small_batches(docs.sparkSession)
    load = _shared(docs.sparkSession, scorer)

    @F.pandas_udf(RESULT)
    def run(texts):
        import pandas as pd
        return pd.DataFrame([load().score(t) for t in texts], columns=["score", "similarity", "evidence"])

    return docs.withColumn("toxicity", run(F.col("text")))


def acceptable(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all columns.

    Columns of any name come back as they are, repeated rows and null doc_ids
    too; equal texts are kept or go together; null and empty texts score as in
    ``scored``; an empty table gives an empty result.
    """
    columns = docs.columns
    renamed = docs.toDF(*[f"__{i}" for i in range(len(columns))]).withColumn("text", F.col(f"__{columns.index('text')}"))
    kept = scored(renamed, fit(docs, labels)).where(F.col("toxicity.score") < threshold)
    return kept.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(columns)])
