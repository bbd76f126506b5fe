"""Registered queries of the operators, with their production parameters, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import (bpe, decontaminate, exact_dedup, html_text, licenses, packing, phrases, sharding, simhash, token_alignment, toxicity,
                            url_filters, warc)
from shelfspark.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from its nearest labelled examples, which are never held-out rows."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), F.col("toxicity.score").alias("score"),
                        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                        F.col("toxicity.similarity").alias("similarity"), F.col("toxicity.evidence").alias("evidence"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signature detections in every document."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page after site templates are removed."""
    return html_text.main_text(read(spark, sf_dir, "pages"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that overlaps a benchmark item, with the item and the overlap, by spaced seeds."""
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"),
                                  short_agree=decontaminate.AGREE)


def tokenizer_path() -> str:
    """The 50k byte-level vocabulary of the installed tokenizer files."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document, long texts by tree concatenation."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each group of equal texts stays, by the extendible-hash index, for every document."""
    return exact_dedup.duplicates(read(spark, sf_dir, "documents"))


ORACLE["op6_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM t
"""


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to Zstandard archives and read back."""
    found = warc.archived(read(spark, sf_dir, "pages"))
    return found.select("page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
                        warc.page_id("refers_to").alias("refers_to"))


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url by the base rules, else by mined association rules."""
    return url_filters.verdicts(read(spark, sf_dir, "pages"))


@query
def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot among 24 shards by a Feistel permutation (law: rows)."""
    placed = sharding.shard(read(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 3 differing bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, bits=3)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations of two to five words in at least 100 places."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


ORACLE["op11_phrase_mining"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')), '[ 	]+'), lambda w: w <> '') AS words
    FROM documents)),
spans AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM pieces, range(1, 6) AS s(k), LATERAL (SELECT unnest(range(1, len(words) - k + 2)) AS i)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM spans GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND a >= 100),
inner_ AS (
  SELECT DISTINCT b.lang, array_to_string(b.words[i:i + m - 1], ' ') AS phrase, b.a
  FROM cand AS b, range(2, 5) AS s(m), LATERAL (SELECT unnest(range(1, len(b.words) - m + 2)) AS i) WHERE m < len(b.words)),
kept AS (SELECT * FROM cand AS c WHERE NOT EXISTS (
  SELECT 1 FROM inner_ AS i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 100 * c.a)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, s.cut, x.a AS l, y.a AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM kept AS c JOIN range(1, 5) AS s(cut) ON s.cut < c.k
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:s.cut], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[s.cut + 1:], ' ')
  JOIN total AS t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


def piece_model_path() -> str:
    """The 32k sentencepiece model of the installed tokenizer files."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment measures of every document between the 50k byte-level and the 32k piece vocabulary."""
    return token_alignment.alignment(read(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


def word_tokenizer_path() -> str:
    """The 49k vocabulary with word ends of the installed tokenizer files."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4,096 ids, by best fit planned over the lengths' histogram."""
    return packing.packed(read(spark, sf_dir, "documents"), word_tokenizer_path())
