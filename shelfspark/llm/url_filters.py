"""URL filters: hand-written rules first, association rules mined from their verdicts for the rest.

URLs that a base rule decides are labelled by it. All words of their host, path,
query and fragment, and the label, are transactions of Spark's FP-growth; rules
that conclude a label are pruned by confidence and support, and dropped where
a shorter rule with the same conclusion is at least as sure. Words that stand
in the same labelled URLs tell the same, so they are mined as one; words of all
labelled URLs tell nothing. Both lose no rule. The others' URLs
look rules up in an inverted index that files each rule under its rarest
token, and the surest rule that matches decides: of equally sure rules the one
with more support, then with more words, then one that blocks, then the last
in the order of its words. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits a host and all its subdomains, if the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host, path):
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


# The contract's rules (fixed values).
BASE = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
        Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_and_path(url):
    """Host after the first ``://`` up to /, ?, # or the end, A-Z lower-cased; path from there up to ?, # or the end."""
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(url, host, path):
    """Sorted different tokens of a URL: the words of host labels, path parts, query keys and values, and fragment, by where they stand."""
    whole = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    query = F.regexp_extract(whole, r"(?s)^[^#?]*\?([^#]*)", 1)
    pairs = F.split(query, "&")
    places = (("host", host), ("path", F.translate(path, UPPER, LOWER)), ("fragment", F.regexp_extract(whole, r"(?s)^[^#]*#(.*)", 1)),
              ("key", F.array_join(F.transform(pairs, lambda p: F.substring_index(p, "=", 1)), "&")),
              ("value", F.array_join(F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, r"^[^=]*=", "")).otherwise("")), "&")))

    def words_of(name, text):
        return F.transform(F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.concat(F.lit(name + ":"), w))

    words = [words_of(name, text) for name, text in places]
    return F.array_sort(F.array_distinct(F.concat(*words))).alias("tokens")


def told(rows: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``row, verdict, tokens`` of all rows, with the tokens that can be in a rule only.

    These are in at least ``min_support`` of the labelled rows, and not in all;
    tokens of the same labelled rows are named by the first of them.
    """
    each = rows.select("row", "verdict", F.explode("tokens").alias("token"))
    labelled = rows.where("verdict IS NOT NULL").count()
    seen = each.where("verdict IS NOT NULL").groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("a"), F.sum(F.shiftright(F.xxhash64("row", F.lit(1)), 24)).alias("b"))
    useful = seen.where((F.col("n") >= min_support * labelled) & (F.col("n") < labelled))  # average words / min_support tokens at most
    same = useful.groupBy("n", "a", "b").agg(F.min("token").alias("name"))
    named = stored(useful.join(same, ["n", "a", "b"]).select("token", "name"), "url-tokens")
    found = each.join(named, "token").groupBy("row").agg(F.array_sort(F.collect_set("name")).alias("tokens"))
    return rows.select("row", "verdict").join(found, "row", "left") \
               .select("row", "verdict", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))


def judged(pages: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``row, page_id, host, path, tokens, rule, verdict`` with the base rules' verdicts; the longest fitting rule wins."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    order = sorted(base, key=lambda r: -len(r.text))
    rule = F.coalesce(*[F.when(r.fits(F.col("host"), F.col("path")), F.lit(r.text)) for r in order], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(r.fits(F.col("host"), F.col("path")), F.lit(r.verdict)) for r in order], F.lit(None).cast("string"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path",
                       tokens(F.col("url"), F.col("host"), F.col("path")), rule.alias("rule"), verdict.alias("verdict"))


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``id, tokens, rarest, verdict, confidence, support`` of the rules mined from ``tokens, verdict`` rows.

    Their number is bounded by the tokens that reach the support (a URL's
    words / min_support) and not by the table.
    """
    items = F.concat("tokens", F.array(F.concat(F.lit("label:"), F.col("verdict"))))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(labelled.select(items.alias("items")))
    goal = F.element_at("consequent", 1)
    found = model.associationRules.where(goal.startswith("label:")) \
        .where(~F.exists("antecedent", lambda t: t.startswith("label:"))) \
        .select(F.array_sort("antecedent").alias("tokens"), F.substring(goal, 7, 100).alias("verdict"),
                F.round("confidence", 9).alias("confidence"), F.round("support", 9).alias("support"))
    found = stored(found.withColumn("id", F.array_join("tokens", "\x1f")), "url-rules")
    frequency = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    filed = found.select("id", F.explode("tokens").alias("token")).join(frequency, "token")
    rarest = filed.groupBy("id").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    rules = stored(found.join(rarest, "id"), "url-rules-filed")
    # A rule is dropped when part of its tokens already conclude the same at least as surely.
    short = rules.select(F.col("id").alias("other"), F.col("tokens").alias("part"), F.col("rarest").alias("token"),
                         F.col("verdict").alias("same"), F.col("confidence").alias("sure"))
    covered = rules.select("id", "tokens", "verdict", "confidence", F.explode("tokens").alias("token")).join(short, "token") \
        .where((F.col("id") != F.col("other")) & (F.col("verdict") == F.col("same")) & (F.col("sure") >= F.col("confidence"))
               & (F.size(F.array_except("part", "tokens")) == 0)).select("id").distinct()
    return rules.join(covered, "id", "left_anti")


def matched(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``row, verdict, confidence, because`` of the surest rule whose tokens all occur in a row's ``tokens``."""
    index = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("needed"), "verdict", "confidence", "support",
                         F.col("id").alias("because"))
    met = rows.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token") \
              .where(F.size(F.array_except("needed", "tokens")) == 0)
    best = F.struct("confidence", "support", F.size("needed").alias("n"), (F.col("verdict") == "block").alias("b"), "because", "verdict")
    return met.groupBy("row").agg(F.max(best).alias("best")).select(
        "row", F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"),
        F.regexp_replace("best.because", "\x1f", " & ").alias("because"))


def verdicts(pages: DataFrame, base: tuple[Rule, ...] = BASE, default: str = "allow",
             min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row: page_id, host, path, rule (base rule or null), verdict, confidence and because (mined rule or null).

    A null url, or one without ``://``, has an empty host and path and takes
    the method's verdict; where no mined rule matches, or nothing is labelled,
    that is ``default``. Null page_ids and repeated rows come back as they are;
    extra columns are ignored; an empty table gives an empty result.
    """
    rows = stored(judged(pages, base), "url-rows")
    if rows.where("verdict IS NOT NULL").isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.lit(default).alias("verdict"),
                           F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("because"))
    useful = stored(told(rows, min_support), "url-words")
    found = matched(useful.where("verdict IS NULL"), mined(useful.where("verdict IS NOT NULL"), min_support, min_confidence))
    return rows.join(found, "row", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "mined", F.lit(default)).alias("verdict"), "confidence", "because")
