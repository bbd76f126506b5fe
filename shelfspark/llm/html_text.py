"""Main text of web pages by site template removal.

Every element subtree of a page is hashed. Spark counts on how many different
pages of a host each hash occurs; subtrees that recur on many of them are the
site's template and are deleted from every page: outside an article those on
``MIN_PAGES`` pages, inside one those that half of the host's articles share as
well, since articles quote each other. What remains is the article:
elements that are never part of one (menus, forms, scripts, adverts, reader
comments ...) go by their name, role or class, and the text of the article
element (or main, or body) is returned in blocks.

Template hashes are broadcast when their counted number is at most
``BROADCAST_TEMPLATES``; beyond that each page gets its own templates by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import small_batches, stored

# A template occurs on at least so many different pages of its host; inside articles also in this share of them.
MIN_PAGES = 10
SHARE = 0.5
# 8 bytes each: 16 MB in every executor at most.
BROADCAST_TEMPLATES = 2_000_000
# Rows of one (host, subtree) are dealt to so many tasks when templates are joined to pages.
SPREAD = 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption dir head html legend tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
# An element that starts ends these open ones, looked for up to the listed boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
NEVER = frozenset("nav aside footer form script style noscript template iframe object svg canvas button select textarea "
                  "dialog menu head title audio video input label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs masthead comment comments disqus respond share sharing social related recommended promo promotion "
    "pagination pager footer".split())
# Words that may stand beside these in a compound name.
NEUTRAL = frozenset("list box block area wrap wrapper container section widget item items bar form link links post posts button buttons "
                    "top bottom left right site page inner outer main text label header body unit slot side".split())


def _patterns():
    import re
    tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>")
    attribute = re.compile(r"(class|id|role|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
    ends = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
    return tag, attribute, ends


def _never(tag: str, attributes: str, in_article: bool, find) -> bool:
    """Whether an element is never part of an article."""
    import re
    if tag in NEVER or tag == "header" and not in_article:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False
    for name, *values in find.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id") and any(_named(re.findall(r"[a-z]+", w)) for w in value.split()):
            return True
        if name == "role" and value in ROLES or name == "hidden" and value != "until-found":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _named(words: list[str]) -> bool:
    """Whether a class or id is one of NAMES, or made of such and neutral words only."""
    return any(w in NAMES for w in words) and all(w in NAMES or w in NEUTRAL for w in words)


class _Open:
    __slots__ = ("tag", "parts", "block", "dropped", "article", "main", "text")

    def __init__(self, tag, block, dropped, article, main):
        self.tag, self.block, self.dropped, self.article, self.main = tag, block, dropped, article, main
        self.parts, self.text = [], False


class Page:
    """Blocks of text and subtree hashes of one page.

    Markup may be broken: elements close as browsers close them, text in an
    unfinished tag at the end is dropped, stray end tags are ignored.
    ``templates`` holds hashes whose subtrees are deleted.
    """

    def __init__(self, html: str, templates=frozenset(), patterns=None):
        import html as entities
        import xxhash
        self._hash, self._decode = xxhash.xxh64_intdigest, entities.unescape
        self.tag, self.attribute, self.ends = patterns or _patterns()
        self.templates = templates
        self.blocks: list[list] = []  # [text pieces, article, main]
        self.inside: list[int] = []  # subtrees of the article
        self.outside: list[int] = []
        self.article = 0  # digest of the articles
        self.stack = [_Open("", 0, False, False, False)]
        self.fresh = True
        self._parse(html)
        while len(self.stack) > 1:
            self._pop()

    def _parse(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                return
            if lt > at:
                self._text(html[at:lt])
            following = html[lt + 1:lt + 2]
            if following in "!?" and following:
                if html.startswith("<!--", lt):
                    stop, size = html.find("-->", lt + 4), 3
                else:
                    stop, size = html.find(">", lt), 1
                if stop < 0:
                    return
                at = stop + size
                continue
            m = self.tag.match(html, lt)
            if not m:
                if following.isalpha() or following == "/":
                    if following == "/" and not html[lt + 2:lt + 3].isalpha():  # not a tag at all
                        stop = html.find(">", lt)
                        if stop < 0:
                            return
                        at = stop + 1
                        continue
                    return  # an unfinished tag at the end
                self._text("<")
                at = lt + 1
                continue
            at = m.end()
            closing, name, attributes = m.group(1), m.group(2).lower(), m.group(3)
            if closing:
                self._end(name)
                continue
            self._start(name, attributes)
            if name in RAW and name != "noscript":
                raw = self.ends[name].search(html, at)
                if not raw:
                    return
                at = raw.start()
            elif name in VOID or attributes.endswith("/") and name in ("path", "svg"):
                self._pop()

    def _open(self, names, until=frozenset()) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in names:
                return i
            if self.stack[i].tag in until:
                return 0
        return 0

    def _start(self, name: str, attributes: str) -> None:
        if name in CLOSES_P:
            i = self._open({"p"}, {"button", "table", "td", "th", "caption", "object"})
            while i and len(self.stack) > i:
                self._pop()
        if name in ENDS:
            i = self._open(*ENDS[name])
            while i and len(self.stack) > i:
                self._pop()
        if name in BLOCKS:
            self.fresh = True
        top = self.stack[-1]
        dropped = top.dropped or _never(name, attributes, top.article or top.main, self.attribute)
        self.stack.append(_Open(name, len(self.blocks), dropped, (top.article or name == "article") and not dropped,
                                (top.main or name == "main") and not dropped))
        if name == "br":
            self._text(" ")

    def _end(self, name: str) -> None:
        i = self._open({name}, frozenset() if name in BLOCKS else BLOCKS - {"p", "div"} | {"p"} - {name})
        while i and len(self.stack) > i:
            self._pop()

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        text = self._decode(raw) if "&" in raw else raw
        words = text.split()
        if words:
            top.parts.append(" ".join(words).encode("utf-8", "replace"))
            top.text = True
        if top.dropped or not words and self.fresh:
            return
        if self.fresh:
            self.blocks.append([[], top.article, top.main])
            self.fresh = False
        if self.blocks:
            self.blocks[-1][0].append(text)

    def _pop(self) -> None:
        done = self.stack.pop()
        if done.tag in BLOCKS:
            self.fresh = True
        digest = self._hash(done.tag.encode() + b"\0" + b"\1".join(done.parts))
        above = self.stack[-1]
        above.parts.append(digest.to_bytes(8, "big"))
        if done.text:
            above.text = True
            if done.tag in BLOCKS and done.tag not in ("html", "body"):
                (self.inside if done.article or done.main else self.outside).append(digest)
                if done.tag == "article" or done.tag == "main" and not done.article:
                    self.article ^= digest
                if digest in self.templates:
                    for b in self.blocks[done.block:]:
                        b[0] = None

    def text(self) -> str:
        kept = [b for b in self.blocks]
        for place in (1, 2):
            if any(b[place] for b in kept):
                kept = [b for b in kept if b[place]]
                break
        lines = (" ".join("".join(b[0]).split()) for b in kept if b[0])
        return "\n".join(x for x in lines if x)


def host(url):
    """Host of a url: after the first ``://`` up to /, ?, # or the end, A-Z lower-cased."""
    inside = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(inside, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


SUBTREES = "page string, host string, article long, inside array<long>, outside array<long>"


def _subtrees(pages: DataFrame) -> DataFrame:
    """The different subtree hashes of every page, inside and outside its article, and the article's digest."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        made = _patterns()
        for b in batches:
            found = [Page(h, patterns=made) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([p.article - 2**63 for p in found], pa.int64()),
                 *(pa.array([[x - 2**63 for x in set(s)] for s in part], pa.list_(pa.int64()))
                   for part in ([p.inside for p in found], [p.outside for p in found]))],
                ["page", "host", "article", "inside", "outside"])

    return pages.select("page", "host", "html").mapInArrow(run, SUBTREES)


def _recurring(seen: DataFrame, context: str, column: str, min_pages: int, share: float) -> DataFrame:
    """(host, subtree) of ``column`` that recur in many different values of ``context``."""
    once = seen.dropDuplicates(["host", context])
    size = once.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    often = once.select("host", F.explode(column).alias("subtree")).groupBy("host", "subtree") \
                .agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    return often.join(size, "host").where(F.col("n") >= share * F.col("pages")).select("host", "subtree")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """``(seen, templates)``: subtrees of every page, and the (host, subtree) that recur.

    Subtrees outside the article count once per different page, those inside
    once per different article: copies of an article make no template of it.
    """
    seen = stored(_subtrees(pages), "subtrees")
    found = _recurring(seen, "page", "outside", min_pages, 0.0).unionByName(
        _recurring(seen, "article", "inside", min_pages, share)).distinct()
    return seen, stored(found, "templates")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE,
              broadcast_limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``page_id, url, html``.

    Null html counts as empty, null urls share the empty host; null page_ids
    and repeated rows come back as they are; extra columns are ignored; an
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    rows = rows.withColumn("page", F.sha1("html"))
    seen, found = templates(rows, min_pages, share)
    count = found.count()
    if count <= broadcast_limit:
        known: dict[str, set] = {}
        for h, s in found.collect():  # at most broadcast_limit rows
            known.setdefault(h, set()).add(s + 2**63)
        shared = spark.sparkContext.broadcast(known)
        rows = rows.withColumn("own", F.lit(None).cast("array<long>"))
    else:
        shared = spark.sparkContext.broadcast(None)
        deal = F.pmod(F.xxhash64("page"), F.lit(SPREAD))
        each = seen.dropDuplicates(["host", "page"]) \
                   .select("page", "host", F.explode(F.concat("inside", "outside")).alias("subtree"), deal.alias("deal"))
        dealt = found.withColumn("deal", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SPREAD)])))
        own = each.join(dealt, ["host", "subtree", "deal"]).groupBy("page", "host").agg(F.collect_set("subtree").alias("own"))
        rows = rows.join(own, ["page", "host"], "left")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        made, known, none = _patterns(), shared.value, frozenset()
        for b in batches:
            texts = []
            for html, h, own in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                site = known.get(h, none) if known is not None else {x + 2**63 for x in own or ()}
                texts.append(Page(html, site, made).text())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "host", "own").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
