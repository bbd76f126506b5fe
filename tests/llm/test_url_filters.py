"""URL filters: contract rules, mined rules against brute force."""
import itertools
from collections import Counter

from shelfspark.llm import url_filters as U

SCHEMA = "page_id long, url string, verdict int"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def split(url):
    a, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(url):
    host, path = split(url)
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0])) if fits else (None, None)


URLS = ["http://A.Example.ORG/es/1", "http://example.org/es", "https://x.example.org/en/12?a=b", "http://org/", "http://notorg/", "http://a.com/fr/x#y",
        "http://a.com/de/", "http://b.net/es/3", None, "", "no host", "http://", "http://example.org?x=/es/", "http://h.org", "ftp://u.com/de/?q", "://com/de/q",
        "http://a.net/\ne", "http://ÄÖ.org/é", "http://a://b.org/x", "http://dots..com/de/"]


def test_base_rules(spark):
    rows = [(i, u, 1) for i, u in enumerate(URLS)] + [(2, URLS[2], 1), (None, URLS[0], 1)]
    got = U.verdicts(spark.createDataFrame(rows, SCHEMA).repartition(2), min_support=0.3).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, u, _ in rows:
        r = by[i]
        assert (r.host, r.path) == split(u), u
        name, verdict = rule(u)
        assert r.rule == name, u
        assert r.verdict == verdict if name else r.verdict in ("allow", "block")


def test_mined_rules_match_brute_force(spark):
    urls = [f"http://{'abc'[i % 3]}.example.{'org' if i % 4 else 'net'}/{'es' if i % 5 == 0 else 'en'}/{i % 7}" for i in range(400)]
    urls += [f"http://shop.com/{'de' if i % 2 else 'fr'}/{i}.html?id=1" for i in range(100)]
    urls += [f"http://q.com/de/{'-'.join(w)}" for w in itertools.product(("red", "blue"), ("big", "small"), ("old", "new")) for _ in range(9)]
    urls += ["http://long.net/" + "-".join(f"w{i}" for i in range(20_000)), "http://x.net/red-big/old?a=b&c=d-e#top"]
    judged = U.judged(spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], SCHEMA)).cache()
    raw = {r.row: r for r in judged.collect()}
    assert any({"path:red", "path:big", "key:a", "value:b", "key:c", "value:d", "value:e", "fragment:top", "host:x"} <= set(r.tokens) for r in raw.values())
    rows = U.told(judged, 0.05).collect()
    n = sum(r.verdict is not None for r in rows)
    where = {}
    for r in raw.values():
        for t in r.tokens if r.verdict else ():
            where.setdefault(t, set()).add(r.row)
    useful = {t: min(u for u, x in where.items() if x == w) for t, w in where.items() if 0.05 * n <= len(w) < n}
    assert {r.row: r.tokens for r in rows} == {k: sorted({useful[t] for t in r.tokens if t in useful}) for k, r in raw.items()}
    labelled = [(set(r.tokens), r.verdict) for r in rows if r.verdict]
    found = {}
    counts = Counter()
    both = Counter()
    for t, v in labelled:
        for n in range(1, len(t) + 1):
            for c in itertools.combinations(sorted(t), n):
                counts[c] += 1
                both[c, v] += 1
    for (c, v), n in both.items():
        if n >= 0.05 * len(labelled) and n / counts[c] >= 0.8:
            found[c, v] = n / counts[c]
    least = {(c, v): p for (c, v), p in found.items()
             if not any(set(d) < set(c) and w == v and q >= p - 1e-9 for (d, w), q in found.items())}
    df = spark.createDataFrame([(sorted(t), v) for t, v in labelled], "tokens array<string>, verdict string")
    mined = U.mined(df, 0.05, 0.8)
    assert {(tuple(r.tokens), r.verdict): round(r.confidence, 6) for r in mined.collect()} == {k: round(p, 6) for k, p in least.items()}
    open_rows = [r for r in rows if not r.verdict]
    got = {r.row: (r.mined, r.confidence) for r in U.matched(spark.createDataFrame([(r.row, r.tokens) for r in open_rows], "row long, tokens array<string>"), mined).collect()}
    for r in open_rows:
        fits = [p for (c, _), p in least.items() if set(c) <= set(r.tokens)]
        assert (r.row in got) == bool(fits)
        if fits:
            assert abs(got[r.row][1] - max(fits)) < 1e-6


def test_nothing_labelled_and_empty(spark):
    got = U.verdicts(spark.createDataFrame([(1, "http://x.net/a", 1)], SCHEMA)).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")]
    assert U.verdicts(spark.createDataFrame([], SCHEMA)).count() == 0
