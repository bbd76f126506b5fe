"""HTML extraction: broken markup, site templates, both ways to apply them."""
import random

import pytest

from shelfspark.llm import html_text
from shelfspark.llm.html_text import Page

SCHEMA = "page_id long, url string, html string, text int"


@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<article><h1>T</h1><p><b>one<br><p>two</article><p>out", "T\none\ntwo"),
    ("<body><nav>menu</nav><header>top</header><main>a <i>b</i>\n c<div>d</div></main><footer>f</footer>", "a b c\nd"),
    ("<article>a<!-- x > y --><script>var t='</p>';</script><style>p{}</style>b</article>", "ab"),
    ("<article><header><h1>kept</h1></header><p>x</p><div class='ad'>buy</div><section id=comments><p>me too</p></section></article>", "kept\nx"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut &amp", "cut &"), ("<article><p>cut</p><p cla", "cut"), ("a < b <3 c", "a < b <3 c"),
    ("<article><p title='a>b'>x</p></article>", "x"), ("<ARTICLE><P>x</P></ARTICLE>", "x"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>", "1\n2\na\nb"),
    ("<article><p>a</b></i></p></div>z</article>", "a\nz"), ("<p>x<form><input>y</form>z", "x\nz"), ("<article></article>", ""),
    ("<article><p>&nbsp;a&nbsp;b&#x41;&eacute;</p></article>", "a bAé"), ("<title>t</title><p>b", "b"),
    ("<article><p>a</p></article><aside>s</aside><article><p>b</p></article>", "a\nb"),
    ("<article class='comment'>c</article><p>d</p>", "d"), ("<div hidden>h</div><div style='display: none'>n</div>v", "v"),
    ("<" * 5000, "<" * 5000), ("<a " * 20000, ""), ("<div>" * 3000 + "deep", "deep"), ("<!-- never closed", ""), ("x<script>never closed", "x")])
def test_pages(html, text):
    assert Page(html).text() == text


def pages():
    rng = random.Random(6)
    rows = []
    for i in range(60):
        site = f"http://{'hot' if i % 3 else 'Small'}.example.org/{i}"
        body = "".join(f"<p>{rng.random()} words of page {i} {j}</p>" for j in range(rng.randrange(1, 5)))
        rows.append((i, site, f"<body><div><p>Welcome to our site</p></div>{body}<div><p>Call us now</p><p>Imprint</p></div></body>", 1))
    article = "<body><article><p>a story</p><p>with two parts</p></article></body>"
    rows += [(100 + i, f"http://copies.example.org/{i}", f"<body><nav>{i}</nav>{article}", 1) for i in range(40)]
    rows += [(200, None, None, 1), (201, "nohost", "", 1), (None, "http://one.example/", "<p>x</p>", 1), (3, rows[3][1], rows[3][2], 1)]
    return rows


@pytest.mark.parametrize("limit", [0, 10**6])  # joined to the pages, or broadcast
def test_templates_of_a_host_go(spark, limit):
    rows = pages()
    got = html_text.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3), broadcast_limit=limit).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    for i, _, html, _ in rows[:60]:
        assert texts[i] == "\n".join(x for x in Page(html).text().split("\n") if "page" in x)
    assert all(texts[100 + i] == "a story\nwith two parts" for i in range(40))  # copies of an article are no template
    assert texts[200] == texts[201] == "" and texts[None] == "x"
    assert all(r.n_chars == len(r.text) for r in got)


def test_neutral_blocks_of_part_of_a_host_go(spark):
    """Blocks without a telling name on 20 to 40 % of a large host's pages are templates; counts equal brute force."""
    rng = random.Random(11)
    rows = []
    for i in range(120):
        blocks = [f"<div class='x{k}'><p>line {k} of the site</p><p>and more {k}</p></div>" for k, every in ((1, 5), (2, 3), (3, 60)) if i % every == 0]
        text = f"<div><p>own text {i} {rng.random()}</p></div>"
        rows.append((i, f"http://big.example/{i}", f"<body>{''.join(blocks)}{text}</body>", 1))
    rows.append((500, "http://big.example/0", rows[0][2], 1))  # a copy is no other page
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    texts = {r.page_id: r.text.split("\n") for r in html_text.main_text(df).collect()}
    for i in range(120):
        want = (["line 3 of the site", "and more 3"] if i % 60 == 0 else []) + [x for x in texts[i] if x.startswith("own")]
        assert texts[i] == want and len(want) >= 1
    named = df.select("page_id", "html", html_text.host(html_text.F.col("url")).alias("host"), html_text.F.sha1("html").alias("page"))
    _, found = html_text.templates(named)
    count = {}
    for html in {r[2] for r in rows}:
        for h in set(Page(html).outside):
            count[h] = count.get(h, 0) + 1
    assert {(r.host, r.subtree + 2**63) for r in found.collect()} == {("big.example", h) for h, n in count.items() if n >= html_text.MIN_PAGES}


@pytest.mark.parametrize("name,kept", [("ad-hoc", True), ("social-policy", True), ("related-work", True), ("comment-box", False), ("ad1", False),
                                       ("cookie_notice", False), ("x ads", False), ("header-text", True)])
def test_names_count_as_a_whole(name, kept):
    assert Page(f"<article><p>a</p><div class='{name}'>b</div></article>").text() == ("a\nb" if kept else "a")


def test_empty_table(spark):
    assert html_text.main_text(spark.createDataFrame([], SCHEMA)).count() == 0
