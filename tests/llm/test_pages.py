import html
import random
import re

import pytest

from marketlake.llm.pages import common, extract, lines, main_text


def lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_longest_common_subsequence():
    rng = random.Random(7)
    for _ in range(600):
        a, b = (["".join(rng.choice("abcdef")) for _ in range(rng.randrange(14))] for _ in range(2))
        found = [x for x, s in zip(a, common(a, b)) if s]
        assert len(found) == lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in found)  # in order


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><div id="cookie-notice">We use cookies</div><header>Site</header><nav><ul><li>Home</nav>
<article><header><h1>Head&nbsp;line</h1></header><p class=lead>One <b>two</b>
 three &lt;tag&gt; &#233;&#x4e2d;<p>Four<br>five<div class="ad-slot">Buy <div>now</div></div><ul><li>item<li>more</ul>
<form>Name</form><section class="comments"><article class="comment">I say</article></section><p hidden>unseen</p>last</article>
<aside>Related</aside><footer>&copy; 2024</footer>"""


def test_parts_of_a_page():
    found = lines(PAGE)
    assert [x for x, inside in found if inside] == ["Head line", "One two three <tag> é中", "Four five", "item", "more", "last"]
    assert [x for x, inside in found if not inside] == []


def test_differencing_without_article():
    page = lambda *x: [(t, False) for t in x]
    one, two = page("Menu", "About", "A text of one", "Imprint"), page("Menu", "A text of another", "Imprint")
    assert main_text(one, [two], True) == "About\nA text of one"
    assert main_text(one, [one, two], True) == "About\nA text of one"  # a copy is passed over
    assert main_text(one, [], True) == "Menu\nAbout\nA text of one\nImprint"
    assert main_text([("Menu", False), ("x", True)], [two], True) == "x"


@pytest.mark.parametrize("table", ["sf0.001"])
def test_like_the_pages_markup(spark, table):
    pages = spark.read.parquet(f"/root/testdata/{table}/pages.parquet")
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:  # these pages have one article of h1, p, b and br
        body = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br" in x else "", x)).split()) for x in re.split("</?(?:p|h1)>", body))
        text = "\n".join(x for x in parts if x)
        assert found[r.page_id] == (r.url, text, len(text))


def test_neighbours_do_not_depend_on_ranges(spark):
    rows = [(i, f"https://h{i % 3}.org/a/{i:03}", f"<p>Menu {i % 3}<p>text {i}<p>foot {i // 40}") for i in range(120)]
    wanted = None
    for n in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
        found = sorted(tuple(r) for r in extract(df).collect())
        assert wanted in (None, found)
        wanted = found
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(f"text {i}" in text and "Menu" not in text for i, _, text, _ in found)


def test_odd_rows(spark):
    rows = [
        (1, None, "<p>alone"), (2, "https://a.org/x", None), (None, "https://a.org/y", "<p>a<p>b"), (3, "not a url", ""),
        (4, "https://a.org/z", "<p>" + "long " * 200_000), (4, "https://a.org/z", "<p>" + "long " * 200_000), (5, "https://a.org/q", "<div <p>\"'&#0;&bogus; <!-- open"),
    ]
    df = spark.createDataFrame([(*r, True, "b") for r in rows], "page_id long, url string, html string, halo boolean, bucket string")
    found = sorted(((r.page_id, r.text[:9], r.n_chars) for r in extract(df).collect()), key=repr)
    assert found[0] == (1, "alone", 5) and found[1] == (2, "", 0) and found[2] == (3, "", 0) and found[-1] == (None, "a\nb", 3)
    assert found[3] == found[4] == (4, "long long", 999_999)
    assert extract(df.limit(0)).count() == 0


def test_text_beside_an_article_goes_only_if_shared(spark):
    html = "<div>Menu of the site</div><div>Story number {0}, told beside the card</div><article>Card number {0} with a text</article><div>Imprint</div>"
    rows = [(i, f"https://h.org/a/{i}", html.format(i)) for i in range(3)] + [(3, "https://alone.org/a", html.format(3))]
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert found[i] == f"Story number {i}, told beside the card\nCard number {i} with a text"
    assert found[3] == "Card number 3 with a text"  # no neighbour to tell
