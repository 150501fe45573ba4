"""Main text of pages: markup rules, and branches that only the tree tells apart."""

import html as H

import pytest

from tablekit.llm import html_style_tree as T

SCHEMA = "page_id bigint, url string, html string"


def lines(page):
    return [line for _, _, line in T.blocks(page)]


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>a\n\t b<br>c</p>", ["a b c"]),
    ("<div>x<div>y</div>z</div>", ["x", "y", "z"]), ("<p>one <b>two</b>three</p>", ["one twothree"]),
    ("<p>&amp;&lt;&#233;&nbsp;x &copy</p>", ["&<é x ©"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<script>var t='</p>';</script><p>x", ["x"]), ("<script>never ends <p>x", []), ("a<!-- <p>b</p> -->c", ["ac"]),
    ("<nav>m</nav><article><h1>t</h1><p>x</p></article><footer>f</footer>", ["t", "x"]),
    ("<div class='side sidebar-2'>s</div><div id=comments>c</div><div role=navigation>n</div><p hidden>h</p><p>x", ["x"]),
    ("<body class='has-sidebar'><article class='no-comments'><p>x", ["x"]), ("<p title='a > b'>x</p>", ["x"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("2 < 3 <p>x", ["2 < 3", "x"]), ("<p>x</div></p></p>y", ["x", "y"]),
    ("<form>q<input></form><aside>z</aside><header>w</header><p>x</p><textarea>t</textarea><button>k</button>", ["x"]),
])
def test_blocks(page, want):
    assert lines(page) == want


def page(i, body, extra=""):
    return f"<html><body><div class=top><span>Welcome to us</span></div><div class=story>{body}</div>{extra}<div class=end>All about us</div></body></html>"


def test_repeated_branches_go(spark):
    rows = []
    for i in range(60):
        host = "big.example.org" if i < 40 else f"h{i}.example.org"
        rows.append((i, f"http://{host}/{i}", page(i, "".join(f"<p>Story {i} part {j} {i * 37 + j}</p>" for j in range(i % 5 + 1)))))
    rows += [(100, "http://big.example.org/x", None), (101, None, ""), (102, "http://big.example.org/y", rows[0][2])]
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (2_000_000, 0):  # broadcast, and joined by host
        got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in T.extract(df, broadcast_rows=limit).collect()}
        assert len(got) == 63
        for i, url, _ in rows[:60]:
            want = "\n\n".join(f"Story {i} part {j} {i * 37 + j}" for j in range(i % 5 + 1))
            assert got[i] == (url, want, len(want))
        assert got[100][1:] == ("", 0) and got[101] == (None, "", 0) and got[102][1] == got[0][1]


def test_a_host_drops_what_others_use(spark):
    """One node holds news on all hosts but one, where it holds a slogan."""
    rows = [(i, f"http://a{i % 7}.org/", f"<p>text {i}</p><div class=x>news {i}</div>") for i in range(60)]
    rows += [(100 + i, "http://shop.org/%d" % i, f"<p>goods {i}</p><div class=x>the same slogan</div>") for i in range(12)]
    for limit in (2_000_000, 0):
        got = {r["page_id"]: r["text"] for r in T.extract(spark.createDataFrame(rows, SCHEMA), broadcast_rows=limit).collect()}
        assert got[5] == "text 5\n\nnews 5" and got[103] == "goods 3"


def test_importance_by_the_formula(spark):
    import math
    rows = [("h", 1, 0, 0, 10), *[("h", 1, 1, k, c) for k, c in enumerate([10, 5, 1])], ("h", 1, 2, 7, 4), ("h", 1, 2, 8, 6)]
    got = T.importance(spark.createDataFrame(rows, "host string, node bigint, kind int, item bigint, n bigint"), ["host", "node"]).first()
    content = 1 - sum(math.log(c, 10) for c in (10, 5, 1)) / 3
    shape = -sum(p * math.log(p, 10) for p in (0.4, 0.6))
    assert got["importance"] == pytest.approx((1 - T.GAMMA) * shape + T.GAMMA * content)


def test_no_page_loses_all_and_empty_table(spark):
    rows = [(i, "http://a.org/", "<p>only this</p>") for i in range(20)]
    assert {r["text"] for r in T.extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {"only this"}
    assert T.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_pages_table(spark):
    """Every page of the smallest table against its article element."""
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in T.extract(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", raw[r["page_id"]], re.S).group(1).replace("<b>", "").replace("</b>", "")
        parts = [" ".join(H.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize("start", [
    '<div class="main" style="overflow:hidden">', '<div aria-hidden="false">', '<div data-role=navigation data-class="ad">', '<div title="hidden">',
    '<div class="layout has-sidebar">', '<div class="no-sidebar">', '<div id="share-prices">', '<div class="post_comments-off">', "<div class='widget'>",
])
def test_wrappers_that_only_look_like_it(start):
    assert lines(f"{start}<h1>t</h1><p>the article</p></div>") == ["t", "the article"]


@pytest.mark.parametrize("start", ["<div hidden>", '<div class="x" hidden="">', "<div class='big Sidebar'>", "<div id=share class=x>", "<div class=ad_3>",
                                   '<div role="navigation">'])
def test_elements_that_go(start):
    assert lines(f"{start}<p>gone</p></div><p>x</p>") == ["x"]


@pytest.mark.parametrize("page, want", [
    ('<a title="x>link text</a> more', ["link text more"]), ('<a title="x>link</a><p class="y">z</p>', ["link", "z"]),
    ("<p title='it>x</p>", ["x"]), ("<p data-x=it's>x</p>", ["x"]), ("<p>x</p><a href=", ["x"]), ("<p>x <a y", ["x"]), ("x<!-- never", ["x"]),
    ('<form action="/"><h1>t</h1><p>x</p><nav>m</nav><select><option>o</select></form>', ["t", "x"]),
    ('<form><div class="sidebar"><p>x</p><div class=ad>a</div></div></form>', ["x"]), ("<nav>a</nav><footer>b</footer>", []),
    ('<div role="dialog"><form><p>x</p></form></div>', ["x"]), ("<div hidden><p>x</p></div>", []),
    ("<article><p>x</p></article><div class='post-comments'><p>c</p></div>", ["x"]), ("<p>x</p><ul class=comments-list><li>c</ul>", ["x"]),
    ("<p>x</p><div id='site-footer'>f</div>", ["x"]), ("<p>x</p><div style='color:red; display : none'>h</div>", ["x"]),
    ("<div class='comments-off'><p>x</p></div><p>y</p>", ["x", "y"]), ("<p>x</p><section id=comment_section-2>c</section>", ["x"]),
    ("<style>p{}</style><script>if (a<b) x()</script><p>x", ["x"]), ("</p></div>x</nowhere>", ["x"]), ("<>x</>", ["<>x</>"]),
])
def test_hostile_and_real_markup(page, want):
    assert lines(page) == want


@pytest.mark.parametrize("page", ["<a x" * 250_000, "<a x='" * 200_000, '<a x="' * 100_000 + "'", "<div>" * 8000 + "x" + "</div>" * 8000, "<div>" * 5000 + "</nope>" * 50_000,
                                  "<nav>" * 8000 + "<p>x", "<b>" * 20_000 + "<p>" * 20_000, "<!--" * 200_000, "<" * 300_000, "<li>" * 50_000, "<script>" * 5000,
                                  "<p class=a>x" * 20_000])
def test_a_million_bytes_take_linear_time(page):
    import time
    begin = time.process_time()
    T.blocks(page)
    assert time.process_time() - begin < 4


def test_hostile_pages_through_the_operator(spark):
    pages = ["<a x" * 100_000, "<div>" * 3000 + "deep", '<a title="x>link', None, "<form><p>wrapped</p></form>"] * 12
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, f"http://h{i % 3}.org/{i}", p) for i, p in enumerate(pages)], SCHEMA)
    for name in ("key", "host", "text", "node", "gone"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in T.extract(df).collect()}
    assert [got[i] for i in range(5)] == ["", "deep", "link", "", "wrapped"] and len(got) == 60
