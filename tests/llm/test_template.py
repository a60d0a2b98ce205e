"""Main text of small pages, and templates found by their recurrence on a host."""

import pytest

from millrace.llm import template


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain  text &amp; more", "plain text & more"), ("<p>a<p>b</p>c", "a b c"),
        ("<article><h1>T&eacute;</h1><p><b>x<br><p>y</article><footer>no</footer>", "Té x y"),
        ("<nav>menu</nav><script>var t='</p>';</script><style>p{}</style><main><p>k</p></main><aside>s</aside>", "k"),
        ("<body><div class='ad banner'>buy</div><p>keep</p><div id=comments><p>reader</p></div>", "keep"),
        ("<article><p>a</p><form>f<input></form><div class='cookie-notice'>c</div><p>b</p></article>", "a b"),
        ("<article><header><h1>Head</h1></header><p>t</p></article>", "Head t"), ("<script>never closed <p>x", ""),
        ("<p>1 < 2 and <3</p>", "1 < 2 and <3"), ("<!-- <p>gone</p> --><p title='a>b'>stays</p></div></p>", "stays"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>&nbsp;a&#x41;&lt;b&gt;</p>", "aA<b>"),
        ("<ul><li>one<li>two</ul>", "one two"), ("<p hidden>h</p><p aria-hidden='true'>i</p><p>j</p>", "j"),
    ],
)
def test_main_text(html, text):
    assert template.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<main style="overflow:hidden"><p>a</p></main>', "a"), ('<div style="overflow-x:hidden">a</div><p>b</p>', "a b"),
        ('<div data-role="widget">a</div><div data-id="share-1">b</div><div title="x class=ad y">c</div>', "a b c"),
        ("<div CLASS = 'ad'>a</div><div data-x=1 role=navigation>b</div><div hidden>c</div><p>d</p>", "d"),
        ("<p>a</p><svg-icon></svg-icon><select-box>b</select-box><template-part>c</template-part><p>d</p>", "a bc d"),
        ('<p>a<svg class="x>y" />b</p><math/><p>c</p><svg><text>no</text></svg>d', "ab c d"),
        ("<div class=post>text</div><aside><article>teaser</article></aside>", "text"),
        ("<main>text</main><div class=related><div><article>teaser</article></div></div>", "text"),
    ],
)
def test_text_is_not_lost_to_loose_patterns(html, text):
    assert template.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h2 id='related-work'>Related work</h2><p>x</p></article>", "Related work x"), ("<article><section id=discussion><p>x</p></section></article>", "x"),
        ("<article><p class='social-history'>a</p><p id=search-algorithms>b</p><div class='share-prices'>c</div></article>", "a b c"),
        ("<article><p class=notice>a</p><div class='site-footer'>b</div><div id='comments-list'>c</div><div class='share-buttons'>d</div><p>e</p></article>", "e"),
        ("<main><p>own</p></main><article class=teaser>Read also</article>", "own"), ("<main><p>own</p></main><article>Read also</article>", "own"),
        ("<main><p>menu</p><article><p>the article itself</p></article></main>", "the article itself"),
        ("<main><p>a long own text</p><article><p>more</p></article></main>", "a long own text more"),
        ("<a \"b c> <p>x</p>", "x"), ("a < b <p class='>y</p> <i>z", "a < b y z"), ("<p>x</p><a 'b", "x <a 'b"),
    ],
)
def test_names_marks_and_torn_tags(html, text):
    assert template.main_text(html) == text


@pytest.mark.parametrize("piece", ['<a "', "<a ", "<a \"' ", "<script ", "<!", "<!-- ", "<div>", "</p>", "<p>", "<b class='x", "<svg ", "</script"])
@pytest.mark.parametrize("tail", ["", ">", "</span>" * 20_000])
def test_broken_pages_are_read_in_linear_time(piece, tail):
    import time

    start = time.process_time()
    template.main_text(piece * (1_000_000 // len(piece)) + tail)
    assert time.process_time() - start < 6


def test_notices_inside_articles_of_a_host(spark):
    def page(i, host="n.example", notice="<div class=box>Subscribe now!</div>"):
        return (i, f"http://{host}/{i}", f"<article><h1>Title {i}</h1><p>First {i}.</p>" + f"<p>Some more of {i}.</p>" * (i % 7) + f"<ul><li>Salt</li><li>own {i}</li></ul>{notice}</article>")

    copies = [(1000 + i, f"http://copies.example/{i}", f"<article><p>{'Long text of all the copies. ' * 3}</p><p>edit {i}</p><p>And its last part.</p></article>") for i in range(40)]
    few = [page(2000 + i, "few.example") for i in range(4)]
    rows = [page(i) for i in range(400)] + copies + few
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in template.extract(df).collect()}

    def own(i):
        return f"Title {i} First {i}." + f" Some more of {i}." * (i % 7) + f" Salt own {i}"

    want = {i: own(i) for i in range(400)} | {2000 + i: own(2000 + i) + " Subscribe now!" for i in range(4)}
    want |= {1000 + i: "Long text of all the copies. " * 3 + f"edit {i} And its last part." for i in range(40)}
    assert got == want


def test_counts_of_a_host_restated(spark):
    pages = [(f"http://h{i % 3}.example/{i}", f"<body><div><p>{'abc'[i % 3]}</p></div><div><p>own {i}</p></div><div><b>{i % 4}</b></div></body>") for i in range(60)]
    df = spark.createDataFrame(pages, "url string, html string")
    got = {r.host: set(r.templates) for r in template.templates(df, many_pages=10**9).collect()}
    want = {}
    for h in range(3):
        trees = [{n.hash for n in template.parse(html) if n.tag not in ("#root", "html", "body") and n.parts} for url, html in pages if f"//h{h}." in url]
        every = set().union(*trees)
        want[f"h{h}.example"] = {t for t in every if sum(t in tree for tree in trees) >= max(5, 0.3 * len(trees))}
    assert got == want


def test_templates_of_a_host(spark):
    def page(i, host):
        return (i, f"http://{host}/p{i}", f"<body><div><p>Site banner of all pages</p></div><div><p>own text {i}</p></div></body>", "url")

    rows = [page(i, "a.example") for i in range(12)] + [page(50 + i, "b.example") for i in range(3)]
    rows += [(98, None, "<p>no url</p>", "x"), (99, "http://a.example/same", None, "x"), (0, *page(0, "a.example")[1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in template.extract(df).collect()}
    assert got[(5, "http://a.example/p5")] == ("own text 5", 10)
    assert got[(51, "http://b.example/p51")][0] == "Site banner of all pages own text 51"  # too few pages to tell
    assert got[(98, None)][0] == "no url" and got[(99, "http://a.example/same")] == ("", 0)
    assert template.extract(df).count() == len(rows)


def test_repeated_paragraphs_of_articles_stay(spark):
    rows = [(i, f"http://a.example/{i}", "<article><p>the same article</p></article>") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in template.extract(df).collect()} == {"the same article"}


def test_repeated_items_and_cells_of_articles_stay(spark):
    page = "<div><{0}><ul><li>Salt</li><li>own {1}</li></ul><table><tr><th>Sum</th><td>Total</td></tr></table><dl><dt>Who<dd>All</dl><div>plain</div></{0}></div><div>side</div>"
    rows = [(i, f"http://{tag}.example/{i}", page.format(tag, i % 2)) for tag in ("article", "main") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in template.extract(df).collect()} == {f"Salt own {i} Sum Total Who All plain" for i in range(2)}


@pytest.mark.parametrize("by", ["section", "layout"])
def test_templates_of_one_layout_of_a_large_host(spark, by):
    def page(i):
        k = i % 5
        side, path = (f"<div><p>Side block {k}</p></div>", f"part{k}/{i}") if by == "section" else (f"<div class='l{'abcde'[k]}'><p>Side block {k}</p></div>", f"{i}")
        return (i, f"http://big.example/{path}", f"<body>{side}<div><p>own text {i}</p></div></body>")

    rows = [page(i) for i in range(400)] + [(1000 + i, f"http://big.example/copies/{i}", "<body><div><h2>copy</h2></div></body>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in template.extract(df).collect()}
    assert got == {i: f"own text {i}" for i in range(400)} | {1000 + i: "copy" for i in range(60)}


def test_empty_table(spark):
    assert template.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_equals_the_articles(spark):
    import re
    from html import unescape

    from millrace.llm.common import REGISTRY

    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in REGISTRY["op2_template_removal"].build(spark, folder).collect():
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        want = " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
        assert r.text == want and r.n_chars == len(want)
