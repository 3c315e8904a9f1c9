"""Main text of pages: markup cases, importance against brute force, planted repeated branches, odd rows."""

import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import pytest

from tidemark.llm import style_tree
from tidemark.llm.reports import op10_site_style_tree

SF = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """Plain reading of the test pages: the blocks inside <article>."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks, self.now = False, [], []

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.now = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1"):
            self.cut()
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            if self.inside:
                self.cut()
            self.now = []
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now.append(data)


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op10_site_style_tree(spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        plain = Article()
        plain.feed(pages[r["page_id"]]["html"])
        plain.close()
        plain.cut()
        assert r["text"] == "\n".join(plain.blocks)
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("source, text", [
    ("", ""), (None, ""), ("just  text", "just text"), ("<p>a<p>b", "a\nb"), ("<p>a&amp;b &lt;i&gt; &#233;&nbsp;x</p>", "a&b <i> é x"),
    ("<div>a <b>b</b>\n c<br>d</div>", "a b c d"), ("<!-- <p>x</p> --><p>a</p><!-- open <p>z", "a"),
    ("<script>'</p>'<p>x</script><style>p{}</style><p>a", "a"), ("<script>never closed <p>x", ""),
    ("<body><header>h</header><nav>n</nav><main><p>a</p><aside>s</aside><form><p>f</form></main><footer>f</footer>", "a"),
    ("<article><h1>t</h1><p>a</p><div class='comments'><p>c</p></div></article><div>out</div>", "t\na"),
    ("<div class='ad'>x</div><div id='cookie-notice'>y</div><p>a</p>", "a"), ("<div class='download'>a</div>", "a"),
    ("<div role=navigation>x</div><p hidden>y</p><p title='a>b' class=x>a</p>", "a"), ("a < b <3", "a < b <3"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ("<p>a</div></section>b</p>", "a\nb"), ("<P CLASS='x'>A</P><Footer>b</FOOTER>", "A"), ("<p>a</p><p title=\"open>b</p>", "a\nb"),
    ("<article class='comment'>x</article><article>a</article>", "a"), ("<div><a href=x>menu one</a> <a href=y>two</a></div><p>a", "a"),
    ("<title>t</title><textarea><p>x</textarea><select><option>o</select><p>a", "a"),
])
def test_markup(source, text):
    assert style_tree.Page(source).main_text() == text


def test_work_is_linear():
    for big in ("<" * 200_000, "<a b=\"" * 50_000, "<!--" * 50_000, "<div>" * 50_000 + "x", "<p>" * 50_000, "<li>" * 50_000, "<script>" * 30_000):
        style_tree.Page(big).main_text()
    words = "w " * 400_000
    assert len(style_tree.Page(f"<p>{words}</p>").main_text()) == 799_999


def site(n, seed=1):
    rnd = random.Random(seed)
    prose = lambda k: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(k))
    pages, texts = [], []
    for i in range(n):
        body, sub = [prose(30) for _ in range(3)], f"Part {prose(4)}"
        pages.append(
            "<html><body><div class='top'>Shop of the year</div><section><div class='lead'>" + sub + "</div>"
            + "".join(f"<p>{p}</p>" for p in body) + "</section><div class='low'><p>All rights are with us.</p><p>Read the terms.</p></div></body></html>"
        )
        texts.append("\n".join([sub, *body]))
    return pages, texts


def test_repeated_branches_go(spark):
    pages, texts = site(40)
    rows = [(i, f"https://User@Site.example:80/{i}?x", p) for i, p in enumerate(pages)]
    alone, _ = site(1, seed=2)
    rows += [(100, "https://alone.example/", alone[0]), (101, None, "<p>a</p>"), (102, "https://site.example/", None), (0, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "1 AS mark", "2 AS low", "3 AS host")
    found = style_tree.main_texts(frame).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r["text"] for r in found}
    assert [by_id[i] for i in range(40)] == texts
    assert by_id[100].startswith("Shop of the year\n") and by_id[101] == "a" and by_id[102] == ""
    assert style_tree.main_texts(frame.limit(0)).count() == 0


def test_copies_of_an_article_stay(spark):
    page = "<body><article><h1>t</h1><p>one</p><p>two</p></article></body>"
    frame = spark.createDataFrame([(i, "http://h/", page) for i in range(50)], "page_id bigint, url string, html string")
    assert {r["text"] for r in style_tree.main_texts(frame).collect()} == {"t\none\ntwo"}


def test_importance(spark):
    rnd = random.Random(4)
    rows = [("h", 1, rnd.randrange(3), "s" if rnd.random() < 0.5 else "c", rnd.randrange(5), rnd.randrange(4)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "host string, page bigint, node bigint, kind string, value bigint, children int")
    found = {r["node"]: r["importance"] for r in style_tree.importance(frame).collect()}
    for node in found:
        def entropy(kind):
            counts = Counter(r[4] for r in rows if r[2] == node and r[3] == kind)
            n = sum(counts.values())
            return -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)

        mine = [r for r in rows if r[2] == node]
        n_s = sum(r[3] == "s" for r in mine)
        weight = style_tree.GAMMA ** (sum(r[5] for r in mine) / n_s)
        assert found[node] == pytest.approx((1 - weight) * entropy("s") + weight * entropy("c"))


def unique(rnd, n):
    return [" ".join(f"w{rnd.randrange(10**9)}" for _ in range(12)) for _ in range(n)]


def cleaned(spark, pages):
    frame = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in style_tree.main_texts(frame).collect()}


def test_unique_texts_of_a_regular_container_stay(spark):
    rnd = random.Random(6)
    texts = [unique(rnd, 12) for _ in range(10)]
    pages = [f"<body><div class='text'>{''.join(f'<p>{p}</p>' for p in t)}</div><div class='end'>All rights are with us.</div></body>" for t in texts]
    inline = [unique(rnd, 1)[0] for _ in range(10)]
    pages = [p.replace("<body>", f"<body><div class='lead'>{t}{'<b></b>' * 14}</div>") for p, t in zip(pages, inline)]
    # A page crawled many times is one page.
    found = cleaned(spark, pages + [pages[0]] * 200)
    assert [found[i] for i in range(10)] == ["\n".join([lead, *t]) for lead, t in zip(inline, texts)]
    assert {found[i] for i in range(10, 210)} == {found[0]}
    two = cleaned(spark, [p.replace("<div class='end'>All rights are with us.</div>", "") for p in pages[:2]])
    assert two == {i: "\n".join([inline[i], *texts[i]]) for i in range(2)}


def test_branches_of_few_texts_each_go_as_a_whole(spark):
    rnd = random.Random(8)
    texts = [unique(rnd, 3) for _ in range(5)]
    end = "<div class='end'><p class='a'>All rights are with us.</p><p class='b'>Read the terms.</p></div>"
    pages = [f"<body><section>{''.join(f'<p>{p}</p>' for p in t)}</section>{end}</body>" for t in texts]
    assert cleaned(spark, pages) == {i: "\n".join(t) for i, t in enumerate(texts)}


def test_whole_child_sequences_at_any_depth(spark):
    rnd = random.Random(9)
    style = lambda tail: {p.styles[-1][1:] for p in [style_tree.Page(f"<div class='text'>{'<p>a</p>' * 64}{tail}</div>")]}
    assert style("<p>a</p>") != style("<h2>a</h2>") and {n for _, n in style("<p>a</p>" * 36)} == {100}
    texts = [unique(rnd, 70) for _ in range(6)]
    end = "<div class='end'><p class='a'>All rights are with us.</p><p class='b'>Read the terms.</p></div>"
    deep = lambda inside: "<div>" * 9 + inside + "</div>" * 9
    pages = [f"<body>{deep('<div>' + ''.join(f'<p>{p}</p>' for p in t) + '</div>' + end)}</body>" for t in texts]
    assert cleaned(spark, pages) == {i: "\n".join(t) for i, t in enumerate(texts)}
    rows = style_tree.nodes_of.func(pa.array(["<div>x" * 5_000]))[0]
    assert len(rows) <= 4 * 5_000


def test_open_elements_close_however_deep():
    """A paragraph, list item or cell ends where the next begins, under any number of inline elements left open."""
    for start, end in (("<p>", ""), ("<ul><li>", "</ul>"), ("<table><tr><td>", "</table>")):
        inner = re.search(r"<(\w+)>$", start).group(1)
        for depth in (1, 63, 64, 500):
            page = style_tree.Page(f"<body>{start}one {'<b>' * depth}two<{inner}>three{end}</body>")
            assert [b[0] for b in page.blocks] == ["one two", "three"]
            around = [page.places[page.places[b[3]][1]][1] for b in page.blocks]
            assert around[0] == around[1]  # the second lies beside the first, not below it
