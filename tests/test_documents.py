import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions.html import rows_of
from tidemark.operators import documents, sketch

NEWS = """
<table><tr class="athing other"><td><span class="titleline"><a href="https://a.example/x">First <b>one</b></a> <a href="no">second</a></span></td></tr>
<tr class="athing"><td>no link<br></td></tr><tr class="spacer"><td><span class="titleline"><a href="skip">s</a></span></td></tr>
<tr class="athing"><td><span class="titleline"><a href="item?id=3">A &amp; B</a></span></td></tr>
<tr class="athing"><td><span class="titleline"><i><a href="deep">not a child</a></i></span></td></tr>
<tr class="athing"><td><span class="titleline"><a href="https://a.example/x">again</a></span></td></tr></table>
"""
QUOTES = """<div class="quote"><span class="text">Be</span><small class="author">Ann</small></div>
<div class="quote"><span class="text">Go</span></div><div class="quote big"><span class="text">Be</span><small class="author">Bob</small></div>"""


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(1, "https://news.example/list?p=1", NEWS), (2, "https://news.example/q", QUOTES), (3, "https://e.example/", None)], "page_id BIGINT, url STRING, html STRING")


def test_links_of_selected_rows(pages):
    found = documents.extract_links(pages, base="https://news.example").orderBy("position").collect()
    assert [(r.position, r.url, r.title) for r in found] == [
        (0, "https://a.example/x", "First one"), (2, "https://news.example/item?id=3", "A & B"), (4, "https://a.example/x", "again"),
    ]
    assert documents.extract_links(pages, limit=2).count() == 1
    unique = documents.dedupe_urls(documents.extract_links(pages), "page_id", "position").collect()
    assert {r.url: r.title for r in unique} == {"https://a.example/x": "First one", "https://news.example/item?id=3": "A & B"}


def test_quotes(pages):
    found = documents.extract_quotes(pages).orderBy("position").collect()
    digest = hashlib.sha256(b"Be").hexdigest()[-6:]
    assert [(r.content, r.title) for r in found] == [("Be", "Ann"), ("Go", ""), ("Be", "Bob")]
    assert found[0].url == found[2].url == f"https://news.example/q#{digest}"


def test_selectors():
    html = "<ul><li class='a b'><p>x</p></li><li><ul><li class=a>y</li></ul></li></ul>"
    assert [r.get("t") for r in rows_of(html, "ul > li", {"t": ("p", None)})] == ["x", None, None]
    assert len(rows_of(html, "li.a", {})) == 2 and len(rows_of(html, "li.a.b", {})) == 1 and len(rows_of(html, "li li", {})) == 1


def test_registry_names_what_it_has(pages):
    registry = documents.default_registry()
    assert registry.available_sources == ["hn", "jsonplaceholder", "playwright"]
    with pytest.raises(ValueError, match="available: hn, jsonplaceholder, playwright"):
        registry.get("nobody")
    assert registry.apply("hn", pages).count() == 3
    assert [documents.clamp_limit(n) for n in (0, 5, 500)] == [1, 5, 100]


def test_bloom_has_no_false_negatives_and_fits_the_formula(spark):
    size = sketch.bloom_size(10_000, 0.01)
    assert (size, sketch.bloom_hashes(size, 10_000)) == (95850, 6)
    urls = spark.range(2000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    bloom = sketch.bloom_build(urls.filter("length(url) % 2 = 0"), "url", 500, 0.05)
    probed = {r.url: r.maybe_seen for r in sketch.bloom_probe(urls, "url", bloom, 500, 0.05).collect()}
    assert len(probed) == 2000 and all(seen for url, seen in probed.items() if len(url) % 2 == 0)
    small = sketch.bloom_size(500, 0.05)
    bits = {int(hashlib.sha256(f"{s}:{u}".encode()).hexdigest(), 16) % small for u in probed if len(u) % 2 == 0 for s in range(sketch.bloom_hashes(small, 500))}
    stored = {r.word * 64 + bit for r in bloom.collect() for bit in range(64) if (r.bits >> bit) & 1}
    assert stored == bits
    halves = [sketch.bloom_build(urls.filter(c), "url", 500, 0.05) for c in ("length(url) = 2", "length(url) = 4")]
    assert {(r.word, r.bits) for r in sketch.bloom_merge(*halves).collect()} == {(r.word, r.bits) for r in bloom.collect()}


def test_unseen_urls_are_exact_even_with_a_crowded_filter(spark):
    urls = spark.range(400).select(F.col("id").cast("string").alias("url"))
    seen = urls.filter("CAST(url AS INT) < 300")
    bloom = sketch.bloom_build(seen, "url", 20, 0.3)
    found = {int(r.url) for r in sketch.unseen_urls(urls.union(urls), seen, bloom, 20, 0.3).collect()}
    assert found == set(range(300, 400))


def test_cascaded_probe_shuffles_few_rows_for_unseen_items(spark):
    """The same answer as looking up every bit, no false negative, and at most two and a half rows per unseen item."""
    from pyspark.sql import functions as F

    from tidemark.operators import sketch

    seen = spark.range(1000).select(F.concat(F.lit("seen-"), "id").alias("k"))
    bloom = sketch.bloom_build(seen, "k", 1000)
    unseen = spark.range(2000).select(F.concat(F.lit("new-"), "id").alias("k"))
    found = {r.k: r.maybe_seen for r in sketch.bloom_probe(seen.union(unseen), "k", bloom, 1000).collect()}
    words = {r.word: r.bits for r in bloom.collect()}
    places = seen.union(unseen).select("k", sketch.bloom_positions("k", 1000).alias("p")).collect()
    every = {r.k: [bool(words.get(p // 64, 0) >> (p % 64) & 1) for p in r.p] for r in places}
    assert found == {k: all(bits) for k, bits in every.items()}
    assert all(found[k] for k in found if k.startswith("seen-"))
    stages = sketch.bloom_stages(len(places[0].p))
    sent = 0
    for bits in (b for k, b in every.items() if k.startswith("new-")):
        for seeds in stages:
            sent += len(seeds)
            if not all(bits[i] for i in seeds):
                break
    assert sent <= 2.5 * 2000
