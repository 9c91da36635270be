import time

from pyspark.sql import functions as F

from kindred.sources import pages, shops

DETAIL_B = """<html><head><script>var a="</p><h1 data-dmid='x'>no</h1>";</script></head><body>
<a data-dmid="product-brand"> Acme </a>
<h1 data-dmid="detail-page-headline-product-title">Acme <span>Day &amp; <b>Night</b></span></h1>
{price}<div data-dmid="buybox">Jetzt <b>4,45</b> € statt 9,99 €</div>
<div data-dmid="price-infos">0,05 l<p>(89,00 €)</p></div>
<div data-dmid="Inhaltsstoffe-content"><h3>Liste</h3><!-- c -->{ingredients}</div>
<span data-dmid="product-rating" aria-label="4,7 von 5 Sternen bei 480 Bewertungen"></span>
</body></html>"""


def test_detail_b(spark):
    rows = [
        ("full", DETAIL_B.format(price="<span data-dmid='price-localized'>3,95 €</span>",
                                 ingredients="<div class='x whitespace-pre-line'>Aqua,\nGlycerin</div>")),
        ("fallback", DETAIL_B.format(price="", ingredients="<p>Aqua<p>Oil")),
        ("empty", ""), ("none", None),
    ]
    got = {r.url: r for r in shops.detail_b(spark.createDataFrame(rows, "url string, html string")).collect()}
    full = got["full"]
    assert (full.brand, full.product_name, full.price) == ("Acme", "Day &Night", "3,95 €")
    assert (full.base_price, full.ingredients) == ("0,05 l(89,00 €)", "Aqua,\nGlycerin")
    assert (full.rating, full.review_count) == ("4.7", "480")
    assert got["fallback"].price == "4,45 €"
    assert got["fallback"].ingredients == "Liste Aqua Oil"
    assert set(got["empty"][1:-1]) == {""} and set(got["none"][1:-1]) == {""}
    outcome = pages.outcome(shops.detail_b(spark.createDataFrame(rows, "url string, html string")))
    assert {r.ok: r["count"] for r in outcome.groupBy("ok").count().collect()} == {True: 2, False: 2}


def test_detail_a(spark):
    html = """<h1>other</h1><h1 data-nc="typography-next"><a data-qa-block="product_brand_name">Acme</a>
    <span data-qa-block="product_name">Cream</span></h1>
    <div id="764163da-b008-4e51-ae78-632f8fd81dbf"><span class="a pdp-product-info-details">Aqua<br>Oil
    <script>x</script></span></div>"""
    plain = "<h1><a data-qa-block='product_brand_name'>B</a></h1>"
    got = shops.detail_a(spark.createDataFrame([("1", html), ("2", plain)], "url string, html string")).collect()
    assert [tuple(r)[:4] for r in got] == [("1", "Acme", "Cream", "Aqua, Oil"), ("2", "B", "", "")]


def test_cards_a(spark):
    card = """<a data-nc="card" href="/p/{n}"><p data-qa-block="product_brand">B{n}</p>
    <i data-qa-block="product_price"> 9,95 € </i></a>"""
    html = ("<a data-nc='card' href='/outside'></a><div data-qa-block='product-section'>"
            + card.format(n=1) + card.format(n=2) + "</div>")
    got = shops.cards_a(spark.createDataFrame([(html,), ("<p>no section",)], "html string"),
                        "https://shop.example").collect()
    assert [(r.brand, r.series, r.price, r.url) for r in got] == [
        ("B1", "", "9,95 €", "https://shop.example/p/1"), ("B2", "", "9,95 €", "https://shop.example/p/2")]


def test_tiles_b(spark):
    html = """<div data-dmid="product-tile" data-gtin="40"><a href="/cart/add">+</a><a href="/p/40">x</a>
      <div data-dmid="product-image-container"><img src="" data-src="i.png"></div>
      <b data-dmid="product-brand">Acme</b>
      <div data-dmid="product-description"><span>Acme</span><span>Day Cream</span><span>(480)</span></div>
      <i data-dmid="product-tile-rating" aria-label="4,7 von 5 Sternen bei 480 Bewertungen"></i></div>
    <div data-dmid="product-tile" data-dan="7"><img src="j.png"></div>
    <div data-dmid="product-tile"><a href="https://y.example/p">x</a></div>"""
    got = shops.tiles_b(spark.createDataFrame([("serum", html)], "subcategory string, html string"),
                        "https://shop.example").collect()
    assert len(got) == 2  # the second has neither number nor link
    first, second = got
    assert (first.brand, first.name, first.gtin, first.dan) == ("Acme", "Day Cream", "40", None)
    assert (first.product_url, first.image_url) == ("https://shop.example/p/40", "i.png")
    assert (first.rating, first.review_count, first.price) == ("4.7", "480", None)
    assert (second.product_url, second.name, second.image_url) == ("https://y.example/p", None, None)


def test_inventory_and_work_list(spark):
    rows = spark.createDataFrame([("<i data-dmid='b'><i data-dmid=\"a\"><i data-dmid='b'>",)], "html string")
    got = pages.attribute_inventory(rows, "data-dmid").collect()
    assert [(r.value, r.uses) for r in got] == [("a", 1), ("b", 2)]
    urls = spark.createDataFrame([(" u ",), (None,), ("\n ",)], "url string")
    assert [r.url for r in pages.work_list(urls, "url").collect()] == ["u"]


ATTRIBUTES = [
    ('<img data-src="lazy.jpg" src="real.jpg">', ["real.jpg"]),
    ('<!-- <img src="no.jpg"> --><img src=plain.jpg><img src=\'q "x".jpg\'>', ["plain.jpg", 'q "x".jpg']),
    ('<IMG SRC = "a?b=1&amp;c=2" alt="src=\'no\'">', ["a?b=1&c=2"]),
    ("<script>'<img src=\"no.jpg\">'</script><img src=''><p src>", []),
    ('<img alt="a > b" src="x.jpg"/> src="text.jpg" <img src="open.jpg"', ["x.jpg"]),
    ("<imgx src=y><img\nsrc=z>", ["y", "z"]), (None, None), ("", []),
]


def test_attribute_values(spark):
    rows = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(ATTRIBUTES)], "i int, html string")
    got = {r.i: r.v for r in rows.select("i", pages.attribute_values(F.col("html"), "src").alias("v")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(ATTRIBUTES)}
    images = rows.select("i", pages.attribute_values(F.col("html"), "src", tag="img").alias("v")).collect()
    assert {r.i: r.v for r in images}[5] == ["z"]


def test_failed_pages_are_records(spark):
    broken = "<![odd]><p>x</p>"
    by_url = spark.createDataFrame([("1", broken), ("2", "<p>")], "url string, html string")
    for record in (shops.detail_a(by_url), shops.detail_b(by_url)):
        assert {r.url: r.page_error is None for r in record.collect()} == {"1": False, "2": True}
        assert sorted((r.ok, r.failed) for r in pages.outcome(record).collect()) == [(False, False), (False, True)]
    cards = shops.cards_a(by_url, "https://shop.example").collect()
    assert [(r.url, r.page_error is None) for r in cards] == [(None, False)]
    tiles = shops.tiles_b(by_url.withColumnRenamed("url", "subcategory"), "https://shop.example").collect()
    assert [(r.subcategory, r.product_url, r.page_error is None) for r in tiles] == [("1", None, False)]


def test_many_unclosed_tags_take_linear_time(spark):
    html = "<b><i>" * 20_000 + "</p>" * 20_000 + "<h1>x</h1>"
    start = time.time()
    assert pages._Page(html).first(pages.Find(tag="h1")) is not None
    assert time.time() - start < 5
