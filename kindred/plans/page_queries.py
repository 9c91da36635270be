"""Page extraction over the whole page table.

The table's pages are not the shops' pages, so these queries hand other selectors to
the same extractors; the shops' own selectors are tested on fixtures.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions import fields
from kindred.plans.adapters import table
from kindred.plans.registry import query
from kindred.sources import pages
from kindred.sources.pages import Field, Find

ROOT = "https://shop.example"


def _decoded(sql: str) -> str:
    for entity, character in (("&quot;", '"'), ("&amp;", "&"), ("&amp", "&")):
        sql = f"replace({sql}, '{entity}', '{character}')"
    return f"trim({sql})"


TITLE_SQL = _decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")
HEAD_SQL = _decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")
NAV_SQL = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
LABELS_SQL = f"""list_filter(list_transform(regexp_extract_all({NAV_SQL}, '>([^<>]+)<', 1),
  lambda x: {_decoded("x")}), lambda x: x <> '')"""

TITLE = Field("title", (Find(tag="title"),))
HEAD = Field("heading", (Find(tag="h1"),), inner=Find(tag="span"))
LANG = Field("lang", (Find(tag="html"),), attribute="lang", only_attribute=True)
NAV = Field("links", (Find(tag="nav"),), joiner=", ")


@query("page_detail", f"""
SELECT page_id, url, {TITLE_SQL} AS title, {HEAD_SQL} AS heading,
       regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""")
def page_detail(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"), (TITLE, HEAD, LANG)).drop("page_error")


@query("page_detail_joined_text", f"""
SELECT page_id, coalesce(array_to_string({LABELS_SQL}, ', '), '') AS links FROM pages""")
def page_detail_joined_text(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"), (NAV,)).select("page_id", "links")


LINKS_SQL = f"""
SELECT page_id, unnest(regexp_extract_all({NAV_SQL}, '<a href="([^"]*)">[^<]*</a>', 1)) AS href,
       unnest(regexp_extract_all({NAV_SQL}, '<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages"""


@query("page_cards", f"""
SELECT page_id, {_decoded("label")} AS label, '{ROOT}' || {_decoded("href")} AS url FROM ({LINKS_SQL})""")
def page_cards(spark, sf_dir):
    cards = pages.extract(
        table(spark, sf_dir, "pages").select("page_id", "html"),
        (Field("label", ()), Field("href", (), attribute="href", only_attribute=True)),
        each=Find(tag="a"), within=Find(tag="nav"))
    return cards.select("page_id", "label", F.concat(F.lit(ROOT), "href").alias("url"))


@query("page_tiles", f"""
SELECT page_id, nullif({_decoded("label")}, '') AS name, '{ROOT}' || {_decoded("href")} AS product_url
FROM ({LINKS_SQL}) WHERE href <> '' AND NOT regexp_matches(href, 'cart|wishlist|shoppinglist')""")
def page_tiles(spark, sf_dir):
    tiles = pages.extract(
        table(spark, sf_dir, "pages").select("page_id", "html"),
        (Field("gtin", (), attribute="data-gtin", only_attribute=True),
         Field("name", (), joiner="\n"),
         Field("hrefs", (Find(tag="a"),), attribute="href", only_attribute=True, every=True)),
        each=Find(tag="li"), within=Find(tag="nav"))
    url = fields.first_link(F.col("hrefs"), ROOT)
    return tiles.withColumn("product_url", url).filter(
        (F.coalesce("gtin", F.lit("")) != "") | F.col("product_url").isNotNull()
    ).select("page_id", F.nullif("name", F.lit("")).alias("name"), "product_url")


@query("page_first_link", f"""
SELECT page_id, CASE WHEN href LIKE 'http%' THEN href ELSE '{ROOT}' || href END AS link FROM (
  SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: {_decoded("x")}),
    lambda x: x <> '' AND NOT regexp_matches(x, 'cart|wishlist|shoppinglist'))[1] AS href FROM pages)""")
def page_first_link(spark, sf_dir):
    hrefs = pages.attribute_values(F.col("html"), "href", tag="a")
    return table(spark, sf_dir, "pages").select(
        "page_id", fields.first_link(hrefs, ROOT).alias("link"))


def _image_markup(page):
    """Four ways in which an image stands before the rest of a page."""
    number = page.cast("string")
    forms = (
        ('<!-- <img src="old.jpg"> --><img data-src="lazy.jpg" src="real-', '.jpg">'),
        ("<img src='' data-src='lazy-", ".jpg'>"),
        ("<img alt='src=\"no.jpg\"' src=plain-", ".jpg>"),
        ("<script>var x = '<img src=\"no.jpg\">';</script><IMG SRC = \"a.jpg?x=1&amp;y=", '">'))
    return F.element_at(F.array(*[F.concat(F.lit(x), number, F.lit(y)) for x, y in forms]), (page % 4 + 1).cast("int"))


@query("page_image", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'real-' || page_id || '.jpg' WHEN 1 THEN 'lazy-' || page_id || '.jpg'
  WHEN 2 THEN 'plain-' || page_id || '.jpg' ELSE 'a.jpg?x=1&y=' || page_id END AS image
FROM pages WHERE html IS NOT NULL""")
def page_image(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").filter("html IS NOT NULL")
    rows = rows.withColumn("html", F.concat(_image_markup(F.col("page_id")), "html"))

    def first(attr):
        return F.get(pages.attribute_values(F.col("html"), attr, tag="img"), 0)
    return rows.select("page_id", fields.first_filled(first("src"), first("data-src")).alias("image"))


@query("page_own_image", f"""
SELECT page_id, nullif(coalesce({_decoded("regexp_extract(html, '<a href=\"([^\"]*)\"', 1)")}, ''), '') AS image,
       len(regexp_extract_all(html, '<a href="[^"]')) AS images FROM pages""")
def page_own_image(spark, sf_dir):
    """The first image of each page where its links stand as images: every value is the page's own."""
    lazy = F.col("page_id") % 2 == 0
    html = F.replace(F.col("html"), F.lit('<a href="'), F.when(lazy, "<img src='' data-src=\"").otherwise('<img src="'))
    sources = {attr: pages.attribute_values(F.col("html"), attr, tag="img") for attr in ("src", "data-src")}
    images = {attr: F.get(values, 0) for attr, values in sources.items()}
    return table(spark, sf_dir, "pages").withColumn("html", html).select(
        "page_id", fields.first_filled(images["src"], images["data-src"]).alias("image"),
        (F.size(sources["src"]) + F.size(sources["data-src"])).cast("long").alias("images"))


@query("attr_inventory", f"""
SELECT value, count(*) AS uses FROM (
  SELECT unnest(regexp_extract_all(html, '<[a-z0-9]+ (?:[a-z-]+="[^"]*" )*class="([^"]+)"', 1)) AS value FROM pages)
GROUP BY 1""")
def attr_inventory(spark, sf_dir):
    return pages.attribute_inventory(table(spark, sf_dir, "pages"), "class")


@query("url_worklist", """
SELECT trim(url) AS url FROM (
  SELECT CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 13 = 0 THEN '  '
         ELSE ' ' || url || ' ' END AS url FROM pages) WHERE trim(url) <> ''""")
def url_worklist(spark, sf_dir):
    page = F.col("page_id")
    raw = table(spark, sf_dir, "pages").select(
        F.when(page % 11 == 0, F.lit(None).cast("string")).when(page % 13 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), "url", F.lit(" "))).alias("url"))
    return pages.work_list(raw, "url")


#: Markup that the parser refuses.
REFUSED = "<![odd]>"


@query("extract_outcome", f"""
SELECT ok, failed, count(*) AS rows FROM (
  SELECT page_id % 7 = 0 AS failed, page_id % 7 <> 0 AND (
         (regexp_extract(html, 'class="ad">([^<]*)<', 1) <> '' AND page_id % 2 = 0)
         OR (page_id % 3 = 0 AND {HEAD_SQL} <> '')) AS ok FROM pages) GROUP BY 1, 2""")
def extract_outcome(spark, sf_dir):
    page = F.col("page_id")
    html = F.when(page % 7 == 0, F.concat(F.lit(REFUSED), "html")).otherwise(F.col("html"))
    raw = pages.extract(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), (
        Field("ad", (Find(tag="div", attr="class", value="ad", how="word"),)), HEAD))
    records = raw.select(
        F.when(page % 2 == 0, F.col("ad")).otherwise("").alias("brand"),
        F.when(page % 3 == 0, F.col("heading")).otherwise("").alias("product_name"),
        F.lit("").alias("ingredients"), "page_error")
    return pages.outcome(records).groupBy("ok", "failed").agg(F.count(F.lit(1)).alias("rows"))
