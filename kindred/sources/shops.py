"""The two shops' pages as bronze records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import fields as fn
from kindred.sources import page_specs as specs
from kindred.sources.pages import extract


def _missing_to_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in names})


def detail_b(pages: DataFrame) -> DataFrame:
    """url, html → the detail record of shop B; missing text is empty."""
    source = F.col("rating_source")
    return extract(pages, specs.DETAIL_B).select(
        "url", "brand", "product_name",
        fn.fallback_price(F.col("price_text"), F.col("box_text")).alias("price"), "base_price",
        F.coalesce(fn.rating(source), F.lit("")).alias("rating"),
        F.coalesce(fn.review_count(source), F.lit("")).alias("review_count"), "ingredients", "page_error",
    )


def detail_a(pages: DataFrame) -> DataFrame:
    return extract(pages, specs.DETAIL_A).select("url", "brand", "product_name", "ingredients", "page_error")


def cards_a(pages: DataFrame, root: str) -> DataFrame:
    """url, html → one row per card of the product section, links made absolute. A page
    that cannot be read is one row with ``page_error`` and no link."""
    cards = extract(pages.select("html"), specs.CARD_FIELDS_A, each=specs.CARD_A, within=specs.SECTION_A)
    return cards.select("brand", "series", "product_type", "price", "uvp_price", "base_price",
                        F.when(F.col("page_error").isNull(), F.concat(F.lit(root), F.coalesce("href", F.lit("")))).alias("url"),
                        "page_error")


def tiles_b(pages: DataFrame, root: str) -> DataFrame:
    """subcategory, html → one row per tile; a tile with neither number nor link is
    dropped, missing values are null. A page that cannot be read is one row with
    ``page_error``."""
    raw = extract(pages.select("subcategory", "html"), specs.TILE_FIELDS_B, each=specs.TILE_B)
    raw = _missing_to_null(raw, ["gtin", "dan", "brand", "price", "base_price", "availability"])
    source = F.col("rating_source")
    return raw.select(
        "subcategory", "brand", fn.clean_name(F.col("raw_name"), F.col("brand")).alias("name"),
        "price", "base_price", fn.rating(source).alias("rating"),
        fn.review_count(source).alias("review_count"), "availability", "gtin", "dan",
        fn.first_link(F.col("hrefs"), root).alias("product_url"),
        fn.first_filled(F.col("image_src"), F.col("image_data_src")).alias("image_url"), "page_error",
    ).filter(F.col("gtin").isNotNull() | F.col("product_url").isNotNull() | F.col("page_error").isNotNull())
