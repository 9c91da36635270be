"""Scalar clean-up of scraped fields: prices, ratings, names, links, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions.text import DIGIT, SPACE, SPACE_CHARACTERS, strip, unicode_classes

# The shapes of price, rating and review texts.
PRICE = r"(\d+[,.]\d+)"
GROUPED_PRICE = r"(\d{1,3}(?:\.\d{3})+,\d+|\d+[,.]\d+)"
PRICE_WITH_CURRENCY = r"(\d+[.,]\d+\s*€)"
RATING = r"(\d[.,]\d)\s*von\s*5"
REVIEWS = r"bei\s*(\d+)\s*Bewertung"
#: White space with a line break in it, then a bracket that begins with a number. Tried
#: only where white space begins.
REVIEWS_BEGIN = rf"(?<!{SPACE})(?={SPACE.replace(chr(92) + 'n', '')}*+\n){SPACE}++\(\d[\s\S]*\z"
SKIPPED_LINKS = ("cart", "wishlist", "shoppinglist")


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, unicode_classes(pattern), 1), F.lit(""))


def parse_price(text: Column, grouped: bool = False) -> Column:
    """First decimal number of a price text as float32; none gives null.

    By default ``1.234,56`` reads as 1.234, as the figures in use do; ``grouped``
    reads the dot as a thousands mark instead.
    """
    found = _first(text, GROUPED_PRICE if grouped else PRICE)
    if grouped:
        found = F.when(found.contains(",") & found.contains("."),
                       F.replace(found, F.lit("."), F.lit(""))).otherwise(found)
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double").cast("float")


def fallback_price(price: Column, box_text: Column) -> Column:
    """The price element's text, else the first amount in the surrounding box."""
    return F.coalesce(price, _first(box_text, PRICE_WITH_CURRENCY), F.lit(""))


def rating(source: Column) -> Column:
    return F.replace(_first(source, RATING), F.lit(","), F.lit("."))


def review_count(source: Column) -> Column:
    return _first(source, REVIEWS)


def clean_name(raw: Column, brand: Column) -> Column:
    """Name without leading brand and trailing review count; empty gives null."""
    raw = F.coalesce(raw, F.lit(""))
    named = F.coalesce(brand, F.lit("")) != ""
    bare = F.when(named & F.startswith(raw, brand),
                  strip(F.substring(raw, F.length(brand) + 1, F.length(raw)))).otherwise(raw)
    return F.nullif(strip(_without_reviews(F.rtrim(bare, F.lit(SPACE_CHARACTERS)))), F.lit(""))


def _without_reviews(text: Column) -> Column:
    """Cut a review count in brackets on a line of its own from the end of ``text``.

    It can only begin after the last bracket that closes before the one at the end, so
    one pass over what stands there finds it.
    """
    body = F.left(text, F.length(text) - 1)
    last = F.substring_index(body, ")", -1)
    before = F.left(body, F.length(body) - F.length(last))
    cut = F.regexp_replace(last, REVIEWS_BEGIN.replace(r"\d", DIGIT).replace(r"[\s\S]", "(?s:.)"), "")
    return F.when(F.endswith(text, F.lit(")")) & (F.length(cut) < F.length(last)), F.concat(before, cut)).otherwise(text)


def absolute_url(href: Column, root: Column | str) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(root, href))


def first_link(hrefs: Column, root: Column | str, skipped: Sequence[str] = SKIPPED_LINKS) -> Column:
    """First non-empty link that leads to none of the ``skipped`` places."""
    def eligible(href: Column) -> Column:
        ok = href != ""
        for word in skipped:
            ok = ok & ~F.contains(href, F.lit(word))
        return ok
    return absolute_url(F.get(F.filter(hrefs, eligible), 0), root)


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty (``src``, else ``data-src``)."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def match_percent(similarity: Column) -> Column:
    """Whole percent, cut off rather than rounded."""
    return (similarity.cast("double") * 100).cast("int")


def price_label(price: Column, missing: str) -> Column:
    """Two decimals with the currency sign; null or 0 is ``missing``."""
    known = F.coalesce(price, F.lit(0)) != 0
    return F.when(known, F.concat(F.lit("€"), F.format_string("%.2f", price.cast("double")))
                  ).otherwise(F.lit(missing))
