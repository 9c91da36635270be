"""Where the two shops' pages hold each field.

Selectors are data; another shop needs another specification, not other code.
"""

from kindred.sources.pages import Field, Find

DMID = "data-dmid"
QA = "data-qa-block"


def _dmid(value: str, tag: str | None = None) -> Find:
    return Find(tag=tag, attr=DMID, value=value)


def _qa(value: str, tag: str | None = None) -> Find:
    return Find(tag=tag, attr=QA, value=value)


DETAIL_B = (
    Field("brand", (_dmid("product-brand"),)),
    Field("product_name", (_dmid("detail-page-headline-product-title", "h1"),),
          inner=Find(tag="span")),
    Field("price_text", (_dmid("price-localized"),), missing=None),
    Field("box_text", (_dmid("buybox"),), strip=False),
    Field("base_price", (_dmid("price-infos"),)),
    Field("ingredients", (_dmid("Inhaltsstoffe-content"),), joiner=" ",
          inner=Find(tag="div", attr="class", value="whitespace-pre-line", how="contains")),
    Field("rating_source", (_dmid("product-tile-rating"),), attribute="aria-label", strip=False,
          otherwise=(_dmid("product-rating"),)),
)

INGREDIENT_BLOCK_A = "764163da-b008-4e51-ae78-632f8fd81dbf"
HEADLINE_A = Find(tag="h1", attr="data-nc", value="typography-next")

DETAIL_A = (
    Field("brand", (HEADLINE_A, _qa("product_brand_name", "a")),
          otherwise_first=Find(tag="h1")),
    Field("product_name", (HEADLINE_A, _qa("product_name", "span")),
          otherwise_first=Find(tag="h1")),
    Field("ingredients", (
        Find(tag="div", attr="id", value=INGREDIENT_BLOCK_A),
        Find(tag="span", attr="class", value="pdp-product-info-details", how="word"),
    ), joiner=", "),
)

SECTION_A = Find(tag="div", attr=QA, value="product-section")
CARD_A = Find(tag="a", attr="data-nc", value="card")
CARD_FIELDS_A = (
    Field("brand", (_qa("product_brand"),)),
    Field("series", (_qa("product_series"),)),
    Field("product_type", (_qa("product_type"),)),
    Field("price", (_qa("product_price"),)),
    Field("uvp_price", (_qa("product_rrpprice"),)),
    Field("base_price", (_qa("product_baseprice"),)),
    Field("href", (), attribute="href", only_attribute=True),
)

TILE_B = _dmid("product-tile")
TILE_FIELDS_B = (
    Field("gtin", (), attribute="data-gtin", only_attribute=True),
    Field("dan", (), attribute="data-dan", only_attribute=True),
    Field("brand", (_dmid("product-brand"),), joiner="\n"),
    Field("raw_name", (_dmid("product-description"),), joiner="\n"),
    Field("price", (_dmid("price-localized"),), joiner="\n"),
    Field("base_price", (_dmid("price-infos"),), joiner="\n"),
    Field("rating_source", (_dmid("product-tile-rating"),), attribute="aria-label"),
    Field("availability", (_dmid("overview-availability-container"),), joiner="\n"),
    Field("hrefs", (Find(tag="a"),), attribute="href", only_attribute=True, every=True),
    Field("image_src", (_dmid("product-image-container"), Find(tag="img")), attribute="src",
          only_attribute=True, otherwise=(Find(tag="img"),)),
    Field("image_data_src", (_dmid("product-image-container"), Find(tag="img")),
          attribute="data-src", only_attribute=True, otherwise=(Find(tag="img"),)),
)
