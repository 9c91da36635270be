"""Column layouts of every stage."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LISTING_A = _strings("brand", "series", "product_type", "price", "uvp_price", "base_price", "url")
INGREDIENTS_A = _strings("url", "brand", "product_name", "ingredients")
LISTING_B = _strings(
    "subcategory", "brand", "name", "price", "base_price", "rating", "review_count",
    "availability", "gtin", "dan", "product_url", "image_url",
)
DETAIL_B = _strings(
    "url", "brand", "product_name", "price", "base_price", "rating", "review_count", "ingredients",
)
MERGED_B = _strings(
    "product_url", "brand", "product_name", "price", "ingredients",
    "rating_search", "review_count_search",
)

SILVER = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("price_eur", T.FloatType()),
    T.StructField("url", T.StringType()),
    T.StructField("ingredient", T.StringType()),
    T.StructField("position", T.IntegerType()),
])

GOLD = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query_product_name", T.StringType()),
    T.StructField("query_brand", T.StringType()),
    T.StructField("query_price_eur", T.DoubleType()),
    T.StructField("query_url", T.StringType()),
    T.StructField("match_id", T.StringType()),
    T.StructField("match_product_name", T.StringType()),
    T.StructField("match_brand", T.StringType()),
    T.StructField("match_price_eur", T.DoubleType()),
    T.StructField("match_url", T.StringType()),
    T.StructField("cosine_similarity", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
])

MONEY = T.DecimalType(12, 4)

MATCH = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price_eur", MONEY),
    T.StructField("url", T.StringType()),
    T.StructField("cosine_similarity", MONEY),
])

SERVING = T.StructType([
    T.StructField("item_key", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price_eur", MONEY),
    T.StructField("url", T.StringType()),
    T.StructField("top_matches", T.ArrayType(MATCH)),
])
