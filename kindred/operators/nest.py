"""Gold rows (one per match) to serving items (one per product) and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import schemas
from kindred.operators.match import brand_key
from kindred.session import materialise


def first_per_product(silver: DataFrame) -> DataFrame:
    """Metadata of each product, read from its first row. ``min_by`` keeps one partial
    row per map task, so a product of any length is safe."""
    names = ["brand", "product_name", "price_eur", "source", "url"]
    return (
        silver.filter(F.col("product_id").isNotNull()).groupBy("product_id")
        .agg(F.min_by(F.struct(*names), F.coalesce("position", F.lit(999))).alias("m"))
        .select("product_id", *[F.col(f"m.{n}").alias(n) for n in names])
    )


def with_numbers(products: DataFrame) -> DataFrame:
    """``products`` (``product_id`` unique) with ``number``, in the order of the ids, written: eight bytes stand for
    an id of any length and keep its place in ties."""
    ordered = products.repartitionByRange("product_id").sortWithinPartitions("product_id")
    return materialise(ordered.withColumn("number", F.monotonically_increasing_id()), "numbered", codec="zstd")


def attach_attributes(ranked: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """The two attribute look-ups, after ranking: only the top rows carry text. The query
    comes last and by the type of its id in gold, so that its rows stay together for nesting.
    ``key``: the column of ``products`` whose values ``ranked`` has for ids."""
    types = {f.name: f.dataType for f in schemas.GOLD}
    by_id = key == "product_id"
    on = {p: f"{p}_id" if by_id else f"{p}_key" for p in ("match", "query")}

    def side(prefix: str) -> DataFrame:
        return products.select(
            *([] if by_id else [F.col(key).alias(on[prefix])]),
            F.col("product_id").cast(types[f"{prefix}_id"]).alias(f"{prefix}_id"),
            F.col("product_name").alias(f"{prefix}_product_name"),
            F.col("brand").alias(f"{prefix}_brand"),
            F.col("price_eur").cast("double").alias(f"{prefix}_price_eur"),
            F.col("url").alias(f"{prefix}_url"))

    return (
        ranked.select(*[(F.col(f"{p}_id").cast(types[f"{p}_id"]) if by_id else F.col(f"{p}_id")).alias(on[p]) for p in on],
                      "similarity", "rank")
        .join(side("match"), on["match"]).join(side("query"), on["query"])
        .withColumn("cosine_similarity", F.round("similarity", 4))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.GOLD])
    )


def money(value: Column | str) -> Column:
    """Exact decimal with four places; null, NaN and the infinite become null."""
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast(schemas.MONEY)


def text_or_nan(value: Column | str) -> Column:
    """Items hold no missing strings: they become the text ``nan``."""
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("nan"))


def _match_struct() -> Column:
    return F.struct(
        F.col("rank").cast("int").alias("rank"),
        text_or_nan("match_product_name").alias("product_name"),
        text_or_nan("match_brand").alias("brand"),
        money("match_price_eur").alias("price_eur"),
        text_or_nan("match_url").alias("url"),
        money("cosine_similarity").alias("cosine_similarity"),
    )


def _header() -> Column:
    return F.struct(
        text_or_nan("query_product_name").alias("product_name"),
        text_or_nan("query_brand").alias("brand"),
        money("query_price_eur").alias("price_eur"),
        text_or_nan("query_url").alias("url"),
    )


def nest_matches(gold: DataFrame) -> DataFrame:
    """One item per query product with its matches sorted by rank.

    Items are keyed by product id, so a list never holds more than the top n.
    """
    ranked = F.struct(F.col("rank").cast("int").alias("rank"), _match_struct().alias("match"))
    return (
        gold.groupBy(F.col("query_id").alias("item_key"))
        .agg(F.min_by(_header(), "rank").alias("h"),
             F.sort_array(F.collect_list(ranked)).alias("m"))
        .select("item_key", "h.*", F.transform("m", lambda x: x["match"]).alias("top_matches"))
    )


def matches_by_name(gold: DataFrame) -> DataFrame:
    """The same items keyed by product name, in long form (one row per match).

    Products of one name share the header of the first of them. Any number of
    products may share a name, so their matches stay rows and are not gathered.
    """
    named = gold.filter(F.col("query_product_name").isNotNull())
    first = F.struct("query_id", "rank")
    headers = named.groupBy(F.col("query_product_name").alias("item_key")).agg(
        F.min_by(_header(), first).alias("h"))
    rows = named.select(F.col("query_product_name").alias("item_key"), F.inline(
        F.array(_match_struct())).alias("rank", "match_product_name", "match_brand",
                                        "match_price_eur", "match_url", "cosine_similarity"))
    return rows.join(headers, "item_key").select(
        "item_key", F.col("h.brand").alias("query_brand"),
        F.col("h.price_eur").alias("query_price_eur"), F.col("h.url").alias("query_url"),
        "rank", "match_product_name", "match_brand", "match_price_eur", "match_url",
        "cosine_similarity")


def flat_items(items: DataFrame) -> DataFrame:
    """One row per item and match; items without matches drop out."""
    return items.select(
        "item_key", F.col("product_name").alias("query_product_name"),
        F.col("brand").alias("query_brand"), F.col("price_eur").alias("query_price_eur"),
        F.col("url").alias("query_url"), F.posexplode("top_matches").alias("place", "x"),
    ).select(
        "item_key", "query_product_name", "query_brand", "query_price_eur", "query_url",
        (F.col("place") + 1).alias("place"), F.col("x.rank").alias("rank"),
        F.col("x.product_name").alias("match_product_name"),
        F.col("x.brand").alias("match_brand"), F.col("x.price_eur").alias("match_price_eur"),
        F.col("x.url").alias("match_url"), F.col("x.cosine_similarity").alias("cosine_similarity"))


def floats(items: DataFrame) -> DataFrame:
    """Items with all decimals, nested ones too, as doubles."""
    return items.withColumn("price_eur", F.col("price_eur").cast("double")).withColumn(
        "top_matches", F.transform("top_matches", lambda m: m.withField(
            "price_eur", m["price_eur"].cast("double")).withField(
            "cosine_similarity", m["cosine_similarity"].cast("double"))))


def sides(products: DataFrame, query_source: str, match_source: str) -> DataFrame:
    """product_id, side, brand of the products of the two sources to be matched."""
    return products.filter(F.col("source").isin(query_source, match_source)).select(
        "product_id", F.when(F.col("source") == query_source, "query").otherwise("match")
        .alias("side"), "brand")


def gold_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.avg(F.when(F.col("rank") == 1, F.col("cosine_similarity"))).alias("avg_rank1"),
        F.count_distinct("query_product_name").alias("matched_products"),
        F.count(F.lit(1)).alias("match_rows"))


def same_brand_rows(gold: DataFrame) -> DataFrame:
    """Gold rows that break the brand rule (none, unless the table was edited)."""
    return gold.filter(brand_key("query_brand") == brand_key("match_brand"))
