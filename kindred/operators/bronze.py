"""Bronze records to silver rows: one row per product, ingredient and position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.fields import parse_price
from kindred.functions.text import SYNONYMS, flatten_lines, ingredient_array
from kindred.operators.balance import balance
from kindred.session import materialise

#: Copies of one record expanded by a single task at most.
COPIES_PER_TASK = 10_000
#: So many repeated contents (two hashes and a number each) are looked up where the texts are read;
#: more are joined, which shuffles the texts.
LOOKED_UP = 1_000_000


def project_trim(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``names``: new name → column. Trims blanks (U+0020 only)."""
    return df.select(*[F.trim(F.col(old)).alias(new) for new, old in names.items()])


def with_key(df: DataFrame, key: str = "url") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def has_text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.trim(column), F.lit("")) != ""


def with_text(df: DataFrame, column: str = "ingredients_raw", observation=None) -> DataFrame:
    """Rows whose text is neither null nor blank. The dropped rows are counted by the
    same job through ``observation``."""
    if observation is not None:
        df = df.observe(observation, F.count_if(~has_text(column)).alias("dropped"),
                        F.count(F.lit(1)).alias("rows"))
    return df.filter(has_text(column))


def flatten_text(df: DataFrame) -> DataFrame:
    """Line feeds to blanks and both ends stripped in every string column."""
    return df.select(*[
        flatten_lines(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name) for f in df.schema
    ])


def join_products(products: DataFrame, ingredients: DataFrame, key: str = "url") -> DataFrame:
    """Many-to-many inner join. Left unhinted: broadcast is chosen only for a side of
    measured small size, a hot key is split by the skew-join rule."""
    return products.join(ingredients, key, "inner")


def content_key(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes that are equal for equal contents, and for others but by chance (2^-128)."""
    marked = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*marked).alias("_k1"), F.xxhash64(F.lit("second"), *reversed(marked)).alias("_k2")


def copy_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """_k1, _k2, copies: how often each content occurs."""
    return df.select(*content_key(list(columns or df.columns))).groupBy("_k1", "_k2").agg(
        F.count(F.lit(1)).alias("copies"))


def add_stable_id(df: DataFrame, source: str | Column, key: str = "url", columns: Sequence[str] | None = None,
                  earlier: DataFrame | None = None) -> DataFrame:
    """``product_id`` from source, key, content and the number of the copy.

    The same rows get the same ids in any run and partitioning. Rows are written once with
    two hashes of their content, by which contents are counted, so no text is shuffled to
    find out that it has no copy: such rows get their id where they are read (a plan made before the repeated contents
    are counted would shuffle them, so these are written first). Only contents that do repeat are grouped as such
    (one partial row per map task, however many copies there are), then spread again
    in slices, so no task expands an unbounded group. ``earlier`` (``copy_counts`` of
    rows that came before) lets the numbers go on from there.
    """
    columns = list(columns or df.columns)
    source = F.lit(source) if isinstance(source, str) else source
    k1, k2 = content_key(columns)
    keyed = materialise(df.select(*columns, k1, k2), "keyed", codec="zstd")
    counts = keyed.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("copies"))
    if earlier is None:
        again = counts.filter("copies > 1").select("_k1", "_k2", F.lit(0).cast("bigint").alias("_before"))
    else:
        known = earlier.groupBy("_k1", "_k2").agg(F.sum("copies").alias("_before"))
        again = counts.join(known, ["_k1", "_k2"], "left").filter("copies > 1 OR _before IS NOT NULL").select(
            "_k1", "_k2", F.coalesce("_before", F.lit(0)).alias("_before"))
    again = materialise(again, "again")
    again = F.broadcast(again) if again.count() <= LOOKED_UP else again
    one = keyed.join(again, ["_k1", "_k2"], "left_anti").select(*columns, F.lit(1).cast("bigint").alias("_copy"))
    many = keyed.join(again, ["_k1", "_k2"]).groupBy("_k1", "_k2").agg(
        F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_copies"),
        F.first("_before").alias("_before")).select("_k1", "_row.*", "_copies", "_before")
    step = F.lit(COPIES_PER_TASK).cast("bigint")
    slices = many.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), step)))
    spread = (
        slices.repartition("_k1", "_from")
        .withColumn("_copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("_copies"), F.col("_from") + step - 1))))
        .select(*columns, (F.col("_copy") + F.col("_before")).alias("_copy")))
    content = F.concat_ws("\x1f", *[
        F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    identity = F.concat_ws("\x1f", source, content, F.col("_copy").cast("string"))
    return one.unionByName(spread).withColumn("product_id", F.sha2(identity, 256)).drop("_copy")


def add_running_id(df: DataFrame, source: str) -> DataFrame:
    """Cheap ids, unique within a run only (no shuffle)."""
    return df.withColumn("product_id", F.concat_ws(
        "_", F.lit(source), F.monotonically_increasing_id().cast("string")))


def explode_ingredients(df: DataFrame, text: str = "ingredients_raw",
                        synonyms: Mapping[str, str] = SYNONYMS) -> DataFrame:
    """One row per kept ingredient with its position from 1; none gives no row. Cleaning costs
    by the byte: ``balance`` deals rows of a few large tasks by their bytes beforehand."""
    names = [c for c in df.columns if c != text]
    return df.select(*names, F.posexplode(
        ingredient_array(F.col(text), synonyms)).alias("position", "ingredient")
    ).withColumn("position", F.col("position") + 1)


def to_silver(listings: DataFrame, source: str, stable_ids: bool = True,
              optional: Sequence[str] = (), observation=None, earlier: DataFrame | None = None) -> DataFrame:
    """``listings``: url, brand, product_name, price_eur, ingredients_raw. ``earlier``: see ``add_stable_id``."""
    kept = balance(with_text(with_key(listings), observation=observation), "ingredients_raw")
    keyed = add_stable_id(kept, source, earlier=earlier) if stable_ids else add_running_id(kept, source)
    return explode_ingredients(keyed.withColumn("source", F.lit(source))).select(
        "product_id", "source", "brand", "product_name", "price_eur", "url",
        "ingredient", "position", *optional)


def listings_a(listing: DataFrame, ingredients: DataFrame) -> DataFrame:
    products = with_key(listing.select(
        F.trim("url").alias("url"), F.trim("brand").alias("brand"),
        F.trim("series").alias("product_name"), parse_price(F.col("price")).alias("price_eur")))
    texts = with_key(project_trim(ingredients, {"url": "url", "ingredients_raw": "ingredients"}))
    return join_products(products, texts)


def listings_b(merged: DataFrame, with_ratings: bool = False) -> DataFrame:
    """Ratings are carried only when asked for; the silver table has no use for them."""
    columns = [
        F.trim("product_url").alias("url"), F.trim("brand").alias("brand"),
        F.trim("product_name").alias("product_name"),
        parse_price(F.col("price")).alias("price_eur"),
        F.trim("ingredients").alias("ingredients_raw"),
    ]
    if with_ratings:
        columns += [F.col("rating_search").try_cast("float").alias("rating"),
                    F.col("review_count_search").alias("review_count")]
    return with_key(merged.select(*columns))


def union_sources(*silver: DataFrame) -> DataFrame:
    """Bag union by column name."""
    first, *rest = silver
    for other in rest:
        first = first.unionByName(other)
    return first
