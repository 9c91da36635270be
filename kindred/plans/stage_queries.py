"""Scans, sinks, bronze steps, profiles and checks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred import schemas
from kindred.operators import bronze, nest, profile, quality, weigh
from kindred.plans.adapters import (
    GOLD_SQL, PRODUCTS_SQL, WEIGHTS_SQL, document_listings, order_gold, order_items,
    order_rows, table, with_lines,
)
from kindred.plans.registry import query
from kindred.plans.text_queries import STAGES_SQL
from kindred.session import fresh_path, materialise
from kindred.sources import tables
from kindred.streaming import arrivals, increments

# --- scans and sinks ---------------------------------------------------------


@query("scan_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = fresh_path(spark, "bronze")
    tables.write_bronze(part, path, sep=";")
    back = tables.read_bronze(spark, path, sep=";", columns=part.columns)
    return back.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in part.schema])


def _silver(spark, sf_dir):
    products = with_lines(spark, sf_dir)
    rows = weigh.cells(order_rows(spark, sf_dir))
    return rows.join(products, "product_id").select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SILVER])


SILVER_SQL = "WITH " + PRODUCTS_SQL + "," + WEIGHTS_SQL + """,
silver AS (
  SELECT CAST(product_id AS VARCHAR) AS product_id, source, brand, product_name,
         CAST(CAST(price_eur AS FLOAT) AS DOUBLE) AS price_eur, url,
         CAST(ingredient AS VARCHAR) AS ingredient, CAST(position AS INTEGER) AS position
  FROM cells JOIN products USING (product_id))
"""


@query("scan_silver", SILVER_SQL + "SELECT * FROM silver")
def scan_silver(spark, sf_dir):
    path = fresh_path(spark, "silver")
    tables.write_silver(_silver(spark, sf_dir), path)
    return tables.read_silver(spark, path).withColumn("price_eur", F.col("price_eur").cast("double"))


@query("sink_silver", SILVER_SQL + """
SELECT source, count(*) AS rows, count(DISTINCT product_id) AS distinct_product_id
FROM silver GROUP BY 1""")
def sink_silver(spark, sf_dir):
    path = fresh_path(spark, "silver-csv")
    tables.export_csv(_silver(spark, sf_dir), path)
    return tables.read_silver_csv(spark, path).groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("product_id").alias("distinct_product_id"))


@query("sink_gold", GOLD_SQL + """
SELECT CAST(query_id AS VARCHAR) AS query_id, CAST(match_id AS VARCHAR) AS match_id,
       cosine_similarity, rank FROM gold""")
def sink_gold(spark, sf_dir):
    path = fresh_path(spark, "gold-csv")
    tables.write_gold(order_gold(spark, sf_dir), path, fmt="csv")
    return tables.read_gold_csv(spark, path).select(
        "query_id", "match_id", "cosine_similarity", "rank")


@query("scan_gold_cast", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS query_price_eur,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 3 + 1 AS INTEGER) END AS rank
FROM orders""")
def scan_gold_cast(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        key, F.when(key % 5 == 0, F.lit("auf Anfrage")).otherwise(
            F.col("o_totalprice").cast("string")).alias("query_price_eur"),
        F.when(key % 7 == 0, F.lit("n/a")).otherwise(
            (F.col("o_custkey") % 3 + 1).cast("string")).alias("rank"))
    text = [f.name for f in schemas.GOLD if f.name not in ("query_price_eur", "rank", "query_id")]
    gold = raw.select(key.cast("string").alias("query_id"), "query_price_eur", "rank",
                      *[F.lit(None).cast("string").alias(c) for c in text])
    return tables.coerce_gold(gold).select(
        F.col("query_id").cast("bigint").alias("o_orderkey"), "query_price_eur", "rank")


FLAT_SQL = """
SELECT CAST(query_id AS VARCHAR) AS item_key, coalesce(query_brand, 'nan') AS query_brand,
       query_price_eur, rank, coalesce(match_product_name, 'nan') AS match_product_name,
       match_price_eur, cosine_similarity FROM gold"""


def _flat(items):
    return nest.flat_items(items).select(
        "item_key", "query_brand", F.col("query_price_eur").cast("double").alias("query_price_eur"),
        "rank", "match_product_name", F.col("match_price_eur").cast("double").alias("match_price_eur"),
        F.col("cosine_similarity").cast("double").alias("cosine_similarity"))


@query("sink_serving", GOLD_SQL + FLAT_SQL)
def sink_serving(spark, sf_dir):
    path = fresh_path(spark, "serving")
    tables.write_serving(order_items(spark, sf_dir), path)
    return _flat(tables.read_serving(spark, path))


@query("nest_matches", GOLD_SQL + FLAT_SQL)
def nest_matches(spark, sf_dir):
    return _flat(order_items(spark, sf_dir))


@query("nest_by_name", GOLD_SQL + """,
heads AS (
  SELECT query_product_name AS item_key, query_url FROM (
    SELECT *, row_number() OVER (PARTITION BY query_product_name
             ORDER BY CAST(query_id AS VARCHAR), rank) AS r FROM gold) WHERE r = 1)
SELECT item_key, heads.query_url, rank, match_product_name, cosine_similarity
FROM gold JOIN heads ON item_key = query_product_name""")
def nest_by_name(spark, sf_dir):
    return nest.matches_by_name(materialise(order_gold(spark, sf_dir), "gold")).select(
        "item_key", "query_url", "rank", "match_product_name",
        F.col("cosine_similarity").cast("double").alias("cosine_similarity"))


@query("decimal_cast", GOLD_SQL + """
SELECT CAST(query_id AS VARCHAR) AS item_key, query_price_eur AS price_eur,
       round(sum(match_price_eur), 4) AS match_prices, round(sum(cosine_similarity), 4) AS similarities
FROM gold GROUP BY 1, 2""")
def decimal_cast(spark, sf_dir):
    def total(field):
        return F.round(F.aggregate("top_matches", F.lit(0.0), lambda s, m: s + m[field]), 4)
    return nest.floats(order_items(spark, sf_dir)).select(
        "item_key", "price_eur", total("price_eur").alias("match_prices"),
        total("cosine_similarity").alias("similarities"))


@query("stream_arrival", "SELECT lang, count(*) AS rows, sum(n_chars) AS n_chars FROM documents GROUP BY 1")
def stream_arrival(spark, sf_dir):
    """Files arrive one after the other; every batch refreshes the published counts."""
    documents = table(spark, sf_dir, "documents")
    landing_dir, stored, counts = (fresh_path(spark, x) for x in ("landing", "arrivals", "counts"))
    documents.repartition(3, "doc_id").write.parquet(landing_dir)

    def refresh(rows, batch_id):
        tables.publish(rows.groupBy("lang").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("n_chars"),
            F.count_distinct("batch_id").alias("batches")), counts)

    landing = arrivals.watch(spark, landing_dir, documents.schema, "parquet", files_per_batch=1)
    arrivals.store_arrivals(landing, stored, fresh_path(spark, "progress"), refresh).awaitTermination()
    last = spark.read.parquet(tables.current(spark, counts))
    if last.agg(F.max("batches")).first()[0] == 1:
        raise AssertionError("the files came in one batch")
    return last.drop("batches")


@query("stream_increments", STAGES_SQL + """
SELECT ingredient, count(*) AS doc_freq FROM silver GROUP BY 1""")
def stream_increments(spark, sf_dir):
    """Listings arrive in three files and three batches; each batch is cleaned alone and
    the document frequencies of the parts are added up."""
    rows = document_listings(spark, sf_dir).select(
        "url", "brand", "product_name", F.lit(0.0).cast("float").alias("price_eur"), "ingredients_raw")
    landing, stored, made = (fresh_path(spark, x) for x in ("landing", "arrivals", "parts"))
    rows.repartition(3, "url").write.parquet(landing)
    parts = increments.Parts(spark, made)
    arriving = arrivals.watch(spark, landing, rows.schema, "parquet", files_per_batch=1)
    arrivals.store_arrivals(arriving, stored, fresh_path(spark, "progress"),
                            each=lambda batch, batch_id: parts.add(batch, "b", batch_id)).awaitTermination()
    return parts.frequency()


# --- bronze steps ------------------------------------------------------------

BRONZE_SQL = """
bronze AS (
  SELECT CASE WHEN doc_id % 17 = 0 THEN NULL ELSE ' ' || CAST(doc_id AS VARCHAR) || '  ' END AS url,
         ' ' || lang || ' ' AS brand, source || ' ' AS series,
         CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN '   ' ELSE text END AS ingredients
  FROM documents)"""


def _bronze(spark, sf_dir):
    doc, space = F.col("doc_id"), F.lit(" ")
    nothing = F.lit(None).cast("string")
    return table(spark, sf_dir, "documents").select(
        F.when(doc % 17 == 0, nothing).otherwise(
            F.concat(space, doc.cast("string"), F.lit("  "))).alias("url"),
        F.concat(space, "lang", space).alias("brand"), F.concat("source", space).alias("series"),
        F.when(doc % 19 == 0, nothing).when(doc % 23 == 0, F.lit("   "))
        .otherwise(F.col("text")).alias("ingredients"))


@query("project_trim", "WITH " + BRONZE_SQL + """
SELECT trim(url) AS url, trim(brand) AS brand, trim(series) AS product_name FROM bronze""")
def project_trim(spark, sf_dir):
    return bronze.project_trim(_bronze(spark, sf_dir),
                               {"url": "url", "brand": "brand", "product_name": "series"})


@query("filter_notnull", "WITH " + BRONZE_SQL + """
SELECT trim(url) AS url, trim(brand) AS brand FROM bronze WHERE url IS NOT NULL""")
def filter_notnull(spark, sf_dir):
    return bronze.with_key(bronze.project_trim(
        _bronze(spark, sf_dir), {"url": "url", "brand": "brand"}))


@query("filter_missing", "WITH " + BRONZE_SQL + """
SELECT trim(url) AS url, length(trim(ingredients)) AS n FROM bronze
WHERE url IS NOT NULL AND ingredients IS NOT NULL AND trim(ingredients) <> ''""")
def filter_missing(spark, sf_dir):
    rows = bronze.with_key(bronze.project_trim(
        _bronze(spark, sf_dir), {"url": "url", "ingredients_raw": "ingredients"}))
    return bronze.with_text(rows).select(
        "url", F.length("ingredients_raw").cast("bigint").alias("n"))


@query("surrogate_key", """
SELECT sha256(concat_ws(chr(31), 'a', url, brand, CAST(k AS VARCHAR))) AS product_id, url, brand
FROM (SELECT source AS url, lang AS brand,
             row_number() OVER (PARTITION BY source, lang) AS k FROM documents)""")
def surrogate_key(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        F.col("source").alias("url"), F.col("lang").alias("brand"))
    return bronze.add_stable_id(rows, "a").select("product_id", "url", "brand")


@query("join_products", """
SELECT d.doc_id, lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def join_products(spark, sf_dir):
    return bronze.join_products(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                "doc_id").select("doc_id", "lang", "quality", "toxic")


@query("union_sources", """
SELECT source, count(*) AS rows FROM (
  SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS source FROM lineitem) GROUP BY 1""")
def union_sources(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    a = rows.filter("product_id % 2 = 0").select("product_id", F.lit("a").alias("source"))
    b = rows.filter("product_id % 2 <> 0").select(F.lit("b").alias("source"), "product_id")
    return bronze.union_sources(a, b).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


@query("bronze_to_silver", STAGES_SQL + """
SELECT 'https://shop.example/' || CAST(doc_id AS VARCHAR) AS url, 'a' AS source, lang AS brand,
       CAST(CAST(CAST(printf('%.2f', n_chars / 100.0) AS DOUBLE) AS FLOAT) AS DOUBLE) AS price_eur,
       ingredient, position
FROM silver JOIN documents USING (doc_id)""")
def bronze_to_silver(spark, sf_dir):
    from kindred.functions.fields import parse_price

    rows = document_listings(spark, sf_dir).withColumn("price_eur", parse_price(F.col("price")))
    return bronze.to_silver(rows.drop("is_a", "price"), "a").select(
        "url", "source", "brand", F.col("price_eur").cast("double").alias("price_eur"),
        "ingredient", "position")


# --- profiles and aggregates ---------------------------------------------------


@query("profile", """
SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS distinct_product_id,
       count(DISTINCT l_partkey) AS distinct_ingredient FROM lineitem""")
def profile_rows(spark, sf_dir):
    return profile.profile(order_rows(spark, sf_dir), ["product_id", "ingredient"])


@query("count_by_category", "SELECT lang, source, count(*) AS rows FROM documents GROUP BY 1, 2")
def count_by_category(spark, sf_dir):
    return profile.count_by(table(spark, sf_dir, "documents"), "lang", "source")


@query("doc_freq", "WITH " + WEIGHTS_SQL + " SELECT ingredient, doc_freq FROM freq")
def doc_freq(spark, sf_dir):
    return weigh.document_frequency(weigh.cells(order_rows(spark, sf_dir)))


@query("pivot_first", """
SELECT l_orderkey AS product_id, l_partkey AS ingredient, min(l_linenumber)::DOUBLE AS position
FROM lineitem GROUP BY 1, 2""")
def pivot_first(spark, sf_dir):
    return weigh.cells(order_rows(spark, sf_dir))


@query("first_per_product", SILVER_SQL + """
SELECT DISTINCT product_id, brand, product_name, price_eur, source, url FROM silver""")
def first_per_product(spark, sf_dir):
    return nest.first_per_product(_silver(spark, sf_dir)).withColumn(
        "price_eur", F.col("price_eur").cast("double"))


@query("sparsity", "WITH " + WEIGHTS_SQL + """
SELECT p AS products, i AS ingredients, round((p * i::DOUBLE - nz) / (p * i::DOUBLE) * 100, 9) AS sparsity
FROM (SELECT count(DISTINCT product_id) AS p, count(DISTINCT ingredient) AS i,
             count(*) FILTER (tfidf <> 0) AS nz FROM weights)""")
def sparsity(spark, sf_dir):
    return profile.sparsity(weigh.weigh(order_rows(spark, sf_dir))).withColumn(
        "sparsity", F.round("sparsity", 9))


@query("pivot_weights", "WITH " + WEIGHTS_SQL + f""",
columns AS (
  SELECT ingredient, (number - 1) // {profile.BLOCK_WIDTH} AS block, (number - 1) % {profile.BLOCK_WIDTH} AS place
  FROM (SELECT ingredient, row_number() OVER (ORDER BY ingredient) AS number FROM freq))
SELECT product_id, block, CAST({profile.BLOCK_WIDTH} AS INTEGER) AS width,
       CAST(count(*) FILTER (tfidf <> 0) AS INTEGER) AS filled, round(sum(tfidf), 9) AS total,
       round(sum(tfidf * (place + 1)), 7) AS placed
FROM weights JOIN columns USING (ingredient) GROUP BY 1, 2""")
def pivot_weights(spark, sf_dir):
    weighted = materialise(weigh.weigh(order_rows(spark, sf_dir)).select("product_id", "ingredient", "tfidf"), "weights")
    blocks = profile.pivot_blocks(weighted, profile.pivot_columns(weighted))

    def total(term):
        return F.aggregate(F.transform("values", term), F.lit(0.0), lambda x, y: x + y)
    return blocks.select(
        "product_id", "block", F.size("values").alias("width"),
        F.size(F.filter("values", lambda v: v != 0)).alias("filled"), F.round(total(lambda v: v), 9).alias("total"),
        F.round(total(lambda v, i: v * (i + 1)), 7).alias("placed"))


@query("gold_summary", GOLD_SQL + """
SELECT round(avg(cosine_similarity) FILTER (rank = 1), 6) AS avg_rank1,
       count(DISTINCT query_product_name) AS matched_products, count(*) AS match_rows FROM gold""")
def gold_summary(spark, sf_dir):
    return nest.gold_summary(order_gold(spark, sf_dir)).withColumn(
        "avg_rank1", F.round("avg_rank1", 6))


# --- checks --------------------------------------------------------------------

CHECKED = ("documents", "pages", "labels", "region", "part")


@query("dq_min_rows", "\nUNION ALL\n".join(f"""
SELECT '{t}' AS input, count(*) AS rows, CAST({100 if t != 'part' else 10} AS INTEGER) AS min_rows,
       count(*) > 0 AS not_empty, count(*) >= {100 if t != 'part' else 10} AS passed,
       CASE WHEN count(*) >= {100 if t != 'part' else 10} THEN 'ok' ELSE 'warn' END AS severity
FROM {t}""" for t in CHECKED))
def dq_min_rows(spark, sf_dir):
    rules = {t: quality.MIN_ROWS_PER_FILE for t in CHECKED if t != "part"}
    return quality.check_min_rows({t: table(spark, sf_dir, t) for t in CHECKED}, rules)


@query("dq_load_count", GOLD_SQL + """
SELECT count(DISTINCT query_id) AS written, count(DISTINCT query_id) AS stored FROM gold""")
def dq_load_count(spark, sf_dir):
    items, seen = quality.counted(order_items(spark, sf_dir))
    path = fresh_path(spark, "serving")
    tables.write_serving(items, path)
    stored = tables.read_serving(spark, path)
    quality.verify_count(stored, seen.get["rows"])
    return stored.agg(F.lit(seen.get["rows"]).cast("bigint").alias("written"),
                      F.count(F.lit(1)).alias("stored"))


