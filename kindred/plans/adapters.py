"""The given tables in the shapes the operators expect, and the same in SQL.

Orders play the products, their parts the ingredients, the line number the position;
even orders belong to the query source and odd ones to the match source. Documents
play the listings with free text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import bronze, match, nest, weigh


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, ingredient, position."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("product_id"), F.col("l_partkey").alias("ingredient"),
        F.col("l_linenumber").alias("position"))


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        key.alias("product_id"), F.when(key % 2 == 0, "a").otherwise("b").alias("source"),
        F.col("c_mktsegment").alias("brand"), F.col("c_name").alias("product_name"),
        F.col("o_totalprice").alias("price_eur"),
        F.concat(F.lit("https://shop.example/"), key.cast("string")).alias("url"))


def with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have a line at all: the products the pipeline would see."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product_id")).distinct()
    return order_products(spark, sf_dir).join(lines, "product_id", "left_semi")


PRODUCTS_SQL = """
products AS (
  SELECT o_orderkey AS product_id, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS source,
         c_mktsegment AS brand, c_name AS product_name, o_totalprice AS price_eur,
         'https://shop.example/' || CAST(o_orderkey AS VARCHAR) AS url
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
)"""

WEIGHTS_SQL = """
cells AS (
  SELECT l_orderkey AS product_id, l_partkey AS ingredient, min(l_linenumber) AS position
  FROM lineitem GROUP BY 1, 2
),
total AS (SELECT count(DISTINCT product_id) AS n FROM cells),
freq AS (SELECT ingredient, count(DISTINCT product_id) AS doc_freq FROM cells GROUP BY 1),
weights AS (
  SELECT product_id, ingredient, position, doc_freq, 1.0::DOUBLE / position AS tf,
         ln(n::DOUBLE / doc_freq) AS idf, ln(n::DOUBLE / doc_freq) / position AS tfidf
  FROM cells JOIN freq USING (ingredient) CROSS JOIN total
)"""

COSINE_SQL = """
norms AS (SELECT product_id, sqrt(sum(tfidf * tfidf)) + 1e-10 AS norm FROM weights GROUP BY 1),
cosines AS (
  SELECT a.product_id AS query_id, b.product_id AS match_id,
         sum(a.tfidf * b.tfidf) / (any_value(na.norm) * any_value(nb.norm)) AS similarity
  FROM weights a JOIN weights b ON a.ingredient = b.ingredient
   AND a.product_id % 2 = 0 AND b.product_id % 2 = 1
  JOIN norms na ON na.product_id = a.product_id JOIN norms nb ON nb.product_id = b.product_id
  WHERE a.tfidf > 0 AND b.tfidf > 0 GROUP BY 1, 2
)"""

#: Positive matches only. Ranked on twelve places, then by id.
RANKED_SQL = """
ranked AS (
  SELECT * FROM (
    SELECT query_id, match_id, similarity, CAST(row_number() OVER (
             PARTITION BY query_id ORDER BY round(similarity, 12) DESC, match_id) AS INTEGER) AS rank
    FROM cosines JOIN products q ON q.product_id = query_id JOIN products m ON m.product_id = match_id
    WHERE similarity < 0.9999
      AND coalesce(upper(q.brand), 'NAN') <> coalesce(upper(m.brand), 'NAN'))
  WHERE rank <= 3
)"""

#: With the zero padding: the lowest ids that share nothing.
PADDED_SQL = RANKED_SQL + """,
have AS (
  SELECT product_id, brand, count(query_id) AS k
  FROM products LEFT JOIN ranked ON query_id = product_id
  WHERE source = 'a' GROUP BY 1, 2
),
padded AS (
  SELECT query_id, match_id, similarity, rank FROM ranked
  UNION ALL
  SELECT query_id, match_id, 0.0, CAST(k + r AS INTEGER) FROM (
    SELECT h.product_id AS query_id, m.product_id AS match_id, k, row_number() OVER (
             PARTITION BY h.product_id ORDER BY m.product_id) AS r
    FROM have h JOIN products m ON m.source = 'b'
     AND coalesce(upper(m.brand), 'NAN') <> coalesce(upper(h.brand), 'NAN')
    WHERE k < 3 AND NOT EXISTS (
      SELECT 1 FROM cosines c WHERE c.query_id = h.product_id AND c.match_id = m.product_id))
  WHERE k + r <= 3
)"""

GOLD_SQL = ("WITH " + ",".join((PRODUCTS_SQL, WEIGHTS_SQL, COSINE_SQL, PADDED_SQL)) + """,
gold AS (
  SELECT query_id, q.product_name AS query_product_name, q.brand AS query_brand,
         q.price_eur AS query_price_eur, q.url AS query_url, match_id,
         m.product_name AS match_product_name, m.brand AS match_brand,
         m.price_eur AS match_price_eur, m.url AS match_url,
         round(similarity, 4) AS cosine_similarity, rank
  FROM padded JOIN products q ON q.product_id = query_id JOIN products m ON m.product_id = match_id
)""")


def order_matches(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    products = with_lines(spark, sf_dir)
    return match.rank_matches(lambda listed: weigh.weigh(order_rows(spark, sf_dir), products=listed),
                              nest.sides(products, "a", "b"), **options)


def order_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold rows of the orders. Every query makes its own, so each does and shows the whole job."""
    return nest.attach_attributes(order_matches(spark, sf_dir), order_products(spark, sf_dir))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest.nest_matches(order_gold(spark, sf_dir))


# --- documents as listings ---------------------------------------------------

#: A heading and the separators of ingredient lists put into the prose, the same way
#: in both dialects.
WORDING = (
    (" de ", " (Aqua de) "), (" the ", " 5% / "), (" und ", " 1,2-X | Water, "),
    (" el ", " (x) CI 77891, Bio-Zutat, "), (" an ", " • 1,2,3-Triol\\y * "),
)
HEADED = ("Ingredients / INCI: ", "INCI ", "ingredients : ", "", "Ingredients;\n")


def label_text() -> Column:
    text = F.col("text")
    for old, new in WORDING:
        text = F.replace(text, F.lit(old), F.lit(new))
    heading = F.element_at(F.array(*[F.lit(h) for h in HEADED]),
                           (F.col("doc_id") % 5 + 1).cast("int"))
    return F.concat(heading, text)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _label_sql() -> str:
    text = "text"
    for old, new in WORDING:
        text = f"replace({text}, {_sql_text(old)}, {_sql_text(new)})"
    cases = " ".join(f"WHEN {i} THEN {_sql_text(h)}" for i, h in enumerate(HEADED))
    return f"(CASE doc_id % 5 {cases} END || {text})"


LABEL_SQL = _label_sql()


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, label: every document with its whole text as an ingredient list."""
    return table(spark, sf_dir, "documents").select("doc_id", label_text().alias("label"))


def document_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the layout of a joined listing."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://shop.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("brand"), F.col("source").alias("product_name"),
        F.concat(F.replace(F.format_string("%.2f", F.col("n_chars") / 100.0), F.lit("."),
                           F.lit(",")), F.lit(" €")).alias("price"),
        label_text().alias("ingredients_raw"), (F.col("doc_id") % 2 == 0).alias("is_a"))


def document_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.functions.fields import parse_price

    rows = document_listings(spark, sf_dir).withColumn("price_eur", parse_price(F.col("price")))
    return bronze.union_sources(
        bronze.to_silver(rows.filter("is_a").drop("is_a", "price"), "a"),
        bronze.to_silver(rows.filter("NOT is_a").drop("is_a", "price"), "b"))
