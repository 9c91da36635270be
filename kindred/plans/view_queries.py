"""The serving view's queries over the items made from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import view
from kindred.plans.adapters import GOLD_SQL, order_items
from kindred.plans.registry import query

SEARCHED, BRAND, LEAST = "MACH", "BUILDING", 0.6

ITEMS_SQL = GOLD_SQL + """,
items AS (
  SELECT CAST(query_id AS VARCHAR) AS item_key, any_value(query_product_name) AS product_name,
         any_value(query_brand) AS brand, any_value(query_price_eur) AS price_eur,
         max(cosine_similarity) FILTER (rank = 1) AS best,
         max(match_price_eur) FILTER (rank = 1) AS best_price
  FROM gold GROUP BY 1)
"""
LISTED_SQL = ITEMS_SQL + "SELECT item_key, product_name, brand, price_eur, best FROM items"


def _listed(items):
    return items.select("item_key", "product_name", "brand",
                        F.col("price_eur").cast("double").alias("price_eur"),
                        view.best_similarity().alias("best"))


@query("view_search", LISTED_SQL + f"""
WHERE contains(lower(product_name), '{SEARCHED.lower()}') OR contains(lower(brand), '{SEARCHED.lower()}')""")
def view_search(spark, sf_dir):
    return _listed(view.search(order_items(spark, sf_dir), SEARCHED))


@query("view_brand", LISTED_SQL + f" WHERE brand = '{BRAND}'")
def view_brand(spark, sf_dir):
    return _listed(view.of_brand(order_items(spark, sf_dir), BRAND))


@query("view_min_sim", LISTED_SQL + f" WHERE best >= {LEAST}")
def view_min_sim(spark, sf_dir):
    return _listed(view.at_least(order_items(spark, sf_dir), LEAST))


@query("view_sorted", LISTED_SQL + " ORDER BY coalesce(best, 0) DESC, item_key")
def view_sorted(spark, sf_dir):
    return _listed(view.by_similarity(order_items(spark, sf_dir)))


@query("view_browse", LISTED_SQL + f"""
WHERE contains(lower(product_name), '9') AND brand = '{BRAND}' AND best >= {LEAST}
ORDER BY best DESC, item_key""")
def view_browse(spark, sf_dir):
    return _listed(view.browse(order_items(spark, sf_dir), "9", BRAND, LEAST))


@query("brands", ITEMS_SQL + "SELECT brand, count(*) AS items FROM items GROUP BY 1")
def brands(spark, sf_dir):
    return view.brands(order_items(spark, sf_dir))


@query("view_savings", GOLD_SQL + """,
gains AS (
  SELECT CAST(query_id AS VARCHAR) AS item_key, rank, match_product_name,
         CASE WHEN coalesce(query_price_eur, 0) <> 0 AND coalesce(match_price_eur, 0) <> 0
              THEN round(query_price_eur - match_price_eur, 2) END AS savings FROM gold)
SELECT item_key, rank, match_product_name, savings,
       CASE WHEN savings > 0 THEN 'Save €' || printf('%.2f', savings)
            WHEN savings IS NOT NULL THEN '+€' || printf('%.2f', abs(savings)) END AS savings_label
FROM gains""")
def view_savings(spark, sf_dir):
    return view.savings(order_items(spark, sf_dir))


@query("view_labels", GOLD_SQL + """
SELECT CAST(query_id AS VARCHAR) AS item_key, rank,
       CAST(trunc(cosine_similarity * 100) AS INTEGER) AS match_percent,
       CASE WHEN coalesce(query_price_eur, 0) <> 0 THEN '€' || printf('%.2f', query_price_eur)
            ELSE 'Price unavailable' END AS product_price,
       CASE WHEN coalesce(match_price_eur, 0) <> 0 THEN '€' || printf('%.2f', match_price_eur)
            ELSE '—' END AS match_price FROM gold""")
def view_labels(spark, sf_dir):
    return view.labels(order_items(spark, sf_dir))


@query("view_stats", ITEMS_SQL + """
SELECT count(*) AS products, count(DISTINCT brand) AS brands,
       round(coalesce(sum(best), 0) / greatest(count(*), 1), 6) AS avg_similarity,
       round(coalesce(sum(price_eur - best_price) FILTER (price_eur <> 0 AND best_price <> 0
         AND price_eur > best_price), 0) / greatest(count(*) FILTER (price_eur <> 0
         AND best_price <> 0 AND price_eur > best_price), 1), 4) AS avg_saving FROM items""")
def view_stats(spark, sf_dir):
    return view.statistics(order_items(spark, sf_dir)).select(
        "products", "brands", F.round("avg_similarity", 6).alias("avg_similarity"),
        F.round("avg_saving", 4).alias("avg_saving"))
