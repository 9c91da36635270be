"""Matching over the orders and, end to end, over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import match, nest, weigh
from kindred.plans.adapters import (
    COSINE_SQL, PADDED_SQL, PRODUCTS_SQL, RANKED_SQL, WEIGHTS_SQL, document_silver, order_matches,
    order_rows, with_lines,
)
from kindred.plans.catalogue import gold_rows
from kindred.plans.registry import query
from kindred.plans.text_queries import STAGES_SQL
from kindred.session import materialise_alone

#: Similarity floor of the registered pair query.
PAIR_FLOOR = 0.5

_BASE = "WITH " + ",".join((PRODUCTS_SQL, WEIGHTS_SQL, COSINE_SQL))


@query("cosine_pairs", _BASE + f"""
SELECT query_id, match_id, round(similarity, 9) AS similarity FROM cosines
WHERE similarity >= {PAIR_FLOOR}""")
def cosine_pairs(spark, sf_dir):
    return match.cosine_pairs(
        weigh.weigh(order_rows(spark, sf_dir)), nest.sides(with_lines(spark, sf_dir), "a", "b"),
        PAIR_FLOOR).withColumn("similarity", F.round("similarity", 9))


@query("topn_matches", _BASE + "," + RANKED_SQL + """
SELECT query_id, match_id, round(similarity, 9) AS similarity, rank FROM ranked""")
def topn_matches(spark, sf_dir):
    return order_matches(spark, sf_dir, pad_zero=False).withColumn(
        "similarity", F.round("similarity", 9))


@query("topn_padded", _BASE + "," + PADDED_SQL + """
SELECT query_id, match_id, round(similarity, 9) AS similarity, rank FROM padded""")
def topn_padded(spark, sf_dir):
    return order_matches(spark, sf_dir).withColumn("similarity", F.round("similarity", 9))


#: Brute force over the texts' tokens; ids are the urls here. Compared on the sorted
#: similarities of each product, since the ids of the job are hashes.
DOCUMENT_SQL = STAGES_SQL + """,
total AS (SELECT count(DISTINCT doc_id) AS n FROM silver),
freq AS (SELECT ingredient, count(*) AS doc_freq FROM silver GROUP BY 1),
weights AS (
  SELECT doc_id, ingredient, ln(n::DOUBLE / doc_freq) / position AS w
  FROM silver JOIN freq USING (ingredient) CROSS JOIN total WHERE doc_freq < n),
norms AS (SELECT doc_id, sqrt(sum(w * w)) + 1e-10 AS norm FROM weights GROUP BY 1),
cosines AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) / (any_value(na.norm) * any_value(nb.norm)) AS s
  FROM weights a JOIN weights b ON a.ingredient = b.ingredient AND a.doc_id % 2 = 0 AND b.doc_id % 2 = 1
  JOIN norms na ON na.doc_id = a.doc_id JOIN norms nb ON nb.doc_id = b.doc_id GROUP BY 1, 2),
best AS (
  SELECT a, s, row_number() OVER (PARTITION BY a ORDER BY s DESC) AS rank
  FROM cosines JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b
  WHERE s < 0.9999 AND upper(x.lang) <> upper(y.lang))
SELECT 'https://shop.example/' || CAST(a AS VARCHAR) AS query_url, CAST(rank AS INTEGER) AS rank,
       round(s, 4) AS cosine_similarity FROM best WHERE rank <= 3"""


@query("gold_documents", DOCUMENT_SQL)
def gold_documents(spark, sf_dir):
    silver = materialise_alone(lambda: document_silver(spark, sf_dir), "silver", codec="zstd")
    return gold_rows(silver, pad_zero=False).select("query_url", "rank", "cosine_similarity")
