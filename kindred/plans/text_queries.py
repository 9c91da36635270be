"""Scalar and array functions over the whole text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions import fields, text
from kindred.operators import bronze, weigh
from kindred.operators.balance import balance
from kindred.plans.adapters import LABEL_SQL, WEIGHTS_SQL, listings, order_rows, table
from kindred.plans.registry import query

SPACE = text.SPACE


def _re(sql: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({sql}, '{pattern}', '{by}', 'g')"


def _strip(sql: str) -> str:
    return _re(sql, rf"\A{SPACE}+|{SPACE}+\z")


def _heading(sql: str) -> str:
    for heading in text.HEADINGS:
        pattern = text.unicode_classes(heading)
        sql = _strip(rf"regexp_replace({sql}, '(?i)\A{pattern}', '')")
    return sql


def _brackets(sql: str) -> str:
    for word in text.WATER_WORDS:
        sql = _re(sql, rf"(?i)\({word}[^)]*\)")
    return sql


def _upper(sql: str) -> str:
    return f"replace(replace(upper({sql}), 'ẞ', 'SS'), 'ß', 'SS')"


# Each stage is one CTE, so that every function has an independent statement in SQL.
SPACED = _re("label", f"{SPACE}+", " ")
STAGES_SQL = f"""
WITH raw AS (SELECT doc_id, {LABEL_SQL} AS label FROM documents),
spaced AS (SELECT doc_id, CASE WHEN {_strip("label")} = '' THEN '' ELSE {SPACED} END AS t FROM raw),
headed AS (SELECT doc_id, {_heading("t")} AS t FROM spaced),
bracketed AS (SELECT doc_id, {_brackets("t")} AS t FROM headed),
separated AS (
  SELECT doc_id, {_re(_re(_re(_re(_re(
    "t", rf"{SPACE}*[|]{SPACE}*", ","), rf"{SPACE}*[*]{SPACE}*", ","),
    rf"{SPACE}*·{SPACE}*", ","), rf"{SPACE}*•{SPACE}*", ","), rf"{SPACE}*[.]{SPACE}*", ",")} AS t
  FROM bracketed),
held AS (SELECT doc_id, {_re("t", "([0-9]),([0-9])", chr(92) + "1CHEMCOMMA" + chr(92) + "2")} AS t
         FROM separated),
prepared AS (SELECT doc_id, {_strip(_upper("t"))} AS t FROM held),
split AS (
  SELECT doc_id, unnest(string_split(t, ',')) AS token, generate_subscripts(string_split(t, ','), 1) AS i
  FROM prepared WHERE t <> ''),
cut AS (
  SELECT doc_id, i, {_strip("split_part(" + _strip("split_part(" + _strip("token") + ", '/', 1)")
                            + ", chr(92), 1)")} AS token FROM split),
bare AS (
  SELECT doc_id, i, {_strip(_re("token", rf"{SPACE}*\([^)]*\)"))} AS token FROM cut),
clean AS (
  SELECT doc_id, i, replace({_strip(_re("token", rf"{SPACE}+[0-9]+\.?[0-9]*{SPACE}*%"))},
         'CHEMCOMMA', ',') AS token FROM bare),
real AS (
  SELECT doc_id, i, token FROM clean
  WHERE NOT ({" OR ".join(f"regexp_matches(token, '(?i){text.unicode_classes(p).replace(chr(39), chr(39) * 2)}')"
                          for p in text.FOOTNOTES)})),
named AS (
  SELECT doc_id, i, CASE WHEN token IN ({", ".join(f"'{k}'" for k in text.SYNONYMS)})
                    THEN 'AQUA' ELSE token END AS token FROM real),
kept AS (
  SELECT doc_id, i, token FROM named
  WHERE length(token) >= 3 AND NOT regexp_matches(token, '^CI{SPACE}+[0-9]+$')),
seen AS (SELECT doc_id, token, min(i) AS i FROM kept GROUP BY 1, 2),
silver AS (
  SELECT doc_id, token AS ingredient,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS position FROM seen)
"""


def _stage(name: str) -> str:
    return STAGES_SQL + f"SELECT doc_id, t AS result FROM {name}"


def _tokens(name: str) -> str:
    return STAGES_SQL + f"SELECT doc_id, token, count(*) AS uses FROM {name} GROUP BY 1, 2"


def _on_label(step):
    def run(spark, sf_dir):
        return listings(spark, sf_dir).select("doc_id", step(F.col("label")).alias("result"))
    return run


def _token_counts(step, keep=None, rename=None):
    def run(spark, sf_dir):
        rows = listings(spark, sf_dir).select("doc_id", text.prepare_list(F.col("label")).alias("t"))
        rows = rows.filter("t <> ''").select(
            "doc_id", F.explode(text.split_list(step(F.col("t")))).alias("token"))
        rows = rows.withColumn("token", text.release_commas(F.col("token")))
        if rename is not None:
            rows = rows.withColumn("token", rename(F.col("token")))
        if keep is not None:
            rows = rows.filter(keep(F.col("token")))
        return rows.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("uses"))
    return run


def _headed(col):
    return text.strip_heading(text.collapse_space(col))


def _bracketed(col):
    return text.drop_water_brackets(_headed(col))


def _separated(col):
    return text.unify_separators(_bracketed(col))


def _held(col):
    return F.replace(text.hold_commas(_separated(col)), F.lit(text.HELD_COMMA), F.lit("CHEMCOMMA"))


def _prepared(col):
    return F.replace(text.prepare_list(col), F.lit(text.HELD_COMMA), F.lit("CHEMCOMMA"))


query("norm_ws", _stage("spaced"))(_on_label(text.collapse_space))
query("strip_prefix", _stage("headed"))(_on_label(_headed))
query("drop_paren_terms", _stage("bracketed"))(_on_label(_bracketed))
query("unify_delims", _stage("separated"))(_on_label(_separated))
query("protect_commas", _stage("held"))(_on_label(_held))
query("normalise_tokens", _stage("prepared"))(_on_label(_prepared))


@query("split_tokens", STAGES_SQL + """
SELECT doc_id, replace(token, 'CHEMCOMMA', ',') AS token, count(*) AS uses FROM split GROUP BY 1, 2""")
def split_tokens(spark, sf_dir):
    return _token_counts(lambda t: t)(spark, sf_dir)



query("clean_token", _tokens("clean"))(_token_counts(text.clean_tokens))
query("reject_footnotes", _tokens("real"))(
    _token_counts(text.clean_tokens, lambda t: ~text.is_footnote(t)))
query("synonyms", _tokens("named"))(
    _token_counts(text.clean_tokens, lambda t: ~text.is_footnote(t), text.apply_synonyms))
query("reject_short", _tokens("kept"))(
    _token_counts(text.clean_tokens, lambda t: ~text.is_footnote(t) & ~text.is_too_short(t),
                  text.apply_synonyms))


@query("distinct_tokens", STAGES_SQL + """
SELECT doc_id, string_agg(token, '|' ORDER BY i) AS result FROM seen GROUP BY 1""")
def distinct_tokens(spark, sf_dir):
    rows = listings(spark, sf_dir).select(
        "doc_id", text.ingredient_array(F.col("label")).alias("tokens"))
    return rows.filter(F.size("tokens") > 0).select(
        "doc_id", F.array_join("tokens", "|").alias("result"))


@query("explode_positions", STAGES_SQL + "SELECT doc_id, ingredient, position FROM silver")
def explode_positions(spark, sf_dir):
    return bronze.explode_ingredients(balance(listings(spark, sf_dir), "label"), "label").select(
        "doc_id", "ingredient", "position")


# --- weights -------------------------------------------------------------------


@query("tf", "WITH " + WEIGHTS_SQL + " SELECT product_id, ingredient, tf FROM weights")
def tf(spark, sf_dir):
    return weigh.cells(order_rows(spark, sf_dir)).select(
        "product_id", "ingredient", weigh.term_frequency("position").alias("tf"))


@query("idf", "WITH " + WEIGHTS_SQL + """
SELECT product_id, ingredient, doc_freq, round(idf, 9) AS idf FROM weights""")
def idf(spark, sf_dir):
    return weigh.weigh(order_rows(spark, sf_dir)).select(
        "product_id", "ingredient", "doc_freq", F.round("idf", 9).alias("idf"))


@query("tfidf", "WITH " + WEIGHTS_SQL + """
SELECT product_id, ingredient, round(tfidf, 9) AS tfidf FROM weights""")
def tfidf(spark, sf_dir):
    return weigh.weigh(order_rows(spark, sf_dir)).select(
        "product_id", "ingredient", F.round("tfidf", 9).alias("tfidf"))


# --- scraped fields --------------------------------------------------------------

PRICE_TEXT_SQL = """(CASE o_orderkey % 4
  WHEN 0 THEN replace(printf('%.2f', o_totalprice), '.', ',') || ' €'
  WHEN 1 THEN 'ab ' || printf('%.2f', o_totalprice) || ' €/l'
  WHEN 2 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' €'
  ELSE '1.' || replace(printf('%.2f', o_totalprice), '.', ',') END)"""


def price_text():
    amount = F.format_string("%.2f", F.col("o_totalprice"))
    comma = F.replace(amount, F.lit("."), F.lit(","))
    kind = F.col("o_orderkey") % 4
    return (F.when(kind == 0, F.concat(comma, F.lit(" €")))
            .when(kind == 1, F.concat(F.lit("ab "), amount, F.lit(" €/l")))
            .when(kind == 2, F.concat(F.floor("o_totalprice").cast("bigint").cast("string"),
                                      F.lit(" €")))
            .otherwise(F.concat(F.lit("1."), comma)))


@query("parse_price", f"""
SELECT o_orderkey, CAST(CAST(TRY_CAST(replace(nullif(regexp_extract(
  {PRICE_TEXT_SQL}, '([0-9]+[,.][0-9]+)', 1), ''), ',', '.') AS DOUBLE) AS FLOAT) AS DOUBLE) AS price_eur
FROM orders""")
def parse_price(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fields.parse_price(price_text()).cast("double").alias("price_eur"))


@query("price_fallback", f"""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN {PRICE_TEXT_SQL} END,
  nullif(regexp_extract('Jetzt nur ' || {PRICE_TEXT_SQL} || ' statt 9,99 €',
    '([0-9]+[.,][0-9]+ *€)', 1), ''), '') AS price FROM orders""")
def price_fallback(spark, sf_dir):
    own = F.when(F.col("o_orderkey") % 3 == 0, price_text())
    box = F.concat(F.lit("Jetzt nur "), price_text(), F.lit(" statt 9,99 €"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fields.fallback_price(own, box).alias("price"))


RATING_TEXT_SQL = """(CASE WHEN p_size % 7 = 0 THEN 'noch keine Bewertung' ELSE
  CAST(p_size % 5 AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN ',' ELSE '.' END ||
  CAST(p_partkey % 10 AS VARCHAR) || ' von 5 Sternen bei ' || CAST(p_partkey AS VARCHAR) ||
  ' Bewertungen' END)"""


@query("rating_extract", f"""
SELECT p_partkey,
  replace(nullif(regexp_extract({RATING_TEXT_SQL}, '([0-9][.,][0-9]) *von *5', 1), ''), ',', '.') AS rating,
  nullif(regexp_extract({RATING_TEXT_SQL}, 'bei *([0-9]+) *Bewertung', 1), '') AS review_count
FROM part""")
def rating_extract(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    source = F.when(size % 7 == 0, F.lit("noch keine Bewertung")).otherwise(F.concat(
        (size % 5).cast("string"), F.when(key % 2 == 0, ",").otherwise("."),
        (key % 10).cast("string"), F.lit(" von 5 Sternen bei "), key.cast("string"),
        F.lit(" Bewertungen")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", fields.rating(source).alias("rating"),
        fields.review_count(source).alias("review_count"))


@query("clean_name", """
SELECT p_partkey, nullif(trim(regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN trim(p_name) ELSE
  trim(p_name || CASE WHEN p_partkey % 2 = 0 THEN chr(10) || '(' || CAST(p_size AS VARCHAR) || ' Bewertungen)'
  ELSE '' END) END, '\\s*\\n\\s*\\([0-9]+[^)]*\\)\\s*$', '')), '') AS name FROM part""")
def clean_name(spark, sf_dir):
    count = F.concat(F.lit("\n("), F.col("p_size").cast("string"), F.lit(" Bewertungen)"))
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_brand"), F.lit("\n"), F.col("p_name"))
                 ).otherwise(F.concat(F.col("p_name"),
                                      F.when(F.col("p_partkey") % 2 == 0, count).otherwise("")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", fields.clean_name(raw, F.col("p_brand")).alias("name"))


@query("flatten_text", f"""
SELECT conv_id, turn, {_strip("role")} AS role, {_strip("replace(text, chr(10), ' ')")} AS text
FROM conversations""")
def flatten_text(spark, sf_dir):
    return bronze.flatten_text(table(spark, sf_dir, "conversations"))


@query("coerce_numeric", """
SELECT event_id, coalesce(TRY_CAST(k AS DOUBLE), 999) AS position FROM (
  SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'n/a' WHEN user_id % 7 = 0 THEN NULL
    ELSE regexp_extract(props, '([0-9]+)', 1) END AS k FROM events)""")
def coerce_numeric(spark, sf_dir):
    user = F.col("user_id")
    k = (F.when(user % 5 == 0, F.lit("n/a")).when(user % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.regexp_extract("props", "([0-9]+)", 1)))
    return table(spark, sf_dir, "events").select(
        "event_id", weigh.tolerant_position(k).alias("position"))
