import random
import re
import time

import pytest
from pyspark.sql import functions as F

from kindred.functions import fields, text
from kindred.operators import bronze

LISTS = {
    "Ingredients / INCI: Aqua, Glycerin": ["AQUA", "GLYCERIN"],
    "INCI Aqua; Glycerin": ["AQUA; GLYCERIN"],
    "ingredients / Inhalt: Aqua": ["AQUA"],
    "Water, Aqua, Glycerin": ["AQUA", "GLYCERIN"],
    "Aqua • Glycerin | Niacinamide. Panthenol": ["AQUA", "GLYCERIN", "NIACINAMIDE", "PANTHENOL"],
    "1,2-Hexanediol, Aqua": ["1,2-HEXANEDIOL", "AQUA"],
    "Aqua, 1,2,3-Triol": ["AQUA", "1,2", "3-TRIOL"],
    "Parfum/Fragrance, Tocopherol (Vitamin E)": ["PARFUM", "TOCOPHEROL"],
    "Aqua, CI 77891, AB, 5 %, Bio-Zutat": ["AQUA"],
    "Niacinamide 5%, Retinol 0.5%": ["NIACINAMIDE", "RETINOL 0,5%"],
    "Foo\\Bar (x) baz, Foo 3 % extra": ["FOO", "FOO EXTRA"],
    "(x) 5% foo, Bar (y) 5%": ["5% FOO", "BAR"],
    "Groß,ätherisch, NATÜRLICH, naturlich Foo": [
        "GROSS", "ÄTHERISCH", "NATÜRLICH"],
    "Aqua \r\n, Glycerin\x1f": ["AQUA", "GLYCERIN"],
    "Kiehl's Oil, 12 Stars, 300PPM, 10ppb)": [],
    "Aqua (Aqua, Water), (Eau) Glycerin": ["AQUA", "GLYCERIN"],
    "deionized water, AQUA [WATER], Sea Water": ["AQUA", "SEA WATER"],
    ", ,": [],
    "   ": [],
    None: [],
}


def test_ingredient_lists(spark):
    rows = spark.createDataFrame(list(enumerate(LISTS)), "i int, raw string")
    found = {r.i: r.x for r in rows.select("i", text.ingredient_array(F.col("raw")).alias("x")).collect()}
    for i, (raw, expected) in enumerate(LISTS.items()):
        assert (found[i] or []) == expected, raw


def test_positions_are_dense_and_distinct(spark):
    rows = spark.createDataFrame([(1, "B, A, B, xx, C"), (2, None)], "i int, ingredients_raw string")
    got = bronze.explode_ingredients(rows.withColumn(
        "ingredients_raw", F.replace("ingredients_raw", F.lit("A"), F.lit("AAA")))).collect()
    assert [(r.i, r.ingredient, r.position) for r in got] == [(1, "AAA", 1)]


@pytest.mark.parametrize("raw, plain, grouped", [
    ("22,95 €", 22.95, 22.95), ("ab 4.45 €", 4.45, 4.45), ("45 €", None, None),
    ("1.234,56 €", 1.234, 1234.56), (None, None, None), ("ca. 3 x 2,5", 2.5, 2.5)])
def test_prices(spark, raw, plain, grouped):
    row = spark.createDataFrame([(raw,)], "p string").select(
        fields.parse_price(F.col("p")).alias("a"), fields.parse_price(F.col("p"), True).alias("b")).first()
    assert row.a == (None if plain is None else pytest.approx(plain, rel=1e-6))
    assert row.b == (None if grouped is None else pytest.approx(grouped, rel=1e-6))


def test_scraped_fields(spark):
    row = spark.createDataFrame(
        [("4,7 von 5 Sternen bei 480 Bewertungen", "Acme", "Acme\nDay Cream\n(480)",
          ["/cart/1", "", "/p/2", "https://x.example/3"], "", "d.png")],
        "r string, b string, n string, h array<string>, s string, d string").select(
        fields.rating(F.col("r")).alias("rating"), fields.review_count(F.col("r")).alias("reviews"),
        fields.clean_name(F.col("n"), F.col("b")).alias("name"),
        fields.clean_name(F.lit("Acme"), F.col("b")).alias("nothing"),
        fields.first_link(F.col("h"), "https://shop.example").alias("link"),
        fields.first_filled(F.col("s"), F.col("d")).alias("image"),
        fields.price_label(F.lit(0.0), "—").alias("free"),
        fields.price_label(F.lit(3.456), "—").alias("label"),
        fields.match_percent(F.lit(0.999)).alias("percent")).first()
    assert tuple(row) == ("4.7", "480", "Day Cream", None, "https://shop.example/p/2", "d.png",
                          "—", "€3.46", 99)


@pytest.mark.parametrize("value", [
    "a" + " " * 1_000_000 + "b", "a" + "\n" * 1_000_000 + "b", "(" * 1_000_000, "(aqua" * 200_000,
    "x\n(1" * 250_000, "a\n(1)" * 200_000, " \n" * 500_000 + "(1"])
def test_long_runs_take_linear_time(spark, value):
    rows = spark.createDataFrame([(value,)], "v string").cache()
    rows.count()
    for step in (text.strip, text.flatten_lines, text.prepare_list, lambda v: text.clean_tokens(text.collapse_space(v)),
                 lambda v: fields.clean_name(v, F.lit("Acme"))):
        start = time.time()
        rows.select(F.length(step(F.col("v")))).collect()
        assert time.time() - start < 2


def test_names_lose_what_the_plain_pattern_cuts(spark):
    pick = random.Random(4)
    names = ["".join(pick.choice("\n ()1a\xa0") for _ in range(pick.randint(0, 12))) for _ in range(1500)]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", fields.clean_name(F.col("n"), F.lit(None)).alias("c")).collect()
    for row in got:
        assert (row.c or "") == re.sub(r"\s*\n\s*\(\d+[^)]*\)\s*\Z", "", row.n, count=1).strip(), repr(row.n)


def test_fixed_values_written_out(spark):
    """What the lists of fixed values must do, spelled out apart from them."""
    from kindred.functions.text import ingredient_array

    headings = ["Ingredients / INCI: ", "INGREDIENTS, inci : ", "ingredients /something else: ", "Ingredients; ", "Ingredients : ",
                "ingredients ", "INCI: ", "inci ", "Ingredients INCI: "]
    waters = ["water", "Eau", "Aqua/Water", "Water/Aqua", "Aqua/Water/Eau", "Water/Aqua/Eau", "Deionized Water",
              "Purified Water", "Distilled Water", "WaterAquaEau", "WasserAquaEau"]
    notes = ["hergestellt in X", "Bio-Zutat", "exclusive anti age complex", "PEOPLE'S choice", "10 PPM", "3 ppb", "5 %", "20ppm x", "12 abc", "1.-2"]
    rows = [(h + "Glycerin, Parfum", ["GLYCERIN", "PARFUM"]) for h in headings]
    rows += [(f"{w}, Glycerin", ["AQUA", "GLYCERIN"]) for w in waters]
    rows += [(f"Glycerin, {n}, Parfum", ["GLYCERIN", "PARFUM"]) for n in notes]
    rows += [("Glycerin | Parfum * Talc · Mica • Silica", ["GLYCERIN", "PARFUM", "TALC", "MICA", "SILICA"]),
             ("Glycerin, CI 77891, ab, Talc", ["GLYCERIN", "TALC"])]  # colour index numbers and short tokens go
    df = spark.createDataFrame([(r[0],) for r in rows], "t string")
    got = [r[0] for r in df.select(ingredient_array(F.col("t"))).collect()]
    assert [(t, g, w) for (t, w), g in zip(rows, got, strict=True) if g != w] == []
