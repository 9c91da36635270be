import dataclasses

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kindred import schemas, session
from kindred.operators import bronze, nest, profile, quality, view, weigh
from kindred.plans import catalogue
from kindred.sources import tables
from kindred.streaming import arrivals

LISTING_A = "﻿brand;series;product_type;price;uvp_price;base_price;url\n" + "".join(
    f"{b};{s};Creme;{p};;;{u}\n" for b, s, p, u in [
        ("Luxe", "Rich ""Cream""", "45,50 €", "u1"), ("Luxe", "Light Gel", "ab 30,00 €", "u2"),
        ("Nova", "Gold", "12 €", "u3"), ("Nova", "No list", "9,99 €", "u4"), ("X", "No url", "1,00 €", "")])
INGREDIENTS_A = '﻿url,brand,product_name,ingredients\n' + "".join(
    f'{u},x,y,"{i}"\n' for u, i in [
        (" u1 ", "Ingredients: Aqua, Glycerin, Retinol, ""Gold"" Dust"), ("u2", "Aqua, Niacinamide, Panthenol"),
        ("u3", "Aqua, Gold Powder"), ("u4", "  ")])
MERGED_B = "product_url,brand,product_name,price,ingredients,rating_search,review_count_search\n" + "".join(
    f'{u},{b},{n},"{p}","{i}",{r},3\n' for u, b, n, p, i, r in [
        ("v1", "Budget", "Dupe One", "3,95 €", "Water, Glycerin, Retinol", "4.5"),
        ("v2", "Budget", "Dupe Two", "2,45 €", "Aqua, Niacinamide", "n/a"),
        ("v3", "LUXE", "Own brand", "5,00 €", "Aqua, Glycerin, Retinol, Wax", ""),
        ("v4", "Plain", "Oil", "1,95 €", "Olive Oil, Tocopherol", "4")])


@pytest.fixture(scope="module")
def layout(tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    for name, content in (("a.csv", LISTING_A), ("i.csv", INGREDIENTS_A), ("b.csv", MERGED_B)):
        (root / name).write_text(content, encoding="utf-8")
    return catalogue.Layout(*[str(root / n) for n in ("a.csv", "i.csv", "b.csv", "silver", "gold", "serving")])


def test_whole_job(spark, layout):
    assert catalogue.run(spark, layout) == 3
    silver = tables.read_silver(spark, layout.silver)
    assert silver.schema == schemas.SILVER
    assert silver.filter("source = 'a'").select("product_id").distinct().count() == 3
    prices = {r.url: r.price_eur for r in silver.select("url", "price_eur").distinct().collect()}
    assert prices["u1"] == pytest.approx(45.5) and prices["u3"] is None
    gold = tables.read_gold(spark, layout.gold)
    assert gold.schema == schemas.GOLD
    assert nest.same_brand_rows(gold).isEmpty()
    rows = {(r.query_url, r.rank): (r.match_url, r.cosine_similarity) for r in gold.collect()}
    assert rows["u1", 1][0] == "v1" and rows["u2", 1][0] == "v2"
    assert all((u, 3) in rows for u in ("u1", "u2", "u3"))
    items = tables.read_serving(spark, layout.serving)
    assert items.schema == schemas.SERVING
    found = view.browse(items, "rich", similarity=0.1).collect()
    assert [r.product_name for r in found] == ["Rich Cream"]
    save = view.savings(items).filter("rank = 1").collect()
    assert "Save €41.55" in {r.savings_label for r in save}
    assert view.statistics(items).first().products == 3


def test_csv_round_trip_keeps_quotes(spark, tmp_path):
    rows = spark.createDataFrame([('say "hi"; x', None), ("a,b", "c")], "p string, q string")
    tables.write_bronze(rows, str(tmp_path / "t"), sep=";")
    back = tables.read_bronze(spark, str(tmp_path / "t"), sep=";", columns=["p", "q"])
    assert sorted(map(tuple, back.collect())) == [("a,b", "c"), ('say "hi"; x', None)]
    with pytest.raises(ValueError):
        tables.require_columns(back, ["missing"])


def test_silver_csv_and_gold_casts(spark, tmp_path):
    silver = spark.createDataFrame([("p", "a", "NA", "n", 1.5, "u", "X", 2)], schemas.SILVER)
    tables.export_csv(silver, str(tmp_path / "s"))
    back = tables.read_silver_csv(spark, str(tmp_path / "s"))
    assert back.schema == schemas.SILVER
    assert tuple(back.first()) == ("p", "a", None, "n", 1.5, "u", "X", 2)


def test_stable_ids_do_not_depend_on_partitioning(spark, monkeypatch):
    monkeypatch.setattr(bronze, "COPIES_PER_TASK", 3)
    rows = spark.createDataFrame([("u", "x")] * 11 + [("u", "y")] * 2 + [("v", None)], "url string, t string")
    ids = [sorted(r.product_id for r in bronze.add_stable_id(rows.repartition(n), "a").collect())
           for n in (1, 5)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 14
    assert len({r.product_id for r in bronze.add_running_id(rows, "a").collect()}) == 14


def test_dropped_rows_are_counted_by_the_same_job(spark):
    rows = spark.createDataFrame([("u", "x"), ("v", " "), ("w", None)], "url string, ingredients_raw string")
    seen = Observation("missing")
    assert bronze.with_text(rows, observation=seen).count() == 1
    assert seen.get == {"dropped": 2, "rows": 3}


def test_optional_columns(spark):
    merged = spark.createDataFrame([("u", "b", "n", "1,50", "Aqua, Oil", "4.5x", "7")], schemas.MERGED_B)
    row = bronze.to_silver(bronze.listings_b(merged, with_ratings=True), "b",
                           optional=("rating", "review_count")).first()
    assert row.rating is None and row.review_count == "7"


def gold_row(query, rank, sim, price=10.0, other=4.0, brand="A", name="N"):
    return (query, name, brand, price, "u", f"m{rank}", f"M{rank}", "B", other, "w", sim, rank)


def test_items_and_views(spark):
    gold = spark.createDataFrame([
        gold_row("1", 2, 0.5, other=None), gold_row("1", 1, 0.9), gold_row("2", 1, 0.7, price=0.0),
        gold_row("3", 1, 0.2, price=3.0, brand=None, name="100% Oil"), gold_row("3", 2, 0.1, other=3.0, name="100% Oil")],
        schemas.GOLD)
    items = nest.nest_matches(gold).cache()
    assert [m.rank for m in items.filter("item_key = '1'").first().top_matches] == [1, 2]
    assert items.filter("item_key = '3'").first().brand == "nan"
    none = items.limit(1).withColumn("item_key", F.lit("4")).withColumn(
        "top_matches", F.filter("top_matches", lambda m: F.lit(False)))
    items = items.unionByName(none)
    keys = lambda df: [r.item_key for r in df.collect()]
    assert keys(view.by_similarity(items)) == ["1", "2", "3", "4"]
    assert keys(view.search(items, "100% o")) == ["3"] and keys(view.search(items, "_")) == []
    assert len(keys(view.search(items, ""))) == 4 and len(keys(view.of_brand(items))) == 4
    assert sorted(keys(view.at_least(items, 0.7))) == ["1", "2"] and len(keys(view.at_least(items, 0))) == 4
    labels = {(r.item_key, r.rank): r.savings_label for r in view.savings(items).collect()}
    assert labels == {("1", 1): "Save €6.00", ("1", 2): None, ("2", 1): None, ("3", 1): "+€1.00",
                      ("3", 2): "+€0.00"}
    texts = {(r.item_key, r.rank): (r.match_percent, r.product_price, r.match_price)
             for r in view.labels(items).collect()}
    assert texts["1", 2] == (50, "€10.00", "—") and texts["2", 1][1] == "Price unavailable"
    stats = view.statistics(items).first()
    assert stats.products == 4 and stats.avg_similarity == pytest.approx((0.9 + 0.7 + 0.2) / 4)
    assert stats.avg_saving == pytest.approx(6.0)
    assert view.statistics(items.limit(0)).first().avg_saving == 0
    assert {r.brand: r["items"] for r in view.brands(items).collect()}["nan"] >= 1
    assert nest.matches_by_name(gold).filter("item_key = 'N'").count() == 3
    assert nest.flat_items(nest.floats(items)).count() == 5
    assert nest.gold_summary(gold).first().matched_products == 2


def test_profile_and_pivot(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1)],
                                 "product_id string, ingredient string, position int")
    weighted = weigh.weigh(rows)
    assert profile.sparsity(weighted).first().sparsity == pytest.approx(75.0)
    block = {r.product_id: r.y for r in profile.pivot_export(weighted, ["x", "y"]).collect()}
    assert block["b"] == 0.0 and block["a"] > 0
    assert profile.profile(rows, ["ingredient"]).first().distinct_ingredient == 2


def test_checks(spark):
    few = spark.range(3)
    report = {r.input: r for r in quality.check_min_rows({"few": few, "none": few.limit(0)}, {"few": 3}).collect()}
    assert report["few"].severity == "ok" and report["none"].severity == "warn"
    with pytest.raises(quality.QualityError):
        quality.require_rows(few.limit(0), "gold")
    with pytest.raises(quality.QualityError):
        quality.verify_count(few, 4)
    with pytest.raises(quality.QualityError):
        quality.check_min_rows({})


def test_arrivals_are_stored_once_and_refresh_over_everything(spark, tmp_path):
    landing, stored, progress = (str(tmp_path / n) for n in ("landing", "bronze", "progress"))
    seen = []

    def take():
        source = arrivals.watch(spark, landing, schemas.INGREDIENTS_A, header=True)
        arrivals.store_arrivals(source, stored, progress,
                                lambda all_rows, batch: seen.append(all_rows.count())).awaitTermination()

    rows = spark.createDataFrame([("u1", "b", "n", "Aqua")], schemas.INGREDIENTS_A)
    tables.write_bronze(rows, landing)
    take()
    take()  # nothing new
    tables.write_bronze(rows, landing, mode="append")
    take()
    assert seen == [1, 2]
    back = arrivals.read_arrivals(spark, stored, schemas.INGREDIENTS_A)
    assert {r.batch_id: r.rows for r in arrivals.count_arrivals(back).collect()} == {0: 1, 1: 1}


def test_arrivals_start_the_job(spark, layout, tmp_path):
    """Two files in two batches end in the gold of one run over everything."""
    catalogue.run(spark, layout)
    at = dataclasses.replace(layout, **{n: str(tmp_path / n) for n in ("silver", "gold", "serving")})
    rows = tables.read_bronze(spark, layout.listing_a, sep=";", columns=schemas.LISTING_A.fieldNames())
    landing = str(tmp_path / "landing")
    for part in (rows.filter("brand = 'Luxe'"), rows.filter("brand <> 'Luxe'")):
        tables.write_bronze(part.coalesce(1), landing, sep=";", mode="append")
    source = arrivals.watch(spark, landing, schemas.LISTING_A, header=True, sep=";", files_per_batch=1)
    arrivals.store_arrivals(source, str(tmp_path / "stored"), str(tmp_path / "progress"),
                            catalogue.on_arrival(at, "listing_a")).awaitTermination()
    stored = arrivals.read_arrivals(spark, str(tmp_path / "stored"), schemas.LISTING_A)
    assert arrivals.count_arrivals(stored).count() == 2
    columns = ("query_url", "rank", "match_url", "cosine_similarity")
    want, got = ({tuple(r) for r in tables.read_gold(spark, p).select(*columns).collect()} for p in (layout.gold, at.gold))
    assert got == want


def test_publishing_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        tables.current(spark, path)
    for n in (1, 2, 3):
        tables.publish(spark.range(n), path)
    def refuse(rows):
        raise ValueError(rows.count())
    with pytest.raises(ValueError):
        tables.publish(spark.range(9), path, check=refuse)
    assert spark.read.parquet(tables.current(spark, path)).count() == 3
    assert len(session.matching(spark, f"{path}/*")) == tables.KEPT_VERSIONS


def test_scratch_tables_go(spark):
    with session.scratch(spark):
        kept = session.materialise(spark.range(5), "trial")
        where = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert session.matching(spark, where)
    assert not session.matching(spark, where)


def test_increments_equal_one_run(spark, layout, tmp_path, monkeypatch):
    """Ten files in ten batches: every text is cleaned once, gold is that of one run over
    everything, and a batch that comes again changes nothing."""
    base = [("Luxe", "Creme", "x", "10,00 €", "", "", f"https://a.example/{i % 7}") for i in range(20)]
    rows = spark.createDataFrame(base, schemas.LISTING_A)
    texts = spark.createDataFrame(
        [(f"https://a.example/{i}", "Luxe", "Creme", f"Aqua, Glycerin, Oil {i % 3}, Extract {i}") for i in range(7)],
        schemas.INGREDIENTS_A)
    one = dataclasses.replace(layout, **{n: str(tmp_path / f"one-{n}") for n in
                                         ("listing_a", "ingredients_a", "silver", "gold", "serving")})
    tables.write_bronze(texts, one.ingredients_a)
    tables.write_bronze(rows, one.listing_a, sep=";")
    catalogue.run(spark, one)

    many = dataclasses.replace(one, **{n: str(tmp_path / f"many-{n}") for n in ("silver", "gold", "serving")})
    landing = str(tmp_path / "landing")
    for i in range(10):
        part = spark.createDataFrame(base[2 * i:2 * i + 2], schemas.LISTING_A)
        tables.write_bronze(part.coalesce(1), landing, sep=";", mode="append")
    cleaned = []
    clean = bronze.explode_ingredients
    monkeypatch.setattr(bronze, "explode_ingredients", lambda df, *a: cleaned.append(df.count()) or clean(df, *a))
    golds = []
    gold_rows = catalogue.gold_rows
    monkeypatch.setattr(catalogue, "gold_rows", lambda *a, **k: golds.append(1) or gold_rows(*a, **k))

    def take():
        source = arrivals.watch(spark, landing, schemas.LISTING_A, header=True, sep=";", files_per_batch=1)
        return catalogue.take_arrivals(spark, many, "listing_a", source, str(tmp_path / "stored"), str(tmp_path / "progress"))

    def gold(at):
        return sorted(map(tuple, tables.read_gold(spark, at.gold).collect()), key=str)

    assert take() == tables.read_serving(spark, one.serving).count()
    others = bronze.with_text(bronze.with_key(catalogue._listings(spark, many, {})[catalogue.SOURCE_B])).count()
    assert sum(cleaned) == 20 + others and len(cleaned) == 11 and len(golds) == 1
    assert gold(many) == gold(one)
    assert take() is None and len(golds) == 1
    # A batch is tried again after a failure.
    parts = catalogue.Parts(spark, f"{many.silver}-parts")
    before = sorted(map(tuple, parts.silver().collect()), key=str)
    batch = arrivals.read_arrivals(spark, str(tmp_path / "stored"), schemas.LISTING_A).filter("batch_id = 4").drop("batch_id")
    parts.add(catalogue._listings(spark, many, {"listing_a": batch})[catalogue.SOURCE_A], catalogue.SOURCE_A, 4)
    assert sorted(map(tuple, parts.silver().collect()), key=str) == before


def test_half_written_versions_and_two_writers(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/v-broken")  # a writer that broke off before its manifest
    spark.range(8).write.parquet(f"{path}/v-cut")
    text = session.read_small(spark, f"{tables.current(spark, path)}/{tables.MANIFEST}")
    session.write_new(spark, f"{path}/v-cut/{tables.MANIFEST}", text.replace('"version": 1', '"version": 7')[:-4])
    assert tables.read_published(spark, path, spark.range(1).schema).count() == 3
    # Another writer commits between our write and our manifest: both numbers count on.
    tables.publish(spark.range(4), path, check=lambda rows: tables.publish(spark.range(5), path))
    assert [v.rows for v in tables.versions(spark, path)] == [5, 4]
    assert tables.read_published(spark, path, spark.range(1).schema).count() == 4
    # Two writers that saw the same versions take one number: one of them is read, whole.
    last = tables.last_version(spark, path)
    for name, n in (("v-x", 6), ("v-y", 7)):
        spark.range(n).write.parquet(f"{path}/{name}")
        files = [f for f in session.files_below(spark, f"{path}/{name}") if f.endswith(".parquet")]
        session.write_new(spark, f"{path}/{name}/{tables.MANIFEST}", tables._manifest(last.number + 1, n, files))
    assert tables.read_published(spark, path, spark.range(1).schema).count() == 7
    with pytest.raises(Exception, match="exist"):
        session.write_new(spark, f"{path}/v-y/{tables.MANIFEST}", "")
    # A stray file in the folder is not read.
    spark.range(100).coalesce(1).write.mode("append").parquet(f"{path}/v-y")
    assert tables.read_published(spark, path, spark.range(1).schema).count() == 7
    assert tables.remove_unfinished(spark, path) == 2


def test_ids_shuffle_no_texts(spark):
    rows = spark.createDataFrame([(f"u{i % 5}", "text " * (i % 5)) for i in range(12)] + [("v", None)], "url string, t string")
    got = bronze.add_stable_id(rows, "a")
    ids = sorted(r.product_id for r in got.collect())
    assert len(set(ids)) == 13
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k1" in plan and "hashpartitioning(url" not in plan and "hashpartitioning(t" not in plan
    first, second = rows.limit(7), rows.exceptAll(rows.limit(7))
    later = bronze.add_stable_id(second, "a", earlier=bronze.copy_counts(first))
    assert sorted(r.product_id for r in bronze.add_stable_id(first, "a").union(later).collect()) == ids


def test_balanced_by_bytes(spark, monkeypatch):
    from kindred.operators import balance as b

    monkeypatch.setattr(b, "LEAST_BYTES", 0)
    rows = spark.createDataFrame([(i, "x" * (20_000 if i < 8 else 50)) for i in range(2000)] + [(-1, None)], "i int, t string")
    dealt = b.balance(rows.coalesce(1), "t")
    assert dealt.columns == ["i", "t"]
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(
        F.sum(F.coalesce(F.length("t"), F.lit(0)) + b.ROW_BYTES).alias("n")).collect()]
    assert max(sizes) < 2.5 * sum(sizes) / 8 and dealt.exceptAll(rows).isEmpty() and dealt.count() == 2001
    assert b.balance(rows.limit(0), "t").count() == 0


def test_pivot_in_blocks(spark):
    rows = spark.createDataFrame([(f"p{i}", f"w{(i * j) % 23:02d}", j + 1) for i in range(12) for j in range(5)],
                                 "product_id string, ingredient string, position int")
    weighted = weigh.weigh(rows).cache()
    columns = profile.pivot_columns(weighted, 4)
    names = {r.block * 4 + r.place: r.ingredient for r in columns.collect()}
    assert [names[i] for i in range(len(names))] == sorted(set(names.values()))
    cells = {(r.product_id, r.ingredient): r.tfidf for r in weighted.collect()}
    seen = {}
    for r in profile.pivot_blocks(weighted, columns, 4).collect():
        assert len(r["values"]) == 4
        for i, v in enumerate(r["values"]):
            if 4 * r.block + i in names:
                seen[r.product_id, names[4 * r.block + i]] = v
            else:
                assert v == 0.0
    assert all(seen[k] == v for k, v in cells.items())
    assert all(v == 0.0 for k, v in seen.items() if k not in cells)


def test_profiles_do_not_copy_rows(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1), (None, None, 1)],
                                 "product_id string, ingredient string, position int")
    for df in (profile.profile(rows, ["product_id", "ingredient"]), profile.sparsity(weigh.weigh(rows))):
        row = df.first().asDict()
        assert {row.get("products", 2), row.get("ingredients", 2), row.get("distinct_product_id", 2)} == {2}
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    empty = profile.profile(rows.limit(0), ["ingredient"]).first()
    assert (empty.rows, empty.distinct_ingredient) == (0, 0)


def test_nesting_after_the_look_ups_needs_no_shuffle(spark):
    """Rows come by query from the last look-up, whatever type the ids have there."""
    products = spark.createDataFrame(
        [(k, "ab"[k % 2], f"n{k}", 1.5 * k, f"u{k}") for k in range(8)],
        "product_id long, brand string, product_name string, price_eur double, url string")
    ranked = spark.createDataFrame([(0, 1, 0.5, 1), (0, 3, 0.25, 2), (2, 5, 0.0, 1)],
                                   "query_id long, match_id long, similarity double, rank int")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        gold = nest.attach_attributes(ranked, products)
        items = nest.nest_matches(gold)
        exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (gold, items)]
        assert exchanges[0] == exchanges[1]
        got = {r.item_key: (r.product_name, [m.product_name for m in r.top_matches]) for r in items.collect()}
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    assert got == {"0": ("n0", ["n1", "n3"]), "2": ("n2", ["n5"])}


def test_texts_without_a_copy_are_not_shuffled_for_their_ids(spark):
    """The repeated contents are known before the texts are read again, whatever the planner takes for small."""
    rows = spark.createDataFrame([(f"u{i % 40}", f"text {i % 40}") for i in range(43)], "url string, t string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = bronze.add_stable_id(rows, "a")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert len({r.product_id for r in got.collect()}) == 43
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def test_repeated_contents_beyond_those_looked_up(spark, monkeypatch):
    rows = spark.createDataFrame([(f"u{i % 20}", f"text {i % 20}") for i in range(33)], "url string, t string")
    ids = sorted(r.product_id for r in bronze.add_stable_id(rows, "a").collect())
    monkeypatch.setattr(bronze, "LOOKED_UP", 1)
    assert sorted(r.product_id for r in bronze.add_stable_id(rows, "a").collect()) == ids and len(set(ids)) == 33


def test_numbers_keep_the_order_of_ids(spark):
    products = spark.createDataFrame([(f"p{i * 7919 % 1000}", str(i)) for i in range(1000)], "product_id string, brand string")
    got = sorted(nest.with_numbers(products.repartition(7)).collect(), key=lambda r: r.number)
    assert [r.product_id for r in got] == sorted(f"p{i}" for i in range(1000))
    assert {(r.product_id, r.brand) for r in got} == {tuple(r) for r in products.collect()}


def test_tables_on_the_way_go(spark):
    made = []

    def make():
        made.append(session.materialise(spark.range(5), "way").inputFiles()[0])
        return spark.read.parquet(made[0].rsplit("/", 1)[0]).withColumn("x", F.col("id") * 2)

    kept = session.materialise_alone(make, "kept")
    assert kept.count() == 5 and not session.files_below(spark, session.shared_dir(spark)).count(made[0].split("/kindred/")[-1])
    assert not session.matching(spark, made[0])


def test_shuffle_files_go_with_the_job(spark):
    before = spark.conf.get(session.CLEANUP_KEY, None)
    rows = spark.range(1000).selectExpr("id % 7 AS k").repartition("k").groupBy("k").count()
    assert session.materialise(rows, "counted").count() == 7
    assert spark.conf.get(session.CLEANUP_KEY, None) == before
