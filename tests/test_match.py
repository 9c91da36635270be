"""The sparse join against an independent dense computation."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import match, nest, weigh
from kindred.plans import catalogue as job
from kindred.session import materialise

SCHEMA = "product_id string, ingredient string, position int"


def dense_ranking(rows, products, n=3, ceiling=0.9999, pad=True):
    """Plain NumPy over the whole matrix; ties by id on twelve places."""
    cells = {}
    for p, i, pos in rows:
        cells[p, i] = min(pos, cells.get((p, i), 10 ** 9))
    ids = sorted({p for p, _ in cells})
    words = sorted({i for _, i in cells})
    freq = defaultdict(int)
    for _, i in cells:
        freq[i] += 1
    matrix = np.zeros((len(ids), len(words)))
    for (p, i), pos in cells.items():
        matrix[ids.index(p), words.index(i)] = math.log(len(ids) / freq[i]) / pos
    unit = matrix / (np.linalg.norm(matrix, axis=1, keepdims=True) + 1e-10)
    cosine = unit @ unit.T
    brand = {p: (b or "nan").upper() for p, _, b in products}
    out = {}
    queries = [p for p, s, _ in products if s == "query"]
    others = [p for p, s, _ in products if s == "match"]
    for q in queries:
        scored = []
        for m in others:
            s = float(cosine[ids.index(q), ids.index(m)])
            if s >= ceiling or brand[q] == brand[m] or (s <= 0 and not pad):
                continue
            scored.append((-round(s, 12), m))
        out[q] = [(m, pytest.approx(-s, abs=1e-9)) for s, m in sorted(scored)[:n]]
    return {q: v for q, v in out.items() if v}


def ranked(spark, rows, products, parts=4, **options):
    silver = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    got = match.rank_matches(weigh.weigh(silver), sides.repartition(parts), **options).collect()
    out = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.match_id, r.similarity))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def catalogue(seed, n, words, brands, hot=(), copies=0.0, length=(1, 7)):
    rng = random.Random(seed)
    rows, products, lists = [], [], []
    for k in range(n):
        if lists and rng.random() < copies:
            chosen = lists[0] if rng.random() < 0.7 else rng.choice(lists)
        else:
            chosen = [h for h in hot if rng.random() < 0.8]
            chosen += rng.sample(words, rng.randint(*length))
        lists.append(chosen)
        p = f"p{k:04d}"
        rows += [(p, w, i + 1) for i, w in enumerate(chosen)]
        products.append((p, "query" if k % 2 == 0 else "match", rng.choice(brands)))
    return rows, products


WORDS = [f"w{i}" for i in range(30)]
BRANDS = ["acme", "ACME", "bolt", "Cora", None]


@pytest.mark.parametrize("seed, options", [
    (1, {}), (2, {"hot": ("aqua", "glycerin")}), (3, {"copies": 0.5}),
    (4, {"hot": ("aqua",), "copies": 0.3, "length": (0, 3)}),
])
def test_equals_dense_computation(spark, monkeypatch, seed, options):
    monkeypatch.setattr(match, "SHORT_LIST", 4)  # so that small data has long lists, too
    monkeypatch.setattr(match, "BANDED_LENGTH", 8)
    rows, products = catalogue(seed, 120, WORDS, BRANDS, **options)
    known = {p for p, _, _ in rows}
    products = [p for p in products if p[0] in known]
    assert ranked(spark, rows, products) == dense_ranking(rows, products)


def test_long_lists_with_default_limits(spark):
    rows, products = catalogue(9, 700, WORDS[:6], ["a", "b", "c"], hot=("aqua",), length=(2, 5))
    assert ranked(spark, rows, products) == dense_ranking(rows, products)


def test_one_brand_holds_most_products(spark, monkeypatch):
    monkeypatch.setattr(match, "SHORT_LIST", 4)
    rows, products = catalogue(5, 100, WORDS, ["acme"] * 9 + ["bolt"], hot=("aqua",))
    assert ranked(spark, rows, products) == dense_ranking(rows, products)
    assert ranked(spark, rows, products, pad_zero=False) == dense_ranking(rows, products, pad=False)


def test_independent_of_partitioning(spark):
    rows, products = catalogue(6, 60, WORDS, BRANDS)
    one, seven = (ranked(spark, rows, products, parts=n) for n in (1, 7))
    assert {q: [(m, pytest.approx(s, abs=1e-12)) for m, s in v] for q, v in one.items()} == seven


def test_rules(spark):
    rows = [
        ("a1", "x", 1), ("a1", "y", 2), ("b1", "x", 1), ("b1", "y", 2),  # equal lists: skipped
        ("b2", "x", 1), ("b3", "x", 1), ("b3", "z", 2), ("b4", "y", 1),
        ("a2", "only", 1), ("b5", "other", 1), ("a3", "x", 1), ("b6", "z", 1),
    ]
    products = [("a1", "query", "Acme"), ("b1", "match", "Bolt"), ("b2", "match", "aCME"),
                ("b3", "match", "Bolt"), ("b4", "match", None), ("a2", "query", None),
                ("b5", "match", "Bolt"), ("a3", "query", "Zeta"), ("b6", "match", "Bolt")]
    got = ranked(spark, rows, products)
    assert [m for m, _ in got["a1"]] == ["b4", "b3", "b5"]  # b2 has the same brand
    assert got["a2"] == [("b1", 0.0), ("b2", 0.0), ("b3", 0.0)]  # b4 is brand-less as well
    assert [m for m, s in got["a3"] if s > 0] == ["b1", "b3"]  # b2 is the same product
    assert ranked(spark, rows, products, pad_zero=False).keys() == {"a1", "a3"}


def test_ingredient_of_every_product_weighs_nothing(spark):
    rows = [("a1", "aqua", 1), ("b1", "aqua", 1), ("b2", "aqua", 1), ("b2", "x", 2)]
    products = [("a1", "query", "a"), ("b1", "match", "b"), ("b2", "match", "c")]
    assert ranked(spark, rows, products) == {"a1": [("b1", 0.0), ("b2", 0.0)]}


def test_copies_cost_one_vector_and_common_words_few_pairs(spark):
    """A third of all products are copies, and every list starts with one word; the
    pair step must not grow with the square of either group."""
    rng = random.Random(3)
    rows, products = [], []
    for k in range(3000):
        p = f"p{k:05d}"
        rare = ["base"] if k % 3 == 0 else [f"r{rng.randrange(600)}" for _ in range(3)]
        words = rare + ["aqua"]
        rows += [(p, w, i + 1) for i, w in enumerate(dict.fromkeys(words))]
        products.append((p, "query" if k % 2 else "match", f"brand{rng.randrange(50)}"))
    rows += [("none", "zzz", 1)]  # so that the common word weighs something
    silver = spark.createDataFrame(rows, SCHEMA)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    vectors = match.build_vectors(weigh.weigh(silver), sides)
    profiles = vectors.features.select("side", "profile").distinct().count()
    assert profiles < 2100  # 1000 copies fell into two profiles
    floors = match.query_floors(vectors, match.representatives(vectors.members, 3), 3, 0.9999)
    pairs = match.met_pairs(vectors.features, floors).count()
    assert pairs < 1500 * 1500 / 40


def test_brand_lines_form_few_pairs(spark):
    """Products of a brand share their leading ingredients, so the nearest ones are all
    of the own brand. Pairs must stay few and grow with the products, not their square."""
    kept = []
    for count in (1000, 2000):
        rng = random.Random(7)
        rows, products = [], []
        for k in range(count):
            brand = k % 20
            words = [f"line{brand}-{i}" for i in range(6)] + [f"common{i}" for i in range(3)]
            words += [f"r{rng.randrange(count // 4)}" for _ in range(6)]
            rng.shuffle(words)
            rows += [(f"p{k:05d}", w, i + 1) for i, w in enumerate(dict.fromkeys(words))]
            products.append((f"p{k:05d}", "query" if (k // 20) % 2 else "match", f"brand{brand}"))
        silver = spark.createDataFrame(rows, SCHEMA)
        sides = spark.createDataFrame(products, "product_id string, side string, brand string")
        vectors = match.build_vectors(weigh.weigh(silver), sides, same_brand=False)
        floors = match.query_floors(vectors, match.representatives(vectors.members, 3), 3, 0.9999)
        assert floors.filter("floor > 0").count() > 0.95 * count / 2
        kept.append(match.met_pairs(vectors.features, floors, same_brand=False).count())
    assert kept[0] < 0.1 * 500 ** 2 and kept[1] < 0.05 * 1000 ** 2
    assert kept[1] < 3 * kept[0]


def test_pairs_above_a_floor(spark, monkeypatch):
    monkeypatch.setattr(match, "SHORT_LIST", 3)
    monkeypatch.setattr(match, "BANDED_LENGTH", 6)
    rows, products = catalogue(8, 80, WORDS[:12], BRANDS, copies=0.3)
    silver = spark.createDataFrame(rows, SCHEMA)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    weights = defaultdict(dict)
    for r in weigh.weigh(silver).collect():
        weights[r.product_id][r.ingredient] = r.tfidf
    norm = {p: math.sqrt(sum(w * w for w in v.values())) + 1e-10 for p, v in weights.items()}
    wanted = {}
    for q, s, _ in products:
        for m, t, _ in products:
            if s == "query" and t == "match":
                dot = sum(w * weights[m].get(i, 0) for i, w in weights[q].items())
                if dot / norm[q] / norm[m] >= 0.4:
                    wanted[q, m] = pytest.approx(dot / norm[q] / norm[m], abs=1e-9)
    got = match.cosine_pairs(weigh.weigh(silver), sides, 0.4).collect()
    assert {(r.query_id, r.match_id): r.similarity for r in got} == wanted
    with pytest.raises(ValueError):
        match.cosine_pairs(weigh.weigh(silver), sides, 0.0)


def test_missing_positions(spark):
    rows = spark.createDataFrame([("a", "x", "1"), ("a", "y", "n/a"), ("b", "x", None)],
                                 "product_id string, ingredient string, position string")
    got = {(r.product_id, r.ingredient): r.tf for r in weigh.weigh(rows).collect()}
    assert got == {("a", "x"): 1.0, ("a", "y"): 1 / 999, ("b", "x"): 1 / 999}


def near_equal(n_cluster, seed=1, others=40, brands=7):
    """Two families of lists that differ in a far tail only, split over both sides, and others."""
    rng = random.Random(seed)
    rows, products = [], []
    for k in range(n_cluster + others):
        p = f"p{k:05d}"
        if k < n_cluster:
            base = [f"f{k % 2}-{i}" for i in range(6)]
            rows += [(p, w, i + 1) for i, w in enumerate(base)]
            rows += [(p, f"tail{rng.randrange(n_cluster)}", rng.randint(1500, 2500)) for _ in range(3)]
        else:
            words = [f"f{k % 2}-{rng.randrange(6)}"] * (k % 3 == 0) + [f"o{rng.randrange(12)}" for _ in range(3)]
            rows += [(p, w, i + 1) for i, w in enumerate(dict.fromkeys(words))]
        products.append((p, "query" if (k // 2) % 2 else "match", f"b{rng.randrange(brands)}"))
    return rows, products


@pytest.mark.parametrize("brands", [2, 7, 1000])
def test_nearly_equal_lists(spark, brands):
    rows, products = near_equal(120, brands=brands)
    assert ranked(spark, rows, products) == dense_ranking(rows, products)
    assert ranked(spark, rows, products, pad_zero=False) == dense_ranking(rows, products, pad=False)


def test_nearly_equal_lists_form_few_pairs(spark):
    kept = []
    for n in (400, 1600):
        rows, products = near_equal(n)
        silver = spark.createDataFrame(rows, SCHEMA)
        sides = spark.createDataFrame(products, "product_id string, side string, brand string")
        vectors = match.build_vectors(weigh.weigh(silver), sides, same_brand=False, ceiling=0.9999)
        reps = match.representatives(vectors.members, 3)
        floors = match.query_floors(vectors, reps, 3, 0.9999)
        compared = match.compared_clusters(vectors, floors, 0.9999)
        assert compared.filter("state = 'above'").count() >= 2
        kept.append(match.met_pairs(vectors.features, floors, same_brand=False, compared=compared).count())
    every = 2 * (1600 // 4) ** 2  # pairs within the families, that is nearly all there are
    assert kept[1] < 8 * kept[0] and kept[1] < every / 10


def test_places(spark):
    """Free places beside plain counting."""
    from kindred.operators import places

    rng = random.Random(4)
    blocked = {k: sorted(rng.sample(range(1, 60), rng.randint(0, 40))) for k in range(6)}
    got = places.free_places(
        spark.createDataFrame([(k, p) for k, v in blocked.items() for p in v], "k int, place long"),
        spark.createDataFrame([(k, n) for k in blocked for n in range(1, 30)], "k int, nth int"), ["k"]).collect()
    assert len(got) == 6 * 29
    for r in got:
        free = [p for p in range(1, 200) if p not in blocked[r.k]]
        assert r.place == free[r.nth - 1]


def test_places_in_a_hot_group(spark):
    from kindred.operators import places

    rows = [(i, "hot" if i % 10 else f"b{i}") for i in range(3000)]
    got = places.add_places(spark.createDataFrame(rows, "id long, brand string").repartition(5), ["id"],
                            {"overall": [], "in_brand": ["brand"]}, "t").collect()
    seen = defaultdict(int)
    for place, r in enumerate(sorted(got, key=lambda r: r.id), 1):
        seen[r.brand] += 1
        assert (r.overall, r.in_brand) == (place, seen[r.brand])


def test_padding_beyond_a_window_limit(spark):
    """One brand has nine tenths of the rows, and queries score with so many profiles that
    more than a thousand products per brand must be at hand."""
    rows, products = [], []
    for k in range(420):
        p = f"m{k:04d}"
        rows += [(p, "common", 1), (p, f"r{k}", 2)] if k < 400 else [(p, f"z{k}", 1)]
        products.append((p, "match", "big" if k % 10 else "small"))
    rows += [("q1", "common", 1), ("q1", "x", 2), ("q2", "y", 1)]
    products += [("q1", "query", "other"), ("q2", "query", "big")]
    got = ranked(spark, rows, products, n=3, ceiling=1e-5)
    assert got == dense_ranking(rows, products, ceiling=1e-5)
    assert [m for m, s in got["q1"]] == ["m0400", "m0401", "m0402"]


def test_short_lists_form_few_rows(spark):
    """Every list is short and most pairs share one ingredient alone: what n others of the
    same list beat goes where the list is opened, with the same answers."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(80)]
    rows, products = catalogue(11, 400, words, ["a", "b", "c", None], length=(1, 6), copies=0.1)
    silver = spark.createDataFrame(rows, SCHEMA)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    vectors = match.build_vectors(weigh.weigh(silver), sides, same_brand=False, ceiling=0.9999)
    assert not rng.choice(vectors.features.select("wide").distinct().collect()).wide
    fa, fb = match._sides(vectors.features)
    every = fa.join(fb, "ingredient").count()
    floors = match.query_floors(vectors, match.representatives(vectors.members, 3), 3, 0.9999, wide_only=True)
    assert floors.isEmpty()
    assert match.narrow_pairs(fa, fb, 3, 0.9999).count() < every / 3
    assert ranked(spark, rows, products) == dense_ranking(rows, products)


def test_bits_of_the_other_ingredients(spark):
    """Two profiles that share an ingredient and one more have a common bit, even where the
    two ingredients have the same bit; there are more ingredients than bits."""
    rows, products = catalogue(12, 60, [f"w{i}" for i in range(200)], ["a"], length=(40, 80))
    vectors = match.build_vectors(weigh.weigh(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(
        products, "product_id string, side string, brand string"))
    held = defaultdict(dict)
    for r in vectors.features.collect():
        held[r.profile][r.ingredient] = r.others
    for x in held.values():
        for y in held.values():
            both = x.keys() & y.keys()
            assert len(both) < 2 or all(x[i] & y[i] for i in both)


def test_shuffled_features_carry_one_brand(spark, monkeypatch):
    plans = {}

    def kept(df, label, **options):
        plans[label] = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return materialise(df, label, **options)

    monkeypatch.setattr(match, "materialise", kept)
    weighted = spark.createDataFrame(
        [(p, i, w) for p in range(8) for i, w in ((p // 4, 1.0), (9, 0.5))], "product_id long, ingredient long, tfidf double")
    products = spark.createDataFrame(
        [(p, "query" if p % 2 else "match", "x" if p < 4 else f"y{p}") for p in range(8)], "product_id long, side string, brand string")
    vectors = match.build_vectors(weighted, products, same_brand=False)
    shuffled = re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]", plans["features"])
    assert any("lead_brand" in columns for columns in shuffled)
    assert not any("only_brand" in columns for columns in shuffled)
    # 0 to 3 are copies of one brand on each side, 4 to 7 of two.
    assert {(r.profile, r.lead_brand, r.only_brand) for r in vectors.features.collect()} == {
        (0, "X", "X"), (1, "X", "X"), (4, "Y4", None), (5, "Y5", None)}


def test_lists_counted_with_the_weights(spark, monkeypatch):
    """Lists that are short by their products are not shuffled again; those that are long, or are a line of one
    of the brands of copies, are counted by profiles. The answers are the same."""
    monkeypatch.setattr(match, "SHORT_LIST", 4)
    shuffled = []

    def kept(df, label, **options):
        kept_rows = materialise(df, label, **options)
        if label == "features":
            shuffled.append(kept_rows.count())
        return kept_rows

    monkeypatch.setattr(match, "materialise", kept)
    rows, products = catalogue(21, 90, [f"w{i}" for i in range(120)], BRANDS, copies=0.2, length=(1, 4))
    # Copies of two brands whose list is a line of one brand on the other side, and rows for one list that is long.
    rows += [(f"c{k}", "line", 1) for k in range(4)] + [(f"l{k}", "long", k % 3 + 1) for k in range(12)]
    products += [(f"c{k}", "query" if k < 2 else "match", "acme" if k != 1 else "bolt") for k in range(4)]
    products += [(f"l{k}", "query" if k % 2 else "match", BRANDS[k % 5]) for k in range(12)]
    silver = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    got = defaultdict(list)
    for r in sorted(match.rank_matches(lambda listed: weigh.weigh(silver, products=listed), sides).collect(),
                    key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.match_id, r.similarity))
    assert dict(got) == dense_ranking(rows, products)
    assert 0 < shuffled[0] < len(set(rows)) / 2


def test_list_lengths(spark):
    cells = spark.createDataFrame([("a1", "x"), ("a2", "x"), ("b1", "x"), ("b2", "x"), ("a1", "y"), ("b1", "z"), ("un", "x")],
                                  "product_id string, ingredient string")
    products = spark.createDataFrame([("a1", "query", "K"), ("a2", "query", "k"), ("b1", "match", None), ("b2", "match", "k"),
                                      ("b2", "match", "m")], "product_id string, side string, brand string")
    got = {r.ingredient: r for r in match.list_lengths(cells, products, F.count("product_id").alias("n")).collect()}
    assert {i: (r.postings, r.n) for i, r in got.items()} == {"x": (2, 5), "y": (0, 1), "z": (0, 1)}
    assert got["x"].query_line is not None and got["x"].match_line is None
    assert got["x"].query_line == got["y"].query_line != got["z"].match_line


def test_cells_are_dealt_by_ingredient_once(spark):
    """Lists are counted where the cells meet their ingredient: no sums by task are shuffled beside them, which are
    as many rows as the cells in a large catalogue. The counts are those of ``list_lengths``."""
    rows, products = catalogue(31, 80, WORDS, BRANDS, length=(1, 4))
    products += [("p0001", "match", "other"), ("p0002", "match", "acme"), ("p0003", "query", None)]
    silver = spark.createDataFrame(rows, SCHEMA)
    sides = spark.createDataFrame(products, "product_id string, side string, brand string")
    weighted = weigh.weigh(silver, products=sides)
    plan = weighted._sc._jvm.PythonSQLUtils.explainString(weighted._jdf.queryExecution(), "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(ingredient", plan)) == 1
    plain = {(r.product_id, r.ingredient): r.tfidf for r in weigh.weigh(silver).collect()}
    lists = {r.ingredient: r for r in match.list_lengths(weigh.cells(silver), sides).collect()}
    named = {r.h for r in sides.select(F.xxhash64(match.brand_key("brand")).alias("h")).collect()}
    got = weighted.collect()
    assert {(r.product_id, r.ingredient): r.tfidf for r in got} == plain
    for r in got:
        known = lists[r.ingredient]
        assert r.postings == known.postings
        for line in ("match_line", "query_line"):  # a hash of several brands is no brand's
            assert known[line] == (r[line] if r[line] in named else None)


@pytest.mark.parametrize("seed, options", [(1, {}), (3, {"copies": 0.5}), (4, {"hot": ("aqua",), "copies": 0.3, "length": (0, 3)})])
@pytest.mark.parametrize("short", [4, 32])
def test_copies_that_stay_apart(spark, monkeypatch, seed, options, short):
    """Where copies are few, nothing is written again for them and no representative is looked up."""
    monkeypatch.setattr(match, "SHORT_LIST", short)
    monkeypatch.setattr(match, "BANDED_LENGTH", 8)
    monkeypatch.setattr(match, "FEW_COPIES", 1000)
    monkeypatch.setattr(match, "RARE_COPIES", 0)
    written = []
    monkeypatch.setattr(match, "materialise", lambda df, label, **o: written.append(label) or materialise(df, label, **o))
    rows, products = catalogue(seed, 120, WORDS, BRANDS, **options)
    known = {p for p, _, _ in rows}
    products = [p for p in products if p[0] in known]
    assert ranked(spark, rows, products) == dense_ranking(rows, products)
    assert not {"profiles", "copied", "representatives", "large"} & set(written)


def test_which_copies_stay_apart(spark):
    def built(rows, products):
        return match.build_vectors(weigh.weigh(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(
            products, "product_id string, side string, brand string"), same_brand=False)

    rows = [(f"p{k:03d}", f"w{(k // 2) % 60}", 1) for k in range(160)] + [(f"p{k:03d}", f"x{k // 4}", 2) for k in range(160)]
    products = [(f"p{k:03d}", "query" if k % 2 else "match", f"b{k % 7}") for k in range(160)]
    few = [("c1", "w1", 1), ("c2", "w1", 1)], [("c1", "match", "b1"), ("c2", "match", "b2")]
    vectors = built(rows + few[0], products + few[1])
    assert vectors.single and vectors.members.filter("profile != product_id").isEmpty()
    many = [(f"c{k}", "w1", 1) for k in range(10)], [(f"c{k}", "match", "b1") for k in range(10)]
    vectors = built(rows + many[0], products + many[1])
    assert not vectors.single and vectors.members.filter("profile = 'c0'").count() == 10
    # A product of two brands has one profile, which is of no one brand.
    vectors = built(rows, products + [("p000", "match", "other")])
    assert not vectors.single
    assert {r.only_brand for r in vectors.features.filter("profile = 'p000'").collect()} == {None}


def test_numbers_and_hashes_stand_for_ids_and_texts(spark, monkeypatch):
    """Gold goes through the matching without long ids or ingredient texts, and the answers are the same, ties and
    zero padding by the order of the ids included."""
    types = []
    rank = match.rank_matches

    def seen(weighted, products, **options):
        def weigh_it(listed):
            rows = weighted(listed)
            types.append((listed.schema["product_id"].dataType, rows.schema["product_id"].dataType, rows.schema["ingredient"].dataType))
            return rows
        return rank(weigh_it, products, **options)

    monkeypatch.setattr(match, "rank_matches", seen)
    rows, products = catalogue(41, 110, WORDS, BRANDS, copies=0.3, hot=("aqua",), length=(1, 5))
    rows = [(p[::-1], w, i) for p, w, i in rows] + [("9zzz", None, 1)]  # ids whose order is not that of the rows
    products = [(p[::-1], s, b) for p, s, b in products] + [("9zzz", "match", "bolt")]
    of = {p: (s, b) for p, s, b in products}
    silver = spark.createDataFrame(
        [(p, "a" if of[p][0] == "query" else "b", of[p][1], f"n{p}", 1.0, f"u{p}", w, i) for p, w, i in rows + rows[:40]],
        "product_id string, source string, brand string, product_name string, price_eur float, url string, "
        "ingredient string, position int").repartition(4)
    for pad in (False, True):
        gold = job.gold_rows(silver, pad_zero=pad).collect()
        plain = rank(weigh.weigh(silver), nest.sides(nest.first_per_product(silver), "a", "b"), pad_zero=pad).collect()
        assert sorted((r.query_id, r.rank, r.match_id, r.cosine_similarity) for r in gold) == sorted(
            (r.query_id, r.rank, r.match_id, pytest.approx(r.similarity, abs=1e-4)) for r in plain)
        assert all((r.query_url, r.match_url) == (f"u{r.query_id}", f"u{r.match_id}") for r in gold)
    assert {t.simpleString() for seen_types in types for t in seen_types} == {"bigint"}


def test_ingredients_of_one_hash_are_told_apart(spark):
    cells = spark.createDataFrame([(1, 7, 1, 1.0, 5, None), (2, 7, 1, 1.0, None, 6), (1, 7, 2, 2.0, 5, None), (2, 8, 1, 2.0, None, 6)],
                                  "product_id long, ingredient long, second long, position double, held_by long, asked_by long")
    got = match.counted_lists(cells, "second").collect()
    assert sorted((r.product_id, r.position, r.doc_freq, r.postings) for r in got) == [
        (1, 1.0, 2, 1), (1, 2.0, 1, 0), (2, 1.0, 2, 1), (2, 2.0, 1, 0)]
    assert len({r.ingredient for r in got}) == 3 and [r.ingredient for r in got if r.position == 2.0 and r.product_id == 2] == [8]


def test_numbered_weights_are_the_weights(spark):
    rows, products = catalogue(43, 60, WORDS, BRANDS, length=(1, 4))
    silver = spark.createDataFrame(rows, SCHEMA)
    numbered = nest.with_numbers(spark.createDataFrame(products, "product_id string, side string, brand string"))
    listed = numbered.select(F.col("number").alias("product_id"), "side", "brand")
    weighted = weigh.weigh_numbered(silver, numbered, listed)
    by_id = {r.number: r.product_id for r in numbered.collect()}
    got = sorted((by_id[r.product_id], r.position, r.doc_freq, round(r.tfidf, 12), r.postings) for r in weighted.collect())
    plain = weigh.weigh(silver, products=listed.join(numbered.select("product_id", "number").withColumnRenamed("product_id", "id"),
                                                     F.col("product_id") == F.col("number")).select(
        F.col("id").alias("product_id"), "side", "brand"))
    assert got == sorted((r.product_id, r.position, r.doc_freq, round(r.tfidf, 12), r.postings) for r in plain.collect())


def mostly_own(seed, n):
    """Lists whose first ingredients no other product has, as sentences of texts: the shared ones weigh little."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows, products = [], []
    for k in range(n):
        p = f"p{k:04d}"
        own = rng.choice((0, 2, 6, 12))
        rows += [(p, f"{p}-{i}", i + 1) for i in range(own)]
        rows += [(p, w, own + i + 1) for i, w in enumerate(rng.sample(words, rng.randint(2, 9)))]
        products.append((p, "query" if k % 2 == 0 else "match", rng.choice(BRANDS)))
    return rows, products


def test_light_shared_ingredients(spark, monkeypatch):
    """Where most of a vector is its own, floors and bands go by the shared part, and what is met proves floors before it
    is written: few pairs are left."""
    monkeypatch.setattr(match, "SHORT_LIST", 4)
    monkeypatch.setattr(match, "BANDED_LENGTH", 8)
    written = {}

    def kept(df, label, **how):
        out = materialise(df, label, **how)
        written[label] = out.count()
        return out

    monkeypatch.setattr(match, "materialise", kept)
    rows, products = mostly_own(51, 300)
    assert ranked(spark, rows, products, pad_zero=False) == dense_ranking(rows, products, pad=False)
    queries = sum(s == "query" for _, s, _ in products)
    assert written["met"] < 8 * queries
    assert written["probes"] < 60 * queries
