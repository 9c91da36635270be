"""Columns of the input that bear the names operators use inside, repeated rows that
differ in other columns, ids that are text, and measures beside plain computations."""

import random

import numpy as np
from pyspark.sql import functions as F

from kindred.llm import decontaminate, near_dedup, quality_knn, quality_rules, shards, substring
from tests.llm import brute
from tests.llm.test_text_operators import prose

INSIDE = ("n_words", "symbol_share", "symbol_share_max", "mean_word_min", "kept", "row", "limits", "own", "_w", "_l",
          "_marks", "_upper", "_lang", "_row_1", "_row_2", "row_1", "root", "_p", "_i", "_places", "_items", "held",
          "_own", "_copy", "_first_id", "a.b", "na`me")


def dressed(df):
    """``df`` with a text under every name in ``INSIDE``."""
    for name in INSIDE:
        df = df.withColumn(name, F.concat(F.lit(f"own {name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return df


def same_rows(got, want):
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_clashing_columns_come_back_as_they_were(spark):
    rows = [(i, prose(i, 60), "en", "s") for i in range(70)] + [(90, "too short", "en", None)]
    docs = dressed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).cache()
    same_rows(quality_rules.keep_good(docs), docs.filter("doc_id < 70"))
    same_rows(near_dedup.keep_one(docs.unionByName(docs.filter("doc_id < 9"))), docs)
    items = spark.createDataFrame([(i, prose(i, 60)) for i in range(3)], "item_id long, text string")
    same_rows(decontaminate.clean(docs, items), docs.filter("doc_id > 2"))
    for block_bytes in (1 << 20, 300):  # one automaton, or one for each item
        found = decontaminate.find(docs, items, block_bytes=block_bytes)
        kept = [c for c in docs.columns if c not in decontaminate.RESULT]
        assert found.columns == [*kept, *decontaminate.RESULT]
        quoted = [F.col("`" + c.replace("`", "``") + "`") for c in kept]
        same_rows(found.select(*quoted), docs.select(*quoted))
        assert {r.doc_id for r in found.filter("n_hit = 60").collect()} == {0, 1, 2}


def test_repeated_rows_that_differ_elsewhere(spark):
    rows = [(1, prose(1, 30), source, n) for source, n in (("b", 1), ("a", 2), (None, 3), ("c", 4))] * 2
    kept = {tuple(map(tuple, near_dedup.keep_one(
        spark.createDataFrame(pick, "doc_id long, text string, source string, n int").repartition(parts)).collect()))
        for parts, pick in ((1, rows), (3, rows[::-1]), (2, rows[3:] + rows[:3]))}
    assert len(kept) == 1 and len(next(iter(kept))) == 1


def test_ids_that_are_text(spark):
    rows = [("7", prose(1, 40)), ("x-1", prose(1, 40)), ("x-2", prose(2, 40)), (None, prose(3, 40)), ("8", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = shards.assign(docs, 40).collect()
    assert len(got) == 5 and len({r.doc_id for r in got}) == 5 and {7, 8, None} < {r.doc_id for r in got}
    same = shards.assign(spark.createDataFrame([(7, prose(1, 40))], "doc_id long, text string"), 40).first()
    assert same.shard == next(r.shard for r in got if r.doc_id == 7)
    removed = {r.doc_id: r.n_removed for r in substring.cut(docs).collect()}
    assert sorted((removed["7"], removed["x-1"])) == [0, 40] and removed["x-2"] == 0


def test_thresholds_above_the_exact_size(spark):
    """A sketch of 20,000 values: its quartiles stand within a percent of the ranks asked for."""
    pick = np.random.default_rng(1)
    values = pick.gamma(2.0, 1.0, 20_000)
    rows = [(float(v), "en", "s", False) for v in values]
    df = spark.createDataFrame(rows, "v double, lang string, source string, base_failed boolean").repartition(7)
    measured = df.select("lang", "source", "base_failed", *(F.col("v").alias(m) for m in quality_rules.SPREADS))
    limits = quality_rules.thresholds(measured, spreads={m: 0.0 for m in quality_rules.SPREADS}).first()
    low, high = (np.quantile(values, q) for q in (0.25, 0.75))
    for name in quality_rules.SPREADS:
        # max = high + FENCE * (high - low): an error of a percent in the ranks moves it by so much at most.
        least, most = ((np.quantile(values, 0.75 + e) * (1 + quality_rules.FENCE)
                        - np.quantile(values, 0.25 - e) * quality_rules.FENCE) for e in (-0.01, 0.01))
        assert least <= limits[f"{name}_max"] <= most
    assert limits["mean_word_max"] - (high + quality_rules.FENCE * (high - low)) < 0.5


def test_planted_repetition_fails_the_query_rules(spark):
    texts = [(i, prose(i, 60), "en", "s") for i in range(80)]
    again = prose(300, 8)
    texts.append((100, " ".join([prose(301, 30), again, prose(302, 30), again]), "en", "s"))
    shares = brute.quality(texts[-1][1])
    assert 0.15 < shares[4] / shares[0] < 0.3 and not shares[5]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality_rules.apply_rules(docs).filter("kept").collect()} == set(range(80))


def test_votes_beside_plain_cosines():
    """Every neighbour's similarity computed by itself, nearest first, earlier rows first among equals."""
    pick = np.random.default_rng(3)
    rows = pick.poisson(1.0, (300, quality_knn.TERMS)).astype(np.float32)
    rows[100:220] = rows[5]  # more equal rows than neighbours, with different labels
    labels = pick.integers(0, 2, 300).astype(float)
    idf = pick.random(quality_knn.TERMS).astype(np.float32)
    basis = np.linalg.qr(pick.normal(size=(quality_knn.TERMS, 16)))[0].astype(np.float32)
    space = quality_knn.Space(idf, basis, quality_knn._unit((np.log1p(rows) * idf) @ basis), labels, 0.5)
    asked = np.concatenate([rows[5:7], pick.poisson(1.0, (20, quality_knn.TERMS)).astype(np.float32)])
    together = space.votes(asked)
    for i, counts in enumerate(asked):
        x = np.log1p(counts.astype(float)) * idf @ basis
        cosines = [max(0.0, float(x @ v) / np.linalg.norm(x)) for v in space.vectors.astype(float)]
        nearest = sorted(range(300), key=lambda j: (-round(cosines[j], 5), j))[:quality_knn.NEIGHBOURS]
        weight = np.array([cosines[j] for j in nearest])
        want = (weight * labels[nearest]).sum() / weight.sum()
        # One neighbour may change places with another of nearly the same cosine.
        assert abs(together[i] - want) < 1.5 / quality_knn.NEIGHBOURS
        assert space.votes(asked[i:i + 1])[0] == together[i] or abs(space.votes(asked[i:i + 1])[0] - together[i]) < 1e-4
    assert abs(together[0] - labels[[5, *range(100, 220)]][:quality_knn.NEIGHBOURS].mean()) < 1e-3
