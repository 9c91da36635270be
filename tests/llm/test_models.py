"""Classifiers on rows held out, shards by their law, and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from kindred.llm import quality_knn, shards, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("module, label, least", [(toxicity, "toxic", 0.95), (quality_knn, "quality", 0.97)])
def test_held_out_rows(spark, tables, module, label, least):
    docs, labels = tables
    model = module.fit(docs, labels)
    rows = module.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    yes, no = ([r.score for r in held if r[label] == x] for x in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in yes for b in no]) > least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD) for r in rows)


@pytest.mark.parametrize("module", [toxicity, quality_knn])
def test_classifier_edges(spark, module):
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "x " * 9000, "c")],
                                "doc_id long, text string, score string")
    no_labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (9, 7, 7)], "doc_id long, quality int, toxic int")
    label = "toxic" if module is toxicity else "quality"
    rows = module.score(odd, module.fit(odd, no_labels, label)).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    assert module.score(odd.limit(0), module.fit(odd.limit(0), no_labels, label)).collect() == []


def test_margins_are_the_sum_over_pairs():
    pick = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(30, dtype=np.int32), -0.5, pick.normal(size=30).astype(np.float32),
                               pick.normal(size=(30, toxicity.FACTORS)).astype(np.float32), 1.5, -0.25)
    terms = [np.sort(pick.choice(30, n, replace=False)) for n in (0, 1, 2, 7, 30)]
    row = np.repeat(np.arange(5), [len(t) for t in terms])
    margins = machine.margins(row, np.concatenate(terms), 5)
    scores = machine.probabilities(row, np.concatenate(terms), 5)
    for t, margin, score in zip(terms, margins, scores, strict=True):
        pairs = sum(float(machine.factors[i].astype(float) @ machine.factors[j].astype(float))
                    for a, i in enumerate(t) for j in t[a + 1:])
        want = -0.5 + float(machine.weights[t].sum()) + toxicity.PAIR_SCALE / max(1, len(t)) * pairs
        assert margin == pytest.approx(want, abs=1e-3)
        assert score == pytest.approx(1 / (1 + np.exp(-(1.5 * want - 0.25))), abs=1e-3)


def test_calibration_weighs_misses():
    pick = np.random.default_rng(6)
    labels = (np.arange(4000) % 8 == 0).astype(float)
    margins = pick.normal(np.where(labels == 1, 1.0, -3.0), 1.0)
    scale, shift = toxicity.calibration(margins, labels)
    # Where p(margin) = 1/2: the densities with weights 3 and 7 cross at -1 + ln(7 / 3) / 4.
    assert -shift / scale == pytest.approx(-1 + np.log(7 / 3) / 4, abs=0.12)
    assert toxicity.calibration(-margins, labels)[0] == 0.0


def test_learned_terms_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TERMS", 400)
    docs = spark.createDataFrame([(i, f"word{i} common") for i in range(1, 400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    machine = toxicity.fit(docs, labels)
    assert 0 < len(machine.weights) < 500
    assert {r.predicted for r in toxicity.score(docs, machine).collect()} <= {0, 1}


def test_factors_learn_what_no_sum_can():
    """Two terms that are harmless alone and harmful together, and the reverse for others."""
    terms = [np.array(t, np.int32) for t in ([0], [1], [0, 1], []) * 200]
    labels = np.array([0, 0, 1, 0] * 200, float)
    slot = np.arange(2, dtype=np.int32)
    machine = toxicity.train(slot, terms, labels)
    row, flat = np.repeat(np.arange(4), [1, 1, 2, 0]), np.concatenate(terms[:4])
    margin = machine.margins(row, flat, 4)
    assert margin[2] > 0 > max(margin[0], margin[1], margin[3])


def test_pairs_are_learned_of_terms_that_tell_nothing_alone(spark):
    """Each of two terms stands in half of the toxic and half of the clean rows; toxic are
    those that hold both or none. Fitted and scored from tables."""
    pick, rows = np.random.default_rng(5), []
    for i in range(3000):
        a, b = i & 1, i >> 1 & 1
        words = [f"w{w}" for w in pick.integers(0, 120, 12)] + ["abcd"] * a + ["efgh"] * b
        rows.append((i, " ".join(words), int(a == b)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    machine = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    held = [r for r in toxicity.score(table, machine).collect() if r.held_out]
    assert len(held) > 400
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.9


def test_every_learned_term_has_a_factor(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} common") for i in range(1, 60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    monkeypatch.setattr(toxicity, "CALIBRATION_LEAST", 100)  # too few rows to leave any out
    machine = toxicity.fit(docs, labels)
    learned = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5]
    text = " ".join(f"word{i}" for i in learned).encode()
    _, bucket = toxicity.term_buckets(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert (machine.slot[bucket] >= 0).all()
    assert len(machine.factors) == len(machine.weights) == machine.slot.max() + 1


def jump(key, count):
    key, b, j = key % (1 << 64), -1, 0
    while j < count:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(spark):
    rows = [(i * 37 - 500, f"text {i}" * (i % 5)) for i in range(400)] + [(None, None), (7, "x"), (7, "x"), (7, "y")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, slot int").repartition(3)
    got = shards.assign(docs, 40).collect()
    assert len(got) == len(rows)
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (jump(key, 40), jump(key, 41))
        assert r.grown_shard in (r.shard, 40)
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert shards.assign(docs.limit(0), 40).collect() == []


def test_pipeline_beside_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        after = docs.collect()
        if number < 4:
            assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
        texts = {r.doc_id: r.text for r in before}
        if number == 0:
            assert not any(brute.quality(r.text)[5] for r in after) and len(after) > 0.7 * len(before)
        if number == 1:
            groups = brute.components(texts.items(), 5)
            assert {r.doc_id for r in after} == {d for d, (_, c) in groups.items() if d == c}
        if number == 2:
            want = {d: " ".join(kept) if gone else texts[d]
                    for d, (_, gone, kept) in brute.without_repeats(texts.items()).items() if kept or not gone}
            assert {r.doc_id: r.text for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
        if number == 3:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert {r.doc_id for r in after} == {d for d, t in texts.items() if not brute.contamination(t, items)[1]}
        if number == 4:
            assert {r.doc_id for r in after} == set(texts) and all(r.restored for r in after)
