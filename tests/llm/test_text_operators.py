"""Operators on documents beside brute force, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

import random

import pytest

from kindred.llm import decontaminate, licences, near_dedup, quality_rules, substring
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string"


def prose(seed, count, vocabulary=40):
    pick = random.Random(seed)
    return " ".join(pick.choice("abcdefgh") * pick.randint(1, 3) + str(pick.randint(0, vocabulary)) for _ in range(count))


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    base, passage = prose(1, 60), prose(2, 30)
    out = [None, "", "  \n\t", "One", "one", "Uno dos", "ÄÖ é " * 3, "a b " * 300, prose(3, 4000)]
    out += [base, base, base.upper(), base + " tail", prose(4, 25) + " " + passage + " " + prose(5, 25)]
    out += [prose(6, 10) + " " + passage, passage[:-8] + " x", passage + "\n" + passage]
    for i in range(60):  # a family of near copies, some beyond the threshold of each other
        words = base.split()
        for _ in range(pick.randint(0, 6)):
            words[pick.randrange(len(words))] = f"new{pick.randint(0, 500)}"
        out.append(" ".join(words))
    return [(7 * i % 1009 + 1, t, pick.choice(["en", "de", None]), pick.choice(["s0", "s1", None])) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(spark, docs, rows):
    for width in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.group(docs, width, 80).collect()}
        assert got == brute.components([r[:2] for r in rows], width)
    assert near_dedup.group(empty(spark), 2, 80).collect() == []


def test_near_duplicates_keep_one_of_repeated_rows(spark):
    twice = spark.createDataFrame([(1, prose(1, 30), "x"), (1, prose(1, 30), "x"), (2, prose(1, 30), "x"),
                                   (None, prose(9, 30), "x"), (3, None, "x")], "doc_id long, text string, kept string")
    kept = near_dedup.keep_one(twice)
    assert kept.columns == twice.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


@pytest.mark.parametrize("hot", [2000, 2])
def test_substring(spark, docs, rows, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    want = {d: (n, gone, brute.sha(" ".join(kept)))
            for d, (n, gone, kept) in brute.without_repeats([r[:2] for r in rows]).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in substring.cut(docs).collect()}
    assert got == want


def test_substring_edges(spark):
    assert substring.cut(empty(spark)).collect() == []
    text = prose(8, 50)
    odd = spark.createDataFrame([(None, text, 1), (5, text, 2), (5, text, 3), (6, "a  b", 4)],
                                "doc_id long, text string, n_words long")
    got = sorted((r.doc_id or 0, r.text, r.n_words) for r in substring.without_repeats(odd).collect())
    assert got == [(0, "", 1), (5, text, 2), (5, text, 3), (6, "a  b", 4)]


def test_decontamination(spark, docs, rows):
    items = [(1, prose(2, 30)), (2, "Uno, DOS!"), (3, None), (4, "..."), (10, prose(2, 30)), (11, prose(99, 15))]
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 60):
        got = {r.doc_id: (r.n_words, r.n_hit, list(r.hit_items))
               for r in decontaminate.find(docs, table, block_bytes=block).collect()}
        assert got == {d: brute.contamination(t, items) for d, t, *_ in rows}
    spans = decontaminate.find(docs, table).filter("n_hit > 0").select("text", "spans", "hit_items").collect()
    assert {r.text[r.spans[0].start:r.spans[0].end] for r in spans if r.hit_items == ["2"]} == {"Uno dos"}
    clashing = docs.selectExpr("doc_id", "text", "1 AS n_hit", "2 AS spans")
    clean = decontaminate.clean(clashing, table)
    assert clean.columns == clashing.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, (_, n, _) in got.items() if not n}
    assert decontaminate.find(docs, table.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find(empty(spark), table).count() == 0


def test_quality_measures(spark, docs, rows):
    got = quality_rules.apply_rules(docs).select("doc_id", *quality_rules.MEASURED, "kept").collect()
    assert {tuple(r)[:7] for r in got} == {(d, *brute.quality(t)) for d, t, *_ in rows}
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.apply_rules(empty(spark)).collect() == []


def test_quality_thresholds_follow_the_group(spark):
    pick = random.Random(3)
    texts = [(i, prose(i, 60), "en", "s") for i in range(80)]
    texts += [(100, "\n".join(f"{w}%%%" for w in prose(200, 60).split()), "en", "s"),
              (101, " ".join(w + "!!" for w in prose(201, 60).upper().split()), "en", "s"),
              (102, "".join(pick.choice("abc") for _ in range(900)).replace("c", " c" * 12), "en", "s")]
    kept = quality_rules.keep_good(spark.createDataFrame(texts, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "source"]
    assert {r.doc_id for r in kept.collect()} >= set(range(80))
    assert not {r.doc_id for r in kept.collect()} & {100, 101}


def test_licences(spark, docs, rows):
    notices = [(5001, "All Rights Reserved. all rights reserved", None, None),
               (5002, "x Licensed under the Apache License, Version 2.0.", None, None),
               (5003, "This work is licensed under the GNU General Public License, version 3.", None, None),
               (5004, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without "
                      "restriction", None, None), (5005, "cc by cc-by CC BY-NC 4.0 all rights", None, None)]
    both = docs.unionByName(spark.createDataFrame(notices, SCHEMA)).withColumnRenamed("lang", "n_words")
    got = {r.doc_id: r for r in licences.scan(both).collect()}
    for doc_id, text, *_ in rows + notices:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrases(text, licences.BASE)
        assert 0 <= r.score <= 1
    assert [got[i].labels for i in (5001, 5002, 5003, 5004)] == ["reserved", "apache-2.0", "gpl,gpl-3.0", "mit"]
    assert licences.scan(empty(spark)).collect() == []


def test_matching_statistics_are_the_longest_runs():
    pick = random.Random(11)
    lists = [[pick.choice([b"a", b"b", b"c"]) for _ in range(pick.randint(2, 9))] for _ in range(6)]
    auto = licences.Automaton(lists, 2)
    words = [pick.choice([b"a", b"b", b"c"]) for _ in range(200)]
    found = auto.statistics([auto.words[w] for w in words])
    for i, (_, length) in enumerate(found):
        runs = [n for n in range(i + 2) for t in lists for j in range(len(t) - n + 1) if t[j:j + n] == words[i + 1 - n:i + 1]]
        assert length == max(runs)


def test_licences_keep_the_runs_of_every_template(spark):
    texts = ["This work is licensed under the Creative Commons Attribution 4.0 International License",
             "This work is licensed under the terms of the GNU General Public License",
             "this work is licensed under the terms of the gnu general public license version 3"]
    pick = random.Random(17)
    for _ in range(80):  # stretches of templates, cut at random places and joined
        parts = [brute.normal_words(pick.choice(licences.TEMPLATES)[0]) for _ in range(4)]
        cuts = [sorted(pick.choices(range(len(p) + 1), k=2)) for p in parts]
        texts.append(" ".join(w for p, (a, b) in zip(parts, cuts, strict=True) for w in p[a:b] + ["other"] * pick.randint(0, 1)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licences.scan(docs).collect():
        words = brute.normal_words(r.text)
        covers = {}
        for text, label in licences.TEMPLATES:
            cover = brute.template_cover(words, brute.normal_words(text), licences.MIN_RUN, licences.MAX_GAP)
            covers[label] = max(cover, covers.get(label, 0))
        want = {label: c for label, c in covers.items() if c >= licences.MIN_COVER}
        base = brute.phrases(r.text, licences.BASE)
        assert r.labels == ",".join(sorted(set(want) | set(base[4].split(",")) - {""}))
        got = {label: max(s.cover for s in r.spans if s.label == label) for label in {s.label for s in r.spans}}
        assert got == pytest.approx(want)
        assert r.score == pytest.approx(1.0 if base[1] else max(want.values(), default=0))
        if r.doc_id == 0:
            assert r.labels == "cc-by-4.0" and r.score == pytest.approx(12 / 13)


def test_runs_of_each_template_are_maximal():
    pick = random.Random(12)
    for _ in range(20):
        lists = [[pick.choice([b"a", b"b", b"c"]) for _ in range(pick.randint(2, 12))] for _ in range(6)]
        auto = licences.Automaton(lists, 0)
        words = [pick.choice([b"a", b"b", b"c"]) for _ in range(100)]
        if set(words) <= set(auto.words):
            ids = [auto.words[w] for w in words]
            got = sorted(auto.runs(ids, auto.statistics(ids), 3))
            assert got == sorted((n, *run) for n, own in enumerate(lists) for run in brute.template_runs(words, own, 3))


def test_licences_report_every_place(spark):
    notice, other = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License"
    apart = " ".join([notice, prose(1, 50), notice, other, prose(2, 5), notice])
    docs = spark.createDataFrame([(1, apart), (2, " ".join([other] * 2000)), (3, notice)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(docs).collect()}
    spans = [(s.label, s.start, s.end, s.cover) for s in got[1].spans]
    assert sorted(spans) == [("apache-2.0", a, a + 8, 1.0) for a in (0, 58, 76)] + [("mit", 66, 71, 1.0)]
    assert [(s.start, s.end) for s in got[2].spans] == [(5 * i, 5 * i + 5) for i in range(2000)]
    assert len(got[3].spans) == 1 and got[1].score == 1.0


def test_chains_look_back_as_far_as_runs_can_join():
    runs = [(0, 0, 10), *((4, 300 + 7 * i, 6) for i in range(100)), (10, 10, 10)]
    assert licences.chains(runs, 15)[0] == (20, 0, 20)


def test_quality_rejects_repetition_below_the_base_cutoff(spark):
    texts = [(i, prose(i, 60), "en", "s") for i in range(80)]
    again = prose(300, 8)
    texts += [(100, " ".join([prose(301, 30), again, prose(302, 30), again]), "en", "s"),  # 16 of 76 words
              (101, "\n".join(["a b c"] * 8 + prose(303, 40).split()[:3]), "en", "s"),  # base rule
              (102, "\n".join([w for x in prose(304, 10, 400).split() for w in [f"{x} {x}{x}"]]
                              + ["one", prose(305, 20), "one", prose(306, 20)] + ["one"] * 6), "en", "s")]
    shares = {d: brute.quality(t) for d, t, *_ in texts}
    assert 0.15 < shares[100][4] / shares[100][0] < 0.3 and not shares[100][5]
    lines = texts[82][1].split("\n")
    assert shares[102][3] / len(lines) > 0.3 and not shares[102][5] and shares[102][4] == 0
    kept = {r.doc_id for r in quality_rules.keep_good(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert kept == set(range(80))


def test_near_duplicates_keep_one_under_one_id_or_none(spark):
    a, b, c, d = (prose(seed, 100) for seed in (401, 402, 403, 404))
    table = [(1, a), (1, a + " tail"), (None, b), (None, b + " tail"), (None, c), (2, c + " tail"), (1, d),
             (5, None), (5, ""), (6, None)]
    for schema in ("doc_id long, text string", "doc_id long, text string, root long"):
        rows = [(*r, 9) if "root" in schema else r for r in table]
        kept = [tuple(r)[:2] for r in near_dedup.keep_one(spark.createDataFrame(rows, schema)).collect()]
        assert [sum(t is not None and t.startswith(x) for _, t in kept) for x in (a, b, c, d)] == [1, 1, 1, 1]
        assert (2, c + " tail") in kept and (1, d) in kept and len(kept) == 7


def test_substring_joins_anchors_beyond_the_filter(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(substring, "FILTER_ANCHORS", 0)
    want = {d: (n, gone, brute.sha(" ".join(kept)))
            for d, (n, gone, kept) in brute.without_repeats([r[:2] for r in rows]).items()}
    for hot in (2000, 2):
        monkeypatch.setattr(substring, "HOT", hot)
        got = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in substring.cut(docs).collect()}
        assert got == want


def test_families_below_the_threshold_form_no_pairs(spark, monkeypatch):
    """Texts of one family, similar by about 0.55: comparisons grow as the rows, not as their square."""
    asked = []
    pairs = near_dedup._pairs

    def counted(rows, central, percent):
        met = rows.groupBy("band").count().selectExpr("sum(count * (count - 1) / 2) AS n").first().n
        asked.append(0 if central else met or 0)  # what the join within buckets forms
        return pairs(rows, central, percent)

    monkeypatch.setattr(near_dedup, "_pairs", counted)
    base, compared = prose(77, 60, 10_000).split(), []
    for count in (100, 200):
        pick, texts = random.Random(9), []
        for i in range(count):
            words = list(base)
            for at in pick.sample(range(60), 5):
                words[at] = f"new{i}x{at}"
            texts.append((i, " ".join(words)))
        texts += [(1000, " ".join(base)), (1001, " ".join(base[:-1]))]
        asked.clear()
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.group(
            spark.createDataFrame(texts, "doc_id long, text string"), 2, 80).collect()}
        assert got == brute.components(texts, 2)
        compared.append(sum(asked))
    assert compared[1] <= 3 * compared[0] + 200 and compared[1] < 200 * 200 / 8
