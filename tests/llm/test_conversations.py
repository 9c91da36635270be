"""Prefix trie, hard negatives and chat formatting beside brute force, with nulls, ties,
repeated rows, empty tables, long conversations and clashing column names."""

import hashlib
import json
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.llm import chat_format, contraction, hard_negatives, prefix_trie, turns

CONVERSATION = "conv_id long, turn long, role string, text string"


def in_order(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [x[1:] for x in sorted(v)] for c, v in convs.items()}


def brute_trie(rows):
    convs = in_order(rows)
    members, ends, parent, size = defaultdict(list), defaultdict(list), {}, {}
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(convs.get(c - c % 5, [])[:h] + convs[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                parent[path[:d]], size[path[:d]] = path[:d - 1], len(path[d - 1][1].encode())
        ends[path].append(c)
    kids = defaultdict(list)
    for node, up in parent.items():
        kids[up].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = (len(members[node]) - 1) * size.get(node, 0) + sum(saved[k] for k in kids[node])
    return {(members[n][0], len(n), members[parent[n]][0] if n in parent else None, len(members[n]), len(kids[n]),
             leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members}


def conversations():
    pick = random.Random(3)
    rows = [(None, 0, "user", "nobody"), (3, None, None, None), (3, 1, "user", ""), (4, 0, "user", "ä€"),
            (4, 0, "user", "ä€"), (4, 0, "user", "ä€"), (10_000_001, 7, "user", "far")]
    openings = [[("user", f"hello {i}"), ("assistant", f"yes {i}")] for i in range(3)]
    for c in range(40, 110):
        talk = openings[pick.randrange(3)] + [(pick.choice("ua"), f"t{pick.randint(0, 1)}") for _ in range(pick.randint(0, 9))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(talk)]
    for c in (200, 201, 202):  # long chains, one of them a copy of another's prefix
        rows += [(c, i, "user", f"w{i % 7}") for i in range(150 if c < 202 else 90)]
    return rows


def test_prefix_trie(spark, monkeypatch):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATION).withColumns({"k1": F.lit("own"), "pos": F.lit(-1)})
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    got = prefix_trie.build(df.repartition(5))
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint"] * 7
    assert set(map(tuple, got.collect())) == brute_trie(rows)
    assert prefix_trie.build(df.limit(0)).collect() == []


def test_prefix_trie_orders_ties_alike(spark):
    rows = [(5, 0, r, t) for r in ("a", "b", None) for t in ("x", "y", "")] + [(6, 1, "a", "x")]
    first = set(map(tuple, prefix_trie.build(spark.createDataFrame(rows, CONVERSATION)).collect()))
    again = set(map(tuple, prefix_trie.build(spark.createDataFrame(rows[::-1], CONVERSATION).repartition(3)).collect()))
    assert first == again and len(first) >= 10


@pytest.mark.parametrize("shape", ["path", "star", "comb", "random"])
def test_contraction(spark, shape):
    pick = random.Random(8)
    n = 120
    up = {"path": lambda i: i - 1, "star": lambda i: 0, "comb": lambda i: max(0, i - 1 - i % 2),
          "random": lambda i: pick.randrange(i)}[shape]
    parent = {i: up(i) if i else None for i in range(n)}
    depth = {0: 0}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    total = {i: i + 1 for i in range(n)}
    for i in sorted(parent, key=depth.get, reverse=True):
        if i:
            total[parent[i]] += total[i]
    tree = spark.createDataFrame([(i, parent[i], depth[i], i + 1) for i in range(n)],
                                 "node long, parent long, depth long, v long")
    got = contraction.subtree_totals(contraction.with_children(tree), ["v"])
    assert dict(map(tuple, got.collect())) == total


def test_positions_across_chunks(spark):
    rows = [(1, i % 50, "same") for i in range(400)] + [(2, 0, "x"), (3, None, "y")]
    got = turns.ranked(spark.createDataFrame(rows, "g long, o long, t string").repartition(6), "g", [F.col("o")], "n")
    places = defaultdict(list)
    for r in got.collect():
        places[r.g].append((r.pos, -1 if r.o is None else r.o))
    for g, n in ((1, 400), (2, 1), (3, 1)):
        assert [p for p, _ in sorted(places[g])] == list(range(1, n + 1))
        assert [o for _, o in sorted(places[g])] == sorted(o for _, o in places[g])


def brute_negatives(rows):
    best = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector])
        best[vec_id] = min(best.get(vec_id, row), row)
    out = set()
    for a, (label, x) in best.items():
        if a % 100:
            continue
        clip = (1 << 63) - 1
        score = {i: max(-clip, min(clip, sum(p * q for p, q in zip(x, y)))) for i, (_, y) in best.items()}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and best[i][0] == label][:5]:
            found = [i for i in order if best[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out |= {(a, p, k, i, score[p], score[i]) for k, i in enumerate(found[:10], 1)}
    return out


def vectors():
    pick = np.random.default_rng(4)
    rows = [(None, [1.0], 1), (100, None, 1), (201, [0.5, None], 2), (202, [0.5, float("nan")], 2),
            (203, [float("inf")], 1), (204, [0.25], None), (300, [], 3), (301, [0.5, 0.25, 1.0, 0.5, 0.125, 3.0], 3),
            (400, [0.5] * 4, 1), (400, [0.25] * 4, 1), (400, [0.5] * 4, 1), (500, [3.0e18, 1.0], 4), (501, [2.0e18], 4),
            (502, [1.5e18, -7.0], 5), (503, [2.0], 5)]
    centres = pick.normal(size=(6, 4))
    for i in range(600, 1600):
        c = i % 6
        rows.append((i, [float(np.float32(v)) for v in centres[c] + pick.normal(size=4) * 0.05], int(c + (i % 11 == 0)) % 10))
    return rows + [(i, [0.5, 0.5, 0.5, 0.5], i % 3) for i in range(1600, 1640)]  # ties


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "PAGE_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "TILE", 2)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"key": F.lit("own"), "score": F.lit(1.5), "rank": F.lit("own")})
    planned = []
    plan = hard_negatives.plan
    monkeypatch.setattr(hard_negatives, "plan", lambda *a, **k: planned.append(plan(*a, **k)) or planned[-1])
    got = hard_negatives.mine(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert set(map(tuple, got.collect())) == brute_negatives(rows)
    # Zone maps exclude most of the blocks where vectors stand in clusters.
    n_blocks = len(rows) // 16
    n_groups = planned[1].select("group").distinct().count()
    assert planned[1].count() < n_groups * n_blocks / 2
    assert hard_negatives.mine(df.limit(0)).collect() == []
    assert hard_negatives.mine(df.filter("vec_id % 100 <> 0")).collect() == []


def test_hilbert_visits_neighbours():
    bits, points = 3, np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    keys = hard_negatives.hilbert(points, bits)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    pick = np.random.default_rng(1)
    x, rows = pick.integers(-50, 50, (7, 5)), pick.integers(-50, 50, (30, 5))
    low, high = hard_negatives.bounds(x, rows.min(0)[None], rows.max(0)[None])
    scores = x @ rows.T
    assert (low <= scores).all() and (scores <= high).all()


CONTROLS = st.sampled_from([*chat_format.CONTROL_STRINGS, "\\", "<", "[", "|end|>", "/INST]", "a", "é\n", "<\\s>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(CONTROLS, max_size=4).map("".join), st.lists(CONTROLS, max_size=8).map("".join)),
                max_size=4))
def test_escaping_is_reversible(turns_):
    text, mask = chat_format.render(turns_, learned="a")
    assert chat_format.parse(text) == turns_
    assert [chat_format.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns_ if r == "a"]
    for _, t in turns_:
        assert not any(c in chat_format.escape(t) for c in chat_format.CONTROL_STRINGS)


LAYOUT_ROWS = [
    ('{"messages":[{"role":"user","content":"a"},{"content":null,"role":"assistant"}]}', "messages", [("user", "a"), ("assistant", "")]),
    ('{"messages":[]}', "messages", []),
    ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"},{"from":"tool","value":"c"}]}',
     "shared", [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ('{"system":"s","conversations":[{"from":"human","value":"a"}]}', "shared-system", [("system", "s"), ("user", "a")]),
    ('{"prompt":"p","completion":"c"}', "prompt", [("user", "p"), ("assistant", "c")]),
    ('{"completion":"c","system":"s","prompt":"p"}', "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ('{"instruction":"i","input":"","output":"o"}', "instruction", [("system", "i"), ("user", ""), ("assistant", "o")]),
    ('{"instruction":"i","output":"o"}', "instruction-only", [("user", "i"), ("assistant", "o")]),
    ('{"data":{"prompt":"p","reply":{"text":"t"}}}', "nested", [("user", "p"), ("assistant", "t")]),
    ('{"question":"q","response":"r"}', "question", [("user", "q"), ("assistant", "r")]),
    ('{"prompt":"p","answer":"r"}', None, None), ("{}", None, None), ("[1]", None, None), ("{broken", None, None),
    ("", None, None), (None, None, None),
]


def test_layouts(spark):
    rows = [(i, *r[:1], "own") for i, r in enumerate(LAYOUT_ROWS)]
    records = spark.createDataFrame(rows, "conv_id long, record string, layout string").withColumn("part", F.lit(0))
    got = {r.conv_id: r for r in chat_format.format_records(records).collect()}
    for i, (_, layout, wanted) in enumerate(LAYOUT_ROWS):
        assert got[i].layout == layout
        assert (None if got[i].formatted is None else chat_format.parse(got[i].formatted)) == wanted
    assert got[10].fingerprint == chat_format.fingerprint({"prompt", "answer"})
    with pytest.raises(ValueError, match="one shape"):
        chat_format.by_fingerprint([chat_format.LAYOUTS[0], chat_format.Layout("other", chat_format.LAYOUTS[0].rules)])


def test_chats_read_back(spark):
    pick = random.Random(2)
    rows = conversations() + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(900, i, "assistant" if i % 2 else "user", pick.choice(["", "x\ny", "<|end|>", "é" * 50])) for i in range(70)]
    rows += [(901, i, "assistant", "long " * 20_000) for i in range(16)]
    df = spark.createDataFrame(rows, CONVERSATION).withColumns({"part": F.lit("own"), "record": F.lit(1)})
    formatted = chat_format.format_records(chat_format.records_of(df.repartition(3))).cache()
    assert {"prompt", "shared", "messages"} <= {r.layout for r in formatted.select("layout").distinct().collect()}
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    wanted = in_order(rows)
    assert set(got) == set(wanted)
    for c, talk in wanted.items():
        learned = "".join(t for r, t in talk if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in talk)
        assert tuple(got[c])[:5] == (c, len(talk), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                                     hashlib.sha256(learned.encode()).hexdigest())
        assert got[c].formatted_chars == len(chat_format.render(talk)[0])
    assert chat_format.digests(chat_format.format_records(chat_format.records_of(df.limit(0)))).collect() == []
    assert json.loads(chat_format.records_of(df.filter("conv_id = -7")).first().record)["prompt"] == "</s>[INST] ok [/INST]"
