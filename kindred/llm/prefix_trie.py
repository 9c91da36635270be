"""The trie of conversation prefixes, with totals of every subtree.

Every conversation is rebuilt first (``rebuild``): it may share its opening turns with
the conversation its block of five begins with. Then each (conversation, position) row
gets a key of its whole prefix: the XOR of two 64-bit hashes of (turn, position) over
the prefix, so keys are prefix sums, which chunks of one long conversation compute
apart from each other. Equal keys are equal prefixes but for chance (2^-128 a pair).
A node is a key; the smallest conversation in it and its depth name it. Subtree totals
come from ``contraction``.

Only hashes, positions and byte counts are shuffled; texts are read once.

Defined results: a null role or text is empty; a null turn comes first; rows of one
conversation and turn follow by hash of role and text; repeated rows each are a turn;
rows without conv_id take no part; without rows there is no root and no row. Blocks of
five and remainders of negative ids are those of SQL, which round towards zero.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.llm.contraction import subtree_totals, with_children
from kindred.llm.turns import ranked, rows_of
from kindred.session import materialise

#: Fixed values of the rebuilding rule.
BLOCK = 5
MOST_SHARED = 8

#: Turns of a conversation whose prefix keys one window computes.
CHUNK = 4096
#: Members of a node whose ids are joined in one piece.
PIECE = 512


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("long")


def block_start(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, x1, x2 (hash of the turn), size (bytes of its text)."""
    rows = rows_of(conversations).select(
        "conv_id", F.col("turn").alias("_turn"), F.xxhash64("role", "text").alias("x1"),
        F.xxhash64(F.lit("second"), "text", "role").alias("x2"), F.octet_length("text").cast("long").alias("size"))
    return materialise(ranked(rows, "conv_id", [F.col("_turn"), F.col("x1"), F.col("x2")], "numbered"), "turns")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, x1, x2, size), and conv_id, length of every conversation."""
    sizes = materialise(turns.groupBy("conv_id").agg(F.max("pos").alias("n")), "sizes")
    starts = sizes.filter(f"conv_id % {BLOCK} = 0").select(
        F.col("conv_id").alias("start"), F.col("n").alias("n_start"))
    shared = sizes.withColumn("h", shared_turns(F.col("conv_id"))).withColumn("start", block_start(F.col("conv_id")))
    plan = materialise(shared.join(starts, "start", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_start", F.lit(0)))).select(
        "conv_id", "start", "h", "taken",
        (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    own = turns.join(plan, "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "x1", "x2", "size")
    opening = turns.filter((F.col("pos") <= MOST_SHARED) & (F.col("conv_id") % BLOCK == 0)).withColumn(
        "start", F.col("conv_id"))
    user = F.explode(F.transform(F.sequence(F.lit(1 - BLOCK), F.lit(BLOCK - 1)),
                                 lambda i: F.try_add(F.col("start"), i.cast("long"))))
    taken = opening.drop("conv_id").withColumn("conv_id", user).join(
        plan.filter("taken > 0"), ["conv_id", "start"]).filter("pos <= taken").select(
        "conv_id", "pos", "x1", "x2", "size")
    return own.unionByName(taken), plan.select("conv_id", "length")


def prefixes(built: DataFrame) -> DataFrame:
    """conv_id, pos, size, k1, k2 (key of the prefix), up1, up2 (key of the prefix without its last turn)."""
    rows = built.select(
        "conv_id", "pos", "size", F.xxhash64("x1", "x2", "pos").alias("y1"),
        F.xxhash64("pos", F.lit("second"), "x2", "x1").alias("y2"),
        F.expr(f"(pos - 1) div {CHUNK}").alias("chunk"))
    inside = W.partitionBy("conv_id", "chunk").orderBy("pos")
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy("conv_id", "chunk").agg(F.bit_xor("y1").alias("c1"), F.bit_xor("y2").alias("c2"))
        .select("conv_id", "chunk", F.bit_xor("c1").over(before).alias("c1"), F.bit_xor("c2").over(before).alias("c2"))
        .filter("chunk > 0"))
    keyed = rows.withColumn("k1", F.bit_xor("y1").over(inside)).withColumn("k2", F.bit_xor("y2").over(inside))
    whole = {f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)}
    return keyed.join(carried, ["conv_id", "chunk"], "left").select(
        "conv_id", "pos", "size", *(c.alias(n) for n, c in whole.items()),
        *(whole[f"k{i}"].bitwiseXOR(F.col(f"y{i}")).alias(f"up{i}") for i in (1, 2)))


def _digest_ends(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 from rows k1, k2, conv_id.

    Ranges of (key, conv_id) join their ids in pieces; a key that one range holds whole
    is hashed there. Pieces of the others, few or none in a range but for a key of very
    many members, are hashed in order; a digest is sequential by nature, so the text of
    such a key streams through one task, piece by piece.
    """
    sorted_ends = ends.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, whole, out = None, [], False, []

        def put(complete: bool) -> None:
            text = ",".join(map(str, ids))
            out.append((*key, ids[0], None if complete else text,
                        hashlib.sha256(text.encode()).hexdigest() if complete else None))

        for batch in batches:
            for k1, k2, conv_id in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "conv_id")), strict=True):
                if (k1, k2) != key:
                    if key is not None and ids:
                        put(whole)
                    # The range's first key may have begun in the range before.
                    whole, key, ids = key is not None, (k1, k2), []
                elif len(ids) == PIECE:
                    put(False)
                    whole, ids = False, []
                ids.append(conv_id)
            yield _columns(out)
            out = []
        if key is not None and ids:
            put(False)
            yield _columns(out)

    def _columns(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            names=["k1", "k2", "first", "piece", "ends_sha256"])

    parts = materialise(sorted_ends.mapInArrow(
        pieces, "k1 long, k2 long, first long, piece string, ends_sha256 string"), "members")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for k1, k2, piece in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "piece")), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
        if key is not None:
            out.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))],
            names=["k1", "k2", "ends_sha256"])

    split = parts.filter("piece IS NOT NULL").select("k1", "k2", "first", "piece").repartition("k1", "k2")
    joined = split.sortWithinPartitions("k1", "k2", "first").drop("first").mapInArrow(
        join, "k1 long, k2 long, ends_sha256 string")
    return parts.filter("ends_sha256 IS NOT NULL").select("k1", "k2", "ends_sha256").unionByName(joined)


def build(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    built, lengths = rebuild(digests(conversations))
    lengths = materialise(lengths, "lengths")
    rows = materialise(prefixes(built), "prefixes")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    nodes = rows.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.min("size").alias("size"), F.min("up1").alias("up1"), F.min("up2").alias("up2"))
    nodes = materialise(nodes.unionByName(root.select(
        zero.alias("k1"), zero.alias("k2"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("size"),
        zero.alias("up1"), zero.alias("up2"))), "nodes")
    # A parent of very many children is a skewed key of this join, which the skew rule
    # splits; the children of the root, most of all, get theirs without a join.
    uppers = nodes.filter("depth > 0").select(
        F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    lowest = (nodes.filter("depth = 0").select("conv_id").first() or [None])[0]
    named = (
        nodes.filter("depth > 1").join(uppers, ["up1", "up2"])
        .unionByName(nodes.filter("depth <= 1").withColumn(
            "parent_conv_id", F.when(F.col("depth") == 1, F.lit(lowest).cast("long"))))
        .select("k1", "k2", "depth", "conv_id", "parent_conv_id", "n_convs",
                ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
                F.struct("conv_id", "depth").alias("node"),
                F.when(F.col("depth") > 0, F.struct(
                    F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent")))
    tree = materialise(with_children(named).withColumn(
        "n_leaves", (F.col("kids") == 0).cast("long")), "named")
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    last = rows.select("conv_id", "pos", "k1", "k2").join(
        lengths.select("conv_id", F.col("length").alias("pos")), ["conv_id", "pos"])
    ends = _digest_ends(last.select("k1", "k2", "conv_id").unionByName(
        lengths.filter("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")))
    return (
        tree.drop("n_leaves", "saved_tokens").join(totals, "node").join(ends, ["k1", "k2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
