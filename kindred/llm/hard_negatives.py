"""Hard negatives of anchors, read from the blocks that may hold them.

Vectors are stored as Parquet rows of up to BLOCK_ROWS neighbours (*blocks*), ordered
by label and, within it, along a Hilbert curve through the dimensions that vary most.
Each block has a zone map: the least and the greatest value of every dimension and
the labels it spans. Interval arithmetic on an anchor and a zone map bounds the
products of the anchor with all rows of the block from both sides, so whole blocks
are proven to hold no answer.

Anchors, in groups along the same curve, go through four steps, each of which first
plans on zone maps alone and then reads the chosen blocks:

1. The block of an anchor's own label with the highest bound gives a floor: the score
   of its ``positives``-th best row there.
2. Blocks of its label whose bound reaches the floor give the positives.
3. Each positive allows a window of scores. The block whose bounds lie around the upper
   end of the window gives a floor as in 1.
4. Blocks whose bounds meet the window above the floor give the negatives.

The plan is a join of anchor groups with pages of zone maps, the query set against
all blocks; reading is a join of the chosen (group, block) pairs, gathered in tiles of
neighbouring groups and blocks. A task holds one tile. Only the best rows of each tile
leave it. Nothing is broadcast or collected, whatever the size. If vectors point in all
directions alike, bounds exclude little, and the work is anchors times rows.

Defined results: rows without id, label or vector, or with a null, infinite or
undefined component take no part. Of several rows of one id the one with the smallest
label, then vector, does. A shorter vector has zeros at its end; an empty one scores 0.
Products are exact; beyond the range of a long they count as its end. No anchors, or
no rows, give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.session import materialise

#: Rows of a block, anchors of a group, zone maps of a page; groups and blocks along a tile.
BLOCK_ROWS = 256
GROUP_ROWS = 64
PAGE_ROWS = 256
TILE = 16

#: Dimensions of the Hilbert curve and bits of each.
CURVE_DIMENSIONS = 8
CURVE_BITS = 7

_LONG = (1 << 63) - 1


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points (rows) with coordinates of ``bits`` bits.

    After Skilling (2004): undo the rotations from the top bit down, then read the Gray
    code of the interleaved bits.
    """
    x = points.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            change = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, change)
            x[i] ^= change
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(len(x)):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of integers as rows, filled with zeros at the end."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _packed(matrix: np.ndarray) -> bytes:
    """A byte for the width of the numbers, then the numbers."""
    most = int(np.abs(matrix.astype(object)).max()) if matrix.size else 0
    size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return bytes([size]) + matrix.astype(f"<i{size}").tobytes()


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    flat = np.frombuffer(data, f"<i{data[0]}", offset=1)
    return flat.reshape(rows, len(flat) // rows).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of both: floats where they are exact, else Python's integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = [int(max(abs(int(x.min(initial=0))), int(x.max(initial=0)))) for x in (a, b)]
    if most[0] * most[1] * max(width, 1) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def _clipped(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == np.int64 else np.clip(x, -_LONG, _LONG).astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible product of each anchor with anything between low and high."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return (_clipped(products(up, low) + products(down, high)),
            _clipped(products(up, high) + products(down, low)))


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector (integers) of the rows that take part, one for each id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = materialise(embeddings.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10)
        .otherwise(F.col("label").cast("long")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector")), "vectors")
    repeated = materialise(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"),
                           "repeated")
    if repeated.isEmpty():
        return rows
    chosen = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    return materialise(rows.join(repeated, "vec_id", "left_anti").unionByName(chosen), "vectors")


def curve_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, the place of the vector on the curve through the dimensions of
    the largest variance over all rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector")).astype(np.float64)
            if x.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1])), pa.array(np.full(x.shape[1], float(len(x)))),
                     *map(pa.array, (x.sum(0), (x * x).sum(0), x.min(0), x.max(0)))],
                    names=["d", "n", "s", "q", "low", "high"])

    stats = rows.select("vector").mapInArrow(
        partial, "d long, n double, s double, q double, low double, high double").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    variance = F.col("q") / F.col("n") - (F.col("s") / F.col("n")) ** 2
    best = stats.orderBy(F.desc(variance), "d").limit(CURVE_DIMENSIONS).select("d", "low", "high").collect()
    dims, low, high = ([r[i] for r in best] for i in range(3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"))
            chosen = np.zeros((len(x), max(len(dims), 1)), np.int64)
            for i, d in enumerate(dims):
                if d < x.shape[1] and high[i] > low[i]:
                    share = (x[:, d] - low[i]) / (high[i] - low[i])
                    chosen[:, i] = np.clip(share * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(chosen, CURVE_BITS))],
                                             names=[*batch.schema.names, "key"])

    return materialise(rows.mapInArrow(place, "vec_id long, label long, vector array<bigint>, key long"), "keyed")


BLOCK = ("id long, tile long, n int, label_low long, label_high long, low binary, high binary, "
         "ids array<bigint>, labels array<bigint>, vectors binary")


def blocks_of(keyed: DataFrame, size: int, label: str) -> DataFrame:
    """BLOCK rows of ``size`` neighbours along (label, curve); ``id`` is the smallest vec_id inside."""
    ranges = keyed.repartitionByRange("label", "key", "vec_id").sortWithinPartitions("label", "key", "vec_id")
    ranges = ranges.select("vec_id", "label", "vector", F.spark_partition_id().cast("long").alias("range"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= size:
                yield block(held.slice(0, size), count)
                held, count = held.slice(size), count + 1
            held = held.combine_chunks()
        if held is not None and held.num_rows:
            yield block(held, count)

    def block(rows: pa.Table, count: int) -> pa.RecordBatch:
        x = _matrix(rows.column("vector"))
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        tile = (rows.column("range")[0].as_py() << 32) + count // TILE
        values = (int(ids.min()), tile, len(ids), int(labels.min()), int(labels.max()), _packed(x.min(0)[None]),
                  _packed(x.max(0)[None]), ids, labels, _packed(x))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        names = [c.split()[0] for c in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    return materialise(ranges.mapInArrow(cut, BLOCK), label)


def _zone(table: pa.Table) -> tuple[np.ndarray, ...]:
    """ids, tiles, label_low, label_high, low, high of the zone maps in a table."""
    edges = [[_unpacked(x, 1)[0] for x in table.column(c).to_pylist()] for c in ("low", "high")]
    width = max((len(x) for x in edges[0]), default=0)
    low, high = (np.array([np.pad(x, (0, width - len(x))) for x in side], np.int64).reshape(len(side), width)
                 for side in edges)
    return (*(table.column(c).to_numpy() for c in ("id", "tile", "label_low", "label_high")), low, high)


class _Group:
    """Anchors of a group, with the windows (anchor's place, key, low, high) they look for."""

    def __init__(self, row: dict) -> None:
        self.id, self.tile = row["group"], row["group_tile"]
        self.ids = np.array(row["ids"], np.int64)
        self.labels = np.array(row["labels"], np.int64)
        self.x = _unpacked(row["vectors"], len(self.ids))
        place = {int(v): i for i, v in enumerate(self.ids)}
        self.windows = [(place[w["anchor"]], w["key"], w["low"], w["high"]) for w in row["windows"]]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.array([w[i] for w in self.windows], np.int64) for i in (0, 2, 3))


def _windows(groups: DataFrame, windows: DataFrame) -> DataFrame:
    """Groups with the windows (anchor, key, low, high) of their anchors; groups without any go."""
    listed = groups.select(F.col("id").alias("group"), F.explode("ids").alias("anchor")).join(windows, "anchor")
    gathered = listed.groupBy("group").agg(F.collect_list(F.struct("anchor", "key", "low", "high")).alias("windows"))
    return materialise(groups.select(
        F.col("id").alias("group"), F.col("tile").alias("group_tile"), "ids", "labels", "vectors").join(
        gathered, "group"), "windows")


def plan(groups: DataFrame, pages: DataFrame, same_label: bool, seeds: bool) -> DataFrame:
    """(group, group_tile, block, block_tile) to read for the windows of ``groups``.

    With ``seeds`` one block for each window, else every block whose bounds meet it.
    """
    parts = max(1, math.ceil(groups.count() / TILE))
    n_pages = pages.agg(F.max("page")).first()[0]
    if n_pages is None:
        parts, n_pages = 1, 0
    left = groups.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)).cast("int")).withColumn(
        "page", F.explode(F.sequence(F.lit(0), F.lit(int(n_pages)))))
    right = pages.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def choose(asked: pa.Table, page: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if page.num_rows and asked.num_rows:
            ids, tiles, label_low, label_high, low, high = _zone(page)
            for row in asked.to_pylist():
                group = _Group(row)
                at, least, most = group.arrays()
                label = group.labels[at][:, None]
                fits = ((label_low <= label) & (label <= label_high)) if same_label else (
                    (label_low != label) | (label_high != label))
                lower, upper = (b[at] for b in bounds(group.x, low, high))
                fits &= (upper >= least[:, None]) & (lower <= most[:, None])
                if seeds:
                    near = -upper.astype(np.float64) if same_label else np.abs(
                        (lower.astype(np.float64) + upper) / 2 - most[:, None])
                    near[~fits] = np.inf
                    for w, b in enumerate(near.argmin(1)):
                        if fits[w, b]:
                            out.append((group.id, group.tile, int(ids[b]), int(tiles[b]), int(group.ids[at[w]]),
                                        group.windows[w][1], float(near[w, b])))
                else:
                    out += [(group.id, group.tile, int(ids[b]), int(tiles[b]), None, None, None)
                            for b in np.flatnonzero(fits.any(0))]
        kinds = (pa.int64(),) * 6 + (pa.float64(),)
        return pa.Table.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
            names=["group", "group_tile", "block", "block_tile", "anchor", "key", "near"])

    pairs = left.groupBy("part", "page").cogroup(right.groupBy("part", "page")).applyInArrow(
        choose, "group long, group_tile long, block long, block_tile long, anchor long, key long, near double")
    if seeds:
        pairs = pairs.groupBy("group", "group_tile", "anchor", "key").agg(
            F.min(F.struct("near", "block", "block_tile")).alias("best")).select(
            "group", "group_tile", "best.block", "best.block_tile")
    return materialise(pairs.select("group", "group_tile", "block", "block_tile").distinct(), "pairs")


def read(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, same_label: bool, most: int) -> DataFrame:
    """anchor, key, vec_id, score, rank: the first ``most`` rows of each window in the blocks of ``pairs``."""
    left = pairs.groupBy("group", "block_tile").agg(F.collect_list("block").alias("wanted")).join(groups, "group")
    right = pairs.select(*(F.col(c).alias(c) for c in ("group_tile", "block_tile")), F.col("block").alias("id")).distinct().join(
        blocks.select("id", "n", "ids", "labels", "vectors"), "id")

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        stored = {r["id"]: r for r in held.to_pylist()}
        out: list[list] = [[], [], [], []]
        for row in asked.to_pylist():
            group, found = _Group(row), []
            at, least, greatest = group.arrays()
            for block in (stored[b] for b in row["wanted"]):
                ids, labels = np.array(block["ids"], np.int64), np.array(block["labels"], np.int64)
                scores = _clipped(products(group.x, _unpacked(block["vectors"], block["n"])))[at]
                fits = (scores >= least[:, None]) & (scores <= greatest[:, None]) & (
                    ids != group.ids[at][:, None]) & ((labels == group.labels[at][:, None]) == same_label)
                w, b = np.nonzero(fits)
                found.append(_first(w, ids[b], scores[w, b], most))
            w, ids, scores = _first(*(np.concatenate(x) for x in zip(*found, strict=True)), most)
            out[0] += group.ids[at][w].tolist()
            out[1] += [group.windows[i][1] for i in w]
            out[2] += ids.tolist()
            out[3] += scores.tolist()
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], names=["anchor", "key", "vec_id", "score"])

    best = left.groupBy("group_tile", "block_tile").cogroup(right.groupBy("group_tile", "block_tile")).applyInArrow(
        score, "anchor long, key long, vec_id long, score long")
    order = W.partitionBy("anchor", "key").orderBy(F.desc("score"), "vec_id")
    return materialise(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most), "best")


def _first(w: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The first ``most`` of each window by falling score, then id."""
    order = np.lexsort((ids, -scores, w))
    w, ids, scores = w[order], ids[order], scores[order]
    begins = np.searchsorted(w, w, "left")
    keep = np.arange(len(w)) - begins < most
    return w[keep], ids[keep], scores[keep]


def floors(best: DataFrame, windows: DataFrame, most: int) -> DataFrame:
    """Windows that begin at their ``most``-th score in ``best``, where that many were found."""
    found = best.filter(F.col("rank") == most).select("anchor", "key", F.col("score").alias("floor"))
    return materialise(windows.join(found, ["anchor", "key"], "left").select(
        "anchor", "key", F.greatest("low", "floor").alias("low"), "high"), "floors")


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides.
    """
    keyed = curve_keys(usable(embeddings))
    blocks = blocks_of(keyed, BLOCK_ROWS, "blocks")
    groups = blocks_of(keyed.filter(F.col("vec_id") % every == 0), GROUP_ROWS, "groups")
    zones = blocks.select("id", "tile", "label_low", "label_high", "low", "high")
    n_pages = max(1, math.ceil(blocks.count() / PAGE_ROWS))
    pages = materialise(zones.withColumn("page", F.pmod(F.xxhash64("id"), F.lit(n_pages)).cast("int")), "zones")

    everything = groups.select(F.explode("ids").alias("anchor")).select(
        "anchor", F.lit(0).cast("long").alias("key"), F.lit(-_LONG).alias("low"), F.lit(_LONG).alias("high"))

    def search(windows: DataFrame, same_label: bool, most: int) -> DataFrame:
        asked = _windows(groups, windows)
        seen = read(plan(asked, pages, same_label, seeds=True), asked, blocks, same_label, most)
        raised = _windows(groups, floors(seen, windows, most))
        return read(plan(raised, pages, same_label, seeds=False), raised, blocks, same_label, most)

    near = search(everything, True, positives).select(
        F.col("anchor").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(20,0)")
    windows = materialise(near.select(
        F.col("anchor_id").alias("anchor"), F.col("positive_score").alias("key"),
        F.ceil(score * 3 / 10).cast("long").alias("low"), F.floor(score * 9 / 10).cast("long").alias("high"),
    ).distinct().filter("low <= high"), "allowed")
    hard = search(windows, False, negatives)
    return near.join(hard.select(
        F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_score"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"), F.col("rank").cast("int").alias("rank")),
        ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
