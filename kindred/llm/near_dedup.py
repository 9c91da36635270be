"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit circle make a whole signature (Li and Li, C-MinHash,
ICML 2022): the first scatters the shingles, the second, shifted circularly by k,
gives coordinate k as its minimum over the set. ``BANDS`` groups of ``ROWS``
coordinates are hashed; sets that share a band are candidates. At the threshold 0.8 a
link is missed by all bands with probability (1 - 0.8^5)^40 < 2e-7.

Equal sets are one *class* and meet the rest once. Inside a bucket not all pairs are
formed: every class is first compared with the bucket's pivot; links found join
classes to components, and a bucket of one component needs no further comparison. In
the buckets that still hold several, the class that shares most with others is the
next pivot, and then all pairs between components are compared. A pair is left out
only where both ends are already connected by confirmed links, or where the shingles
that each shares with anything open are too few for the threshold, or where parity
bits prove that too many are not shared; so the components are those of all links. Work on a bucket is joins and sums, never one task per bucket.

Defined results: a text without words (or null) has an empty set and links with
nothing; one with fewer words than a shingle has its whole word sequence as its only
shingle; repeated rows fall in one class; null ids count as larger than all others
and are the component's id only where no other id is in it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm import blocks
from kindred.llm.graph import components
from kindred.session import materialise

SHINGLE = 5
PERCENT = 80
ROWS, BANDS = 5, 40
#: Shingles hashed at once against all coordinates.
CHUNK = 2048
#: Words of 64 parity bits of a set.
PARITY_WORDS = 16

_U32 = np.uint32


def scatter(shingles: np.ndarray) -> np.ndarray:
    """First permutation: shingles to places on the circle of 2^32."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    x ^= x >> _U32(16)
    x *= _U32(0x7FEB352D)
    x ^= x >> _U32(15)
    x *= _U32(0x846CA68B)
    return x ^ (x >> _U32(16))


def signature(places: np.ndarray, size: int) -> np.ndarray:
    """Minimum over the set of the second permutation, shifted by 0 .. size-1."""
    shifts, best = np.arange(size, dtype=np.uint32), np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(places), CHUNK):
        x = places[i:i + CHUNK, None] + shifts
        x *= _U32(0x9E3779B1)
        x ^= x >> _U32(15)
        x *= _U32(0x85EBCA77)
        x ^= x >> _U32(13)
        np.minimum(best, x.min(axis=0), out=best)
    return best


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends, first = blocks.spans(data, offsets, blocks.UNSPACED)
    hashes = blocks.word_hashes(data, starts, ends, blocks.LOWER)
    for a, b in zip(first[:-1], first[1:], strict=True):
        size = min(width, int(b - a))
        yield np.unique(blocks.window_hashes(hashes[a:b], size, size)) if size else np.zeros(0, np.uint64)


def _list(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` with n_shingles, set_key (16 bytes that stand for the set; null if
    empty) and bands (a hash for each band)."""
    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        sizes, keys, signs = [], [], []
        for held in shingle_sets(data, offsets, width):
            sizes.append(len(held))
            if len(held):
                twin = blocks.mix(held ^ np.uint64(0xA5A5A5A55A5A5A5A))
                keys.append(np.array([held.sum(dtype=np.uint64), np.bitwise_xor.reduce(twin)]).tobytes())
                signs.append(signature(scatter(held), ROWS * BANDS))
            else:
                keys.append(None)
        rows = np.array(signs, np.uint64).reshape(len(signs), BANDS, ROWS)
        bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
        for r in range(ROWS):
            bands = blocks.mix(bands * np.uint64(0x9FB21C651E98DF25) + rows[:, :, r])
        hashed = iter(bands)
        return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                _list([next(hashed) if n else np.zeros(0, np.uint64) for n in sizes])]

    return blocks.add_columns(docs, "n_shingles long, set_key binary, bands array<bigint>", of)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct (a, b) of ``pairs`` whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, columns = [], []
            for name in ("set_a", "set_b"):
                lists = batch.column(name)
                columns.append((lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)))
            (oa, va), (ob, vb) = columns
            for i in range(batch.num_rows):
                x, y = va[oa[i]:oa[i + 1]], vb[ob[i]:ob[i + 1]]
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared = int((y[at] == x).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    side = {x: sets.select(F.col("cid").alias(x), F.col("held").alias(f"set_{x}")) for x in "ab"}
    return pairs.select("a", "b").join(side["a"], "a").join(side["b"], "b").mapInArrow(run, "a long, b long")


def _similar_sizes(m: Column, n: Column, percent: int) -> Column:
    return F.least(m, n) * 100 >= F.greatest(m, n) * percent


def _may_link(x: str, y: str, percent: int) -> Column:
    """Neither the common shingles nor the parities of two sets (columns of the prefixes
    ``x`` and ``y``) rule out the similarity.

    Each shingle in just one of them flips one parity bit, so at least as many shingles
    are not shared as there are bits that differ.
    """
    apart = F.lit(0)
    for i in range(PARITY_WORDS):
        apart = apart + F.bit_count(F.col(f"{x}.b{i}").bitwiseXOR(F.col(f"{y}.b{i}")))
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    most = F.least(f"{x}.common", f"{y}.common")
    return (most * 100 >= (total - most) * percent) & ((total - apart) * 100 >= (total + apart) * percent)


def row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two hashes that stand for a row; equal for rows of equal id and text."""
    return (F.xxhash64(doc_id, text).alias("row_1"), F.xxhash64(F.lit(1), text, doc_id).alias("row_2"))


def group(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_1 and row_2 (hashes of id and text), n_shingles, root (stands for the
    component, also where ids repeat; null for an empty set), component_id, kept.

    ``docs``: doc_id, text. One row comes back for each row.
    """
    keyed = docs.select("doc_id", "text", *row_key("doc_id", "text"))
    rows = materialise(sketch(keyed, width).drop("text"), "sketched")
    classes = materialise(
        rows.filter("set_key IS NOT NULL").groupBy("set_key", "n_shingles")
        .agg(F.min("doc_id").alias("lowest"), F.min(F.struct("row_1", "row_2")).alias("sample"),
             F.first("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    roots = _roots(classes, keyed, width, percent)

    own = classes.select("set_key", "cid", "lowest")
    if roots is not None:
        own = own.join(roots.withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn(
            "root", F.coalesce("root", "cid"))
    else:
        own = own.withColumn("root", F.col("cid"))
    own = materialise(own.select("set_key", "root", "lowest"), "rooted")
    lowest = own.groupBy("root").agg(F.min("lowest").alias("component"))
    named = own.join(lowest, "root").select("set_key", "root", "component")
    return (
        rows.join(named, "set_key", "left")
        .withColumn("component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component")))
        .select("doc_id", "row_1", "row_2", "n_shingles", "root", "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def _roots(classes: DataFrame, keyed: DataFrame, width: int, percent: int) -> DataFrame | None:
    """node, root of all classes that a confirmed link joins."""
    banded = classes.select("cid", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min(F.struct("cid", "n")).alias("pivot"), F.count(F.lit(1)).alias("m")
                                        ).filter("m > 1")
    open_rows = materialise(banded.join(shared, "band"), "open")
    sets = _candidate_sets(open_rows, classes, keyed, width)

    pairs = open_rows.filter("cid <> pivot.cid").filter(_similar_sizes(F.col("n"), F.col("pivot.n"), percent)).select(
        F.col("pivot.cid").alias("a"), F.col("cid").alias("b"))
    links = confirm(pairs.distinct(), sets, percent)
    open_rows = open_rows.filter("m > 2").select("band", "cid", "n")
    for central in (True, False):
        links = materialise(links, "links")
        mapping = components(links)
        open_rows = _still_open(open_rows, mapping, sets, percent)
        if open_rows is None:
            return mapping
        links = links.unionByName(confirm(_pairs(open_rows, central, percent).distinct(), sets, percent))
    return components(links)


def _still_open(rows: DataFrame, mapping: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame | None:
    """band, cid, n, common, root, bands, parities of the classes that may still link to another component
    within their bucket; None if there is none.

    ``common`` counts the shingles that another open class has too. Two sets share at
    most the smaller of their common counts, so a class with too few links to nothing.
    Buckets of the same classes are alike; one of them is enough.
    """
    if mapping is None:
        placed = rows.select("band", "cid", "n", F.col("cid").alias("root"))
    else:
        placed = rows.select("band", "cid", "n").join(mapping.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "root", F.coalesce("root", "cid"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("y"),
    ).filter("low <> high").groupBy("m", "x", "y").agg(F.min("band").alias("band"))
    mixed = materialise(placed.join(mixed.select("band"), "band"), "mixed")
    if mixed.isEmpty():
        return None
    mine = mixed.groupBy("cid").agg(F.collect_list("band").alias("bands"))  # at most BANDS
    mine = materialise(mine.join(sets, "cid"), "open_sets")
    shingles = mine.select("cid", F.explode("held").alias("shingle"))
    alone = shingles.groupBy("shingle").agg(F.min("cid").alias("cid"), F.count(F.lit(1)).alias("c")).filter("c = 1")
    private = materialise(alone.groupBy("cid").agg(F.count(F.lit(1)).alias("private")), "private")
    found = materialise(
        mixed.join(mine.drop("held"), "cid").join(private, "cid", "left")
        .withColumn("common", F.col("n") - F.coalesce("private", F.lit(0)))
        .filter(F.col("common") * 100 >= F.col("n") * percent).drop("private"), "open")
    return _within_reach(found, percent)


def _within_reach(rows: DataFrame, percent: int) -> DataFrame:
    """Without the classes that are too large for every other one in their bucket.

    A set of n shingles, of which ``common`` are met elsewhere, links only with sets of up
    to common * (100 + percent) / percent - n shingles. So a bucket of texts that are
    alike, but not enough, is left without a comparison, whatever their number.
    """
    reach = F.floor(F.col("common") * ((100 + percent) / percent) + 1e-9) - F.col("n")
    bounds = rows.groupBy("band").agg(
        F.min("n").alias("least"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    near = rows.join(bounds.select("band", "least"), "band").filter(reach >= F.col("least")).drop("least")
    mixed = near.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return materialise(near.join(mixed.select("band"), "band", "left_semi"), "near")


def _pairs(rows: DataFrame, central: bool, percent: int) -> DataFrame:
    """a, b of open pairs: each class with its bucket's most central one (of the least
    share of shingles to itself), or all of them."""
    if central:
        parity = [f"b{i}" for i in range(PARITY_WORDS)]
        pivots = rows.groupBy("band").agg(F.min(F.struct(
            (1 - F.col("common") / F.col("n")).alias("apart"), "cid", "n", "common", "root", *parity)).alias("p"))
        both = rows.alias("x").join(pivots, "band").filter((F.col("root") != F.col("p.root")) & _may_link("x", "p", percent))
        return both.select(F.col("p.cid").alias("a"), F.col("x.cid").alias("b"))
    x, y = rows.alias("x"), rows.alias("y")
    # A pair is formed in the first bucket that both have open.
    return x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.cid") < F.col("y.cid"))
                  & (F.col("x.root") != F.col("y.root")) & _may_link("x", "y", percent)
                  & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.band"))).select(
        F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))


def _candidate_sets(open_rows: DataFrame, classes: DataFrame, keyed: DataFrame, width: int) -> DataFrame:
    """cid, held, b0 ...: full sets of the classes that share a band, from one text of each."""
    wanted = open_rows.select("cid").distinct().join(classes.select("cid", "sample.*"), "cid")
    texts = keyed.select("row_1", "row_2", "text").join(wanted, ["row_1", "row_2"])

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        held = list(shingle_sets(data, offsets, width))
        bits = np.stack([np.bincount((x >> np.uint64(20)).astype(np.int64) % (64 * PARITY_WORDS),
                                     minlength=64 * PARITY_WORDS) & 1 for x in held]).astype(np.uint8)
        words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        return [_list(held), *(pa.array(words[:, i].copy()) for i in range(PARITY_WORDS))]

    parities = "".join(f", b{i} long" for i in range(PARITY_WORDS))
    found = blocks.add_columns(texts.dropDuplicates(["row_1", "row_2"]).select("cid", "text"),
                               "held array<bigint>" + parities, of)
    return materialise(found.drop("text"), "sets")


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group (the first by doc_id, null ids last, then by hashes of id and
    text, then by a hash of the other columns, which must not be maps), with the columns
    of ``docs`` as they were."""
    # Rows of the component's id; several if texts share it or all ids are null.
    flagged = group(docs.select("doc_id", "text"), width, percent).filter("kept")
    alone = F.col("root").isNull()
    counted = flagged.groupBy(
        "root", F.when(alone, F.col("row_1")).alias("x"), F.when(alone, F.col("row_2")).alias("y"), "row_1", "row_2").agg(
        F.count(F.lit(1)).alias("copies"))
    chosen = materialise(counted.groupBy("root", "x", "y").agg(
        F.min(F.struct("row_1", "row_2", "copies")).alias("first")).select("first.*"), "chosen")
    # The row stands in a struct meanwhile, so none of its columns meets one of ours.
    rows = docs.select(F.struct("*").alias("row"), *row_key("doc_id", "text"))
    single = rows.join(chosen.filter("copies = 1"), ["row_1", "row_2"]).select("row")
    others = [F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "text")]
    repeated = rows.join(chosen.filter("copies > 1"), ["row_1", "row_2"]).groupBy("row_1", "row_2").agg(
        F.min_by("row", F.xxhash64(F.lit(0), *others)).alias("row")).select("row")
    return single.unionByName(repeated).select("row.*")
