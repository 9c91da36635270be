"""Substring dedup with a compressed FM-index per shard.

A window of ``WIDTH`` words goes where an earlier place holds the same words. Streaming
every document through the index of every shard would cost documents times shards, so
shards are made of what can match at all:

1. Every window picks its smallest hashed gram of ``GRAM`` words as *anchor*; equal
   windows have equal anchors. Anchors met at two places (least and greatest place of
   each anchor, a partial aggregate) are repeated; all others end here.
2. Each repeated anchor gives a *segment*: the words of all windows around it. Equal
   segments are indexed once, with their first place.
3. Segments of one anchor share a shard. Per shard, an FM-index over the segments (a
   wavelet matrix of their Burrows-Wheeler transform) is built, all segments are
   streamed through it by backward search, and for every window the interval of its
   occurrences gives the earliest one. A search ends early when one occurrence is left.
4. Windows with an earlier place become word spans of their documents.

An anchor of more than ``HOT`` places (a common line before ever new text) would fill
one shard; its windows are anchors of their own, of full width, and go through steps 1
to 3 alone, so that its shard holds only windows that do repeat, each of them once.
Copies of one text are one document there; of copies only the first keeps words.

Defined results: null or short texts have no window and keep all words; rows of equal
id and text count as one document, rows of one id and different texts are ordered by a
hash of the text; an id that is no whole number counts as its hash, a null id as larger
than all others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm import blocks
from kindred.llm.labelled import long_id
from kindred.llm.wavelet import FMIndex
from kindred.session import materialise

WIDTH, GRAM = 20, 6
#: Places of an anchor that one shard may hold (up to 300 bytes each).
HOT = 50_000
#: Repeated anchors that are sent to the tasks as they are (8 bytes each).
FILTER_ANCHORS = 2_000_000
#: Bytes of a word's hash in a segment.
WORD_BYTES = 6
#: Segments in a shard, on average.
SHARD_SEGMENTS = 20_000

_LAST = (1 << 63) - 1


def sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``size`` consecutive values."""
    have = 1
    while have * 2 <= size:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[:len(values) - (size - have)], values[size - have:]) if have < size else values


def anchors(words: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams that are the smallest of some window, and their hashes.

    ``first``: where each text's words begin in ``words``, and where the last one's end.
    """
    span = width - gram + 1
    if len(words) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = blocks.window_hashes(words, gram)
    least = sliding(grams, span, np.minimum)
    least[~_inside(len(least), first, width)] = 0  # a window over two texts is none
    around = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    at = np.flatnonzero((sliding(around, span, np.maximum) == grams) & (grams > 0))
    return at, grams[at]


def _inside(count: int, first: np.ndarray, width: int) -> np.ndarray:
    """Whether ``width`` words from each of the first ``count`` places on are of one text."""
    begins = np.arange(count)
    return begins + width <= first[np.searchsorted(first, begins, "right")]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows with the hashes of their words and where each row's begin."""
    for part, data, offsets in blocks.slices(batches):
        starts, ends, first = blocks.spans(data, offsets, blocks.UNSPACED)
        yield part, blocks.word_hashes(data, starts, ends), first


def _column(part: pa.RecordBatch, name: str, rows: np.ndarray) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False)[rows]


_PLACES = pa.schema([("anchor", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32())])


def _place_batch(part: pa.RecordBatch, first: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    row = np.searchsorted(first, at, "right") - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(hashes.view(np.int64)), *(pa.array(_column(part, k, row)) for k in ("k1", "k2")),
         pa.array((at - first[row]).astype(np.int32))], schema=_PLACES)


def _places(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """anchor, k1, k2, at of every anchor of ``texts`` (k1, k2, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, first in _words(batches):
            yield _place_batch(part, first, *anchors(words, first, width, gram))

    return texts.select("k1", "k2", "text").mapInArrow(run, "anchor long, k1 long, k2 long, at int")


def _repeated(places: DataFrame) -> DataFrame:
    """anchor, hot: anchors of at least two places. Copies of a text are one place."""
    place = F.xxhash64("k1", "k2", "at")
    return places.groupBy("anchor").agg(
        F.min(place).alias("x"), F.max(place).alias("y"), F.count(F.lit(1)).alias("n")
    ).filter("x <> y").select("anchor", (F.col("n") > HOT).alias("hot"))


@dataclass
class Marks:
    """Texts (id, k1, k2, text) and where their wanted anchors are: given by ``marks``, or
    to be found among the sorted hashes of ``only``."""

    texts: DataFrame
    only: Broadcast | None

    @classmethod
    def of(cls, wanted: DataFrame, docs: DataFrame, firsts: DataFrame, width: int, gram: int) -> Marks:
        """Up to ``FILTER_ANCHORS`` the anchors are sent to the tasks, which find them in
        their texts; beyond that their places are joined, and the places with the texts."""
        if wanted.count() <= FILTER_ANCHORS:
            held = np.sort(np.array([r.anchor for r in wanted.select("anchor").toLocalIterator()], np.int64).view(np.uint64))
            return cls(docs, docs.sparkSession.sparkContext.broadcast(held))
        marks = _places(docs, width, gram).join(wanted.select("anchor"), "anchor")
        grouped = marks.groupBy("k1", "k2").agg(F.collect_set("at").alias("marks")).join(firsts, ["k1", "k2"])
        return cls(docs.join(grouped, ["id", "k1", "k2"]).dropDuplicates(["id", "k1", "k2"]), None)

    def slices(self, batches: Iterator[pa.RecordBatch], width: int, gram: int
               ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """Slices of rows with their words, where each row's begin, and the places of the wanted anchors."""
        for part, words, first in _words(batches):
            if self.only is None:
                marks = part.column("marks")
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(marks).fill_null(0).to_numpy())
                at = np.sort(first[row] + marks.flatten().to_numpy())
            else:
                at, found = anchors(words, first, width, gram)
                near = np.searchsorted(self.only.value, found)
                near[near == len(self.only.value)] = 0
                at = at[self.only.value[near] == found] if len(self.only.value) else at[:0]
            if len(at):
                yield part, words, first, at


_SEGMENTS = ("id long, k1 long, k2 long, start int, anchor long, c1 long, c2 long, words binary")


def _segments(marks: Marks, width: int, gram: int) -> DataFrame:
    """The words of all windows around each mark (a gram's place), one row for each.

    ``words`` (six bytes of hash each) is given once for equal segments of a task.
    """
    reach, only = width - gram, marks.only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part, words, first, at in Marks(None, only).slices(batches, width, gram):
            row = np.searchsorted(first, at, "right") - 1
            starts, ends = np.maximum(at - reach, first[row]), np.minimum(at + width, first[row + 1])
            c1, c2 = (x.view(np.int64) for x in blocks.run_hashes(words, starts, ends))
            short = np.ascontiguousarray(words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
            held: list[bytes | None] = []
            for c, begin, end in zip(c1.tolist(), (WORD_BYTES * starts).tolist(), (WORD_BYTES * ends).tolist(), strict=True):
                held.append(None if c in seen else short[begin:end])
                seen.add(c)
            columns = (*(_column(part, k, row) for k in ("id", "k1", "k2")), (starts - first[row]).astype(np.int32),
                       blocks.window_hashes(words, gram)[at].view(np.int64), c1, c2)
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(held, pa.binary())],
                                             names=[x.split()[0] for x in _SEGMENTS.split(", ")])
            if len(seen) > 1 << 18:
                seen.clear()

    return marks.texts.mapInArrow(run, _SEGMENTS)


def _window_hashes(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` values from each start on."""
    return blocks.window_hashes(words, width)[starts] if len(starts) else np.zeros(0, np.uint64)


def earlier_windows(segments: pa.Table, width: int) -> np.ndarray:
    """For each segment (id, k1, k2, start, words) a bit for each of its windows: set if
    the same words also stand at an earlier place in some segment."""
    raw = [w.as_py() for w in segments.column("words")]
    lengths = np.array([len(w) // WORD_BYTES for w in raw])
    padded = np.zeros((int(lengths.sum()), 8), np.uint8)
    padded[:, :WORD_BYTES] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, WORD_BYTES)
    symbols = np.unique(padded.view("<u8").ravel(), return_inverse=True)[1] + 1
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    owner = np.repeat(np.arange(len(raw)), lengths)
    text = np.zeros(int((lengths + 1).sum()), np.int64)  # 0 parts the segments
    text[begins[owner] + within] = symbols
    index = FMIndex(text, width)
    # Order of places: id, then text, then word; one place in two segments is one number.
    columns = [segments.column(c).to_numpy() for c in ("k2", "k1", "id")]
    by_text = np.lexsort(columns)
    changed = np.zeros(len(raw), np.int64)
    for column in columns:
        changed[1:] |= column[by_text][1:] != column[by_text][:-1]
    document = np.empty(len(raw), np.int64)
    document[by_text] = np.cumsum(changed)
    at = segments.column("start").to_numpy()[owner] + within
    place = np.full(len(text), len(text), np.int64)
    place[begins[owner] + within] = np.unique((document[owner] << 32) | at, return_inverse=True)[1]
    # Backward search of all distinct windows at once; what has one occurrence left is settled.
    starts = np.flatnonzero(within + width <= lengths[owner])
    words = padded.view("<u8").ravel()
    begin, kind = np.unique(_window_hashes(words, starts, width), return_index=True, return_inverse=True)[1:]
    first = (begins[owner] + within)[starts]
    asked = first[begin]
    last = text[asked + width - 1]
    low, high = index.first[last], index.first[last + 1]
    live = np.flatnonzero(high - low > 1)
    for step in range(width - 2, -1, -1):
        low[live], high[live] = index.extend(text[asked[live] + step], low[live], high[live])
        live = live[high[live] - low[live] > 1]
    masks = np.zeros(len(raw), np.int64)
    if len(live):
        lows, back = np.unique(low[live], return_inverse=True)
        highs = np.zeros(len(lows), np.int64)
        highs[back] = high[live]
        by_suffix = np.append(place[index.suffixes], len(text))
        earliest = np.full(len(asked), len(text), np.int64)
        earliest[live] = np.minimum.reduceat(by_suffix, np.stack([lows, highs], 1).ravel())[::2][back]
        again = starts[earliest[kind] < place[first]]
        np.bitwise_or.at(masks, owner[again], np.int64(1) << within[again])
    return masks


def _whole(segments: pa.Table, width: int) -> pa.ChunkedArray:
    """A bit for every window of each segment."""
    windows = pc.add(pc.divide(pc.binary_length(segments.column("words")), WORD_BYTES), 1 - width).cast(pa.int64())
    return pc.subtract(pc.shift_left(pa.scalar(1, pa.int64()), windows), 1)


def _search(segments: DataFrame, width: int) -> DataFrame:
    """id, k1, k2, start, mask: the places of all windows that also stand earlier.

    For anchors of at most ``HOT`` places: all places of a segment meet in its shard.
    """
    shards = max(1, segments.count() // SHARD_SEGMENTS)

    def search(shard: pa.Table) -> pa.Table:
        keys = [shard.column(c).to_numpy() for c in ("start", "k2", "k1", "id", "c2", "c1")]
        order = np.lexsort(keys)  # equal segments together, the earliest place first
        c1, c2 = keys[5][order], keys[4][order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
        group = np.cumsum(fresh) - 1
        given = shard.column("words").is_valid().to_numpy()[order]
        holder = np.zeros(int(group[-1]) + 1, np.int64)
        holder[group[given]] = order[given]  # any row with the words
        first = order[fresh]
        index = shard.select(["id", "k1", "k2", "start"]).take(first).append_column(
            "words", shard.column("words").take(holder))
        mask, whole = earlier_windows(index, width), _whole(index, width).to_numpy()
        same = np.ones(len(order), bool)  # the first place, or that place in a repeated row
        for key in keys[:4]:
            same &= key[order] == key[first][group]
        out = shard.select(["id", "k1", "k2", "start"]).take(order)
        return out.append_column("mask", pa.array(np.where(same, mask[group], whole[group])))

    return segments.withColumn("shard", F.pmod("anchor", F.lit(shards))).groupBy("shard").applyInArrow(
        search, "id long, k1 long, k2 long, start int, mask long").filter("mask <> 0")


def _search_hot(segments: DataFrame, width: int) -> DataFrame:
    """As ``_search``, for segments with any number of places: a shard holds each once,
    with its first place, and the places are joined with what was found."""
    place = F.struct("id", "k1", "k2", "start")
    shards = max(1, segments.filter("words IS NOT NULL").count() // SHARD_SEGMENTS)
    indexed = segments.groupBy("anchor", "c1", "c2").agg(
        F.first("words", ignorenulls=True).alias("words"), F.min(place).alias("first")).select(
        "anchor", "c1", "c2", "words", "first.*", F.pmod("anchor", F.lit(shards)).alias("shard"))

    def search(shard: pa.Table) -> pa.Table:
        return shard.select(["anchor", "c1", "c2", "id", "k1", "k2", "start"]).append_column(
            "mask", pa.array(earlier_windows(shard, width))).append_column("whole", _whole(shard, width))

    found = indexed.groupBy("shard").applyInArrow(
        search, "anchor long, c1 long, c2 long, id long, k1 long, k2 long, start int, mask long, whole long")
    first = found.select("anchor", "c1", "c2", F.struct("id", "k1", "k2", "start").alias("first"), "mask", "whole")
    return (
        segments.select("anchor", "c1", "c2", "id", "k1", "k2", "start")
        .join(first, ["anchor", "c1", "c2"])
        .select("id", "k1", "k2", "start", F.when(place != F.col("first"), F.col("whole")).otherwise(F.col("mask")).alias("mask"))
        .filter("mask <> 0")
    )


def find(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text, further columns) with _first_id (the least id of the
    row's text) and _marks: [start, mask] of segments with windows to remove."""
    keyed = docs.select(_id(docs).alias("id"), *_text_key(), "text")
    firsts = materialise(keyed.groupBy("k1", "k2").agg(F.min("id").alias("id")), "texts")
    repeated = materialise(_repeated(_places(keyed, width, gram)), "repeated")
    plain = Marks.of(repeated.filter("NOT hot"), keyed, firsts, width, gram)
    spans = _search(materialise(_segments(plain, width, gram), "segments"), width)

    if not repeated.filter("hot").isEmpty():
        windows = _windows(Marks.of(repeated.filter("hot"), keyed, firsts, width, gram), width, gram)
        again = Marks.of(materialise(_repeated(windows), "windows"), keyed, firsts, width, width)
        spans = spans.unionByName(_search_hot(materialise(_segments(again, width, width), "hot_segments"), width))

    per_text = spans.groupBy("id", "k1", "k2").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))
    known = firsts.join(per_text, ["id", "k1", "k2"], "left").select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("id").alias("_first_id"), F.col("marks").alias("_marks"))
    own = _text_key()
    return docs.withColumns({"_k1": own[0], "_k2": own[1]}).join(known, ["_k1", "_k2"]).drop("_k1", "_k2")


def _windows(marks: Marks, width: int, gram: int) -> DataFrame:
    """anchor (hash of a whole window), k1, k2, at of the windows around the marks."""
    only = marks.only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, first, places in Marks(None, only).slices(batches, width, gram):
            hashes = blocks.window_hashes(words, width)
            row = np.searchsorted(first, places, "right") - 1
            at = places[:, None] - np.arange(width - gram + 1)
            at = np.unique(at[(at >= first[row][:, None]) & (at + width <= first[row + 1][:, None])])
            yield _place_batch(part, first, at, hashes[at])

    return marks.texts.mapInArrow(run, "anchor long, k1 long, k2 long, at int")


def _id(docs: DataFrame) -> Column:
    return F.coalesce(long_id(docs, "doc_id"), F.lit(_LAST))


def _text_key() -> tuple[Column, Column]:
    return F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")


def removed_words(first: np.ndarray, copies: np.ndarray, marks: pa.Array, width: int) -> np.ndarray:
    """Whether each word is covered by a window to remove.

    ``first``: where each row's words begin. All words of copies go that have a window at
    all. ``marks``: for each row its [start, mask] structs, null for none.
    """
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), pc.list_value_length(marks).fill_null(0).to_numpy())
    held = marks.flatten()
    start, mask = (held.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    edges = np.zeros(int(first[-1]) + 1, np.int64)
    for j in range(width):
        chosen = (mask >> j & 1 == 1) & (start + j + width <= count[row])
        at = first[row[chosen]] + start[chosen] + j
        np.add.at(edges, at, 1)
        np.subtract.at(edges, at + width, 1)
    return (np.cumsum(edges)[:-1] > 0) | np.repeat(copies & (count >= width), count)


def cut(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text: the words that stay, between blanks."""
    found = find(docs, width, gram).withColumn("_copy", _id(docs) != F.col("_first_id"))

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        starts, ends, first = blocks.spans(data, offsets, blocks.UNSPACED)
        count = np.diff(first)
        gone = removed_words(first, part.column("_copy").to_numpy(zero_copy_only=False), part.column("_marks"), width)
        lost = np.concatenate([[0], np.cumsum(gone)])[first]
        kept, sizes = blocks.joined(data, offsets, starts, ends, first, np.flatnonzero(~gone))
        return [pa.array(count, pa.int64()), pa.array(np.diff(lost), pa.int64()), blocks.as_strings(kept, sizes)]

    return blocks.add_columns(found, "n_words long, n_removed long, kept_text string", of).drop(
        "_copy", "_first_id", "_marks")


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text``; untouched texts stay as they are."""
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*own).alias("_own") if own else F.lit(None).cast("int").alias("_own"))
    done = cut(packed, width, gram).withColumn(
        "text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return done.select(*[F.col(f"_own.{c}").alias(c) if c in own else F.col(c) for c in docs.columns])
