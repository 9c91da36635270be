"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows.

Texts are normalised byte by byte (A-Z lower-cased, every other ASCII character that
is no letter or digit a blank), so a word's place in the normalised text is its place
in the original. The automaton holds the windows of ``WINDOW`` consecutive words of
all items, each between blanks; a text is scanned once, whatever the number of
windows. Hits are word intervals, mapped back to character offsets.

The automaton is broadcast, so its size is checked: items beyond ``BLOCK_BYTES`` are
dealt into blocks of that size, each with an automaton of its own that all texts are
scanned with. Nothing is shuffled.

Defined results: a null or wordless text has no hits; an item without words is never
found, one with fewer words than a window is one window; repeated items are found
alike; empty tables give no hits or no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import blocks
from kindred.session import materialise

WINDOW = 10
#: Bytes of item texts in one automaton (some 400 bytes of memory for each).
BLOCK_BYTES = 512 << 10

_NORMAL = bytes(blocks.LOWER[b] if blocks.ALPHANUMERIC[b] else 0x20 for b in range(256))
_built: dict[int, ahocorasick.Automaton] = {}


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows_of(items: list[tuple[str, bytes]], width: int) -> dict[bytes, tuple[int, list[str]]]:
    """Window between blanks → number of words, items that hold it."""
    found: dict[bytes, tuple[int, list[str]]] = {}
    for item, text in items:
        words = normal_words(text)
        size = min(width, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            key = b" " + b" ".join(words[i:i + size]) + b" "
            held = found.setdefault(key, (size, []))[1]
            if not held or held[-1] != item:
                held.append(item)
    return found


def automaton(items: list[tuple[str, bytes]], width: int) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for key, value in windows_of(items, width).items():
        built.add_word(key.decode("latin-1"), value)
    if len(built):
        built.make_automaton()
    return built


def hits(words: list[bytes], built: ahocorasick.Automaton) -> list[tuple[int, int, list[str]]]:
    """First word, word after the last, and items of every occurrence of a window."""
    if not words or not len(built):
        return []
    found = [(end, value) for end, value in built.iter((b" " + b" ".join(words) + b" ").decode("latin-1"))]
    if not found:
        return []
    blanks = np.cumsum([len(w) + 1 for w in words])  # the blank after each word
    after = np.searchsorted(blanks, [end for end, _ in found]) + 1
    return [(int(e) - size, int(e), held) for e, (_, (size, held)) in zip(after, found, strict=True)]


def merged(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(places):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def char_spans(text: bytes, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original of intervals of words."""
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = blocks.spans(data, np.array([0, len(data)]), blocks.ALPHANUMERIC)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(chars[starts[s]]), int(chars[ends[e - 1]])) for s, e in places]


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded bytes; one block at a time is on the driver."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
                        ).filter("item IS NOT NULL AND text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(count))
    for b in range(count):
        yield [(r.item, bytes(r.text)) for r in rows.filter(block == b).sort("item").toLocalIterator()]


def find(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted) and spans (character offsets).

    Input columns of these names are replaced; the others stay, whatever their names.
    """
    out = docs.select("text", _packed(docs, ("text", *RESULT)).alias("own"))
    spark = docs.sparkSession
    for number, block in enumerate(_blocks(items, block_bytes)):
        shared = spark.sparkContext.broadcast(block)
        mark = zlib.crc32(repr(block).encode()) + (number << 32)
        first = number == 0

        def scan(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, shared=shared, mark=mark,
                 first=first) -> list[pa.Array]:
            if mark not in _built:
                _built.clear()
                _built[mark] = automaton(shared.value, width)
            raw = data.tobytes()
            n_words, n_hit, held, spans = [], [], [], []
            earlier = [None] * part.num_rows if first else list(zip(
                part.column("_places").to_pylist(), part.column("_items").to_pylist(), strict=True))
            places_out, items_out = [], []
            for i, before in enumerate(earlier):
                text = raw[offsets[i]:offsets[i + 1]]
                words = normal_words(text)
                found = hits(words, _built[mark])
                places = [(s, e) for s, e, _ in found]
                names = {x for _, _, some in found for x in some}
                if before:
                    places += [(p["s"], p["e"]) for p in before[0]]
                    names |= set(before[1])
                places = merged(places)
                n_words.append(len(words))
                n_hit.append(sum(e - s for s, e in places))
                held.append(sorted(names))
                spans.append([{"start": s, "end": e} for s, e in char_spans(text, places)] if places else [])
                places_out.append([{"s": s, "e": e} for s, e in places])
                items_out.append(sorted(names))
            pair = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array(held, pa.list_(pa.string())), pa.array(spans, span),
                    pa.array(places_out, pair), pa.array(items_out, pa.list_(pa.string()))]

        if not first:
            out = _rescan(materialise(out, "scanned"), scan)
        else:
            out = blocks.add_columns(out, _COLUMNS, scan)
    kept = [F.col("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns if c not in RESULT]
    return out.select(*kept, *RESULT)


#: Columns that ``find`` adds.
RESULT = ("n_words", "n_hit", "hit_items", "spans")
_COLUMNS = ("n_words long, n_hit long, hit_items array<string>, spans array<struct<start:bigint,end:bigint>>, "
            "_places array<struct<s:bigint,e:bigint>>, _items array<string>")


def _rescan(docs: DataFrame, scan) -> DataFrame:
    """As add_columns, but ``scan`` reads the columns it replaces."""
    names = T.StructType.fromDDL(_COLUMNS).names
    kept = [c for c in docs.columns if c not in names]
    ordered = docs.select(*kept, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.slices(batches):
            keep = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*keep, *scan(part, data, offsets)], names=[*kept, *names])

    return ordered.mapInArrow(run, ordered.schema)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any window of an item, with the columns of ``docs``."""
    return find(docs.select("text", _packed(docs, ("text",)).alias("all")), items).filter("n_hit = 0").select(
        *(F.col("text") if c == "text" else F.col("all").getField(c).alias(c) for c in docs.columns))


def _packed(docs: DataFrame, but: tuple[str, ...]) -> Column:
    """The columns of ``docs`` but some in a struct, where their names meet no others."""
    quoted = ("`" + c.replace("`", "``") + "`" for c in docs.columns if c not in but)
    return F.struct(F.lit(0).alias("_"), *map(F.col, quoted))
