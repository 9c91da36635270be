"""Token ids as one compressed wavelet-matrix file per shard.

Documents are encoded in ascending order of their id and cut into shards of about
``SHARD_TOKENS`` ids. A file holds the ids as bit-planes of a wavelet matrix, each in
blocks of ``BLOCK_BITS`` bits, compressed one by one and listed with the number of ones
before them; so a reader opens only the blocks that a query touches:

    blocks of all planes · directory (compressed) · its place and length · magic

``TokenFile`` answers access (the id at a place), rank (occurrences of an id before a
place), count, select and occurrences (places of an id) and restores whole documents.

Files are written under a name of the attempt and renamed, so a repeated task replaces
its file by an equal one. Encoding goes through the tokenizer library; since its words
are independent, the distinct words of a slice are encoded once and frequent ones kept.

Defined results: a null text is empty and gives only the end id; null ids come first;
rows of equal id are ordered by their text; an empty table gives no file and no rows.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import blocks, wavelet
from kindred.session import fresh_path, materialise

SHARD_TOKENS = 1 << 21
BLOCK_BITS = 1 << 15
MAGIC = b"WVMTOK01"
#: Words whose ids a worker keeps (about 200 bytes each).
KEPT_WORDS = 700_000
NO_ID = -(1 << 63)

#: A blank that always begins a word of the tokenizer.
_inner_blank = re.compile(r"(?<=\S) (?=\S)")
#: Letters, marks, and perhaps a line break with letters and marks once more.
_marked_word = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)(?:\n([^\W\d_]+)([!-/:-@\[-`{-~]*))?").fullmatch


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A blank between two characters that are no white space always begins a word of
    the tokenizer, so what stands between such blanks can be encoded by itself. So can the
    letters, the marks and the line break of a word like ``end.\\nNext,``: the tokenizer
    always cuts between them.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        # One character of a byte-level token stands for one byte.
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        #: Ids of words with the blank before them, and of letters or marks with a line break before them.
        self.kept: dict[str, bytes] = {}
        self.lines: dict[str, bytes] = {}

    def _units(self, words: list[str], lead: str) -> dict[str, bytes]:
        """Ids of words that follow a blank, or of letters and marks that follow a line break."""
        if not words:
            return {}
        ids = np.array(self.tokenizer.encode_batch_fast([lead + lead.join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum([1 + len(w.encode()) for w in words])
        cuts = np.concatenate([[0], np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1]) * 4
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}

    def _all_units(self, wanted: set[str], lead: str, known: dict[str, bytes]) -> dict[str, bytes]:
        """Ids of units that are not among the known ones; known from now on as far as there is room."""
        plain, fresh = sorted(wanted.difference(known)), {}
        # In chunks, since the library takes several times a text's size while it encodes it.
        for i in range(0, len(plain), 20_000):
            fresh.update(self._units(plain[i:i + 20_000], lead))
        if len(self.kept) + len(self.lines) + len(fresh) <= KEPT_WORDS:
            known.update(fresh)
        return fresh

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of words that are not kept."""
        parted = {w: m.groups("") for w in wanted if (m := _marked_word(w))}
        heads, lines = {m[0] for m in parted.values()}, {x for m in parted.values() for x in m[1:] if x}
        again = {w for w, m in parted.items() if m[0] in self.kept}
        fresh = self._all_units(wanted.difference(parted) | heads, " ", self.kept)
        fresh_lines = self._all_units(lines, "\n", self.lines)
        kept, known = self.kept, self.lines
        made = {}
        for w, (head, marks, line, more) in parted.items():
            raw = (kept.get(head) or fresh[head]) + (known.get(marks) or fresh_lines[marks])[4:]
            if line:
                raw += known.get(line) or fresh_lines[line]
            if more:
                raw += (known.get(more) or fresh_lines[more])[4:]
            made[w] = raw
        # Kept are those whose letters were met before; many others never come again.
        if len(kept) + len(known) + len(again) <= KEPT_WORDS:
            kept.update((w, made[w]) for w in again)
        fresh.update(made)
        return fresh

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text. Each distinct word is looked up once; the ids are put in place with array operations."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(texts, " ")
        rows = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(rows[0], rows[-1] - rows[0]).dictionary_encode()
        rows, codes, words = rows - rows[0], coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.kept.get, words))
        wanted = {w for w, x in zip(words, found, strict=True) if x is None}
        # A blank beside other white space is no cut; kept words have none at their ends.
        odd = {w for w in wanted if not w or w.strip() != w}
        parted: dict[int, list[str]] = {}
        if odd:
            is_odd = np.fromiter((x is None and w in odd for w, x in zip(words, found, strict=True)), bool, len(words))
            where = np.unique(np.searchsorted(rows, np.flatnonzero(is_odd[codes]), "right") - 1)
            parted = {i: _inner_blank.split(texts[i].as_py()) for i in where.tolist()}
            wanted.difference_update(odd)
        first = codes[rows[:-1]]
        begins = [parted[i][0] if i in parted else words[c] for i, c in enumerate(first.tolist())]
        firsts = [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(begins, add_special_tokens=False)]
        # What only begins texts may be a whole text without blanks: it is of no use to others.
        inner = np.ones(len(codes), bool)
        inner[rows[:-1]] = False
        used = np.bincount(codes[inner], minlength=len(words)) > 0
        wanted.difference_update([words[c] for c in set(first.tolist()) if not used[c]])
        wanted.update(w for p in parted.values() for w in p[1:] if w not in self.kept)
        fresh = self._learn(wanted)
        held = [x if x is not None else fresh.get(w, b"") for w, x in zip(words, found, strict=True)] + firsts
        codes[rows[:-1]] = np.arange(len(firsts)) + len(words)
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        table, taken = np.frombuffer(b"".join(held), np.uint32), sizes[codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        shift = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], taken)
        raw, cuts = table[np.arange(ends[-1]) + shift].tobytes(), (ends[rows] * 4).tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i, p in parted.items():
            out[i] = firsts[i] + b"".join([self.kept.get(w) or fresh[w] for w in p[1:]])
        return out


#: The encoder of a worker; it serves one task after the other, with the words it keeps.
_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A file of ``ids``; ``ends``: where each document ends in them."""
    out, press = io.BytesIO(), zstandard.ZstdCompressor(level=3)
    # Codes number the ids that occur, in their order, which saves planes.
    occurs = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
    book = np.flatnonzero(occurs)
    levels = max(1, (len(book) - 1).bit_length() if len(book) else 1)
    codes = (np.cumsum(occurs) - 1).astype(np.uint16 if levels <= 16 else np.uint32)[ids]
    offsets, before, zeros = [], [], []
    for bits in wavelet.planes(codes, levels):
        ones = 0
        for i in range(0, len(bits), BLOCK_BITS):
            block = bits[i:i + BLOCK_BITS]
            offsets.append(out.tell())
            before.append(ones)
            ones += int(block.sum())
            out.write(press.compress(np.packbits(block, bitorder="little").tobytes()))
        zeros.append(len(bits) - ones)
    offsets.append(out.tell())
    arrays = [np.array(offsets, np.int64), np.array(before, np.int64), doc_ids.astype(np.int64), ends.astype(np.int64),
              book.astype(np.int64)]
    head = json.dumps({"tokens": len(ids), "levels": levels, "zeros": zeros, "docs": len(doc_ids)}).encode()
    directory = press.compress(len(head).to_bytes(8, "little") + head + b"".join(a.tobytes() for a in arrays))
    at = out.tell()
    out.write(directory + at.to_bytes(8, "little") + len(directory).to_bytes(8, "little") + MAGIC)
    return out.getvalue()


class TokenFile:
    """Reader of one file; ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source, self.press = source, zstandard.ZstdDecompressor()
        source.seek(-24, 2)
        tail = source.read(24)
        if tail[16:] != MAGIC:
            raise ValueError("not a token file")
        at, size = (int.from_bytes(tail[i:i + 8], "little") for i in (0, 8))
        source.seek(at)
        raw = self.press.decompress(source.read(size))
        end = 8 + int.from_bytes(raw[:8], "little")
        head = json.loads(raw[8:end])
        self.tokens, self.levels, self.zeros = head["tokens"], head["levels"], head["zeros"]
        self.per_plane = -(-self.tokens // BLOCK_BITS)
        blocks_, docs = self.per_plane * self.levels, head["docs"]
        values = np.frombuffer(raw[end:], np.int64)
        self.offsets, self.before = values[:blocks_ + 1], values[blocks_ + 1:2 * blocks_ + 1]
        self.doc_ids, self.ends, self.book = np.split(values[2 * blocks_ + 1:], [docs, 2 * docs])
        self.open: dict[int, np.ndarray] = {}

    def _block(self, level: int, number: int) -> np.ndarray:
        key = level * self.per_plane + number
        if key not in self.open:
            if len(self.open) >= 1024:
                self.open.clear()
            self.source.seek(int(self.offsets[key]))
            packed = self.press.decompress(self.source.read(int(self.offsets[key + 1] - self.offsets[key])))
            size = min(BLOCK_BITS, self.tokens - number * BLOCK_BITS)
            self.open[key] = np.unpackbits(np.frombuffer(packed, np.uint8), count=size, bitorder="little").astype(bool)
        return self.open[key]

    def _plane(self, level: int) -> np.ndarray:
        return np.concatenate([self._block(level, b) for b in range(self.per_plane)] or [np.zeros(0, bool)])

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before a place."""
        number = at // BLOCK_BITS
        if number == self.per_plane:
            return self.tokens - self.zeros[level]
        return int(self.before[level * self.per_plane + number]
                   + self._block(level, number)[:at - number * BLOCK_BITS].sum())

    def access(self, at: int) -> int:
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = 0
        for level in range(self.levels):
            number = at // BLOCK_BITS
            bit = bool(self._block(level, number)[at - number * BLOCK_BITS])
            ones = self._ones(level, at)
            value = value * 2 + bit
            at = self.zeros[level] + ones if bit else at - ones
        return int(self.book[value])

    def _code(self, token: int) -> int:
        """Number of a token in the file, -1 if it does not occur."""
        at = int(np.searchsorted(self.book, token))
        return at if at < len(self.book) and self.book[at] == token else -1

    def _range(self, code: int, end: int) -> tuple[int, int]:
        low, high = 0, end
        if code < 0:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            if code >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` before ``end``."""
        low, high = self._range(self._code(token), end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def occurrences(self, token: int) -> np.ndarray:
        """Places of ``token``, ascending."""
        code = self._code(token)
        low, high = self._range(code, self.tokens)
        at = np.arange(low, high)
        for level in range(self.levels - 1, -1, -1):
            if not len(at):
                break
            bits = self._plane(level)
            up = code >> (self.levels - 1 - level) & 1
            at = np.flatnonzero(bits)[at - self.zeros[level]] if up else np.flatnonzero(~bits)[at]
        return at

    def select(self, token: int, number: int) -> int:
        """Place of occurrence ``number`` (from 0)."""
        return int(self.occurrences(token)[number])

    def ids(self) -> np.ndarray:
        """All ids; every plane is read once."""
        held = [self._plane(level) for level in range(self.levels)]
        self.open.clear()
        return self.book.astype(np.uint32)[wavelet.restore(held, self.tokens, np.uint16 if self.levels <= 16 else np.uint32)]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
          shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """file, n_docs, n_tokens of the files written for ``docs`` (doc_id, text).

    File names sort as the documents do.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", "text").withColumn("_range", F.spark_partition_id())
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        held, ids, size, number, where = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            name = f"{where:07d}-{number:05d}.wvm"
            ends = np.cumsum([len(h) // 4 for h in held])
            packed = pack(np.frombuffer(b"".join(held), np.uint32), np.array(ids, np.int64), ends)
            trial = f"{root}/_{name}-{uuid.uuid4().hex}"
            with system.open_output_stream(trial) as sink:
                sink.write(packed)
            system.move(trial, f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"file": [name], "n_docs": [len(held)], "n_tokens": [int(ends[-1])]})

        for part, _, _ in blocks.slices(batches):
            where = part.column("_range")[0].as_py()
            texts = part.column("text").fill_null("")
            for doc_id, raw in zip(part.column("doc_id").fill_null(NO_ID).to_pylist(), encoder_of(tokenizer).encode(texts), strict=True):
                held.append(raw + end)
                ids.append(doc_id)
                size += len(raw) // 4 + 1
                if size >= shard_tokens:
                    yield flush()
                    held, ids, size, number = [], [], 0, number + 1
        if held:
            yield flush()

    pyarrow.fs.FileSystem.from_uri(folder)[0].create_dir(pyarrow.fs.FileSystem.from_uri(folder)[1], recursive=True)
    return materialise(ordered.mapInArrow(run, "file string, n_docs long, n_tokens long"), "token-files")


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file, place
    (in its file), read from the ``files`` (file, n_docs, n_tokens) in ``folder``."""
    starts = _starts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, offset in zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{name}") as source:
                    held = TokenFile(source)
                    raw, ends = held.ids().astype("<u4").tobytes(), held.ends
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                checks = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(held.doc_ids, mask=held.doc_ids == NO_ID), pa.array(begins + offset),
                    pa.array(ends - begins), pa.array(checks, pa.int64()), pa.array([name] * len(ends)),
                    pa.array(begins)], names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "place"])

    # Equal dealing of few small rows, each of which stands for a file.
    return starts.repartition(max(1, starts.count()), "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long")


def _starts(files: DataFrame) -> DataFrame:
    """file, offset: the ids in all files before, by sums of ranges and within each."""
    group = F.substring("file", 1, 4)
    sums = files.groupBy(group.alias("g")).agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("g").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("g").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    return materialise(
        files.withColumn("g", group).withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(sums.select("g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "g")
        .select("file", (F.col("base") + F.col("within")).alias("offset")), "token-starts")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` to token files in a fresh shared folder and read them back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    return read(docs.sparkSession, folder, write(docs, folder, tokenizer, end_id, shard_tokens))
