"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text becomes *marked words*: blanks turn into marks, one more stands before the text,
and a word is a run of marks with what follows up to the next mark. No piece of the
model crosses a word's end (checked when it is loaded), so the best split of a text is
the best splits of its words.

The distinct words of a slice are sorted, which puts words of one prefix side by side,
as a depth-first walk of their trie meets them. The walk keeps the forward scores of
the current prefix; a word computes those of its own suffix alone.

Words are found and looked up as byte ranges by array operations; a worker keeps the
pieces of words it has met under a 64-bit hash of their bytes (some 30 bytes a word, up
to a bound, then it begins anew), so only words that are new to it become strings.

The best split has the highest sum of piece scores; of equal sums the one whose last
piece is longest wins, then so on to the left, which is what the unigram algorithm of
SentencePiece does. A character that is no piece is written as its UTF-8 bytes.

Defined results: a null text is empty, an empty one has no pieces; decoding gives the
text back exactly, but that a mark character within a text comes back as a blank, as
in SentencePiece itself; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from kindred.llm import blocks

MARK = "▁"
#: Penalty of an unknown character below the worst piece; fixed value of the algorithm.
UNKNOWN_PENALTY = 10
#: Words whose pieces a worker keeps (about 30 bytes each).
KEPT_WORDS = 1_500_000
_BLANK = 0x20
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)

_words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Vocabulary:
    """Pieces with their scores, bytes for unknown characters, and the bytes of each id."""

    scores: dict[str, float]
    ids: dict[str, int]
    suffixes: set[str]
    byte_ids: list[int]
    unknown_id: int
    texts: list[bytes]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = SentencePieceProcessor(model_file=path)
        scores, ids, byte_ids, texts = {}, {}, [-1] * 256, []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses the end of a word")
                scores[piece], ids[piece] = model.get_score(i), i
                texts.append(piece.replace(MARK, " ").encode())
        suffixes = {p[j:] for p in scores for j in range(len(p))}
        return cls(scores, ids, suffixes, byte_ids, model.unk_id(), texts)


def encode_words(words: list[str], vocabulary: Vocabulary) -> dict[str, list[int]]:
    """Pieces of each distinct word; ``words`` in any order."""
    scores, suffixes, ids = vocabulary.scores, vocabulary.suffixes, vocabulary.ids
    unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
    best, back = [0.0], [0]  # forward score and start of the last piece, for every prefix
    out: dict[str, list[int]] = {}
    before = ""
    for word in sorted(words):
        same = 0
        for x, y in zip(before, word, strict=False):
            if x != y:
                break
            same += 1
        del best[same + 1:], back[same + 1:]
        for end in range(same + 1, len(word) + 1):
            top, at, start = None, end - 1, end - 1
            while start >= 0:
                part = word[start:end]
                if part not in suffixes:
                    break
                score = scores.get(part)
                if score is not None:
                    total = best[start] + score
                    if top is None or total >= top:
                        top, at = total, start
                start -= 1
            if word[end - 1] not in scores:
                total = best[end - 1] + unknown
                if top is None or total > top:
                    top, at = total, end - 1
            best.append(top)
            back.append(at)
        pieces, end = [], len(word)
        while end:
            start = back[end]
            piece = ids.get(word[start:end])
            if piece is not None:
                pieces.append(piece)
            else:
                raw = [vocabulary.byte_ids[b] for b in word[start:end].encode()]
                pieces += reversed(raw) if min(raw) >= 0 else [vocabulary.unknown_id]
            end = start
        pieces.reverse()
        out[word] = pieces
        before = word
    return out


def marked_words(text: str) -> list[str]:
    """The marked words of a text, in order; together they are the whole marked text."""
    if not text:
        return []
    return _words.findall(MARK + text.replace(" ", MARK))


def _gather(arena: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``arena`` one after the other."""
    ends = np.cumsum(sizes)
    return arena[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def blanked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end with marks as blanks, and one more before every text that is not empty."""
    at = np.flatnonzero((data[:-2] == _MARK_BYTES[0]) & (data[1:-1] == _MARK_BYTES[1]) & (data[2:] == _MARK_BYTES[2])
                        ) if len(data) > 2 else np.zeros(0, np.int64)
    if len(at):
        data, keep = data.copy(), np.ones(len(data), bool)
        data[at] = _BLANK
        keep[at + 1] = keep[at + 2] = False
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        data = data[keep]
    sizes = np.diff(offsets)
    fresh = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
    out = np.full(int(fresh[-1]), _BLANK, np.uint8)
    inside = np.ones(len(out), bool)
    inside[fresh[:-1][sizes > 0]] = False
    out[inside] = data
    return out, fresh


class Codec:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary.load(path)
        texts = self.vocabulary.texts
        self.text_sizes = np.array([len(t) for t in texts], np.int64)
        self.text_begins = np.cumsum(self.text_sizes) - self.text_sizes
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.arena = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all texts, where each text's begin (and the last end), and its number of marked words."""
        data, offsets = blanked(data, offsets)
        blank = data == _BLANK
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        hashes, sample, word = np.unique(blocks.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = self._known(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(data, starts[sample[new]], ends[sample[new]], hashes[new], hashes)
            at = self._known(hashes)
        sizes = self.sizes[at][word].astype(np.int64)
        pieces = _gather(self.arena, self.begins[at][word], sizes)
        return pieces, np.concatenate([[0], np.cumsum(sizes)])[first], np.diff(first)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes among the kept ones, -1 where there is none."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, wanted: np.ndarray) -> None:
        raw = data.tobytes()
        words = [raw[a:b].decode("utf-8", "replace").replace(" ", MARK)
                 for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        found = encode_words(list(set(words)), self.vocabulary)
        if len(self.hashes) + len(words) > KEPT_WORDS:  # of the kept ones, only those of this slice
            at = self._known(wanted)
            at = at[at >= 0]
            self.arena = _gather(self.arena, self.begins[at], self.sizes[at].astype(np.int64))
            self.hashes, self.sizes = self.hashes[at], self.sizes[at]
            self.begins = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        sizes = np.array([len(found[w]) for w in words], np.int32)
        fresh = np.array([p for w in words for p in found[w]], np.int32)
        begins = len(self.arena) + np.cumsum(sizes, dtype=np.int64) - sizes
        self.arena = np.concatenate([self.arena, fresh])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]

    def decode(self, pieces: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text that the pieces of each row spell, without the blank before it."""
        sizes = self.text_sizes[pieces]
        data = _gather(self.text_bytes, self.text_begins[pieces], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        keep = np.ones(len(data), bool)
        keep[ends[:-1][np.diff(ends) > 0]] = False
        return blocks.as_strings(data[keep], np.maximum(np.diff(ends) - 1, 0))


#: The codec of a worker; it serves one task after the other, with the words it keeps.
_codecs: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _lists(pieces: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(pieces, pa.int32()))


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with pieces (ids) and n_words (marked words)."""
    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        pieces, begins, count = codec_of(model).encode(data, offsets)
        return [_lists(pieces, begins), pa.array(count, pa.int64())]

    return blocks.add_columns(docs, "pieces array<int>, n_words long", of, text)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (pieces) with decoded, the text that its pieces spell; null pieces are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            texts = codec_of(model).decode(lists.flatten().to_numpy(zero_copy_only=False),
                                           np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    kept = encoded.drop("decoded")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_words, n_pieces, pieces, restored: the pieces spell the text again.

    Both ways go through one worker, which holds one codec.
    """
    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        codec = codec_of(model)
        pieces, begins, count = codec.encode(data, offsets)
        return [_lists(pieces, begins), pa.array(count, pa.int64()), codec.decode(pieces, begins)]

    coded = blocks.add_columns(docs.select("doc_id", "text"), "pieces array<int>, n_words long, decoded string", of)
    return coded.select(
        "doc_id", "n_words", F.size("pieces").cast("long").alias("n_pieces"), "pieces",
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), MARK, " ")).alias("restored"))
