"""Quality by nearest-neighbour voting in a latent semantic space.

Terms of a text are trigrams of character classes (lower case, upper case, digit, every
punctuation mark by itself, and so on), which tell how it is written rather than what
about, and counts of repeated words. Weighted by log frequency times inverse document
frequency over all documents, they are projected on the leading singular vectors of
the labelled sample.

At most ``MAX_ROWS`` labelled rows (the documented bound) become vectors of ``DIMENSIONS``
numbers and are broadcast. Every document is compared with all of them: exact cosines,
block by block as matrix products. Its ``NEIGHBOURS`` nearest vote with their labels,
weighted by similarity; ties go to the earlier row of the sample.

Defined results: an empty or null text has no terms and gets the share of label 1 in
the sample (1 without any sample); texts without a similar neighbour too; repeated rows
score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import blocks
from kindred.llm.labelled import held_out, training_rows

MAX_ROWS = 4096
DIMENSIONS = 64
NEIGHBOURS = 15
THRESHOLD = 0.3
TRIGRAMS = 1024
#: Words equal to the one before, and words equal to the one two before.
REPEATS = 2
TERMS = TRIGRAMS + REPEATS
#: Documents compared at once.
BLOCK = 512

#: Class of each byte: 0 lower, 1 upper, 2 digit, 3 other UTF-8, 4 blank, 5 line end, punctuation by itself.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 3
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0D]] = 4, 5


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x TERMS counts."""
    rows = len(offsets) - 1
    out = np.zeros((rows, TERMS), np.float32)
    if not len(data):
        return out
    kinds = _CLASS[data]
    code = kinds[:-2] + kinds[1:-1] * np.uint64(256) + kinds[2:] * np.uint64(65536) if len(data) > 2 else np.zeros(0, np.uint64)
    bucket = (blocks.mix(code) & np.uint64(TRIGRAMS - 1)).astype(np.int64)
    starts, ends, first = blocks.spans(data, offsets, blocks.UNSPACED)
    words = blocks.word_hashes(data, starts, ends)
    for r in range(rows):
        a, b = offsets[r], max(offsets[r], offsets[r + 1] - 2)
        out[r, :TRIGRAMS] = np.bincount(bucket[a:b], minlength=TRIGRAMS)
        own = words[first[r]:first[r + 1]]
        for gap in (1, 2):
            out[r, TRIGRAMS + gap - 1] = (own[gap:] == own[:-gap]).sum()
    return out


@dataclass
class Space:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    default: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit((np.log1p(counts) * self.idf) @ self.basis)

    def votes(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest vectors."""
        near = min(NEIGHBOURS, len(self.labels))
        if not near:
            return np.full(len(counts), self.default)
        cosines = np.maximum(self.project(counts) @ self.vectors.T, 0)
        # Equal cosines (repeated rows) are told apart by place, so results do not depend on blocks.
        ranked = np.round(cosines.astype(np.float64), 5) - np.arange(len(self.labels)) * 1e-9
        nearest = np.argpartition(-ranked, near - 1, axis=1)[:, :near]
        weight = np.take_along_axis(cosines, nearest, 1).astype(float)
        total = weight.sum(1)
        share = (weight * self.labels[nearest]).sum(1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, share, self.default), 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each term, and all documents. Every task sends one short row for each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = np.zeros(TERMS + 1, np.int64), 0
        for part, data, offsets in blocks.slices(batches):
            held[:TERMS] += (term_counts(data, offsets) > 0).sum(0)
            count += part.num_rows
        held[TERMS] = count
        yield pa.RecordBatch.from_pydict({"term": np.arange(TERMS + 1, dtype=np.int32), "n": held})

    sums = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(TERMS + 1, np.int64)
    for r in sums:
        out[r.term] = r.n
    return out[:TERMS], int(out[TERMS])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_ROWS) -> Space:
    frequency, count = document_frequencies(docs)
    idf = np.log((1 + count) / (1 + frequency)).astype(np.float32) + np.float32(0.05)

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        return [pa.array([c.tobytes() for c in term_counts(data, offsets).astype(np.float32)], pa.binary())]

    found = blocks.add_columns(training_rows(docs, labels, label, most), "counts binary", of).select(
        "label", "counts").collect()  # at most ``most`` rows of TERMS numbers
    found.sort(key=lambda r: (r.counts, r.label))
    if not found:
        return Space(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 1.0)
    counts = np.stack([np.frombuffer(r.counts, np.float32) for r in found])
    weighted = np.log1p(counts) * idf
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    basis = vectors[:, np.argsort(-values)[:DIMENSIONS]].astype(np.float32)
    known = np.array([r.label for r in found], float)
    return Space(idf, basis, _unit(weighted @ basis), known, float(known.mean()))


def score(docs: DataFrame, space: Space) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        counts = term_counts(data, offsets)
        votes = [shared.value.votes(counts[i:i + BLOCK]) for i in range(0, len(counts), BLOCK)]
        return [pa.array(np.concatenate(votes), pa.float64())]

    return blocks.add_columns(docs, "score double", of).withColumns({
        "held_out": held_out(F.col("doc_id")),
        "predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)})
