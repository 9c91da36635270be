"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its lower-cased words and their beginnings of four to six bytes,
hashed into 2^20 buckets; each counts once. Besides a weight, each bucket has a short
vector, and two buckets that meet in a text add the product of theirs (Rendle, 2010):
an insult beside the mention of a group weighs more than both alone, which no sum of
weights can express. Products count by ``PAIR_SCALE`` over the number of the text's terms,
so that long texts are not carried away by them.

Learned on at most ``MAX_ROWS`` labelled rows and about ``MAX_TERMS`` terms (the
documented bounds; rows are chosen by hash). Every bucket met in
them has a weight and a vector, for a term that tells nothing alone may tell beside
another; instead of a choice of terms, weights are drawn to zero by as much as chance
moves them and vectors decay. That keeps margins small, so a fifth of the learned rows
is left out of the training and sets the scale and shift that turn margins into
probabilities; there a missed toxic row costs as much as ``MISS_COST`` false alarms. The model is a table of at most ``BUCKETS`` rows of
``FACTORS`` + 1 numbers (38 MB) and is broadcast; every text is then scored whole, in one
pass, without a shuffle.

Defined results: an empty or null text has no terms and gets the base score; without
usable labels of both kinds every text gets the share of toxic rows (0 if there is no
row); repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import blocks
from kindred.llm.labelled import held_out, training_rows
from kindred.session import materialise

BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)
MAX_ROWS = 20_000
FACTORS = 8
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.1, 2e-4
PAIR_SCALE = 9.0
#: Decay of the vectors: what the product of two terms must come to before they grow.
FACTOR_DECAY = 1e-2
#: Standard errors of its gradient that a weight is drawn towards zero by.
SHRINK = 1.0
THRESHOLD = 0.5
#: Terms of all learned rows that come to the driver (four bytes each).
MAX_TERMS = 40_000_000
#: Every so manieth learned row is left for the calibration, which needs so many of each label.
CALIBRATION_FOLD, CALIBRATION_LEAST = 5, 10
MISS_COST = 3.0


def term_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every term of a slice, with repetitions."""
    starts, ends, first = blocks.spans(data, offsets, blocks.ALPHANUMERIC)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rows, found = [row], [blocks.word_hashes(data, starts, ends, blocks.LOWER)]
    for size in BEGINNINGS:
        longer = ends - starts > size
        s = starts[longer]
        rows.append(row[longer])
        found.append(blocks.word_hashes(data, s, s + size, blocks.LOWER) ^ np.uint64(size * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return np.concatenate(rows), (blocks.mix(np.concatenate(found)) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Machine:
    """``slot`` maps a bucket to its row in ``weights`` and ``factors``, or -1."""

    slot: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def probabilities(self, row: np.ndarray, slot: np.ndarray, rows: int) -> np.ndarray:
        return _sigmoid(self.scale * self.margins(row, slot, rows) + self.shift)

    def terms(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, slot) of a slice."""
        row, bucket = term_buckets(data, offsets)
        slot = self.slot[bucket]
        known = slot >= 0
        pairs = np.unique(row[known] * BUCKETS + slot[known])
        return pairs // BUCKETS, pairs % BUCKETS

    def margins(self, row: np.ndarray, slot: np.ndarray, rows: int) -> np.ndarray:
        total, inner, scale = self._sums(row, slot, rows)
        return self.bias + np.bincount(row, self.weights[slot], rows) + 0.5 * scale * ((total ** 2).sum(1) - inner)

    def _sums(self, row: np.ndarray, slot: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of the vectors of each row, of their squares, and the scale of its pairs; ``row`` ascends."""
        size = np.bincount(row, minlength=rows)
        total, inner, filled = np.zeros((rows, FACTORS), np.float32), np.zeros(rows, np.float32), size > 0
        if len(row):
            held, first = self.factors[slot], (np.cumsum(size) - size)[filled]
            total[filled] = np.add.reduceat(held, first)
            inner[filled] = np.add.reduceat(np.einsum("ij,ij->i", held, held), first)
        return total, inner, PAIR_SCALE / np.maximum(1, size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(slot: np.ndarray, terms: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Adaptive gradient descent on the logistic loss; ``terms``: slots of each row."""
    random, count = np.random.default_rng(seed), int(slot.max(initial=-1)) + 1
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-6, 1 - 1e-6))
    machine = Machine(slot, float(np.log(share / (1 - share))), np.zeros(count, np.float32),
                      random.normal(0, 0.05, (count, FACTORS)).astype(np.float32))
    if not count or len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    size = np.array([len(t) for t in terms], np.int64)
    flat, begin = np.concatenate(terms), np.cumsum(size) - size
    # Standard error of each weight's mean gradient, for the batches that hold the term.
    held = np.bincount(flat, minlength=count) / len(labels)
    chance = SHRINK * np.sqrt(held * share * (1 - share) / len(labels)) / np.maximum(
        1e-9, 1 - (1 - held) ** min(BATCH, len(labels)))
    seen_w, seen_f, seen_b = np.full(count, 1e-2, np.float32), np.full((count, FACTORS), 1e-2, np.float32), 1e-2
    met, place = np.zeros(count, bool), np.zeros(count, np.int32)
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            row = np.repeat(np.arange(len(part)), size[part])
            here = flat[np.repeat(begin[part] - np.cumsum(size[part]) + size[part], size[part]) + np.arange(len(row))]
            total, inner, scale = machine._sums(row, here, len(part))
            margin = (machine.bias + np.bincount(row, machine.weights[here], len(part))
                      + 0.5 * scale * ((total ** 2).sum(1) - inner))
            error = (_sigmoid(margin) - labels[part]) / len(part)
            met[here] = True
            used = np.flatnonzero(met)
            met[used] = False
            place[used] = np.arange(len(used), dtype=np.int32)
            at = place[here]
            grad_w = np.bincount(at, error[row], len(used)) + DECAY * machine.weights[used]
            drawn = (error * scale)[:, None] * total
            own = FACTOR_DECAY - np.bincount(at, (error * scale)[row], len(used))
            grad_f = np.stack([np.bincount(at, drawn[:, f][row], len(used)) for f in range(FACTORS)], 1)
            grad_f += own[:, None] * machine.factors[used]
            seen_w[used] += grad_w ** 2
            seen_f[used] += grad_f ** 2
            seen_b += error.sum() ** 2
            rate = RATE / np.sqrt(seen_w[used])
            moved = machine.weights[used] - rate * grad_w
            machine.weights[used] = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * chance[used])
            machine.factors[used] -= RATE * grad_f / np.sqrt(seen_f[used])
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_ROWS) -> Machine:
    """The machine learned from at most ``most`` labelled rows that are not held out."""
    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        row, bucket = term_buckets(data, offsets)
        pairs = np.unique(row * BUCKETS + bucket)
        ends = np.searchsorted(pairs // BUCKETS, np.arange(part.num_rows + 1))
        flat = (pairs % BUCKETS).astype(np.int32)
        return [pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())]

    rows = materialise(blocks.add_columns(
        training_rows(docs, labels, label, most), "terms binary", of).select("label", "terms"), "terms")
    total = (rows.agg(F.sum(F.octet_length("terms"))).first()[0] or 0) // 4
    share = F.pmod(F.xxhash64("terms", F.lit("share")), F.lit(1 << 20)) < F.lit(
        (1 << 20) if total <= MAX_TERMS else int((1 << 20) * MAX_TERMS / total))
    found = rows.filter(share).collect()
    found.sort(key=lambda r: (r.terms, r.label))
    # Rows of equal terms are on one side.
    apart = np.array([zlib.crc32(r.terms) % CALIBRATION_FOLD == 0 for r in found], bool)
    terms = [np.frombuffer(r.terms, np.int32) for r in found]
    known = np.array([r.label for r in found], float)
    enough = min(int((known[apart] == x).sum()) for x in (0, 1)) >= CALIBRATION_LEAST
    learned = np.flatnonzero(~apart) if enough else np.arange(len(found))
    met = np.zeros(BUCKETS, bool)
    for i in learned:
        met[terms[i]] = True
    slot = np.where(met, np.cumsum(met) - 1, -1).astype(np.int32)
    machine = train(slot, [slot[terms[i]] for i in learned], known[learned])
    if enough:
        left = [np.sort(slot[t[slot[t] >= 0]]) for t in (terms[i] for i in np.flatnonzero(apart))]
        margins = machine.margins(np.repeat(np.arange(len(left)), [len(t) for t in left]), np.concatenate(left), len(left))
        machine.scale, machine.shift = calibration(margins, known[apart])
    return machine


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale (at least 0) and shift of the logistic curve through (margin, label) after Platt
    (1999), with his smoothed targets; toxic rows weigh ``MISS_COST`` each."""
    count = np.array([(labels == x).sum() for x in (0, 1)])
    target = np.where(labels == 1, (count[1] + 1) / (count[1] + 2), 1 / (count[0] + 2))
    weight = np.where(labels == 1, MISS_COST, 1.0) / len(labels)
    at = np.array([1.0, 0.0])
    for _ in range(100):  # damped Newton steps on a convex function of two numbers
        p = _sigmoid(at[0] * margins + at[1])
        slope, bend = weight * (p - target), weight * p * (1 - p)
        gradient = np.array([(slope * margins).sum() + 1e-6 * (at[0] - 1), slope.sum()])
        hessian = np.array([[(bend * margins ** 2).sum() + 1e-6, (bend * margins).sum()],
                            [(bend * margins).sum(), bend.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        at -= step * min(1.0, 1.0 / np.abs(step).max()) if np.abs(step).max() > 0 else step
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(at[0])), float(at[1])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def of(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        row, slot = shared.value.terms(data, offsets)
        return [pa.array(shared.value.probabilities(row, slot, part.num_rows))]

    return blocks.add_columns(docs, "score double", of).withColumns({
        "held_out": held_out(F.col("doc_id")),
        "predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)})
