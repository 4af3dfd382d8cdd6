"""Quality: ordinal cumulative-link regression on graded ratings over hashed text.

One weight vector is shared by all grades; ordered thresholds cut its score: P(grade <= k) = sigmoid(threshold_k - score).
Features are hashed byte trigrams, which see case and punctuation, and a few hashed style measures.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, NON_SPACE, SEGMENT, byte_chunks, crc_text, hold, span_totals, spread, text_bytes, word_hashes, word_spans
from tickloom.llm.labelled import PER_LABEL, sample_of

#: Hashed trigram buckets, buckets of each style measure, and their weight beside the trigrams.
TRIGRAMS, BINS, STYLE = 2048, 12, 0.5
MEASURES = 6
WIDTH = TRIGRAMS + BINS * MEASURES + 1
#: Rows whose features are held at once.
ROWS = 256
STEPS, RATE, DECAY = 250, 0.05, 1e-5
#: Bytes of a style measure: capitals, and signs.
_KINDS = np.zeros(256, np.int8)
_KINDS[65:91] = 1
_KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A feature row for each text; an empty text has the constant only."""
    n = len(off) - 1
    out = np.zeros((n, WIDTH), np.float32)
    sizes = np.diff(off)
    counts = np.zeros(n * TRIGRAMS)
    for lo in range(0, len(data), SEGMENT):  # long texts are counted in segments that overlap by two bytes
        hi = min(len(data), lo + SEGMENT)
        raw = data[lo : min(len(data), hi + 2)].astype(np.uint32)
        key = (raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F) >> np.uint32(21)
        at = np.arange(lo, lo + len(key))
        row = np.searchsorted(off, at, "right") - 1 if n > 1 else np.zeros(len(at), np.int64)
        inside = at + 2 < off[row + 1]
        counts += np.bincount(row[inside] * TRIGRAMS + key[inside], minlength=n * TRIGRAMS)
    shares = np.sqrt(counts.reshape(n, TRIGRAMS))
    norms = np.sqrt((shares**2).sum(axis=1, keepdims=True))
    out[:, :TRIGRAMS] = shares / np.where(norms > 0, norms, 1)
    starts, ends, before = word_spans(data, off, NON_SPACE)
    words = np.diff(before)
    total = np.maximum(words, 1)
    hashes = word_hashes(data, starts, ends, LOWER)
    row = np.repeat(np.arange(n), words)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    length = np.maximum(sizes, 1)
    measures = [
        np.bincount(row[same], minlength=n) / total,
        np.bincount(row[order][new], minlength=n) / total,
        span_totals(_KINDS == 1, data, off[:-1], off[1:]) / length,
        span_totals(_KINDS == 2, data, off[:-1], off[1:]) / length,
        np.minimum(1, sizes / total / 24),
        np.minimum(1, np.log1p(words) / 12),
    ]
    for k, value in enumerate(measures):
        out[np.arange(n), TRIGRAMS + k * BINS + np.minimum(BINS - 1, (np.sqrt(value) * BINS).astype(np.int64))] = STYLE * (words > 0)
    out[:, -1] = 1
    return out


@dataclass
class Model:
    """Grades in order, the shared weights, and the thresholds between grades."""

    grades: list
    weights: np.ndarray
    thresholds: np.ndarray

    def at_most(self, x: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each row and each k but the last."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds - (x @ self.weights)[:, None], -40, 40)))

    def predict(self, x: np.ndarray, tail_from) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, probability of a grade of at least ``tail_from``)."""
        below = np.concatenate([np.zeros((len(x), 1)), self.at_most(x), np.ones((len(x), 1))], axis=1)
        chance = np.diff(below, axis=1)
        tail = np.array([g >= tail_from for g in self.grades])
        return chance @ np.array(self.grades, np.float64), chance[:, tail].sum(axis=1)


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Maximum likelihood by full-batch Adam; grades weigh alike. With one grade, or none, every row gets it."""
    grades = sorted(set(y.tolist())) or [0]
    k = len(grades)
    level = np.searchsorted(grades, y)
    model = Model(grades, np.zeros(x.shape[1] if len(x) else WIDTH, np.float32), np.zeros(0))
    if k < 2:
        return model
    weight = (1 / (k * np.bincount(level)))[level]
    # thresholds stay ordered: the first is free, the others add a positive step
    free = np.concatenate([[0.0], np.zeros(k - 2)])
    state = [model.weights.astype(np.float64), free]
    first, second = [np.zeros_like(v) for v in state], [np.zeros_like(v) for v in state]
    for step in range(1, STEPS + 1):
        w, free = state
        theta = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        score = x @ w.astype(np.float32)
        upper = np.append(theta, np.inf)[level] - score
        lower = np.insert(theta, 0, -np.inf)[level] - score
        a, b = (1 / (1 + np.exp(-np.clip(v, -40, 40))) for v in (upper, lower))
        chance = np.maximum(a - b, 1e-9)
        up, down = weight * a * (1 - a) / chance * np.isfinite(upper), weight * b * (1 - b) / chance * np.isfinite(lower)
        g_score = up - down
        g_theta = np.bincount(level, -up, k + 1)[: k - 1] + np.bincount(level, down, k + 1)[1:k]
        g_free = np.concatenate([[g_theta.sum()], np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(free[1:])])
        for v, g, m, s in zip(state, (x.T @ g_score.astype(np.float32) + DECAY * w, g_free), first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    w, free = state
    return Model(grades, w.astype(np.float32), free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))]))


def _blocks(batch: pa.RecordBatch, name: str):
    """(slice, its features) of at most ``ROWS`` rows."""
    hold("quality")
    for part in byte_chunks(batch, name, 4 << 20):
        for lo in range(0, len(part), ROWS):
            some = part.slice(lo, ROWS)
            yield some, features(*text_bytes(some.column(name)))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, label: str = "quality") -> Model:
    """Train on a bounded sample of the labelled rows whose crc32 leaves a remainder other than 0 modulo 5.

    The sample is bounded, so one task makes its features and trains on all of it; the driver gets the weights.
    """

    def run(batches):
        parts, grades = [], []
        for batch in batches:
            for some, x in _blocks(batch, "text"):
                parts.append(x)
                grades += some.column("y").to_pylist()
        model = train(np.concatenate(parts) if parts else np.zeros((0, WIDTH), np.float32), np.array(grades))
        yield pa.RecordBatch.from_arrays([pa.array([[float(g) for g in model.grades]], pa.list_(pa.float64())), pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([model.thresholds.tolist()], pa.list_(pa.float64()))], ["grades", "weights", "thresholds"])

    # in one order, whatever the partitions, as sums of floats depend on it
    found = sample_of(docs, labels, label, 5, 0, per_label).repartition(1).sortWithinPartitions("y", "text").mapInArrow(run, "grades array<double>, weights binary, thresholds array<double>").collect()
    if not found:
        return train(np.zeros((0, WIDTH), np.float32), np.zeros(0))
    return Model(found[0].grades, np.frombuffer(found[0].weights, np.float32), np.array(found[0].thresholds))


def quality(docs: DataFrame, labels: DataFrame, tail_from=1, least_tail: float = 0.5, per_label: int = PER_LABEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, expected_grade, tail_probability (of a grade of at least ``tail_from``), kept.

    Map only after the fit. A null or empty text is scored by the constant feature; a long text is scored whole, in
    segments; with one grade, or no labels, all rows get the same values; null ids are not held out; repeated rows give a
    row each; an empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, per_label)

    def run(batches):
        for batch in batches:
            for some, x in _blocks(batch, "t"):
                expected, tail = model.predict(x, tail_from)
                yield pa.RecordBatch.from_arrays([some.column("i"), pa.array(expected.astype(np.float64)), pa.array(tail.astype(np.float64))], ["doc_id", "expected_grade", "tail_probability"])

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    rows = source.mapInArrow(run, f"doc_id {source.schema['i'].dataType.simpleString()}, expected_grade double, tail_probability double")
    return rows.select("doc_id", F.coalesce(crc_text("doc_id") % 5 == 0, F.lit(False)).alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= least_tail).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, tail_from=1, least_tail: float = 0.5, per_label: int = PER_LABEL, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, whose tail probability is at least ``least_tail``.

    Nulls, empty and long texts are scored as in :func:`quality`; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(docs, labels, per_label)

    def run(batches):
        for batch in batches:
            for some, x in _blocks(batch, text_col):
                yield some.filter(pa.array(model.predict(x, tail_from)[1] >= least_tail))

    return docs.mapInArrow(run, docs.schema)
