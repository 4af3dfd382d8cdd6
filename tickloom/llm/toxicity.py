"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed byte n-grams, the bag of a window of words the mean of its words, and the
softmax of that mean the window's probability. The text's score is not one mean over all of its words but that of its
worst window, so a long text hides nothing; in training the windows of a text are weighted by a softmax of their scores
that sharpens step by step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ALNUM, LOWER, byte_chunks, crc_text, hold, spread, text_bytes, word_hashes, word_spans
from tickloom.llm.labelled import PER_LABEL, sample_of

#: Words of a window, n-gram sizes in bytes, hash buckets and vector width.
WINDOW, GRAMS, BUCKETS, WIDTH = 2, (3, 4, 5), 1 << 20, 4
#: Adam steps, their rate, the factor on a window's mean (the share of one word is small), and the least uses of an n-gram.
STEPS, RATE, GAIN, LEAST_USES = 36, 0.05, 16.0, 5
#: A run of more bytes (scripts without spaces, glued letters) is cut into pieces of so many bytes, so many apart, each a word
#: of its own. Pieces are short and overlap by more than the longest n-gram, so that a word in a run is not diluted by the rest.
LONGEST, PIECE, PIECE_STEP = 24, 12, 4
#: Words whose n-grams are handled at once.
SLICE = 1 << 15
#: Letters in lower case and every digit as 0: numbers say nothing, so none is learnt by heart.
PLAIN = LOWER.copy()
PLAIN[48:58] = 48


@dataclass
class Model:
    """What a task needs: the score of each n-gram bucket (its vector against the softmax weights), and the bias."""

    grams: np.ndarray
    bias: float


def pieces(starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row) with long runs cut into pieces; each n-gram of a run is whole in one of them."""
    long = ends - starts > LONGEST
    count = np.where(long, -(-(ends - starts - PIECE) // PIECE_STEP) + 1, 1)
    first = np.concatenate([[0], np.cumsum(count)])
    cut = np.repeat(starts, count) + (np.arange(first[-1]) - np.repeat(first[:-1], count)) * PIECE_STEP
    return cut, np.minimum(cut + np.where(np.repeat(long, count), PIECE, LONGEST), np.repeat(ends, count)), first[before]


def words_and_windows(data: np.ndarray, off: np.ndarray):
    """(distinct words' spans, word of each place, windows' first places, windows before each row)."""
    data = PLAIN[data]
    starts, ends, before = pieces(*word_spans(data, off, ALNUM))
    _, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    counts = -(-np.diff(before) // WINDOW)
    windows = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    heads = before[row] + (np.arange(windows[-1]) - windows[row]) * WINDOW
    return data, starts[first], ends[first], which, heads, windows


def gram_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram of `<word>`, n-grams before each word); words are taken in slices, so little is held besides."""
    found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(starts), SLICE):
        a, size = starts[i : i + SLICE], ends[i : i + SLICE] - starts[i : i + SLICE] + 2
        off = np.concatenate([[0], np.cumsum(size)])
        text = np.full(off[-1], ord("<"), np.uint64)
        inner = np.ones(off[-1], bool)
        inner[off[:-1]] = inner[off[1:] - 1] = False
        text[off[1:] - 1] = ord(">")
        text[inner] = data[np.repeat(a, size - 2) + np.arange(off[-1] - 2 * len(size)) - np.repeat(off[:-1] - 2 * np.arange(len(size)), size - 2)]
        left = np.repeat(off[1:], size) - np.arange(off[-1])
        ids = np.empty((off[-1], len(GRAMS)), np.int32)
        for k, n in enumerate(GRAMS):
            key = np.full(off[-1], n, np.uint64)
            for j in range(n):
                key[: off[-1] - j] ^= text[j:]
                key *= np.uint64(0x100000001B3)
            ids[:, k] = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
        whole = left[:, None] >= np.array(GRAMS)
        found.append(ids[whole])
        counts.append(np.add.reduceat(whole.sum(axis=1), off[:-1]))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _means(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The mean of each slice; slices are not empty."""
    return np.add.reduceat(values, before[:-1], axis=0) / (np.diff(before).reshape(-1, *[1] * (values.ndim - 1)))


def scores(data: np.ndarray, off: np.ndarray, model: Model) -> np.ndarray:
    """The probability of each row: that of its worst window; a row without words has that of the bias."""
    base = 1 / (1 + np.exp(-min(model.bias, 0.0) + 4))
    out = np.full(len(off) - 1, base)
    data, starts, ends, which, heads, windows = words_and_windows(data, off)
    if not len(which):
        return out
    word = np.empty(len(starts))
    for i in range(0, len(starts), SLICE):  # bounds the memory of n-grams
        ids, before = gram_ids(data, starts[i : i + SLICE], ends[i : i + SLICE])
        word[i : i + SLICE] = _means(model.grams[ids].astype(np.float64), before)
    window = _means(word[which], np.append(heads, len(which))) + model.bias
    full = np.flatnonzero(np.diff(windows) > 0)
    worst = np.maximum.reduceat(window, windows[full])
    out[full] = 1 / (1 + np.exp(-np.clip(worst, -50, 50)))
    return out


def constant(toxic: bool) -> Model:
    """A model that says the same of every text with words."""
    return Model(np.zeros(BUCKETS, np.float32), 20.0 if toxic else -20.0)


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> Model:
    """Fit vectors and softmax weights together by full-batch Adam steps.

    Texts without words teach nothing. With labels of one value, or no n-gram that is used often enough, the model is
    constant, and toxic only if most labels are.
    """
    labels = np.asarray(labels, np.float64)
    if len(set(labels.tolist())) < 2:
        return constant(bool(len(labels) and labels[0]))
    mostly = labels.mean() > 0.5
    data, off = text_bytes(pa.array(texts, pa.string()))
    data, starts, ends, which, heads, windows = words_and_windows(data, off)
    full = np.diff(windows) > 0
    labels, off_w = labels[full], np.concatenate([[0], np.cumsum(np.diff(windows)[full])])
    if len(set(labels.tolist())) < 2:
        return constant(bool(labels[0]) if len(labels) else mostly)
    ids, before = gram_ids(data, starts, ends)
    sizes, uses = np.diff(before), np.bincount(which, minlength=len(starts))
    total = np.zeros(BUCKETS)
    for i in range(0, len(sizes), SLICE):
        j = min(len(sizes), i + SLICE)
        total += np.bincount(ids[before[i] : before[j]], np.repeat(uses[i:j], sizes[i:j]), BUCKETS)
    often = total >= LEAST_USES
    kept = often[ids]
    used = np.flatnonzero(often)
    if not len(used):
        return constant(mostly)
    slots = np.zeros(BUCKETS, np.int32)
    slots[used] = np.arange(len(used))
    slot = slots[ids[kept]]
    before = np.concatenate([[0], np.cumsum(kept, dtype=np.int32)])[before].astype(np.int64)
    del ids, kept, slots
    in_word, window_of = np.diff(before), np.repeat(np.arange(len(heads), dtype=np.int32), np.diff(np.append(heads, len(which))))
    window_size = np.bincount(window_of).astype(np.float64)
    by_gram = np.argsort(slot, kind="stable").astype(np.int32)
    owner = np.searchsorted(before, by_gram, "right").astype(np.int32) - 1
    del by_gram
    gram_starts = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=len(used)))[:-1]])
    by_word = np.argsort(which, kind="stable")
    word_starts = np.searchsorted(which[by_word], np.arange(len(in_word)))
    some, factor = np.flatnonzero(in_word), (np.float32(GAIN) / sizes.astype(np.float32))[:, None]
    doc_of = np.repeat(np.arange(len(labels)), np.diff(off_w))
    weight = np.where(labels > 0, 0.5 / (labels > 0).sum(), 0.5 / (labels == 0).sum())
    rng = np.random.default_rng(seed)
    state = [rng.normal(0, 0.05, (len(used), WIDTH)).astype(np.float32), rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)]
    first, second = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
    for step in range(1, STEPS + 1):
        emb, soft, bias = state
        word = np.zeros((len(in_word), WIDTH), np.float32)
        for i in range(0, len(some), SLICE):  # bounds the memory of gathered vectors
            part = some[i : i + SLICE]
            lo, hi = before[part[0]], before[part[-1] + 1]
            word[part] = np.add.reduceat(emb[slot[lo:hi]], before[part] - lo, axis=0)
        word *= factor
        window = np.add.reduceat(word[which], heads, axis=0) / window_size[:, None].astype(np.float32)
        logit = window @ soft + bias
        margin = logit[:, 1] - logit[:, 0]
        sharp = np.exp((margin - np.maximum.reduceat(margin, off_w[:-1])[doc_of]) * 2.0 * step / STEPS)
        share = sharp / np.add.reduceat(sharp, off_w[:-1])[doc_of]
        doc = np.add.reduceat(share * margin, off_w[:-1])
        error = weight * (1 / (1 + np.exp(-doc)) - labels)
        g_window = (error[doc_of] * share).astype(np.float32)
        # clean texts have no toxic window at all
        clean = labels[doc_of] == 0
        g_window += np.where(clean, weight[doc_of] / np.diff(off_w)[doc_of] / (1 + np.exp(-margin)), 0).astype(np.float32)
        g_logit = np.stack([-g_window, g_window], axis=1)
        g_soft, g_bias = window.T @ g_logit, g_logit.sum(axis=0)
        g_place = (g_logit @ soft.T / window_size[:, None].astype(np.float32))[window_of]
        g_word = np.add.reduceat(g_place[by_word], word_starts, axis=0) * factor
        g_emb = np.empty_like(emb)
        for i in range(0, len(used), 1 << 13):
            j = min(len(used), i + (1 << 13))
            lo, hi = gram_starts[i], gram_starts[j] if j < len(used) else len(owner)
            g_emb[i:j] = np.add.reduceat(g_word[owner[lo:hi]], gram_starts[i:j] - lo, axis=0)
        for x, g, a, b in zip(state, (g_emb, g_soft, g_bias), first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    emb, soft, bias = state
    grams = np.zeros(BUCKETS, np.float32)
    grams[used] = np.float32(GAIN) * (emb @ (soft[:, 1] - soft[:, 0]))
    model = Model(grams, float(bias[1] - bias[0]))
    # the bias is moved to the best split of the training texts, in the middle of the gap
    del slot, owner, emb, state, first, second, by_word, window_of, data
    p = np.concatenate([scores(*text_bytes(pa.array(texts[i : i + 200], pa.string())), model) for i in range(0, len(texts), 200)])[full]
    z = np.log(np.clip(p, 1e-12, 1) / np.clip(1 - p, 1e-12, 1))
    order = np.argsort(z)
    wrong = np.concatenate([[0], np.cumsum(np.where(labels[order] > 0, weight[order], -weight[order]))])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    k = int(best[len(best) // 2])
    cut = (z[order[max(0, k - 1)]] + z[order[min(len(z) - 1, k)]]) / 2
    model.bias -= float(cut)
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Train on a bounded sample of the labelled rows whose crc32 leaves a remainder other than 0 modulo 5.

    The sample is bounded, so one task trains on all of it; the driver gets the n-grams' scores.
    """

    def run(batches):
        hold("toxicity")
        rows = pa.Table.from_batches(list(batches), schema=pa.schema([("text", pa.string()), ("y", pa.int64())]))
        model = train(rows.column("text").to_pylist(), rows.column("y").to_numpy())
        used = np.flatnonzero(model.grams)
        yield pa.RecordBatch.from_arrays([pa.array([used.astype(np.int32).tobytes()], pa.binary()), pa.array([model.grams[used].tobytes()], pa.binary()), pa.array([model.bias])], ["used", "scores", "bias"])

    sample = sample_of(docs, labels, "toxic", 5, 0, per_label).select("text", F.col("y").cast("long").alias("y"))
    found = sample.repartition(1).sortWithinPartitions("y", "text").mapInArrow(run, "used binary, scores binary, bias double").collect()
    if not found:
        return train([], np.zeros(0))
    grams = np.zeros(BUCKETS, np.float32)
    grams[np.frombuffer(found[0].used, np.int32)] = np.frombuffer(found[0].scores, np.float32)
    return Model(grams, found[0].bias)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of each row."""

    def run(batches):
        hold("toxicity")
        for whole in batches:
            for batch in byte_chunks(whole, "t", 2 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(scores(*text_bytes(batch.column("t")), model))], ["doc_id", "score"])

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    return source.mapInArrow(run, f"doc_id {source.schema['i'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Map only after the fit. A null or empty text, or one without words, has a low score; a long text is scored whole, its
    n-grams in slices; with labels of one value, or none, scores are constant; a null id is not held out; repeated rows
    give a row each; an empty table gives no rows; other columns are ignored.
    """
    rows = scored(docs, fit(docs, labels, per_label))
    return rows.select("doc_id", F.coalesce(crc_text("doc_id") % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that are not predicted toxic.

    Nulls, empty and long texts are scored as in :func:`toxicity`; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(docs, labels, per_label)

    def run(batches):
        hold("toxicity")
        for whole in batches:
            for batch in byte_chunks(whole, text_col, 2 << 20):
                yield batch.filter(pa.array(scores(*text_bytes(batch.column(text_col)), model) < 0.5))

    return docs.mapInArrow(run, docs.schema)
