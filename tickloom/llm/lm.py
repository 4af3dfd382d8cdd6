"""Language-model scores: a gated recurrent network with a class-factored softmax over the corpus's word counts.

The most frequent words have outputs of their own, in classes of equal size; all other words form one more class, inside
which they keep their smoothed share of the corpus's counts. Counts cover every training token. The network is trained by
truncated backpropagation on every training sequence: sequences are dealt by a hash of their document and place into groups
of one size, so there are as many groups as the corpus needs. A round has about the root of its groups as replicas; each goes
through as many groups one after another, and the replicas' weights are averaged: both the steps that weights take and the
tasks that take them grow with the corpus. In scoring, the state is carried from window to window to the document's end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, NON_SPACE, byte_chunks, crc_text, hash_of, hold, mix, spread, stage, text_bytes, word_hashes, word_spans

#: Classes and words in each; their product is the number of words with an output. State width.
CLASSES, IN_CLASS, HIDDEN = 64, 64, 16
WORDS = CLASSES * IN_CLASS
#: Uses of a word with an output; rarer ones teach the network what other words are like.
LEAST_COUNT = 5
OTHER, BEGIN = WORDS, WORDS + 1
#: Steps of a backpropagation window and windows in a training sequence.
STEPS, SPANS = 32, 3
LENGTH = STEPS * SPANS
#: Sequences of a step and of a group, rounds of averaging, times a group goes over its sequences, and the rate.
BATCH, GROUP, ROUNDS, EPOCHS, RATE = 256, 8192, 3, 1, 0.02
#: A word with at least this share of all tokens is known to every task: fewer than 200,000 words, whatever the corpus.
HEAD_SHARE = 200_000
#: Tokens that are scored in step, of these the ones whose outputs are found at once, and rows of outputs that a core's cache holds.
BLOCK_TOKENS, SOFTMAX_ROWS, CACHED_ROWS = 6_000_000, 1 << 15, 1 << 11
#: Uses of a word in a window from which their gradients are added up by a product.
LONG_RUN = 16
#: Numbers of a piece of the weights, in which they are averaged.
PIECE = 1 << 15
#: No word holds a line feed, so this hash is the end's own.
END = hash_of(b"\n")


def token_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, tokens before each row); the end of each row is a token."""
    data, off = text_bytes(batch.column("t"))
    data = LOWER[data]
    starts, ends, before = word_spans(data, off, NON_SPACE)
    hashes = np.insert(word_hashes(data, starts, ends).view(np.int64), before[1:], END)
    return hashes, before + np.arange(len(before))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    return rows.withColumn("held", F.coalesce(crc_text("i") % 7 == 2, F.lit(False)))


def token_counts(source: DataFrame) -> DataFrame:
    """(hash, n) of every training token."""

    def run(batches):
        for whole in batches:
            for batch in byte_chunks(whole, "t", 16 << 20):
                hashes, n = np.unique(token_hashes(batch)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n, pa.int64())], ["hash", "n"])

    return source.where("not held").select("t").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Counts of the head words, which of them have outputs, and the totals."""

    def __init__(self, head: list[tuple[int, int]], tokens: int, distinct: int):
        head.sort(key=lambda x: (-x[1], x[0]))
        own = [x for x in head[:WORDS] if x[1] >= LEAST_COUNT]
        self.tokens, self.distinct, self.own = tokens, distinct, len(own)
        self.own_counts = np.array([n for _, n in own] + [0] * (WORDS - len(own)), np.float64)
        ordered = sorted((h, n, k if k < len(own) else OTHER) for k, (h, n) in enumerate(head))
        self.hashes = np.array([x[0] for x in ordered], np.int64)
        self.counts = np.array([x[1] for x in ordered], np.int64)
        self.slots = np.array([x[2] for x in ordered], np.int16)
        # where the words of each run of first bits start; hashes are spread evenly, so few runs of these many have two words
        self.bits = len(head).bit_length() + 2
        half = 1 << self.bits - 1
        self.runs = np.append(np.searchsorted(self.hashes, np.arange(-half, half) << 64 - self.bits), len(head)).astype(np.int32)
        self.other_tokens = tokens - int(self.own_counts.sum())
        self.other_distinct = distinct - len(own)
        self.base_total, self.other_total = float(tokens + distinct + 1), float(self.other_tokens + self.other_distinct + 1)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, count) of each token; the count is -1 for words outside the head."""
        if not len(self.hashes):
            return np.full(len(hashes), OTHER, np.int16), np.full(len(hashes), -1, np.int64)
        run = (hashes >> 64 - self.bits) + (1 << self.bits - 1)
        at, end = self.runs.take(run), self.runs.take(run + 1)
        np.minimum(at, len(self.hashes) - 1, out=at)
        hit = self.hashes.take(at) == hashes
        left = np.flatnonzero(~hit & (at + 1 < end))
        while len(left):
            at[left] += 1
            found = self.hashes[at[left]] == hashes[left]
            hit[left[found]] = True
            left = left[~found & (at[left] + 1 < end[left])]
        return np.where(hit, self.slots.take(at), np.int16(OTHER)), np.where(hit, self.counts.take(at), -1)


def initial(vocabulary: Vocabulary, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights whose output is the corpus's unigram distribution."""
    rng = np.random.default_rng(seed)
    counts = vocabulary.own_counts.reshape(CLASSES, IN_CLASS)
    per_class = np.append(counts.sum(axis=1), vocabulary.other_tokens + 1.0)
    words = np.where(counts > 0, np.log(np.maximum(counts, 1) / np.maximum(counts.max(axis=1, keepdims=True), 1)), -30.0)
    w = {
        "x": rng.normal(0, 0.1, (WORDS + 2, 3 * HIDDEN)),
        "u": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)),
        "c": rng.normal(0, 0.05, (HIDDEN, CLASSES + 1)),
        "cb": np.log(np.maximum(per_class, 1e-6) / per_class.max()),
        "w": rng.normal(0, 0.05, (CLASSES, HIDDEN, IN_CLASS)),
        "wb": words,
    }
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(v: np.ndarray) -> np.ndarray:
    """In place; far below 0 the exponential is infinite and the result 0, so callers let it overflow."""
    np.negative(v, out=v)
    np.exp(v, out=v)
    v += 1
    return np.reciprocal(v, out=v)


def _step(u: np.ndarray, h: np.ndarray, a: np.ndarray):
    """One step from the inputs' vectors: (new state, update gate, reset gate, candidate, candidate's recurrent part)."""
    b = h @ u
    gates = _sigmoid(a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN])
    z, r, back = gates[:, :HIDDEN], gates[:, HIDDEN:], b[:, 2 * HIDDEN :]
    n = r * back
    n += a[:, 2 * HIDDEN :]
    np.tanh(n, out=n)
    h = h - n
    h *= z
    h += n
    return h, z, r, n, back


def advance(w: dict, h: np.ndarray, x: np.ndarray):
    """:func:`_step` from the inputs' slots."""
    return _step(w["u"], h, w["x"].take(x, axis=0))


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights with their bias as a last row: a state with a 1 behind it gives its logits by one product."""
    return np.concatenate([weights, bias[..., None, :]], axis=-2)


def _with_one(h: np.ndarray) -> np.ndarray:
    out = np.empty((len(h), h.shape[1] + 1), h.dtype)
    out[:, :-1], out[:, -1] = h, 1
    return out


def _reach(weights: np.ndarray) -> tuple[float, float]:
    """(largest sum of a logit's weights, largest bias); ``weights`` have their bias."""
    return float(np.abs(weights[..., :-1, :]).sum(axis=-2).max()), float(weights[..., -1, :].max())


def _capped(reach: tuple[float, float], h: np.ndarray) -> bool:
    """Whether some logit of the states could be over 80, where exponentials are cut; in practice none can."""
    return not reach[0] * max(1.0, float(np.abs(h).max(initial=0))) + reach[1] <= 80


def _exp(logits: np.ndarray, capped: bool) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials in place, their sum by row); biases have a maximum of 0."""
    if capped:
        np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], logits.dtype)


def _log_chance(h: np.ndarray, weights: np.ndarray, target: np.ndarray, capped: bool) -> np.ndarray:
    """The log of the softmax at each row's target; ``h`` has ones and ``weights`` their bias."""
    out = np.empty(len(h), h.dtype)
    for lo in range(0, len(h), CACHED_ROWS):
        part = slice(lo, lo + CACHED_ROWS)
        logits, at = h[part] @ weights, target[part]
        own = logits[np.arange(len(at)), at]
        np.subtract(own, np.log(_exp(logits, capped)[1]), out=out[part])
    return out


class Outputs:
    """The outputs of fixed weights."""

    def __init__(self, w: dict):
        self.c, self.w = _with_bias(w["c"], w["cb"]), _with_bias(w["w"], w["wb"])
        self.reach = _reach(self.c), _reach(self.w)

    def log_probabilities(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target's class and, where it has an output, of the word in the class."""
        capped = any(_capped(x, h) for x in self.reach)
        kind, inside = np.divmod(target.astype(np.int64), IN_CLASS)
        order = np.argsort(kind.astype(np.int16), kind="stable")
        cuts = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        h = _with_one(h.take(order, axis=0))
        kind, inside = kind[order], inside[order]
        found = _log_chance(h, self.c, kind, capped).astype(np.float64)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[k], cuts[k + 1]
            found[a:b] += _log_chance(h[a:b], self.w[k], inside[a:b], capped)
        out = np.empty(len(found))
        out[order] = found
        return out


def log_probabilities(w: dict, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """:meth:`Outputs.log_probabilities` of weights that are used once."""
    return Outputs(w).log_probabilities(h, target)


def _less_targets(logits: np.ndarray, target: np.ndarray, scale: np.float32, capped: bool) -> np.ndarray:
    """The gradient of the loss by its logits, in place: softmax less one at the target, scaled."""
    for lo in range(0, len(logits), CACHED_ROWS):
        some = logits[lo : lo + CACHED_ROWS]
        some, total = _exp(some, capped)
        some *= (scale / total)[:, None]
        some[np.arange(len(some)), target[lo : lo + CACHED_ROWS]] -= scale
    return logits


def _sums_of_runs(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each run of rows, from where each starts; most runs are one row, and a few hold most rows."""
    sizes = np.diff(first, append=len(rows))
    out = rows.take(first, axis=0)
    some = (sizes > 1) & (sizes < LONG_RUN)
    if some.any():
        out[some] = np.add.reduceat(rows[np.repeat(some, sizes)], np.cumsum(sizes[some]) - sizes[some], axis=0)
    for i in np.flatnonzero(sizes >= LONG_RUN).tolist():
        np.matmul(np.ones(sizes[i], rows.dtype), rows[first[i] : first[i] + sizes[i]], out=out[i])
    return out


def sparse_gradients(w: dict, h: np.ndarray, x: np.ndarray, y: np.ndarray):
    """(gradient of the mean loss, last state) of a window ``x`` -> ``y`` (steps, batch); targets below 0 don't count.

    Per weight the rows that have a gradient (None: all) and their gradients.
    """
    size, kind = (len(x), len(h), HIDDEN), h.dtype
    kept, z, r, n, rec = (np.empty(size, kind) for _ in range(5))
    inputs = w["x"].take(x, axis=0)
    with np.errstate(over="ignore"):
        for t in range(len(x)):
            kept[t] = h
            h, z[t], r[t], n[t], rec[t] = _step(w["u"], h, inputs[t])
    states = np.concatenate([kept[1:].reshape(-1, HIDDEN), h])
    target = y.ravel()
    live = np.flatnonzero(target >= 0)
    if not len(live):
        return {}, h
    ts, scale = target[live].astype(np.int64), kind.type(1 / len(live))
    order = np.argsort((ts // IN_CLASS).astype(np.int16), kind="stable")
    live, ts = live[order], ts[order]
    hs = _with_one(states.take(live, axis=0))
    by_class, by_word = _with_bias(w["c"], w["cb"]), _with_bias(w["w"], w["wb"])
    capped = any(_capped(_reach(v), h) for v in (by_class, by_word))
    kind_of, inside = np.divmod(ts, IN_CLASS)
    p = _less_targets(hs @ by_class, kind_of, scale, capped)
    back, g_class = p @ w["c"].T, hs.T @ p
    cuts = np.searchsorted(ts, np.arange(CLASSES + 1) * IN_CLASS)
    kinds = np.flatnonzero(np.diff(cuts))
    outs, q = np.empty((len(kinds), HIDDEN + 1, IN_CLASS), kind), np.empty((cuts[-1], IN_CLASS), kind)
    spans = list(zip(kinds.tolist(), cuts[kinds].tolist(), cuts[kinds + 1].tolist(), strict=True))
    for k, a, b in spans:
        np.matmul(hs[a:b], by_word[k], out=q[a:b])
    _less_targets(q, inside[: cuts[-1]], scale, capped)
    for i, (k, a, b) in enumerate(spans):
        np.matmul(hs[a:b].T, q[a:b], out=outs[i])
        back[a:b] += q[a:b] @ w["w"][k].T
    g_out = np.zeros_like(states)
    g_out[live] = back
    g_out = g_out.reshape(size)
    # what a step's gradient is multiplied by, for all steps at once
    to_n, to_z, to_r = (1 - z) * (1 - n * n), (kept - n) * z * (1 - z), rec * r * (1 - r)
    inner, g_n, carry = np.empty((*size[:2], 3 * HIDDEN), kind), np.empty(size, kind), np.zeros_like(h)
    back_u = np.ascontiguousarray(w["u"].T)
    for t in range(len(x) - 1, -1, -1):
        d = g_out[t] + carry
        d_n = np.multiply(d, to_n[t], out=g_n[t])
        np.multiply(d, to_z[t], out=inner[t, :, :HIDDEN])
        np.multiply(d_n, to_r[t], out=inner[t, :, HIDDEN : 2 * HIDDEN])
        np.multiply(d_n, r[t], out=inner[t, :, 2 * HIDDEN :])
        d *= z[t]
        carry = d + inner[t] @ back_u
    g_u = kept.reshape(-1, HIDDEN).T @ inner.reshape(-1, 3 * HIDDEN)
    inner[:, :, 2 * HIDDEN :] = g_n
    # whole numbers of 16 bits are sorted by digits
    flat = x.ravel().astype(np.int16)
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    used = flat[order[first]]
    g = {"u": (None, g_u), "c": (None, g_class[:-1]), "cb": (None, g_class[-1]), "x": (used, _sums_of_runs(inner.reshape(-1, 3 * HIDDEN).take(order, axis=0), first))}
    return g | ({"w": (kinds, outs[:, :-1]), "wb": (kinds, outs[:, -1])} if len(kinds) else {}), h


def gradients(w: dict, h: np.ndarray, x: np.ndarray, y: np.ndarray):
    """:func:`sparse_gradients` with an array of each weight's shape."""
    found, h = sparse_gradients(w, h, x, y)
    out = {k: np.zeros_like(v) for k, v in w.items()}
    for k, (rows, d) in found.items():
        out[k][slice(None) if rows is None else rows] = d
    return out, h


class Replica:
    """Weights in training by Adam, group after group of sequences (rows of ``LENGTH`` + 1 slots), the state carried over each sequence's windows.

    Input vectors and class outputs move only in the windows that use them, so a step costs what it reads.
    """

    def __init__(self, w: dict):
        self.w = {k: v.copy() for k, v in w.items()}
        self.first, self.second, self.step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0

    def train(self, sequences: np.ndarray, seed: int) -> None:
        w, first, second = self.w, self.first, self.second
        rng = np.random.default_rng(seed)
        for _ in range(EPOCHS):
            order = rng.permutation(len(sequences))
            for i in range(0, len(order), BATCH):
                some = sequences[order[i : i + BATCH]].T.astype(np.int64)
                h = np.zeros((some.shape[1], HIDDEN), np.float32)
                for s in range(0, LENGTH, STEPS):
                    alive = some[s + 1] >= 0
                    if not alive.any():
                        break
                    if not alive.all():
                        some, h = some[:, alive], h[alive]
                    x, y = some[s : s + STEPS], some[s + 1 : s + STEPS + 1]
                    g, h = sparse_gradients(w, h, np.where(x < 0, OTHER, x), y)
                    self.step += 1
                    for k, (rows, d) in g.items():
                        v, m, q = w[k], first[k], second[k]
                        np.clip(d, -1, 1, out=d)
                        at = slice(None) if rows is None else rows
                        mean, square = m[at], q[at]
                        mean = mean + 0.1 * (d - mean)
                        d *= d
                        square = square + 0.01 * (d - square)
                        m[at], q[at] = mean, square
                        square /= 1 - 0.99**self.step
                        np.sqrt(square, out=square)
                        square += 1e-6
                        mean *= RATE / (1 - 0.9**self.step)
                        mean /= square
                        v[at] -= mean


def train_part(w: dict, sequences: np.ndarray, seed: int) -> dict:
    """Weights after one group."""
    replica = Replica(w)
    replica.train(sequences, seed)
    return replica.w


def training_sequences(source: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(mark, slots) of the sequences of all training documents; the mark is a hash of the document's id and of their place in it.

    So neither files nor tasks decide which group a sequence is in, and copies under different ids are dealt apart.
    """

    def run(batches):
        hold("lm")
        for whole in batches:
            for batch in byte_chunks(whole, "t"):
                hashes, before = token_hashes(batch)
                slots = vocabulary.find(hashes)[0]
                per_row = -(-np.diff(before) // LENGTH)
                row = np.repeat(np.arange(len(per_row)), per_row)
                place = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                start = before[row] + place * LENGTH
                last = before[row + 1]
                mark = mix(batch.column("k").to_numpy().view(np.uint64)[row] ^ mix(place.astype(np.uint64)))
                for lo in range(0, len(start), 1 << 12):
                    part = slice(lo, lo + (1 << 12))
                    at = start[part][:, None] + np.arange(-1, LENGTH)
                    values = np.where(at < last[part][:, None], slots[np.clip(at, 0, max(0, len(slots) - 1))], np.int16(-1)).astype(np.int16)
                    values[start[part] == before[row[part]], 0] = BEGIN
                    rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * (LENGTH + 1)), len(values), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(mark[part].view(np.int64)), rows], ["mark", "slots"])

    return source.where("not held").select("t", F.xxhash64(F.col("i").cast("string")).alias("k")).mapInArrow(run, "mark long, slots binary")


def replicas_of(groups: int) -> int:
    """Replicas of a round of so many groups: the root, rounded up."""
    return math.isqrt(groups - 1) + 1


def train(source: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Rounds of training, each followed by the mean of its replicas' weights.

    A group is a share of the marks and a replica a share of the groups, in order, so what is learnt depends neither on the
    input's files nor on the cluster or on tasks that run again. A round of g groups has the root of g replicas, rounded up:
    with four times the corpus each replica takes twice the steps, and twice as many tasks do so. Means are taken in pieces
    by a shuffle; replicas being few, so are the rows of a piece.
    """
    w = initial(vocabulary)
    names, shapes = list(w), {k: v.shape for k, v in w.items()}
    sequences = stage(training_sequences(source, vocabulary), "lm-sequences")
    count = sequences.count()
    if not count:
        return w
    groups = ROUNDS * -(-count // (ROUNDS * GROUP))
    replicas = replicas_of(groups // ROUNDS)
    dealt = sequences.withColumn("group", F.pmod("mark", F.lit(groups))).withColumn("replica", F.expr(f"(group div {ROUNDS}) % {replicas}"))
    for number in range(ROUNDS):
        start = w

        def learn(batches, start=start):
            hold("lm")
            held, group, owner = [], None, None
            replica, seen, total, weights = None, 0, 0, None

            def close():
                """The group that is held has come to its end."""
                nonlocal seen
                rows = np.concatenate(held)
                replica.train(rows, int(group))
                seen += len(rows)
                held.clear()

            def finish():
                """The replica has come to its end."""
                nonlocal weights, total, seen
                flat = np.concatenate([replica.w[k].ravel() for k in names]).astype(np.float64) * seen
                weights = flat if weights is None else weights + flat
                total, seen = total + seen, 0

            for batch in batches:
                if not len(batch):
                    continue
                keys, owners = batch.column("group").to_numpy(), batch.column("replica").to_numpy()
                rows = np.frombuffer(b"".join(batch.column("slots").to_pylist()), np.int16).reshape(-1, LENGTH + 1)
                cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
                for a, b in zip(cuts, cuts[1:]):
                    if held and keys[a] != group:
                        close()
                    if owners[a] != owner:
                        if replica is not None:
                            finish()
                        replica, owner = Replica(start), owners[a]
                    group = keys[a]
                    held.append(rows[a:b])
            if held:
                close()
            if replica is not None:
                finish()
            if total:
                parts = [weights[i : i + PIECE].tobytes() for i in range(0, len(weights), PIECE)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array([total] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["piece", "n", "w"])

        def add(batches):
            sums: dict[int, list] = {}
            for batch in batches:
                for piece, n, raw in zip(*(batch.column(c).to_pylist() for c in ("piece", "n", "w")), strict=True):
                    have = sums.setdefault(piece, [0, 0.0])
                    have[0] += n
                    have[1] = have[1] + np.frombuffer(raw, np.float64)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([(v / n).astype(np.float32).tobytes() for n, v in sums.values()], pa.binary())], ["piece", "w"])

        own = dealt.where(F.col("group") % ROUNDS == number)
        # sorted by the mark within a group: the order of training does not change when a lost task runs again
        parts = own.repartition(replicas, "replica").sortWithinPartitions("replica", "group", "mark", "slots").mapInArrow(learn, "piece long, n long, w binary")
        means = parts.repartition("piece").sortWithinPartitions("piece", "n", "w").mapInArrow(add, "piece long, w binary").collect()
        if means:
            flat, at, w = np.frombuffer(b"".join(r.w for r in sorted(means, key=lambda r: r.piece)), np.float32), 0, {}
            for k in names:
                size = int(np.prod(shapes[k]))
                w[k] = flat[at : at + size].reshape(shapes[k])
                at += size
    return w


def neural_scores(w: dict, slots: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Natural log probability of each row's slots: rows advance in step, longest first, with their state carried over windows."""
    sizes = np.diff(before)
    order = np.argsort(-sizes, kind="stable")
    sizes, starts, out = sizes[order], before[:-1][order], np.zeros(len(order))
    h = np.zeros((len(order), HIDDEN), np.float32)
    last = np.full(len(order), BEGIN, np.int64)
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # rows longer than t
    outputs = Outputs(w)
    states, targets, owners, held = [], [], [], 0
    with np.errstate(over="ignore"):
        for t, n in enumerate(active.tolist()):
            h, last = h[:n], last[:n]
            h = advance(w, h, last)[0]
            last = slots.take(starts[:n] + t).astype(np.int64)
            states.append(h)
            targets.append(last)
            owners.append(np.arange(n))
            held += n
            if held >= SOFTMAX_ROWS or t + 1 == len(active):
                own, all_states, all_targets = np.concatenate(owners), np.concatenate(states), np.concatenate(targets)
                for i in range(0, held, SOFTMAX_ROWS):
                    part = slice(i, i + SOFTMAX_ROWS)
                    out += np.bincount(own[part], outputs.log_probabilities(all_states[part], all_targets[part]), len(out))
                states, targets, owners, held = [], [], [], 0
    result = np.empty(len(order))
    result[order] = out
    return result


def _score_blocks(source: DataFrame, vocabulary: Vocabulary, w: dict, kind: str) -> DataFrame:
    """Per row: what the head words and the network give, and the other words with their number of uses."""
    other_log, base_log, ten = np.log10(vocabulary.other_total), np.log10(vocabulary.base_total), np.log(10)

    def run(batches):
        from pyspark import TaskContext

        hold("lm")
        key, held = TaskContext.get().partitionId() << 40, []

        def close():
            nonlocal key
            hashes = np.concatenate([x[1] for x in held])
            sizes = np.concatenate([np.diff(x[2]) for x in held])
            before = np.concatenate([[0], np.cumsum(sizes)])
            slots, counts = vocabulary.find(hashes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            known = counts >= 0
            logs = np.where(known, np.log10(np.maximum(counts, 0) + 1), 0.0)
            base = np.bincount(row, np.where(known, logs - base_log, 0), len(sizes))
            extra = np.bincount(row, np.where(known & (slots == OTHER), logs - other_log, 0), len(sizes))
            score = neural_scores(w, slots, before) / ten + extra
            tail = np.flatnonzero(~known)
            tail_row, tail_hash = row[tail], hashes[tail]
            order = np.lexsort((tail_hash, tail_row))
            tail_row, tail_hash = tail_row[order], tail_hash[order]
            new = np.ones(len(tail), bool)
            new[1:] = (tail_row[1:] != tail_row[:-1]) | (tail_hash[1:] != tail_hash[:-1])
            first = np.flatnonzero(new)
            uses = np.diff(np.append(first, len(tail)))
            cuts = np.searchsorted(tail_row[first], np.arange(len(sizes) + 1))
            n_known = np.bincount(row[known], minlength=len(sizes))
            at = 0
            for part, _, _ in held:
                lo, hi = at, at + len(part)
                a, b = int(cuts[lo]), int(cuts[hi])
                pairs = pa.ListArray.from_arrays(pa.array(cuts[lo : hi + 1] - a, pa.int32()), pa.StructArray.from_arrays([pa.array(tail_hash[first[a:b]]), pa.array(uses[a:b], pa.int32())], ["hash", "uses"]))
                fields = [pa.array(key + np.arange(lo, hi)), part.column("i"), part.column("held"), pa.array(sizes[lo:hi], pa.int64()), pa.array(n_known[lo:hi], pa.int64()), pa.array(base[lo:hi]), pa.array(score[lo:hi]), pairs]
                yield pa.RecordBatch.from_arrays(fields, ["key", "doc_id", "held_out", "n_tokens", "known", "base", "score", "tail"])
                at = hi
            key += at
            held.clear()

        for whole in batches:
            for batch in byte_chunks(whole, "t"):
                held.append((batch.select(["i", "held"]), *token_hashes(batch)))
                if sum(len(x[1]) for x in held) >= BLOCK_TOKENS:
                    yield from close()
        if held:
            yield from close()

    return source.mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double, tail array<struct<hash:long,uses:int>>")


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words above a ``HEAD_SHARE``-th of all tokens are sent to every task; each document's other words are joined with the
    counts, a row per document and word, no word of which is hot. A null or empty text is its end alone; a long text is
    scored whole, its state carried on; a null id is not held out; repeated rows learn and count each for itself; with no
    training rows every count is 0; an empty table gives no rows; other columns are ignored.
    """
    source = _source(docs, id_col, text_col)
    kind = source.schema["i"].dataType.simpleString()
    counts = stage(token_counts(source), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = total.n // HEAD_SHARE + 1
    head = counts.where(F.col("n") >= least).toPandas()
    vocabulary = Vocabulary(list(zip(head["hash"].tolist(), head["n"].tolist(), strict=True)), total.n, total.v)
    w = train(source, vocabulary)
    scored = stage(_score_blocks(source, vocabulary, w, kind), "lm-scored")
    tail = scored.select("key", F.inline("tail")).join(counts.where(F.col("n") < least), "hash", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + 1)
    sums = tail.groupBy("key").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("uses")).otherwise(0)).alias("more_known"),
        F.sum(F.col("uses") * (log - float(np.log10(vocabulary.base_total)))).alias("more_base"),
        F.sum(F.col("uses") * (log - float(np.log10(vocabulary.other_total)))).alias("more_score"),
    )
    joined = scored.drop("tail").join(sums, "key", "left")
    zero = F.lit(0)
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(int(total.n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
