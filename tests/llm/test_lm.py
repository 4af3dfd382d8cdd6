"""Language-model scores: exact base and counts, gradients by finite differences, probabilities that add to one, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tickloom.llm import lm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def corpus(n=400):
    rng = random.Random(4)
    langs = [[f"{p}{i}" for i in range(60)] for p in ("a", "é", "C")]
    docs = []
    for i in range(n):
        words = rng.choice(langs)
        docs.append((i, " ".join(rng.choice(words[:10] if rng.random() < 0.6 else words) for _ in range(rng.randrange(5, 60))) + f" rare{i}"))
    return docs + [(1000, None), (1001, ""), (None, "a1 x"), (3, docs[3][1]), (1002, "a1 " * 9000), (1003, "\n zz\tzz ")]


def test_base_counts_and_gain(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(3)
    rows = lm.lm_scores(df).collect()
    count = Counter(t for i, x in docs if not held(i) for t in tokens(x))
    total = sum(count.values())
    want = Counter()
    for i, x in docs:
        t = tokens(x)
        want[(i, held(i), len(t), sum(count[w] > 0 for w in t), total, round(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in t), 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    out = [r for r in rows if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_words_outside_the_head(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_SHARE", 20)
    docs = corpus(60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    count = Counter(t for i, x in docs if not held(i) for t in tokens(x))
    total = sum(count.values())
    for r in lm.lm_scores(df).where("doc_id >= 1000").collect():
        t = tokens(dict(docs)[r.doc_id])
        assert r.n_known == sum(count[w] > 0 for w in t)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in t), rel_tol=1e-9)


def test_empty(spark):
    assert lm.lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def small():
    v = lm.Vocabulary([(h * 7, 100 - h) for h in range(70)], 7000, 90)
    return v, lm.initial(v)


def test_outputs_are_probabilities():
    v, w = small()
    h = np.random.default_rng(0).normal(size=(1, lm.HIDDEN)).astype(np.float32)
    slots = np.arange(lm.WORDS + 1)
    p = np.exp(lm.log_probabilities(w, np.repeat(h, len(slots), axis=0), slots))
    assert abs(p.sum() - 1) < 1e-4
    # the last slot's share is split over its words by counts, with one part for the unknown word
    assert v.other_total == v.other_tokens + v.other_distinct + 1


def test_gradients():
    _, w = small()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 70, (4, 3)), rng.integers(0, 70, (4, 3))
    y[3, 1] = -1
    y[0, 0] = lm.OTHER

    def loss():
        h, total = np.zeros((3, lm.HIDDEN)), 0
        for t in range(4):
            h = lm.advance(w, h, x[t])[0]
            live = y[t] >= 0
            total -= lm.log_probabilities(w, h[live], y[t][live]).sum()
        return total / (y >= 0).sum()

    g, _ = lm.gradients(w, np.zeros((3, lm.HIDDEN)), x, y)
    for k in w:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w[k].shape) if k != "x" else (int(rng.choice(x.ravel())), int(rng.integers(0, 3 * lm.HIDDEN)))
            old = w[k][at]
            w[k][at] = old + 1e-5
            up = loss()
            w[k][at] = old - 1e-5
            down = loss()
            w[k][at] = old
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4, (k, at)


def test_state_is_carried_over_windows():
    v, w = small()
    slots = np.random.default_rng(2).integers(0, 70, 150).astype(np.int16)
    h, last, total = np.zeros((1, lm.HIDDEN), np.float32), lm.BEGIN, 0.0
    for s in slots:
        h = lm.advance(w, h, np.array([last]))[0]
        total += lm.log_probabilities(w, h, np.array([s]))[0]
        last = int(s)
    both = lm.neural_scores(w, np.concatenate([slots[:40], slots]), np.array([0, 40, 190]))
    assert abs(both[1] - total) < 1e-3


def test_scores_by_brute_force(spark, monkeypatch):
    """Token by token in plain Python from the fitted weights and the counts."""
    fitted, fit = [], lm.train

    def keep(source, vocabulary):
        fitted.append((vocabulary, fit(source, vocabulary)))
        return fitted[-1][1]

    monkeypatch.setattr(lm, "train", keep)
    monkeypatch.setattr(lm, "HEAD_SHARE", 300)
    docs = [d for d in corpus(150) if d[0] != 1002] + [(1004, "a1 a2 " * 90 + "unseen")]
    rows = lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).collect()
    (v, w), count = fitted[0], Counter(t for i, x in docs if not held(i) for t in tokens(x))
    slot_of = dict(zip(v.hashes.tolist(), v.slots.tolist(), strict=True))
    w = {k: x.astype(float) for k, x in w.items()}

    def softmax(z):
        e = np.exp(z - z.max())
        return e / e.sum()

    def score(text):
        state, last, total = np.zeros(lm.HIDDEN), lm.BEGIN, 0.0
        n = lm.HIDDEN
        for t in tokens(text):
            a, b = w["x"][last], state @ w["u"]
            z, r = (1 / (1 + np.exp(-(a[k : k + n] + b[k : k + n]))) for k in (0, n))
            new = np.tanh(a[2 * n :] + r * b[2 * n :])
            state = z * state + (1 - z) * new
            last = slot_of.get(lm.hash_of(t.encode()), lm.OTHER)
            total += math.log10(softmax(state @ w["c"] + w["cb"])[last // lm.IN_CLASS])
            if last == lm.OTHER:
                total += math.log10((count[t] + 1) / v.other_total)
            else:
                k = last // lm.IN_CLASS
                total += math.log10(softmax(state @ w["w"][k] + w["wb"][k])[last % lm.IN_CLASS])
        return total

    want = [(i, score(x)) for i, x in docs]
    assert len(rows) == len(docs)
    assert all(any(i == r.doc_id and abs(r.score - s) < 0.01 for i, s in want) for r in rows)


def test_every_sequence_trains(spark, monkeypatch):
    """At any size all sequences of the training documents, and no others, reach the network."""
    monkeypatch.setattr(lm, "GROUP", 16)
    docs = corpus(200)
    source = lm._source(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    rows = lm.training_sequences(source, lm.Vocabulary([], 0, 0)).collect()
    assert len(rows) == sum(-(-len(tokens(x)) // lm.LENGTH) for i, x in docs if not held(i))


def test_the_layout_of_the_input_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP", 32)
    docs = spark.createDataFrame(corpus(200), "doc_id long, text string")
    two, nine = ({(r.doc_id, r.n_tokens): r.score for r in lm.lm_scores(docs.repartition(n, "doc_id")).collect()} for n in (2, 9))
    assert two.keys() == nine.keys() and max(abs(two[k] - nine[k]) for k in two) < 1e-3


def test_steps_of_a_replica_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP", 8)
    seen = {}
    for n in (60, 240):
        source = lm._source(spark.createDataFrame(corpus(n), "doc_id long, text string"), "doc_id", "text")
        sequences = lm.training_sequences(source, lm.Vocabulary([], 0, 0)).count()
        groups = -(-sequences // (lm.ROUNDS * lm.GROUP))
        seen[n] = (groups, lm.replicas_of(groups), -(-groups // lm.replicas_of(groups)))
    assert seen[240][1] > seen[60][1] and seen[240][2] > seen[60][2]
    assert [lm.replicas_of(g) for g in (1, 2, 4, 5, 9, 10, 100, 10**6)] == [1, 2, 2, 3, 3, 4, 10, 1000]


def test_head_words_are_found_among_neighbours():
    """Words whose hashes share their first bits, at both ends of the range, and others beside them."""
    base = [-(1 << 63), -1, 0, 12345 << 44, (1 << 63) - 4]
    head = [(h + k, 9 + k) for h in base for k in range(4) if h + k < 1 << 63 and (h, k) != (-1, 1)][:20]
    head = list({h: n for h, n in head}.items())
    v = lm.Vocabulary(list(head), 1000, len(head))
    asked = np.array([h for h, _ in head] + [h + 5 for h in base[:-1]] + [7 << 50], np.int64)
    want = dict(head)
    assert v.find(asked)[1].tolist() == [want.get(int(h), -1) for h in asked]


def test_sums_of_runs():
    rng = np.random.default_rng(3)
    for sizes in ([1], [1, 1, 2], [lm.LONG_RUN, 1, lm.LONG_RUN - 1, 3 * lm.LONG_RUN, 2]):
        rows = rng.normal(size=(sum(sizes), 5))
        first = np.cumsum(sizes) - sizes
        assert np.allclose(lm._sums_of_runs(rows, first), np.add.reduceat(rows, first, axis=0))


def test_outputs_in_blocks(monkeypatch):
    """Chances and scores don't depend on how many rows are taken at once, and logits over the limit are cut."""
    v, w = small()
    rng = np.random.default_rng(5)
    h, target = rng.uniform(-1, 1, (50, lm.HIDDEN)).astype(np.float32), rng.integers(0, lm.WORDS + 1, 50)
    slots, before = rng.integers(0, 70, 400).astype(np.int16), np.array([0, 0, 7, 300, 400])
    whole, scores = lm.log_probabilities(w, h, target), lm.neural_scores(w, slots, before)
    monkeypatch.setattr(lm, "CACHED_ROWS", 3)
    monkeypatch.setattr(lm, "SOFTMAX_ROWS", 5)
    assert np.allclose(lm.log_probabilities(w, h, target), whole, atol=1e-4) and np.allclose(lm.neural_scores(w, slots, before), scores, atol=1e-3)
    w["c"] *= 1e4
    assert np.isfinite(lm.log_probabilities(w, h, np.zeros(50, np.int64))[0])
