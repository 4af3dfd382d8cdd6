"""Quality and toxicity: held-out accuracy on invented text, graded ratings, and edge cases."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F
from tickloom.llm import quality as q
from tickloom.llm import toxicity as t
from tickloom.llm.common import text_bytes


def prose(rng, n=60):
    return " ".join("".join(rng.choices(["an", "er", "th", "on", "re", "st", "in"], k=rng.randrange(1, 4))) for _ in range(n)) + "."


def toxic_corpus(n=900):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, rng.choice([5, 40, 300])).split()
        bad = i % 3 == 0
        for _ in range(2 * bad):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["grumflix", "zomblat", "Quibjerk"]) + "".join(rng.choices("aeiou", k=rng.randrange(3))))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad), 1 - int(bad)))
    return docs, labels


def tables(spark, docs, labels):
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic long, quality long")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    docs += [(5000, None), (5001, ""), (5002, "..."), (None, "grumflix"), (5003, "zumblat GRUMFLYX quibjerkz"), (5004, "an " * 60_000 + "zomblat"), (0, docs[0][1])]
    d, y = tables(spark, docs, labels + [(None, 1, 1), (7000, None, None), (1, 0, 1)])
    rows = t.toxicity(d, y).collect()
    assert len(rows) == len(docs)
    want = {i: k for i, k, _ in labels}
    out = [r for r in rows if r.held_out and r.doc_id in want]
    assert np.mean([r.predicted == want[r.doc_id] for r in out]) > 0.97
    by = {r.doc_id: r for r in rows}
    assert [by[i].predicted for i in (5000, 5001, 5002, 5003, 5004)] == [0, 0, 0, 1, 1]
    assert all(0 <= r.score <= 1 for r in rows)
    kept = {r.doc_id for r in t.keep_clean(d, y).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted}


def test_toxic_words_inside_long_runs():
    docs, labels = toxic_corpus()
    rng = random.Random(3)
    han = [chr(0x4E00 + i) for i in range(400)]

    def runs(n, most):
        for i in range(n):
            run = rng.choices(han, k=rng.choice([40, most]))
            if i % 3 == 0:
                run[rng.randrange(25, len(run)) : 0] = "毒詞罵"
            yield "".join(run), int(i % 3 == 0)

    known = list(runs(300, 120))
    model = t.train([d for _, d in docs] + [d for d, _ in known], np.array([y for _, y, _ in labels] + [y for _, y in known]))
    new = list(runs(150, 900))
    got = t.scores(*text_bytes(pa.array([d for d, _ in new])), model) >= 0.5
    assert np.mean(got == [y == 1 for _, y in new]) > 0.97
    glue = "".join(c for c in prose(rng, 120) if c.isalpha())[:140]
    texts = [glue, *[glue[k:100] + w + rest for k in range(6) for w in ("grumflix", "zomblat", "Quibjerk") for rest in ("", glue[100:])]]
    assert (t.scores(*text_bytes(pa.array(texts)), model) >= 0.5).tolist() == [False] + [True] * 36


def test_pieces_hold_every_gram():
    rng = random.Random(2)
    sizes = [1, 12, 24, 25, 26, 27, 28, 29, 300, 24, 5]
    data, off = text_bytes(pa.array(["".join(rng.choices("abcdefgh", k=n)) for n in sizes]))
    starts, ends, before = t.pieces(off[:-1], off[1:], np.arange(len(off)))
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        own = list(zip(starts[before[i] : before[i + 1]].tolist(), ends[before[i] : before[i + 1]].tolist(), strict=True))
        assert all(any(lo <= k and k + n <= hi for lo, hi in own) for n in t.GRAMS for k in range(a, b - n + 1))
        assert own[0][0] == a and own[-1][1] == b and (len(own) == 1) == (b - a <= t.LONGEST)


def test_without_labels(spark):
    d, y = tables(spark, [(1, "a b"), (2, None)], [])
    assert {r.predicted for r in t.toxicity(d, y).collect()} == {0}
    assert len(q.quality(d, y).collect()) == 2
    d, y = tables(spark, [], [(1, 1, 1)])
    assert t.toxicity(d, y).collect() == [] == q.quality(d, y).collect()


def test_quality_on_held_out_rows(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        text = prose(rng, rng.choice([20, 100]))
        bad = i % 4 == 0
        docs.append((i, " | ".join(text.split()).upper() if bad else text))
        labels.append((i, 0, int(not bad)))
    docs += [(900, None), (901, ""), (None, "x"), (902, "the same " * 50_000)]
    d, y = tables(spark, docs, labels)
    rows = q.quality(d, y).collect()
    assert len(rows) == len(docs)
    assert np.mean([r.kept == (r.doc_id % 4 != 0) for r in rows if r.held_out and r.doc_id < 600]) > 0.98
    assert {r.doc_id for r in q.keep_good(d, y).collect()} == {r.doc_id for r in rows if r.kept}


def test_ordered_grades():
    rng = random.Random(3)
    y = np.array([i % 4 for i in range(800)])
    texts = [" ".join(rng.choices(["good", "fine"] if rng.random() < g / 3 else ["!!x", "##y"], k=1)[0] for _ in range(40)) for g in y]
    x = np.concatenate([q.features(*text_bytes(pa.array(texts[i : i + 100]))) for i in range(0, 800, 100)])
    m = q.train(x[:600], y[:600])
    assert list(m.thresholds) == sorted(m.thresholds) and len(m.thresholds) == 3
    expected, tail = m.predict(x[600:], 2)
    assert np.corrcoef(expected, y[600:])[0, 1] > 0.85
    assert np.mean((tail >= 0.5) == (y[600:] >= 2)) > 0.8


def test_features_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(8)
    texts = pa.array([prose(rng, n) for n in (3, 400, 0, 50)] + ["", None, "ab"])
    whole = q.features(*text_bytes(texts))
    monkeypatch.setattr(q, "SEGMENT", 97)
    assert np.allclose(whole, q.features(*text_bytes(texts)))
    one = np.concatenate([q.features(*text_bytes(texts.slice(i, 1))) for i in range(len(texts))])
    assert np.allclose(whole, one)


def test_labelled_texts_without_words(spark):
    assert (t.scores(*text_bytes(pa.array(["...", "", "ab"])), t.train(["...", "!!"], np.array([0, 1]))) < 0.5).all()
    assert (t.scores(*text_bytes(pa.array(["ab cd"])), t.train(["ab cd", "..."], np.array([1, 0]))) >= 0.5).all()
    d, y = tables(spark, [(1, "..."), (2, "!!"), (3, None), (4, "words here")], [(i, i % 2, i % 2) for i in range(1, 5)])
    assert t.toxicity(d, y).count() == 4 == q.quality(d, y).count()


def test_sample_is_drawn_from_rows_with_texts(spark):
    from tickloom.llm.labelled import sample_of

    docs = [(i, None if i % 3 else f"text {i}") for i in range(600)] + [(3, "another text"), (9, "text 9"), (None, "x")]
    docs += [(3000, "long " * 200_000)]
    labels = [(i, i % 2, i % 5) for i in range(5000)] + [(3, 0, 0)]
    d, y = tables(spark, docs, labels)
    rows = sample_of(d, y, "toxic", 5, 0, per_label=40).collect()
    assert sorted(r.y for r in rows) == [0] * 40 + [1] * 40
    every = sample_of(d, y, "toxic", 5, 0).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    want = {("another text" if i == 3 else f"text {i}", i % 2) for i in range(0, 600, 3) if not held(i)} | ({("long " * 200_000, 0)} if not held(3000) else set())
    assert {(r.text, r.y) for r in every} == want and len(every) == len(want)
    short = sample_of(d, y, "toxic", 5, 0, label_chars=1000).collect()  # texts are as many, none is longer than its share or a slice
    assert len(short) == len(want) and max(len(r.text) for r in short) <= 1000


def test_long_texts_neither_starve_the_sample_nor_are_left_out(spark):
    from tickloom.llm.labelled import sample_of

    def parts(n, text, label, **kw):
        ids = spark.range(n).withColumnRenamed("id", "doc_id")
        out = {0: [], 1: []}
        for r in sample_of(ids.withColumn("text", F.expr(text)), ids.withColumn("toxic", F.expr(label)), "toxic", 5, 0, **kw).collect():
            out[r.y].append(r.text)
        return out

    fifth = parts(400, "repeat(concat(doc_id, ' '), if(doc_id % 5 = 0, 500000, 20))", "doc_id % 2")
    assert min(len(x) for x in fifth.values()) >= 100
    for texts in fifth.values():
        assert sum(map(len, texts)) < 5 << 20 and sum(len(t) > 10_000 for t in texts) >= 20
    one = parts(300, "if(doc_id = 7, concat(repeat('a', 5000000), repeat('z', 5000000)), repeat('clean ', 20))", "if(doc_id = 7, 1, doc_id % 2)", label_chars=100_000)
    (long,) = [t for t in one[1] if "a" * 100 in t]
    assert 50_000 < len(long) <= 100_000 and abs(long.count("a") - long.count("z")) < 2000


def test_sample_by_grade(spark):
    from tickloom.llm.labelled import sample_of

    d, y = tables(spark, [(i, f"text {i}") for i in range(600)], [(i, i % 2, i % 5) for i in range(5000)])
    assert sample_of(d, y, "quality", 5, 0, most=50).groupBy("y").count().agg({"count": "max"}).first()[0] <= 10
    assert sample_of(d.limit(0), y, "toxic", 5, 0).collect() == [] == sample_of(d, y.limit(0), "toxic", 5, 0).collect()


def plain_score(text, model):
    """A text's toxicity word by word: pieces, n-grams, means of windows of two, the worst of them."""
    low = bytes(48 if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = []
    for run in re.findall(rb"[0-9a-z\x80-\xff]+", low):
        if len(run) <= t.LONGEST:
            words.append(run)
        else:
            starts = range(0, -(-(len(run) - t.PIECE) // t.PIECE_STEP) * t.PIECE_STEP + 1, t.PIECE_STEP)
            words += [run[a : a + t.PIECE] for a in starts]
    if not words:
        return 1 / (1 + math.exp(-min(model.bias, 0.0) + 4))

    def bucket(gram):
        key, mask = len(gram), (1 << 64) - 1
        for c in gram:
            key = ((key ^ c) * 0x100000001B3) & mask
        return ((key * 0x9E3779B97F4A7C15) & mask) >> (64 - t.BUCKETS.bit_length() + 1)

    def word(w):
        w = b"<" + w + b">"
        grams = [model.grams[bucket(w[i : i + n])] for n in t.GRAMS for i in range(len(w) - n + 1)]
        return sum(map(float, grams)) / len(grams)

    values = [word(w) for w in words]
    windows = [sum(values[i : i + t.WINDOW]) / len(values[i : i + t.WINDOW]) for i in range(0, len(values), t.WINDOW)]
    return 1 / (1 + math.exp(-max(-50, min(50, max(windows) + model.bias))))


def test_toxicity_by_brute_force(spark):
    docs, labels = toxic_corpus(300)
    docs += [(5000, None), (5001, ""), (5002, "..."), (None, "grumflix 123"), (5003, "Zo" * 60 + " é日本語" * 9), (0, docs[0][1])]
    d, y = tables(spark, docs, labels)
    model = t.fit(d, y)
    want = sorted(((i, plain_score(x, model)) for i, x in docs), key=str)
    got = sorted(((r.doc_id, r.score) for r in t.toxicity(d, y).collect()), key=str)
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-6)


def plain_quality(text, model, tail_from=1):
    """A text's tail probability from its trigrams and style measures, one by one."""
    raw = (text or "").encode()
    x = np.zeros(q.WIDTH)
    for i in range(len(raw) - 2):
        key = ((raw[i] * 0x9E3779B1) ^ (raw[i + 1] * 0x85EBCA6B) ^ (raw[i + 2] * 0xC2B2AE35)) & 0xFFFFFFFF
        x[(key * 0x27D4EB2F & 0xFFFFFFFF) >> 21] += 1
    x = np.sqrt(x)
    x /= np.linalg.norm(x) or 1
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[^\x20\x09-\x0d]+", raw)]
    n, size = max(len(words), 1), max(len(raw), 1)
    signs = {*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)}
    measures = [sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, sum(65 <= c <= 90 for c in raw) / size, sum(c in signs for c in raw) / size, min(1, len(raw) / n / 24), min(1, math.log1p(len(words)) / 12)]
    for k, value in enumerate(measures):
        x[q.TRIGRAMS + k * q.BINS + min(q.BINS - 1, int(math.sqrt(value) * q.BINS))] = q.STYLE * bool(words)
    x[-1] = 1
    score = float(x @ model.weights.astype(float))
    below = [0.0, *(1 / (1 + math.exp(-(c - score))) for c in model.thresholds), 1.0]
    return sum(b - a for g, a, b in zip(model.grades, below, below[1:]) if g >= tail_from)


def test_quality_by_brute_force(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, 30) if i % 3 else " ".join(prose(rng, 8).split()).upper() + " !! ##") for i in range(300)]
    labels = [(i, 0, i % 3) for i in range(300)]
    docs += [(900, None), (901, ""), (None, "One one TWO, é日本"), (902, "the same " * 3000), (7, docs[7][1])]
    d, y = tables(spark, docs, labels)
    model = q.fit(d, y)
    assert len(model.thresholds) == 2
    want = sorted(((i, plain_quality(x, model)) for i, x in docs), key=str)
    got = sorted(((r.doc_id, r.tail_probability) for r in q.quality(d, y).collect()), key=str)
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)
