"""Decontamination against a brute-force search for every window."""

import hashlib
import random
import re

from tickloom.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def check(spark, docs, items):
    d = spark.createDataFrame([(a, b, 7) for a, b in docs], "doc_id long, text string, n_words int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate(d.repartition(3), i).collect()), key=str)
    assert got == brute(docs, items)
    return got


def test_planted_passages(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ça"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 7, 9, 10, 11, 25, 60])))) for i in range(30)] + [(30, "the Same word " * 8), (31, ""), (32, None), (33, "x, y! z")]
    docs = []
    for d in range(120):
        parts = rng.choices(vocabulary, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            w = words(items[rng.randrange(30)][1])
            a = rng.randrange(len(w))
            parts[rng.randrange(len(parts) + 1) : 0] = w[a : a + rng.randrange(1, 30)]
        docs.append((d, ", ".join(parts).upper() if d % 2 else "\n".join(parts)))
    docs += [(200, None), (201, ""), (202, "!!! --"), (203, "the same word " * 5000), (204, items[5][1]), (204, items[5][1]), (205, "X Y Z")]
    got = check(spark, docs, items)
    assert sum(r[-1] for r in got) > 20


def test_empty_tables(spark):
    assert check(spark, [(1, "a b c")], []) == [(1, 3, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert check(spark, [], [(1, "a b c")]) == []


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr("tickloom.llm.decontaminate.BROADCAST_ROWS", 0)
    text = " ".join(f"a{i}" for i in range(30))
    assert [r[2] for r in check(spark, [(1, text), (2, "b " + text[8:60])], [(1, text), (2, text)])]
