import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tickloom.llm.queries import QUERIES
from tickloom.llm.spelling import WaveletTree, near_words, spelling_variants

SF = "/root/testdata/sf0.001"
NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def _edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _variants(words):
    """Every pair, one by one."""
    near = {w: [] for w in words}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for w in words:
        for x in (*by_size[len(w)], *by_size.get(len(w) + 1, ())):
            if w != x and _edit(w, x):
                near[w].append(x)
                if len(x) > len(w):
                    near[x].append(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def _words(docs):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            total[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def _rows(df):
    return {tuple(r[c] for c in NAMES) for r in df.collect()}


def test_wavelet_tree_reports_every_point():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 200):
        values = rnd.permutation(n)
        tree = WaveletTree(values)
        a, lo = rnd.integers(0, n + 1, 50), rnd.integers(0, n + 1, 50)
        b, hi = np.minimum(n, a + rnd.integers(0, n + 1, 50)), np.minimum(n, lo + rnd.integers(0, n + 1, 50))
        q, v = tree.report(a, b, lo, hi)
        want = sorted((i, int(x)) for i in range(50) for x in values[a[i] : b[i]] if lo[i] <= x < hi[i])
        assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == want


@pytest.mark.parametrize("hot", [2, 7, 1 << 15])
def test_near_words_equal_all_pairs(spark, hot):
    rnd = random.Random(hot)
    words = {"".join(rnd.choice("aabéÿ") for _ in range(rnd.randint(5, 9))): rnd.randint(3, 60) for _ in range(700)}
    words |= {"a" * n: n for n in range(5, 30)}
    got = near_words(spark.createDataFrame(list(words.items()), "word string, n long"), hot).collect()
    best = {r.word: (r.n_near, r.best_n, r.best) for r in got}
    want = {}
    for w in words:
        others = [x for x in words if x != w and abs(len(x) - len(w)) < 2 and _edit(w, x)]
        if others:
            top = min(others, key=lambda x: (-words[x], x))
            want[w] = (len(others), words[top], top)
    assert best == want and len(got) == len(best)


def test_variants_of_odd_texts(spark):
    rnd = random.Random(8)
    base = ["thing", "things", "thign", "étésé", "Étésé", "x×y÷z", "word" * 20, "wordy" * 16, "number", "numbers", "numbe", "nummber", "numberss"]
    docs = [(i if i % 9 else None, " ".join(rnd.choice(base) + rnd.choice(["", ".", "1", "Ā", "'s", "\n"]) for _ in range(rnd.randint(0, 80)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "12 34"), (103, "THINGS " * 400_000), (5, docs[5][1]), (5, docs[5][1]), (None, None), (104, ("q" * 5000 + " ") * 3), (105, ("q" * 5001 + " ") * 9)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    assert _rows(spelling_variants(df)) == _variants(_words(docs))


def test_chain_of_forms_and_ties(spark):
    counts = {"abcde": 3, "abcdef": 6, "abcdefg": 12, "abcdefgh": 24, "abcdefghi": 48, "abcdf": 6, "zzzzz": 5}
    docs = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    spoilt = {w: n for w, n in _words(docs).items()}
    got = _rows(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == _variants(spoilt)
    assert ("abcde", "abcdef", "abcdefghi", 3, 2, 6) in got  # of equal n the least word


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op12_spelling"](spark, SF)
    assert dict(rows.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert _rows(rows) == _variants(_words(docs))
