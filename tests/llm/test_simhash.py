"""SimHash fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tickloom.llm.simhash import block_links, near_duplicates


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs):
    prints = [brute_print(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return sorted(((d, f"{p:016x}", least[root(i)]) for i, ((d, _), p) in enumerate(zip(docs, prints, strict=True))), key=str)


def check(spark, docs):
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, component_id string")
    assert sorted((tuple(r) for r in near_duplicates(df.repartition(3)).collect()), key=str) == brute(docs)


def test_copies_and_edge_cases(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=rng.choice([1, 2, 5, 400]))) for _ in range(30)]
    docs = []
    for i in range(150):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(300)}"
        docs.append((i, " ".join(w).upper() if i % 3 else "  ".join(w)))
    docs += [(900, None), (901, ""), (902, "\n\t"), (None, base[0]), (5, docs[5][1]), (903, "é É è"), (904, "long word " * 20000), (905, "a b c d")]
    check(spark, docs)


def test_empty(spark):
    check(spark, [])


def test_every_near_pair_shares_a_block(spark):
    from tickloom.llm.simhash import print_links

    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for b in base for _ in range(20)})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    links = {frozenset((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1)) for r in print_links(df).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in map(tuple, links))
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in map(tuple, links):
        group[root(a)] = root(b)
    assert all(root(a) == root(b) for a in prints for b in prints if (a ^ b).bit_count() <= 3)


def test_long_runs_stay_linear():
    prints = np.array([1 << i for i in range(64)] + [3 << i for i in range(63)], np.uint64)[:, None]
    found = block_links(np.zeros(len(prints), np.int64), prints, 3)
    assert sum(len(a) for a, _ in found) == len(prints) - 1


def test_wide_fingerprints_find_copies_with_more_changes(spark):
    rng = random.Random(11)
    docs, groups = [], {}
    for g in range(25):
        base = rng.choices([f"w{i}" for i in range(5000)], k=400)
        for c in range(4):
            w = list(base)
            for k in rng.sample(range(400), 3 * c):  # similarities of about 0.93, 0.86, 0.80 with the first
                w[k] = f"x{rng.randrange(5000)}"
            docs.append((len(docs), " ".join(w)))
            groups[len(docs) - 1] = g * 4
    docs += [(900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_duplicates(df, wide=True).collect()}
    assert all(got[i] in (i, *range(g, g + 4)) for i, g in groups.items())
    assert sum(got[g + 1] == g for g in set(groups.values())) >= 23
    assert got[900] == got[901] == 900


def five_word_sets(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_pairs_at_the_similarity_are_found_and_others_are_not(spark):
    rng = random.Random(17)
    docs, want = [], {}
    for changes in (3, 6, 8, 9, 10, 14):  # similarities of about 0.93, 0.86, 0.82, 0.80, 0.78, 0.70
        for _ in range(60):
            base = rng.choices([f"w{i}" for i in range(5000)], k=400)
            w = list(base)
            for k in rng.sample(range(400), changes):
                w[k] = f"x{rng.randrange(5000)}"
            x, y = five_word_sets(" ".join(base)), five_word_sets(" ".join(w))
            want[len(docs)] = (changes, 5 * len(x & y) >= 4 * len(x | y))
            docs += [(len(docs), " ".join(base)), (len(docs) + 1, " ".join(w))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_duplicates(df, wide=True).collect()}
    assert all(got[i + 1] == i + 1 for i, (_, near) in want.items() if not near)
    for changes in (3, 6, 8, 9):
        linked = [got[i + 1] == i for i, (c, near) in want.items() if near and c == changes]
        assert np.mean(linked) >= 0.97 and len(linked) > 10, (changes, np.mean(linked))


def test_repeated_passages_do_not_link(spark):
    rng = random.Random(19)
    line = " ".join(f"line{i}" for i in range(8))
    docs = [(i, " ".join(rng.choices([f"w{k}" for k in range(5000)], k=(60, 100, 150)[i % 3]) + [line] * 30)) for i in range(60)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), wide=True).collect()
    assert all(r.component_id == r.doc_id for r in got)


def test_cross_links_join_what_is_apart_and_similar():
    from tickloom.llm.simhash import cross_links

    sets = [np.arange(k, k + 50, dtype=np.uint32) for k in (0, 2, 4, 30, 33, 500)] + [np.zeros(0, np.uint32)]
    prints, label = np.zeros((7, 12), np.uint64), np.arange(7)
    assert cross_links(prints, sets, label, np.zeros(7)) == [(0, 1), (0, 2), (3, 4)]  # 46 of 54 and 47 of 53 are over four fifths
    assert cross_links(prints, sets, np.array([0, 0, 0, 1, 1, 2, 3]), np.zeros(7)) == []
    assert cross_links(prints, sets, label, np.array([0, 0, 1, 1, 1, 0, 0])) == [(0, 2), (1, 2)]
    prints[1] = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert cross_links(prints, sets, label, np.zeros(7)) == [(0, 2), (3, 4)]


def test_hot_blocks_are_split_without_losing_links(spark, monkeypatch):
    from tickloom.llm import simhash

    monkeypatch.setattr(simhash, "HOT_RUN", 5)
    rng = random.Random(8)
    # one block of equal upper bits, most of its prints a few bits from another
    base = [rng.getrandbits(31) for _ in range(60)]
    prints = sorted({(0x5A5A5A5A << 32 | b) ^ sum(1 << k for k in rng.sample(range(31), rng.randrange(4))) for b in base for _ in range(6)})
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    links = {frozenset((r.a, r.b)) for r in simhash.print_links(df).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in map(tuple, links))
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in map(tuple, links):
        group[root(a)] = root(b)
    assert all(root(a) == root(b) for a in prints for b in prints if (a ^ b).bit_count() <= 3)
    # blocks that are left are small, or agree on all but few bits
    keyed = df.selectExpr("1L as block", "print as node", f"print & {(1 << 32) - 1} as rest")
    sizes = [r["count"] for r in simhash.split_hot(keyed, 32, 3).groupBy("block").count().collect()]
    assert max(sizes) < len(prints) / 4


@pytest.mark.parametrize("part", [1 << 13, 60])
def test_long_runs_lose_no_link(spark, monkeypatch, part):
    """A group of graded copies: components equal those of all pairs that share a band, whatever the length of its runs."""
    import pyarrow as pa

    from tickloom.llm import simhash

    monkeypatch.setattr(simhash, "RUN_PART", part)
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(260)]
    texts = []
    for i in range(420):
        words = list(base if i < 40 or not texts else rng.choice(texts))
        for _ in range(rng.choice([0, 1, 2, 4, 7, 9, 12])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        texts.append(words)
    lines = sorted({" ".join(t) for t in texts})
    sets = simhash.shingle_sets(pa.RecordBatch.from_arrays([pa.array(lines)], ["t"]))
    bands, prints = [set(simhash.band_keys(x).tolist()) for x in sets], np.array([simhash.wide_print(x) for x in sets])
    short = [np.unique((x >> np.uint64(32)).astype(np.uint32)) for x in sets]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(lines)):
        for j in range(i + 1, len(lines)):
            if bands[i] & bands[j]:
                common = len(np.intersect1d(short[i], short[j], assume_unique=True))
                if 5 * common >= 4 * (len(short[i]) + len(short[j]) - common):
                    root[find(j)] = find(i)
    want = {}
    for i in range(len(lines)):
        want.setdefault(find(i), set()).add(i)
    assert 5 < len(want) < len(lines) - 50
    got = {}
    for r in near_duplicates(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), wide=True).collect():
        got.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert prints.shape[1] == simhash.WIDE_LANES
