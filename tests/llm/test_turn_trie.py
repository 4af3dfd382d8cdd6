import hashlib
import random
import zlib

import pytest

from tickloom.llm import turn_trie as module
from tickloom.llm.queries import QUERIES
from tickloom.llm.turn_trie import turn_trie

SF = "/root/testdata/sf0.001"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = set()
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _rows(df):
    rows = df.collect()
    out = {tuple(r[c] for c in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


KIND = "conv_id long, turn long, role string, text string, depth int, top string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_trie(spark, seed):
    rnd = random.Random(seed)
    texts = ["", "a", "é" * 3, None, "long " * 2000]
    rows = []
    for c in [*rnd.sample(range(-40, 400), 150), 10**12]:
        for t in range(rnd.randint(1, 12)):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", "user", None]), rnd.choice(texts[:2] if t < 6 else texts)))
    rows += rows[:20] + [(None, 0, "user", "a"), (None, None, None, None)]
    assert _rows(turn_trie(_frame(spark, rows))) == _trie(rows)


def test_deep_copies_and_a_hot_conversation(spark):
    same = [(c, t, "user", f"turn {t}") for c in (5, 10, 15, 20, 21, 22) for t in range(70)]
    rows = [*same, *[(25, t, "user", "z") for t in range(1500)], (30, 0, "user", "alone")]
    assert _rows(turn_trie(_frame(spark, rows))) == _trie(rows)


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(module, "LIST_PART", 40)
    rows = [(c, 0, "user", "hi") for c in range(0, 3000, 5)]
    assert _rows(turn_trie(_frame(spark, rows))) == _trie(rows)


@pytest.mark.parametrize("rows", [[], [(7, 0, "user", "a")], [(c, 0, "u", "a") for c in (1, 2)], [(5, None, None, None)], [(None, 1, "a", "b")]])
def test_small_tables(spark, rows):
    assert _rows(turn_trie(_frame(spark, rows) if rows else spark.createDataFrame([], KIND))) == _trie(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_turn_trie"](spark, SF)
    assert {k for _, k in df.drop("ends_sha256").dtypes} == {"bigint"}
    assert _rows(df) == _trie(rows)
