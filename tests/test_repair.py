"""Filling of lost trades and repaired tables on hand-worked cases."""

import random

import pytest

from tickloom.operators import repair as r
from tickloom.operators.digest import table_digest

GAPS = "symbol string, interval_id long, ts_prev long, ts_next long, missing_trades long, volume_deficit long"
TAPE = "symbol string, ts long, price long, volume long, tape_seq long"


def _fill(spark, gaps, tape, received=None, prior=None, source=True):
    g = spark.createDataFrame([("A", *x) for x in gaps], GAPS)
    if prior is not None:
        g = g.join(spark.createDataFrame(prior, "interval_id long, prior_recovered long"), "interval_id", "left")
    t = spark.createDataFrame([("A", *x) for x in tape], TAPE + (", source int" if source else ""))
    got = received if received is None else spark.createDataFrame([("A", *x) for x in received], "symbol string, ts long, price long, volume long")
    fills, outcomes = r.tape_fill(g, t, got)
    return sorted((x.interval_id, x.ts, x.price, x.tape_seq, *([x.source] if source else [])) for x in fills.collect()), {x.interval_id: x.asDict() for x in outcomes.collect()}


def test_the_first_source_with_any_trade_fills_a_cluster(spark):
    gaps = [(1, 10, 20, 2, 0), (2, 30, 40, 1, 0), (3, 50, 60, 1, 0)]
    tape = [(12, 5, 1, 1, 1), (13, 6, 1, 2, 1), (12, 5, 1, 1, 0), (35, 7, 1, 3, 1), (45, 8, 1, 4, 0)]
    fills, out = _fill(spark, gaps, tape, received=[])
    assert fills == [(1, 12, 5, 1, 0), (2, 35, 7, 3, 1)]  # source 0 has one trade of the first cluster, so the other's two don't count
    assert {i: (o["recovered"], o["residual"], o["status"], o["source"]) for i, o in out.items()} == {1: (1, 1, "partial", 0), 2: (1, 0, "full", 1), 3: (0, 1, "none", None)}


def test_received_trades_are_taken_off_each_source(spark):
    tape = [(12, 5, 1, 1, 0), (12, 5, 1, 1, 1), (12, 5, 1, 2, 1)]
    fills, out = _fill(spark, [(1, 10, 20, 1, 0)], tape, received=[(12, 5, 1)])
    assert fills == [(1, 12, 5, 2, 1)] and out[1]["source"] == 1


def test_without_received_only_seconds_inside_count(spark):
    tape = [(10, 1, 1, 1), (15, 2, 1, 2), (20, 3, 1, 3)]
    fills, out = _fill(spark, [(1, 10, 20, 3, 0)], tape, source=False)
    assert fills == [(1, 15, 2, 2)] and (out[1]["recovered"], out[1]["residual"], out[1]["status"]) == (1, 2, "partial")


def test_what_peers_recovered_counts_first(spark):
    gaps = [(1, 10, 20, 1, 5), (2, 20, 30, 2, 0), (3, 90, 95, 0, 0)]
    tape = [(11, 1, 2, 1), (12, 2, 5, 2), (25, 3, 1, 3), (26, 4, 9, 4)]
    fills, out = _fill(spark, gaps, tape, received=[], prior=[(1, 2), (3, 4)], source=False)
    assert [f[0] for f in fills] == [1, 2, 2] and [f[3] for f in fills] == [1, 2, 4]  # the smallest trade is the surplus
    assert {i: (o["missing_trades"], o["recovered"], o["recovered_prior"], o["residual"], o["surplus"], o["status"]) for i, o in out.items()} == {1: (3, 3, 2, 0, 0, "full"), 2: (2, 2, 0, 0, 1, "over")}


def test_residual_gaps_lower_trades_and_volume(spark):
    gaps = spark.createDataFrame([("A", 1, 5, 30), ("A", 2, 1, 4)], "symbol string, interval_id long, missing_trades long, volume_deficit long")
    fills = spark.createDataFrame([("A", 1, 10), ("A", 1, 8), ("A", 2, 9)], "symbol string, interval_id long, qty long")
    got = {x.interval_id: (x.missing_trades, x.volume_deficit, x.prior_recovered) for x in r.residual_gaps(gaps, fills).collect()}
    assert got == {1: (3, 12, 2), 2: (0, 0, 1)}


LIVE = "symbol string, cum long, price long, volume long, ts long, recv_wall_ns long"
FILLS = "symbol string, interval_id long, ts long, price long, volume long, tape_seq long"


def _place(spark, live, fills, gaps):
    placed = r.place_fills(
        spark.createDataFrame([("A", *x) for x in live], LIVE),
        spark.createDataFrame([("A", *x) for x in fills], FILLS),
        spark.createDataFrame([("A", *x) for x in gaps], "symbol string, interval_id long, cum_prev long, cum_next long"),
    )
    return sorted((x.interval_id, x.tape_seq, x.cum, x.fate) for x in placed.collect())


def test_nested_gaps_share_their_counters(spark):
    fills = [(1, 100 + i, 5, 1, i) for i in range(3)] + [(2, 100 + i, 6, 1, 10 + i) for i in range(3)]
    got = _place(spark, [(1, 5, 1, 0, 0), (10, 5, 1, 999, 9)], fills, [(1, 1, 10), (2, 4, 8)])
    assert got == [(1, 0, 2, "placed"), (1, 1, 3, "placed"), (1, 2, 4, "placed"), (2, 10, 5, "placed"), (2, 11, 6, "placed"), (2, 12, 7, "placed")]


def test_a_late_tick_inside_nested_gaps(spark):
    live = [(1, 5, 1, 0, 0), (6, 7, 3, 105, 50), (10, 5, 1, 999, 9)]
    fills = [(1, 105, 7, 3, 1), (2, 105, 7, 3, 2), (2, 106, 8, 1, 3), (2, 107, 8, 1, 4), (2, 108, 8, 1, 5), (1, 109, 1, 1, 6)]
    got = _place(spark, live, fills, [(1, 1, 10), (2, 4, 8)])
    assert got == [(1, 1, None, "late_live"), (1, 6, 2, "placed"), (2, 2, None, "late_live"), (2, 3, 5, "placed"), (2, 4, 7, "placed"), (2, 5, None, "overfill")]


def _greedy(live, fills, gaps):
    taken, spans = {x[0] for x in live}, {i: (a, b) for i, a, b in gaps}
    out = []
    for i, ts, _, _, seq in sorted(fills, key=lambda f: (f[1], f[4], f[0])):
        slot = next((c for c in range(spans[i][0] + 1, spans[i][1]) if c not in taken), None)
        taken |= {slot}
        out.append((i, seq, slot, "placed" if slot else "overfill"))
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_gaps_equal_one_fill_at_a_time(spark, seed):
    rnd = random.Random(seed)
    gaps = [(i, a := rnd.randrange(200), a + rnd.randrange(1, 25)) for i in range(25)]
    live = [(c, 1, 1, 10**6, c) for c in rnd.sample(range(230), 60)]
    fills = [(i, rnd.randrange(50), 2, 1, n) for n, i in enumerate(rnd.choices(range(25), k=150))]
    got = _place(spark, live, fills, gaps)
    assert got == _greedy(live, fills, gaps) and any(x[3] == "overfill" for x in got)


@pytest.mark.parametrize("block", [2, 64, 4096])
def test_digest_follows_the_rows_only(spark, block):
    rows = [(i % 70, f"x,{i % 7}", None if i % 5 else i / 3) for i in range(500)]
    of = lambda data, parts=3: table_digest(spark.createDataFrame(data, "k long, `a b` string, v double").repartition(parts), block).first()
    whole = of(rows)
    assert whole.rows == 500 and whole == of(rows[::-1], 7) and len(whole.digest) == 64
    assert table_digest(spark.createDataFrame(rows, "k long, `a b` string, v double").select("v", "k", "a b"), block).first() == whole
    assert len({whole.digest, of([*rows[1:], (1, "x,0", 0.0)]).digest, of(rows[1:]).digest, of([*rows, rows[0]]).digest, of([]).digest}) == 5
    assert of([(1, "2:a", None)]).digest != of([(1, None, None)]).digest


def test_repair_valid(spark):
    audit = spark.range(9).selectExpr("id as k")
    good = table_digest(audit).first().digest
    one = lambda **kw: spark.createDataFrame([tuple(({"status": "OK", "live_rows": 4, "filled_rows": 2, "topup_rows": 1, "audit_trades_received": 4, "audit_digest": good} | kw).values())], "status string, live_rows long, filled_rows long, topup_rows long, audit_trades_received long, audit_digest string")
    check = lambda rows=7, **kw: r.repair_valid(spark.range(rows), one(**kw), audit).first()
    assert check().valid and check(6).against == ["rows"] and check(audit_digest="0").against == ["audit"]
    assert check(status=None, live_rows=5, audit_digest=None).against == ["status", "live_rows", "rows", "audit"]


def test_digest_of_more_blocks_than_three_digits_name(spark):
    import hashlib
    from itertools import groupby

    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    n = 16**3 + 100  # blocks of one row
    rows = sorted(sha(f"{len(str(k))}:{k}") for k in range(n))
    blocks = [f"{key}:{sha(','.join(f'{h}:1' for h in of))}" for key, of in groupby(rows, lambda h: h[:4])]
    assert table_digest(spark.range(n).selectExpr("id as k"), 1).first().digest == sha(",".join(blocks))
