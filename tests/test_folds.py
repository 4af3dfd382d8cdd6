"""Ordered folds against hand-worked cases and plain loops: the counter ledger, positions, failover, tape top-up."""

import random

import pytest

from tickloom.operators import audit, control, execution, repair

COLUMNS = "symbol string, phase string, cum long, volume long, cvolume long, price long, hms string, recv_wall_ns long, seq long, conn_id string"


def frames(spark, cums, conns=None, volumes=None):
    rows, volume = [], {}
    for i, cum in enumerate(cums):
        v = volumes[i] if volumes else cum * 10
        rows.append(("A", "regular", cum, v, 10, 5, f"{90000 + i:06d}", i, i, conns[i] if conns else "c"))
    del volume
    return spark.createDataFrame(rows, COLUMNS).repartition(2)


def ledger(spark, *args, **kw):
    rows = sorted(audit.counter_ledger(frames(spark, *args, **kw)).collect(), key=lambda r: r.cum_prev or 0)
    gaps = [(r.cum_prev, r.cum_next, r.missing_trades, r.kind) for r in rows if r.kind]
    return gaps, rows[0]


def test_single_cut(spark):
    gaps, r = ledger(spark, [1, 2, 5, 6])
    assert gaps == [(2, 5, 2, "confirmed")] and (r.accepted, r.resets) == (4, 0)


def test_jump_of_the_count_only(spark):
    gaps, _ = ledger(spark, [1, 2, 5], volumes=[10, 20, 30])
    assert gaps == [(2, 5, 2, "count_only")]


def test_late_frames_fill_their_interval(spark):
    gaps, r = ledger(spark, [1, 2, 6, 4, 5, 3, 7])
    assert gaps == [] and r.accepted == 7


def test_bounds_of_an_interval_are_duplicates(spark):
    gaps, r = ledger(spark, [1, 2, 6, 2, 7])
    assert gaps == [(2, 6, 3, "confirmed")] and (r.duplicates, r.regressions) == (1, 0)


def test_lone_regression_and_confirmed_reset(spark):
    _, r = ledger(spark, [10, 11, 3, 12])
    assert (r.regressions, r.resets) == (1, 0)
    gaps, r = ledger(spark, [10, 11, 1, 2, 4])
    assert (r.regressions, r.resets) == (3, 1) and gaps == [(2, 4, 1, "confirmed")]


def test_overlap_of_connections(spark):
    gaps, r = ledger(spark, [1, 2, 4, 3, 5], conns=["a", "a", "b", "a", "b"])
    assert gaps == [] and r.accepted == 5
    _, r = ledger(spark, [1, 2, 3, 2, 4], conns=["a", "a", "b", "a", "b"])
    assert r.duplicates == 1


def test_lag_form_equals_the_fold_on_clean_feeds(spark):
    rng = random.Random(1)
    cums = sorted(rng.sample(range(1, 400), 250))
    df = frames(spark, cums)
    short = {(r.cum_prev, r.cum_next, r.missing_trades, r.kind) for r in audit.counter_gaps(df).collect()}
    assert short == set(ledger(spark, cums)[0])


def test_position_ledger(spark):
    rng = random.Random(2)
    fills = [(rng.choice("AB"), i, rng.choice(["BUY", "SELL"]), rng.randrange(1, 20), rng.randrange(1, 9999)) for i in range(300)]
    df = spark.createDataFrame(fills, "symbol string, seq long, side string, fill_qty long, amount_krw long").repartition(3)
    got = {r.seq: (r.qty, r.cost_krw, r.pnl_krw, r.cash_krw) for r in execution.position_ledger(df, 15, 18).collect()}
    books = {}
    for symbol, seq, side, n, amount in fills:
        qty, cost = books.get(symbol, (0, 0))
        fee = amount * 15 // 10_000
        if side == "BUY":
            books[symbol] = (qty + n, cost + amount + fee)
            want = (*books[symbol], 0, -amount - fee)
        elif n > qty:
            want = (qty, cost, None, 0)
        else:
            gone = cost * n // qty
            net = amount - fee - amount * 18 // 10_000
            books[symbol] = (qty - n, cost - gone)
            want = (*books[symbol], net - gone, net)
        assert got[seq] == want


def states(spark, steps, **rules):
    df = spark.createDataFrame([("g", t, s) for t, s in steps], "group_id string, step_s long, status string")
    return [r.state for r in control.run_controller(df, control.FailoverRules(**rules)).orderBy("step_s").collect()]


def test_failover_path(spark):
    steps = [(0, "HEALTHY"), (10, "SILENT"), (14, "SILENT"), (50, "SILENT"), (60, "HEALTHY"), (100, "HEALTHY"), (120, "HEALTHY"), (160, "HEALTHY")]
    assert states(spark, steps, hold=30, confirm=50) == ["PRIMARY_OK", "PRIMARY_OK", "DEGRADED", "SECONDARY_ACTIVE", "SECONDARY_ACTIVE", "FAILBACK_HOLD", "FAILBACK_HOLD", "PRIMARY_OK"]


def test_dead_source_passes_two_states_in_a_step(spark):
    assert states(spark, [(0, "HEALTHY"), (5, "DEAD")]) == ["PRIMARY_OK", "SECONDARY_ACTIVE"]


def test_relapses_demote(spark):
    steps = [(0, "DEAD")]
    for t in range(1, 9):
        steps.append((t * 10, "HEALTHY" if t % 2 else "DEAD"))
    assert states(spark, steps, hold=0)[-1] == "DAY_DEMOTED"


def test_unknown_counts_after_its_grace(spark):
    assert states(spark, [(0, "UNKNOWN"), (20, "UNKNOWN"), (31, "UNKNOWN"), (40, "UNKNOWN")]) == ["PRIMARY_OK", "PRIMARY_OK", "PRIMARY_OK", "DEGRADED"]


def test_topup_takes_the_first_slot_that_brackets(spark):
    slots = spark.createDataFrame([("A", 5, 10, 20), ("A", 6, 10, 20), ("A", 9, 30, 40)], "symbol string, cum long, lo long, hi long")
    trades = spark.createDataFrame([("A", 15, 1, 1, 1), ("A", 25, 1, 1, 2), ("A", 33, 1, 1, 3), ("A", 34, 1, 1, 4)], "symbol string, ts long, price long, volume long, tape_seq long")
    assert sorted((r.tape_seq, r.cum) for r in repair.tape_topup(slots, trades).collect()) == [(1, 5), (3, 9)]


def test_windows_that_leave_the_day_are_refused():
    from tickloom.operators.phase import windows_for

    with pytest.raises(ValueError):
        windows_for(4 * 3600)


def test_bins_do_not_change_the_previous_row(spark):
    from pyspark.sql import functions as F

    from tickloom.operators.intervals import as_of, points_in, with_previous

    rng = random.Random(5)
    rows = [(rng.choice("AB") if rng.random() > 0.1 else None, rng.randrange(200), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, i long").repartition(3)
    got = [sorted((r.i, r.previous.i if r.previous else None) for r in with_previous(df, ["k"], "t", ["i"], w, "i").collect()) for w in (1, 7, 10_000)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 300
    spans = spark.createDataFrame([("A", 5, 60), ("A", 90, 91), ("B", 0, 199)], "k string, lo long, hi long")
    found = [sorted(r.i for r in points_in(df, spans, ["k"], "t", w).collect()) for w in (3, 50, 1000)]
    want = sorted(i for k, t, i in rows if (k == "A" and (5 < t <= 60 or t == 91)) or (k == "B" and t > 0))
    assert found == [want] * 3
    schedule = df.where("i % 10 = 0 and k is not null").groupBy("k", F.col("t").alias("since")).agg(F.max("i").alias("v"))
    marks = [(r.k, r.since, r.v) for r in schedule.collect()]
    want = sorted((i, max([(since, v) for k2, since, v in marks if k2 == k and since <= t], default=(None, None))[1]) for k, t, i in rows)
    for width in (None, 3, 50, 10_000):  # a row with a null key has no schedule
        assert sorted((r.i, r.v) for r in as_of(df, schedule, ["k"], "t", "since", width).collect()) == want


def test_no_interval_is_left_out(spark):
    cums = [1 + 2 * i for i in range(701)]
    gaps, r = ledger(spark, cums)
    assert len(gaps) == 700 and (r.trades, r.net_missing, r.accepted) == (1401, 700, 701)
    totals = audit.ledger_totals(audit.counter_ledger(frames(spark, cums))).first()
    assert (totals.intervals, totals.missing, totals.confirmed_missing, totals.status) == (700, 700, 700, "OK")


def plain_ledger(rows):
    """The stated rules frame by frame: (open gaps, counts); a row is (cum, volume, cvolume, price, hms, conn)."""
    gaps, top, last, low, conns = {}, None, None, [], set()
    n = dict.fromkeys(("accepted", "duplicates", "regressions", "resets"), 0)

    def go(a, b):
        if b[0] - a[0] > 1:
            gaps[a[0]] = [b[0], b[0] - a[0] - 1]

    for r in rows:
        if r[:5] == (last or ())[:5] or (low and r[:5] == low[-1][:5]):
            n["duplicates"] += 1
            continue
        around = top is not None and any(a <= r[0] <= g[0] for a, g in gaps.items())
        if top is not None and ((r[0] <= top[0] and r[5] != top[5] and r[5] in conns) or (r[0] < top[0] and around)):
            hole = next((a for a, g in gaps.items() if a < r[0] < g[0]), None)
            n["duplicates" if hole is None else "accepted"] += 1
            if hole is not None:
                gaps[hole][1] -= 1
                if not gaps[hole][1]:
                    del gaps[hole]
            continue
        conns.add(r[5])
        n["accepted"] += 1
        if top is not None and r[0] < top[0]:
            n["regressions"] += 1
            low = [*low, r][-3:]
            if len(low) == 3 and low[0][0] <= low[1][0] <= low[2][0]:
                go(low[0], low[1]), go(low[1], low[2])
                top = last = low[2]
                low = []
                n["resets"] += 1
            continue
        low = []
        if top is not None:
            go(top, r)
        top = last = r
    return {a: tuple(g) for a, g in gaps.items()}, n


def test_fold_equals_the_rules_frame_by_frame():
    import pandas as pd

    rng = random.Random(12)
    for _ in range(300):
        cum, rows = 0, []
        for _ in range(rng.randrange(1, 60)):
            cum += rng.choice([1, 1, 1, 2, 4])
            value = cum if rng.random() < 0.8 else max(1, cum - rng.randrange(6))
            rows.append((value, value * 10, 10, 5, f"{value:06d}", rng.choice("aab")))
            if rng.random() < 0.1:
                rows.append(rows[-1])
        df = pd.DataFrame(rows, columns=["cum", "volume", "cvolume", "price", "hms", "conn_id"]).assign(recv_wall_ns=range(len(rows)), seq=0)
        got = audit._Segment(df).table()
        found = {int(r.cum_prev): (int(r.cum_next), int(r.missing_trades)) for r in got.itertuples() if r.kind}
        assert (found, {k: int(got[k].iloc[0]) for k in ("accepted", "duplicates", "regressions", "resets")}) == plain_ledger(rows), rows


def budget(spark, rows, **kw):
    df = spark.createDataFrame(rows, "symbol string, status string, trades_observed long, confirmed_missing long, loss_ratio double")
    r = audit.gap_budget(df, **kw).first()
    return r.status, r.basis, r.reasons


def test_gap_budget(spark):
    row = lambda s, t, c, status="OK": (s, status, t, c, c / t)
    assert budget(spark, [row("A", 100_000, 5)]) == ("PASS", "ledger", [])
    assert budget(spark, [row("A", 100_000, 20)]) == ("WARN", "ledger", ["trade_loss_warn:20/100000"])
    assert budget(spark, [row("A", 100_000, 0), row("B", 200, 20), row("C", 100, 10), row("D", 99, 50)])[2] == ["symbol_loss_exceeded:B:20/200+1"]
    assert budget(spark, [row("A", 1000, 6), row("B", 1000, 900, "NO_COUNTER")]) == ("FAIL", "ledger", ["trade_loss_exceeded:6/1000"])
    assert budget(spark, [row("A", 100_000, 0)], tail_silence_s=690.5)[2] == ["tail_silence_exceeded:690s"]
    assert budget(spark, [row("A", 100_000, 0)], tail_silence_s=600.0) == ("PASS", "ledger", [])
    assert budget(spark, [row("A", 100_000, 0)], outage_s=700.0) == ("PASS", "ledger", [])
    assert budget(spark, [row("A", 100_000, 0)], outage_s=700.0, partial=True) == ("FAIL", "ledger+legacy", ["gap_exceeded:700s"])
    assert budget(spark, [], outage_s=700.0) == ("FAIL", "legacy", ["gap_exceeded:700s"])


def test_only_the_regular_phase_counts_and_days_are_apart(spark):
    rows = [("d1", "A", "pre", c, c * 10) for c in (1, 5)] + [("d1", "A", "regular", c, c * 10) for c in (6, 7, 7)]
    rows += [("d2", "A", "regular", c, c * 10) for c in (1, 2)] + [("d2", "B", "pre", c, c * 10) for c in (3, 4)] + [("d2", "C", "regular", 4, 40), ("d2", "C", "pre", 3, 30), ("d2", "D", "regular", 9, 90), ("d2", "D", "pre", 9, 90)]
    df = spark.createDataFrame([(d, s, p, c, v, 10, 5, "090000", i, i, "c") for i, (d, s, p, c, v) in enumerate(rows)], f"dt string, {COLUMNS}")
    totals = {(r.dt, r.symbol): r for r in audit.ledger_totals(audit.counter_ledger(df), cap=0).collect()}
    first = totals["d1", "A"]
    assert (first.frames, first.trades_observed, first.missing, first.net_missing, first.loss_ratio, first.duplicates) == (4, 2, 0, 0, 0.0, 1)
    assert (first.intervals, first.intervals_truncated) == (0, 1)  # that of the pre-market is none of the regular phase
    assert (totals["d2", "A"].trades_observed, totals["d2", "A"].regressions, totals["d2", "A"].resets) == (2, 0, 0)
    assert {k[1]: r.status for k, r in totals.items()} == {"A": "OK", "B": "OK", "C": "OK", "D": "NO_COUNTER"}
    assert totals["d2", "B"].trades_observed == 0
    days = {r.dt: (r.symbols, r.trades_observed, r.symbols_without_counter) for r in audit.session_totals(audit.ledger_totals(audit.counter_ledger(df))).collect()}
    assert days == {"d1": (1, 2, 0), "d2": (3, 3, 1)}


def test_outages_are_split_by_the_ledger(spark):
    s = 1_000_000_000
    bounds = spark.createDataFrame([("a", 100 * s, 1000 * s), ("b", 0, 50 * s)], "dt string, open_ns long, close_ns long")
    outages = spark.createDataFrame([("a", 0, 150 * s), ("a", 150 * s, 200 * s), ("a", 300 * s, 310 * s), ("a", 305 * s, 340 * s), ("a", 990 * s, 2000 * s), ("a", 1000 * s, 1200 * s)], "dt string, gap_start_ns long, gap_end_ns long")
    gaps = spark.createDataFrame([("a", "regular", 339 * s, 330 * s), ("a", "pre", 120 * s, 130 * s), ("a", "regular", 200 * s, 300 * s), ("b", "regular", 1, 2)], "dt string, phase string, recv_prev_ns long, recv_next_ns long")
    got = {r.dt: (r.outage_s, r.silent_s, r.loss_s, r.silent_spans) for r in audit.outage_split(outages, gaps, bounds, ["dt"]).collect()}
    assert got == {"a": (150.0, 110.0, 40.0, 2), "b": (0.0, 0.0, 0.0, 0)}


def test_session_reconciliation(spark):
    days = {  # outage, tail, audit, pending, (trades, lost), manifest, streams
        "pass": (700.0, 0.0, "OK", False, (100_000, 5), True, "tb"),
        "warn": (0.0, 0.0, "OK", False, (100_000, 20), True, "tb"),
        "fail": (0.0, 601.0, "OK", True, (1000, 6), True, "tb"),
        "pending": (0.0, 0.0, "OK", True, (1000, 6), True, "tb"),
        "partial": (700.0, 0.0, "PARTIAL", False, (100_000, 0), True, "tb"),
        "legacy": (700.0, 900.0, "UNAVAILABLE", False, (1000, 6), True, "tb"),
        "quiet": (10.0, 0.0, "OK", False, None, True, "tb"),
        "lost": (700.0, 0.0, "OK", False, (100_000, 0), None, "b"),
        "torn": (700.0, 0.0, "UNAVAILABLE", False, None, False, "t"),
    }
    sessions = spark.createDataFrame([(d, v[0], 0.0, v[0], 0, v[1], v[2], v[3]) for d, v in days.items()], "dt string, outage_s double, silent_s double, loss_s double, silent_spans long, tail_silence_s double, audit_status string, repair_pending boolean")
    totals = spark.createDataFrame([(d, "A", "OK", v[4][0], v[4][1], v[4][1] / v[4][0]) for d, v in days.items() if v[4]], "dt string, symbol string, status string, trades_observed long, confirmed_missing long, loss_ratio double")
    manifests = spark.createDataFrame([(d, v[5]) for d, v in days.items() if v[5] is not None], "dt string, readable boolean")
    journals = spark.createDataFrame([(d, {"t": "tick", "b": "book"}[x]) for d, v in days.items() for x in v[6]], "dt string, stream string")
    run = lambda mode: {r.dt: (r.status, r.holds, r.structural + r.reasons, r.would) for r in audit.session_reconciliation(sessions, totals, manifests, journals, ["tick", "book"], ["dt"], mode).collect()}
    assert run("enforce") == {
        "pass": ("PASS", True, [], None),
        "warn": ("WARN", True, ["trade_loss_warn:20/100000"], None),
        "fail": ("FAIL", False, ["trade_loss_exceeded:6/1000", "tail_silence_exceeded:601s"], None),
        "pending": ("PENDING_REPAIR", True, ["trade_loss_exceeded:6/1000"], None),
        "partial": ("FAIL", False, ["gap_exceeded:700s"], None),
        "legacy": ("FAIL", False, ["gap_exceeded:700s"], None),
        "quiet": ("PASS", True, [], None),
        "lost": ("FAIL", False, ["manifest_missing", "journal_missing:tick"], None),
        "torn": ("FAIL", False, ["journal_missing:book", "manifest_unreadable"], None),
    }
    off = run("off")
    assert off["pass"] == ("FAIL", False, ["gap_exceeded:700s"], None) and off["pending"] == ("PASS", True, [], None)
    shadow = run("shadow")
    assert shadow["pending"] == ("PASS", True, [], "FAIL") and shadow["warn"][3] == "WARN" and shadow["legacy"][3] is None


def test_counts_alone_are_no_loss(spark):
    live = frames(spark, [1, 2, 5, 9], volumes=[10, 20, 30, 90])
    r = audit.loss_totals(live, audit.counter_gaps(live)).first()
    assert (r.trades_observed, r.count_only_missing, r.confirmed_missing, r.loss_ratio) == (9, 2, 3, 3 / 9)
    still = frames(spark, [4, 4], volumes=[10, 20])
    assert audit.loss_totals(still, audit.counter_gaps(still)).first().status == "NO_COUNTER"


def peers(spark, gap, trades):
    gaps = spark.createDataFrame([("A", 1, *gap)], "symbol string, interval_id long, missing_trades long, acml_prev long, acml_next_before long")
    rows = spark.createDataFrame([("A", *t) for t in trades], "symbol string, peer int, acml long, price long, qty long, conflated boolean")
    return sorted((r.peer, r.acml) for r in repair.peer_fill(gaps, rows).collect())


def test_peer_fill(spark):
    plain, other = [(1, 110, 5, 10, False), (1, 120, 5, 10, False)], (3, 130, 5, 30, True)
    assert peers(spark, (3, 100, 130), [*plain, other]) == [(1, 110), (1, 120)]
    assert peers(spark, (3, 100, 130), [*plain, (2, 110, 6, 99, False)]) == [(1, 110), (1, 120)]
    assert peers(spark, (1, 100, 130), [*plain]) == [] and peers(spark, (2, 100, 115), [*plain]) == [(1, 110)]
    assert peers(spark, (1, 100, 130), [other, (4, 130, 5, 30, True)]) == [(3, 130)]
    assert peers(spark, (1, 100, 130), [(2, 130, 5, 20, True), other]) == [(3, 130)]
    assert peers(spark, (2, 100, 130), [other]) == [] and peers(spark, (1, 100, 130), [(3, 100, 5, 30, True)]) == []


LIVE, FILLS = "symbol string, cum long, price long, volume long, ts long, recv_wall_ns long", "symbol string, interval_id long, ts long, price long, volume long, tape_seq long"


def repair_of(spark, live, fills, gaps):
    live = spark.createDataFrame([("A", *t) for t in live], LIVE)
    gaps = spark.createDataFrame([("A", *g) for g in gaps], "symbol string, interval_id long, cum_prev long, cum_next long")
    placed = repair.place_fills(live, spark.createDataFrame([("A", *f) for f in fills], FILLS), gaps)
    return live, placed, sorted((r.tape_seq, r.fate, r.cum) for r in placed.collect())


def test_late_live_ticks_take_their_twins_off(spark):
    live = [(1, 5, 1, 10, 1), (2, 5, 1, 11, 2), (6, 5, 1, 13, 3), (4, 7, 2, 12, 4), (4, 7, 2, 12, 5)]
    fills = [(1, 12, 7, 2, 1), (1, 12, 7, 2, 2), (1, 12, 9, 1, 3), (1, 13, 9, 1, 4)]
    rows, placed, got = repair_of(spark, live, fills, [(1, 2, 6)])
    assert got == [(1, "late_live", None), (2, "placed", 3), (3, "placed", 5), (4, "overfill", None)]
    out = repair.repair_outcome(rows, placed, 5, 4).first()
    assert (out.live_rows, out.filled_rows, out.deduped_late_live, out.overfill_dropped, out.status, out.reason) == (5, 2, 1, 1, "MISMATCH", "overfill_over_tolerance")
    assert repair.repair_outcome(rows, placed, 5, 4, tolerance=0.25).first().status == "OK"
    assert repair.repair_outcome(rows, placed, 9, 4).first().reason == "live_rows_ne_received"
    assert repair.repair_outcome(rows, placed, 9, 3).first().reason == "gapfill_rows_ne_recovered"
    assert repair.with_fills(rows, placed).count() == 7
    # the bounds of a gap are not inside it
    assert repair_of(spark, [(2, 5, 1, 11, 1), (4, 5, 1, 12, 2)], [(1, 11, 5, 1, 1)], [(1, 2, 4)])[2] == [(1, "placed", 3)]


def test_repaired_verdict(spark):
    def verdict(rows):
        r = repair.repaired_verdict(spark.createDataFrame([(*x, x[3] / x[2]) for x in rows], "symbol string, status string, trades_observed long, residual long, residual_ratio double")).first()
        return r.status, r.reasons

    assert verdict([("A", "OK", 100_000, 5)]) == ("PASS", [])
    assert verdict([("A", "OK", 100_000, 20)]) == ("WARN", ["residual_loss_warn:20/100000"])
    assert verdict([("A", "OK", 1000, 6), ("B", "NO_COUNTER", 1000, 0)]) == ("FAIL", ["residual_loss_exceeded:6/1000"])
    assert verdict([("A", "OK", 100_000, 0), ("B", "OK", 200, 20), ("C", "OK", 100, 10), ("D", "OK", 99, 50)]) == ("FAIL", ["residual_symbol_loss_exceeded:B:20/200+1"])
    assert verdict([]) == ("PASS", [])


def test_ledger_of_many_small_segments_is_that_of_each(spark):
    """Segments, clean or not, that share a batch or reach over several; a null key is a segment too."""
    import pandas as pd

    rng, rows = random.Random(21), []
    for n in range(300):
        cum, day, symbol = 0, f"d{n % 3}" if n % 50 else None, f"s{n // 3}"
        for k in range(rng.choice([1, 1, 2, 3, 40])):
            cum += rng.choice([1, 1, 2, 3])
            value = cum if n % 2 or rng.random() < 0.8 else max(1, cum - rng.randrange(4))
            rows.append((day, symbol, "regular", value, value * 10, 10, 5, f"{value:06d}", k, 0, rng.choice("ab")))
    kind = "dt string, " + COLUMNS
    names = [c.split()[0] for c in kind.split(", ")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, kind)
        ledger = audit.counter_ledger(df)
        plan = ledger._jdf.queryExecution().executedPlan().toString()
        got = ledger.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for (day, symbol), one in pd.DataFrame(rows, columns=names).groupby(["dt", "symbol"], dropna=False):
        for r in audit._Segment(one.drop(columns=["dt", "symbol", "phase"])).table().itertuples():
            want.append((None if pd.isna(day) else day, symbol, r.kind, None if r.kind is None else int(r.cum_prev), int(r.accepted), int(r.duplicates), int(r.resets)))
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.dt, r.symbol, r.kind, r.cum_prev, r.accepted, r.duplicates, r.resets) for r in got], key=key) == sorted(want, key=key)
    assert "FlatMapGroups" not in plan  # no call of Python by segment
