"""Features of the universe against exact arithmetic."""

import random
from datetime import date, timedelta
from fractions import Fraction

from tickloom.operators.universe import EXTREME_WINDOW, IMPLIED_TOLERANCE, selection_features


def test_extremes_do_not_lose_what_a_long_product_rounds(spark):
    """The running product of a hundred ratios leaves the extremes within the rounding of four operations."""
    rnd, rows, want = random.Random(8), [], {}
    for symbol in map(str, range(12)):
        moved, closes, before = [Fraction(1)], [], None
        for n in range(110):
            close, pct = float(rnd.randrange(50_000, 250_000)), rnd.randrange(-3100, 3101) / 100.0
            day = date(2000, 1, 1) + timedelta(days=n)
            rows.append((symbol, day, close, 10, 1.0, pct))
            ratio = 1.0 if before is None else close / (1.0 + pct / 100.0) / before
            moved.append(moved[-1] * (1 if abs(ratio - 1.0) <= IMPLIED_TOLERANCE else Fraction(ratio)))
            closes.append(close)
            before = close
            if n >= EXTREME_WINDOW - 1:
                past = [Fraction(closes[k]) / moved[k + 1] for k in range(n - EXTREME_WINDOW + 1, n)]
                want[symbol, day] = max(moved[-1] * max(past), Fraction(close)), min(moved[-1] * min(past), Fraction(close))
    bars = spark.createDataFrame(rows, "symbol string, date date, close double, volume long, trade_value_100m double, daily_change_pct double")
    got = {(r.symbol, r.date): (r.close_max_60, r.close_min_60) for r in selection_features(bars).where("close_max_60 is not null").collect()}
    assert got.keys() == want.keys()
    assert max(abs(Fraction(a) / b - 1) for k in want for a, b in zip(got[k], want[k], strict=True)) <= 4.5e-16


def test_extremes_over_given_bases_are_the_nearest_doubles(spark):
    """However many ratios a base has gone through, the extremes of 60 closes are the exact ones, rounded once."""
    rnd, rows, want = random.Random(12), [], {}
    for symbol in map(str, range(12)):
        moved, closes, before = [Fraction(1)], [], None
        for n in range(110):
            close = float(rnd.randrange(50_000, 9_000_000))
            base = float(rnd.randrange(50_000, 9_000_000)) if rnd.random() < 0.5 else before or close
            day = date(2000, 1, 1) + timedelta(days=n)
            rows.append((symbol, day, close, base, 10, 1.0, 0.0))
            moved.append(moved[-1] * Fraction(1.0 if before is None else base / before))
            closes.append(close)
            before = close
            if n >= EXTREME_WINDOW - 1:
                past = [Fraction(closes[k]) / moved[k + 1] for k in range(n - EXTREME_WINDOW + 1, n)]
                want[symbol, day] = float(max(moved[-1] * max(past), Fraction(close))), float(min(moved[-1] * min(past), Fraction(close)))
    bars = spark.createDataFrame(rows, "symbol string, date date, close double, base_price double, volume long, trade_value_100m double, daily_change_pct double")
    got = {(r.symbol, r.date): (r.close_max_60, r.close_min_60) for r in selection_features(bars).where("close_max_60 is not null").collect()}
    assert got == want


def test_extremes_over_implied_bases_are_the_nearest_doubles(spark):
    rnd, rows, want = random.Random(21), [], {}
    for symbol in map(str, range(12)):
        ratios, closes = [], []
        for n in range(110):
            close, pct = float(rnd.randrange(50_000, 9_000_000)), rnd.randrange(-3100, 3101) / 100.0
            day = date(2000, 1, 1) + timedelta(days=n)
            rows.append((symbol, day, close, 10, 1.0, pct))
            ratio = close / (1.0 + pct / 100.0) / closes[-1] if closes else 1.0
            ratios.append(Fraction(1 if abs(ratio - 1.0) <= IMPLIED_TOLERANCE else ratio))
            closes.append(close)
            if n >= EXTREME_WINDOW - 1:
                now = Fraction(1)
                past = [Fraction(close)]
                for k in range(n, n - EXTREME_WINDOW + 1, -1):
                    now *= ratios[k]
                    past.append(now * Fraction(closes[k - 1]))
                want[symbol, day] = float(max(past)), float(min(past))
    bars = spark.createDataFrame(rows, "symbol string, date date, close double, volume long, trade_value_100m double, daily_change_pct double")
    got = {(r.symbol, r.date): (r.close_max_60, r.close_min_60) for r in selection_features(bars).where("close_max_60 is not null").collect()}
    assert got == want
