"""Row rules of bars and snapshots, and splits by them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import reasons

#: Fixed: percentage points by which the stated change may differ, and bad rows a history day may set aside.
MAX_CHANGE_DISAGREEMENT, MAX_QUARANTINE = 0.1, 5


def bar_rules(columns: list[str], max_disagreement: float = MAX_CHANGE_DISAGREEMENT) -> list[tuple[str, Column]]:
    """The rules that the columns allow, as (name, violated); prices are judged on days with trade."""
    c = {n: F.col(n) for n in columns}
    rules: list[tuple[str, Column]] = []
    if "close" in c:
        rules.append(("close_positive", c["close"] <= 0))
    if "volume" in c:
        rules.append(("volume_non_negative", c["volume"] < 0))
    if "trade_value_100m" in c:
        rules.append(("trade_value_non_negative", c["trade_value_100m"] < 0))
        if "volume" in c:
            rules.append(("volume_trade_value_consistency", (c["volume"] == 0) != (c["trade_value_100m"] == 0)))
    if {"open", "high", "low", "close", "volume"} <= set(c):
        traded = c["volume"] > 0
        outside = lambda n: (c[n] < c["low"]) | (c[n] > c["high"])
        complete = lambda n: c[n].isNotNull() & c["low"].isNotNull() & c["high"].isNotNull()
        rules += [("low_positive", traded & (c["low"] <= 0)), ("low_high_order", traded & (c["low"] > c["high"])), ("open_in_range", traded & complete("open") & outside("open")), ("close_in_range", traded & complete("close") & outside("close"))]
    if {"close", "base_price", "daily_change_pct"} <= set(c):
        based = c["base_price"] > 0
        change = F.try_divide(c["close"], c["base_price"]) * 100 - 100
        rules.append(("change_pct_agreement", based & (F.abs(change - c["daily_change_pct"]) > max_disagreement)))
    return rules


def with_violations(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("violations", reasons(rules))


def split_invalid(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their violations)."""
    flagged = with_violations(bars, bar_rules(bars.columns))
    return flagged.where(F.size("violations") == 0).drop("violations"), flagged.where(F.size("violations") > 0)


def day_verdicts(bars: DataFrame) -> DataFrame:
    """Per date: rows, bad rows, duplicated keys, and whether the day is taken, set aside in part, or refused."""
    flagged = with_violations(bars, bar_rules(bars.columns)).withColumn("_n", F.count("*").over(Window.partitionBy("date", "symbol")))
    days = flagged.groupBy("date").agg(F.count("*").alias("rows"), F.count_if(F.size("violations") > 0).alias("bad_rows"), F.count_if(F.col("_n") > 1).alias("duplicate_rows"))
    status = F.when(F.col("duplicate_rows") > 0, "refused").when(F.col("bad_rows") == 0, "taken").when(F.col("bad_rows") <= MAX_QUARANTINE, "quarantined").otherwise("refused")
    return days.withColumn("status", status)


def plausible_height(days: DataFrame, incoming: DataFrame, share: float = 0.9) -> DataFrame:
    """Incoming days with the row count of the latest stored day before them, and whether theirs is at least ``share`` of it.

    ``days`` and ``incoming``: date, rows. Without a stored day before, the nearest after is the reference; with none a day is plausible.
    """
    marks = days.select("date", F.col("rows").alias("_rows")).withColumn("_new", F.lit(False)).unionByName(incoming.select("date", F.col("rows").alias("_rows")).withColumn("_new", F.lit(True)))
    stored = F.when(~F.col("_new"), F.col("_rows"))
    order = Window.orderBy("date", "_new")
    before = F.last(stored, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(stored, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = marks.withColumn("reference", F.coalesce(before, after)).where("_new").select("date", F.col("_rows").alias("rows"), "reference")
    return rows.withColumn("plausible", F.col("reference").isNull() | (F.col("rows") >= F.col("reference") * share))


def _negative(*names: str) -> list[Column]:
    return [F.col(n) < 0 for n in names]


#: Structural rules by snapshot dataset; datasets not named have none.
def snapshot_rules(dataset: str) -> list[Column]:
    c = F.col
    outside = lambda n: (c(n) < c("lower_limit")) | (c(n) > c("upper_limit"))
    both = c("lower_limit").isNotNull() & c("upper_limit").isNotNull()
    return {
        "security_status": [c("last_price") <= 0, c("lower_limit") >= c("upper_limit"), both & outside("last_price"), both & outside("base_price")],
        "auction_book": _negative("expected_price", "expected_volume"),
        "program_trade": [*_negative("sell_qty", "buy_qty", "cum_volume"), c("net_qty") != c("buy_qty") - c("sell_qty"), c("net_value_krw") != c("buy_value_krw") - c("sell_value_krw")],
        "ranking": [c("rank") < 1, c("trade_value_krw") < 0],
        "index_snapshot": [c("index_value") <= 0, *_negative("cum_value_mil_krw", "advancers", "decliners")],
        "minute_bar": [*[c(n) <= 0 for n in ("open", "high", "low", "close")], (c("high") < c("open")) | (c("high") < c("close")), (c("low") > c("open")) | (c("low") > c("close")), *_negative("volume")],
    }.get(dataset, [])


def snapshot_violation(dataset: str) -> Column:
    """Whether a row breaks a rule of its dataset; what is null breaks none."""
    rules = [F.coalesce(r, F.lit(False)) for r in snapshot_rules(dataset)]
    return reduce(lambda a, b: a | b, rules, F.lit(False))


def rename_legacy(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Old column names to new ones; a table with both is refused."""
    active = {old: new for old, new in names.items() if old in df.columns}
    both = [old for old, new in active.items() if new in df.columns]
    if both:
        raise ValueError(f"old and new names of {both}")
    return df.withColumnsRenamed(active)


def schedule_faults(schedule: DataFrame, start) -> DataFrame:
    """(market, fault) of a dated schedule (market, effective_from, transaction_bps, rural_bps, seq): uncovered start, dates not rising, negative rates."""
    order = Window.partitionBy("market").orderBy("seq")
    rows = schedule.withColumn("_before", F.lag("effective_from").over(order))
    late = rows.groupBy("market").agg(F.min("effective_from").alias("_first")).where(F.col("_first") > F.lit(start)).select("market", F.lit("uncovered_start").alias("fault"))
    stuck = rows.where(F.col("effective_from") <= F.col("_before")).select("market", F.lit("not_increasing").alias("fault"))
    negative = rows.where((F.col("transaction_bps") < 0) | (F.col("rural_bps") < 0)).select("market", F.lit("negative_rate").alias("fault"))
    return late.unionByName(stuck).unionByName(negative).distinct()
