"""Universe selection from daily bars: rolling features, events, core panel, follow-up, tiers, for all dates at once.

Every window looks back only, so one pass over the bars gives each date the result it would have had on that date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case, product_error, reasons, require, two_sum

#: Fixed thresholds of the selection policy.
GUARD_PCT, LIMIT_PCT, SURGE_PCT, VOLSURGE, VOLSURGE_PCT, EXTREME_PCT = 31.0, 29.0, 10.0, 5.0, 5.0, 5.0
MEDIAN_WINDOW, EXTREME_WINDOW, IMPLIED_TOLERANCE, LIQUIDITY = 20, 60, 0.005, 50.0
ELIGIBLE_KIND = "보통주"
EXCLUDED_SECTIONS = ("관리종목(소속부없음)", "SPAC(소속부없음)", "투자주의환기종목(소속부없음)")


def selection_features(bars: DataFrame) -> DataFrame:
    """Rolling median of the trade value, 60-day extremes of the event-adjusted close, and the value's ratio to its median.

    Rows with nulls, without trade, or beyond the price limit are dropped first. A base price that differs from the last
    close is a corporate action: closes are divided by the running product of these ratios. A base implied by the daily
    change counts as no action within the tolerance of its rounding.
    """
    order = Window.partitionBy("symbol").orderBy("date")
    required = ["date", "symbol", "close", "volume", "trade_value_100m", "daily_change_pct"]
    clean = bars.dropna(subset=required).where((F.col("volume") > 0) & (F.col("close") > 0) & (F.abs("daily_change_pct") <= GUARD_PCT))
    for name in ("section", "stock_cert_kind"):
        if name in bars.columns:
            clean = clean.withColumn(name, F.last(name, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    past = order.rowsBetween(-(MEDIAN_WINDOW - 1), 0)
    full = F.count("*").over(past) == MEDIAN_WINDOW
    implied = F.col("close") / (1.0 + F.col("daily_change_pct") / 100.0)
    implied = F.when(implied > 0, implied)
    given = F.when(F.col("base_price") > 0, F.col("base_price").cast("double")) if "base_price" in bars.columns else F.lit(None).cast("double")
    clean = clean.withColumns({"tv_median_20": F.when(full, F.percentile("trade_value_100m", F.lit(0.5)).over(past)), "_before": F.lag("close").over(order), "_given": given, "_implied": implied})
    ratio = F.when(F.col("_before") > 0, F.coalesce(F.col("_given"), F.col("_implied")) / F.col("_before"))
    ratio = F.coalesce(ratio, F.lit(1.0))
    snapped = F.when(F.col("_given").isNull() & F.col("_implied").isNotNull() & (F.abs(ratio - 1.0) <= IMPLIED_TOLERANCE), F.lit(1.0)).otherwise(ratio)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    clean = clean.withColumn("_ratio", snapped).withColumn("_moved", F.product("_ratio").over(so_far))
    # what the roundings of the product and of the closes divided by it lose is carried along, else values near a half are rounded to the wrong side
    lost = product_error(F.coalesce(F.lag("_moved").over(order), F.lit(1.0)), F.col("_ratio"), F.col("_moved"))
    clean = clean.withColumn("_lost", F.nanvl(F.try_divide(lost, F.col("_moved")), F.lit(0.0))).withColumn("_lost", F.sum("_lost").over(so_far))
    clean = clean.withColumn("_norm", F.col("close") / F.col("_moved"))
    again = F.col("_norm") * F.col("_moved")
    lost = ((F.col("close") - again) - product_error(F.col("_norm"), F.col("_moved"), again)) / F.col("close") - F.col("_lost")
    clean = clean.withColumn("_norm", two_sum(F.col("_norm"), F.nanvl(F.col("_norm") * lost, F.lit(0.0))))

    def at_now(norm):
        value = F.col("_moved") * norm["high"]
        rest = product_error(F.col("_moved"), norm["high"], value) + F.col("_moved") * norm["low"] + value * F.col("_lost")
        return value + F.nanvl(rest, F.lit(0.0))

    before = order.rowsBetween(-(EXTREME_WINDOW - 1), -1)
    enough = F.count("*").over(before) == EXTREME_WINDOW - 1
    clean = clean.withColumns({"_top": F.when(enough, F.max("_norm").over(before)), "_low": F.when(enough, F.min("_norm").over(before))})
    clean = clean.withColumns(
        {
            "close_max_60": F.when(F.col("_top").isNotNull(), F.greatest(at_now(F.col("_top")), F.col("close"))),
            "close_min_60": F.when(F.col("_low").isNotNull(), F.least(at_now(F.col("_low")), F.col("close"))),
            "tv_ratio": F.when(F.col("tv_median_20") > 0, F.col("trade_value_100m") / F.col("tv_median_20")),
        }
    )
    return clean.drop("_before", "_given", "_implied", "_ratio", "_lost", "_moved", "_norm", "_top", "_low")


def eligible_class(df: DataFrame) -> Column:
    """Ordinary shares outside the excluded sections; unknown counts as eligible."""
    conditions = [F.lit(True)]
    if "stock_cert_kind" in df.columns:
        conditions.append(F.col("stock_cert_kind").isNull() | (F.col("stock_cert_kind") == ELIGIBLE_KIND))
    if "section" in df.columns:
        conditions.append(F.col("section").isNull() | ~F.col("section").isin(*EXCLUDED_SECTIONS))
    return reduce(lambda a, b: a & b, conditions)


def ineligible_symbols(bars: DataFrame) -> DataFrame:
    """Symbols whose latest known class is excluded."""
    last = bars.groupBy("symbol").agg(F.max_by("stock_cert_kind", F.when(F.col("stock_cert_kind").isNotNull(), F.col("date"))).alias("kind"), F.max_by("section", F.when(F.col("section").isNotNull(), F.col("date"))).alias("section"))
    return last.where((F.col("kind") != ELIGIBLE_KIND) | F.col("section").isin(*EXCLUDED_SECTIONS)).select("symbol")


def event_reasons(downside: bool = True, liquidity: float = LIQUIDITY) -> Column:
    """The reasons for which a liquid row is an event, null for one that is none; the class is not looked at."""
    change, close, surge = F.col("daily_change_pct"), F.col("close"), F.col("tv_ratio") >= VOLSURGE
    up = [("limit_up", change >= LIMIT_PCT), ("surge10", change >= SURGE_PCT), ("volsurge", surge & (change >= VOLSURGE_PCT)), ("newhigh60", (close >= F.col("close_max_60")) & (change >= EXTREME_PCT))]
    down = [("limit_down", change <= -LIMIT_PCT), ("plunge10", change <= -SURGE_PCT), ("volsurge_down", surge & (change <= -VOLSURGE_PCT)), ("newlow60", (close <= F.col("close_min_60")) & (change <= -EXTREME_PCT))]
    found = reasons(up + (down if downside else []))
    return F.when((F.size(found) > 0) & (F.col("trade_value_100m") >= liquidity), found)


def event_direction() -> Column:
    return F.when(F.col("daily_change_pct") > 0, "up").otherwise("down")


def event_rows(featured: DataFrame, downside: bool = True, liquidity: float = LIQUIDITY) -> DataFrame:
    """Liquid rows that qualify as events, with their reasons and direction."""
    rows = featured.where(eligible_class(featured)).withColumn("selection_reasons", event_reasons(downside, liquidity))
    return rows.where("selection_reasons is not null").withColumn("direction", event_direction())


def _value_rank(name: str = "trade_value_100m") -> Column:
    v = F.col(name)
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v).otherwise(F.lit(float("-inf")))


def select_universe(featured: DataFrame, slot_budget: int, downside: bool = True, liquidity: float = LIQUIDITY) -> DataFrame:
    """Event rows of every date with their priority; the first ``slot_budget`` are selected, the rest dropped."""
    if slot_budget < 1:
        raise ValueError("slot_budget must be at least 1")
    order = Window.partitionBy("date").orderBy(_value_rank().desc(), "symbol")
    return event_rows(featured, downside, liquidity).withColumn("priority", F.row_number().over(order)).withColumn("selected", F.col("priority") <= slot_budget)


def session_index(df: DataFrame) -> DataFrame:
    """(date, day): sessions numbered in order; one row per session, so the order over all is small."""
    return df.select("date").distinct().withColumn("day", F.row_number().over(Window.orderBy("date")).cast("long"))


def check_lookahead(df: DataFrame, decision_date) -> DataFrame:
    """The rows, failing the query if one is dated after the decision."""
    return require(df, F.col("date") > F.lit(decision_date), "lookahead: a row is dated after the decision")


def core_panel(featured: DataFrame, enter_rank: int = 60, exit_rank: int = 75, warmup: int = 20) -> DataFrame:
    """(date, symbol, core_rank) of the core's members on every date.

    A symbol is in from a day at rank ``enter_rank`` or better for as long as it stays at ``exit_rank`` or better on every
    session since; days before the last ``warmup`` sessions are not looked at. A symbol that is absent or worse falls out.
    """
    if not 1 <= enter_rank <= exit_rank or warmup < 1:
        raise ValueError("ranks must be 1 <= enter <= exit and warmup at least 1")
    days = session_index(featured)
    ranked = featured.where(eligible_class(featured) & F.col("tv_median_20").isNotNull()).withColumn("core_rank", F.row_number().over(Window.partitionBy("date").orderBy(F.col("tv_median_20").desc(), "symbol")))
    good = ranked.where(F.col("core_rank") <= exit_rank).join(days, "date")
    runs = good.withColumn("run", F.col("day") - F.row_number().over(Window.partitionBy("symbol").orderBy("day")))
    upto = Window.partitionBy("symbol", "run").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    entered = runs.withColumn("entered", F.max(F.when(F.col("core_rank") <= enter_rank, F.col("day"))).over(upto))
    return entered.where(F.col("entered") > F.col("day") - warmup).select("date", "symbol", "core_rank")


def follow_up(featured: DataFrame, sessions: int = 3, downside: bool = True, liquidity: float = LIQUIDITY) -> DataFrame:
    """(date, symbol, follow_age, direction): symbols that trade on a date and were events within the ``sessions`` before."""
    events = event_rows(featured, downside, liquidity).select("date", "symbol", F.col("direction").alias("_direction"))
    rows = featured.where(eligible_class(featured)).select("date", "symbol").join(events, ["date", "symbol"], "left").join(session_index(featured), "date")
    before = Window.partitionBy("symbol").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("_direction").isNotNull(), F.struct("day", "_direction"))).over(before)
    aged = rows.withColumn("_last", last).withColumn("follow_age", F.col("day") - F.col("_last.day"))
    return aged.where(F.col("follow_age") <= sessions).select("date", "symbol", "follow_age", F.col("_last._direction").alias("direction"))


def select_tiers(featured: DataFrame, slot_budget: int, enter_rank: int = 60, exit_rank: int = 75, warmup: int = 20, sessions: int = 3, downside: bool = True, liquidity: float = LIQUIDITY) -> DataFrame:
    """Core by rank, then events by value, then follow-ups by age, value and symbol, numbered and cut at the budget, for every date."""
    keys = ["date", "symbol"]
    if not 1 <= enter_rank <= exit_rank or warmup < 1:
        raise ValueError("ranks must be 1 <= enter <= exit and warmup at least 1")
    # all of it are columns and windows of the same rows, so these are read once and never joined with themselves
    rows = featured.where(eligible_class(featured)).join(session_index(featured), "date")
    ranked = F.col("tv_median_20").isNotNull()
    place = F.row_number().over(Window.partitionBy("date").orderBy(ranked.desc(), F.col("tv_median_20").desc(), "symbol"))
    rows = rows.withColumns({"_rank": F.when(ranked, place), "_event": event_reasons(downside, liquidity), "_way": event_direction()})
    days = Window.partitionBy("symbol").orderBy("day")
    good = F.coalesce(F.col("_rank") <= exit_rank, F.lit(False))
    upto, before = days.rowsBetween(Window.unboundedPreceding, 0), days.rowsBetween(Window.unboundedPreceding, -1)
    past = F.max(F.when(F.col("_event").isNotNull(), F.struct("day", "_way"))).over(before)
    rows = rows.withColumns({"_run": F.when(good, F.col("day") - F.sum(good.cast("long")).over(upto)), "_past": past})
    inside = Window.partitionBy("symbol", "_run").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    entered = F.max(F.when(F.col("_rank") <= enter_rank, F.col("day"))).over(inside)
    age = F.col("day") - F.col("_past.day")
    rows = rows.withColumns(
        {
            "core_rank": F.when(F.col("_run").isNotNull() & (entered > F.col("day") - warmup), F.col("_rank")),
            "selection_reasons": F.col("_event"),
            "follow_age": F.when(age <= sessions, age),
            "event_direction": F.when(F.col("_event").isNotNull(), F.col("_way")),
            "follow_direction": F.when(age <= sessions, F.col("_past._way")),
        }
    ).where("core_rank is not null or selection_reasons is not null or follow_age is not null")
    core, event, follow = F.col("core_rank").isNotNull(), F.col("selection_reasons").isNotNull(), F.col("follow_age").isNotNull()
    label = F.concat(F.lit("follow:"), F.col("follow_age").cast("string"))
    none = F.array().cast("array<string>")
    names = F.concat(F.coalesce("selection_reasons", none), F.when(core, F.array(F.lit("core"))).otherwise(none), F.when(follow & (event | ~core), F.array(label)).otherwise(none))
    tier = first_case([(core, F.lit("core")), (event, F.lit("event"))], "follow")
    rows = rows.withColumns({"tier": tier, "selection_reasons": names, "direction": F.coalesce("event_direction", "follow_direction")})
    rank = first_case([(F.col("tier") == "core", F.lit(0)), (F.col("tier") == "event", F.lit(1))], 2)
    age = F.when(F.col("tier") == "follow", F.col("follow_age")).otherwise(0)
    value = F.when(F.col("tier") == "core", F.lit(0.0)).otherwise(_value_rank())
    order = Window.partitionBy("date").orderBy(rank, F.when(core, F.col("core_rank")), age, value.desc(), "symbol")
    return rows.withColumn("priority", F.row_number().over(order)).withColumn("selected", F.col("priority") <= slot_budget).select(*keys, "selection_reasons", "daily_change_pct", "trade_value_100m", "tv_ratio", "tier", "core_rank", "direction", "priority", "selected")


def ranking_snapshot(amount: DataFrame, fluctuation: DataFrame, capacity: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Two rankings (symbol, rank, trade_value, change_pct) merged: limit-up first, then by the ranks, nulls last, renumbered and cut."""
    by = [*keys, "symbol"]
    a = amount.select(*by, F.col("rank").alias("ta_rank"), F.col("trade_value").alias("ta_value"), F.col("change_pct").alias("ta_change"))
    b = fluctuation.select(*by, F.col("rank").alias("fl_rank"), F.col("trade_value").alias("fl_value"), F.col("change_pct").alias("fl_change"))
    rows = a.join(b, by, "full").withColumns({"change_pct": F.coalesce("fl_change", "ta_change"), "trade_value": F.coalesce("ta_value", "fl_value")})
    limit = F.col("change_pct") >= LIMIT_PCT
    names = reasons([("limit_up", limit), ("trade_amount", F.col("ta_rank").isNotNull()), ("fluctuation", F.col("fl_rank").isNotNull())])
    order = Window.partitionBy(*keys).orderBy(F.when(limit, 0).otherwise(1), F.col("ta_rank").asc_nulls_last(), F.col("fl_rank").asc_nulls_last(), "symbol")
    return rows.withColumns({"selection_reasons": names, "position": F.row_number().over(order)}).where(F.col("position") <= capacity).select(*by, "position", "ta_rank", "fl_rank", "trade_value", "change_pct", "selection_reasons")


def best_by_value(rows: DataFrame, capacity: int, keys: tuple[str, ...] = (), tie: str = "seq") -> DataFrame:
    """Each symbol's row of largest value, the first of equals, then the ``capacity`` largest."""
    one = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "symbol").orderBy(F.col("trade_value").desc(), tie))).where("_n = 1").drop("_n")
    return one.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("trade_value").desc(), "symbol"))).where(F.col("position") <= capacity)


def admissions(candidates: DataFrame, feeds: list[tuple[str, int]], min_change: float, min_value: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Qualifying candidates (symbol, change_pct, trade_value, ineligible) dealt to feeds by rank, as far as capacity goes.

    The k-th candidate goes to the feed whose cumulative capacity first reaches k: no loop is needed.
    """
    rows = candidates.where((F.abs("change_pct") >= min_change) & (F.col("trade_value") >= min_value))
    order = Window.partitionBy(*keys, "ineligible").orderBy(F.col("trade_value").desc(), "symbol")
    place = F.row_number().over(order)
    upto, cases = 0, []
    for name, capacity in feeds:
        upto += capacity
        cases.append((F.col("_n") <= upto, F.lit(name)))
    feed = F.when(~F.col("ineligible"), first_case(cases))
    rows = rows.withColumn("_n", place).withColumn("feed", feed)
    status = first_case([(F.col("ineligible"), F.lit("ineligible")), (F.col("feed").isNull(), F.lit("capacity"))], "admitted")
    return rows.withColumns({"status": status, "direction": F.when(F.col("change_pct") > 0, "up").otherwise("down")}).drop("_n")


def shard_blocks(pairs: DataFrame, block: int, shards: int, reserve: int = 0, order=("tier", "seq"), keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs by priority in blocks of ``block``; the last shard keeps ``reserve`` places free; what is left over has no shard."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    shard = F.when(F.col("_n") < shards * block - reserve, F.floor(F.col("_n") / block))
    return pairs.withColumn("_n", place).withColumn("shard", shard.cast("long")).drop("_n")


#: Fixed: what excludes a security, warning levels by code, and the code of the full-margin flag.
EXCLUSIONS = (("managed", "managed"), ("halted", "trading_halted"), ("liquidation", "liquidation_trading"), ("short_overheated", "short_overheated"))
WARNINGS = (("00", "none"), ("01", "caution"), ("02", "warning"), ("03", "risk"))
MARGIN_100 = "57"


def classify_status(df: DataFrame) -> DataFrame:
    """exclude, warning_level and the sorted flags of a security's status row; an unmapped code is ``unknown``."""
    flags = reasons([*[(flag, F.col(source)) for flag, source in EXCLUSIONS], ("margin_100", F.col("status_code") == MARGIN_100), ("credit_unavailable", ~F.col("credit_available"))])
    exclude = F.greatest(*[F.coalesce(F.col(source), F.lit(False)) for _, source in EXCLUSIONS])
    return df.withColumns({"exclude": exclude, "warning_level": first_case([(F.col("market_warning_code") == c, F.lit(level)) for c, level in WARNINGS], "unknown"), "flags": F.array_sort(flags)})


def listing_context(bars: DataFrame, session, symbols: DataFrame | None = None) -> DataFrame:
    """(symbol, first_date, status): listed on the session, or established before it; dates before the store starts are unknown, and so is all if a key is null."""
    firsts = bars.groupBy("symbol").agg(F.min("date").alias("first_date"), F.count_if(F.col("date").isNull() | F.col("symbol").isNull()).alias("bad"))
    start = bars.agg(F.min("date").alias("store_start"), (F.count_if(F.col("date").isNull() | F.col("symbol").isNull()) > 0).alias("degraded"))
    status = first_case([(F.col("degraded"), F.lit("unknown")), (F.col("first_date") == F.lit(session), F.when(F.col("store_start") < F.lit(session), "listed_today").otherwise("unknown")), (F.col("first_date") < F.lit(session), F.lit("established"))], "unknown")
    return firsts.join(F.broadcast(start)).select("symbol", "first_date", status.alias("status"))
