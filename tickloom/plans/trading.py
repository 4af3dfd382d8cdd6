"""Queries of validation, execution, calendar and feed control."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import div, first_case
from tickloom.operators import calendar as c
from tickloom.operators import control as k
from tickloom.operators import execution as x
from tickloom.operators import validation as v
from tickloom.operators.admission import admit
from tickloom.plans.registry import BARS, COUNTED, TICKS, register, table
from tickloom.sources.adapters import counted_ticks, daily_bars, ticks

#: Bars with faults: negative volumes, closes outside the range, wrong changes.
_BAD = "select date, symbol, case when n % 13 = 0 then 0.0 else close end as close, high as open, high, low, base_price, case when n % 7 = 0 and symbol like '%2' then -volume when n % 11 = 0 then 0 else volume end as volume, trade_value_100m, daily_change_pct + case when symbol like '%4' then 5.0 else 0.0 end as daily_change_pct, n from bars"
_RULES = """list_filter([case when close <= 0 then 'close_positive' end, case when volume < 0 then 'volume_non_negative' end, case when trade_value_100m < 0 then 'trade_value_non_negative' end, case when (volume = 0) <> (trade_value_100m = 0) then 'volume_trade_value_consistency' end,
 case when volume > 0 and low <= 0 then 'low_positive' end, case when volume > 0 and low > high then 'low_high_order' end, case when volume > 0 and (open < low or open > high) then 'open_in_range' end, case when volume > 0 and (close < low or close > high) then 'close_in_range' end,
 case when base_price > 0 and abs(close / base_price * 100 - 100 - daily_change_pct) > 0.1 then 'change_pct_agreement' end], lambda x: x is not null)"""


def _bad_bars(spark, sf_dir):
    daily_bars(spark, sf_dir).createOrReplaceTempView("bars_in")
    return spark.sql(_BAD.replace("from bars", "from bars_in").replace("0.0", "cast(0 as double)").replace("5.0", "cast(5 as double)"))


@register("v1_bar_violations", f"with {BARS}, b as ({_BAD}) select date, symbol, {_RULES} as violations from b where len({_RULES}) > 0")
def v1_bar_violations(spark, sf_dir):
    return v.split_invalid(_bad_bars(spark, sf_dir))[1].select("date", "symbol", "violations")


@register("v1_valid_bars", f"with {BARS}, b as ({_BAD}) select date, symbol, volume from b where len({_RULES}) = 0")
def v1_valid_bars(spark, sf_dir):
    return v.split_invalid(_bad_bars(spark, sf_dir))[0].select("date", "symbol", "volume")


@register("v2_day_verdicts", f"with {BARS}, b as ({_BAD}), f as (select date, count(*) as rows, count(*) filter (len({_RULES}) > 0) as bad_rows, 0::bigint as duplicate_rows from b group by 1) select *, case when bad_rows = 0 then 'taken' when bad_rows <= 5 then 'quarantined' else 'refused' end as status from f")
def v2_day_verdicts(spark, sf_dir):
    return v.day_verdicts(_bad_bars(spark, sf_dir))


_MINUTES = f"{TICKS}, m0 as (select symbol, dt, min(price) as low, max(price) as high, arg_min(price, seq) as open, arg_max(price, seq) as c0, cast(sum(cvolume) as bigint) as v0 from ticks group by symbol, dt), mb as (select *, c0 - case when symbol like '%6' then 100000 else 0 end as close, v0 * case when symbol like '%9' then -1 else 1 end as volume from m0)"


@register("v3_minute_violations", f"with {_MINUTES} select symbol, dt, open <= 0 or high <= 0 or low <= 0 or close <= 0 or high < open or high < close or low > open or low > close or volume < 0 as violation from mb")
def v3_minute_violations(spark, sf_dir):
    rows = ticks(spark, sf_dir).groupBy("symbol", "dt").agg(F.min("price").alias("low"), F.max("price").alias("high"), F.min_by("price", "seq").alias("open"), (F.max_by("price", "seq")).alias("close"), F.sum("cvolume").alias("volume"))
    rows = rows.withColumns({"close": F.col("close") - F.when(F.col("symbol").like("%6"), 100000).otherwise(0), "volume": F.col("volume") * F.when(F.col("symbol").like("%9"), -1).otherwise(1)})
    return rows.select("symbol", "dt", v.snapshot_violation("minute_bar").alias("violation"))


@register("v3_program_violations", f"with {TICKS} select seq, cvolume - 90 < 0 or price - 5 <> price - cvolume as violation from ticks")
def v3_program_violations(spark, sf_dir):
    t = ticks(spark, sf_dir).select("seq", F.lit(5).alias("sell_qty_"), (F.col("cvolume") - 90).alias("cum_volume"), F.col("price").alias("buy_qty"), F.col("cvolume").alias("sell_qty"), (F.col("price") - 5).alias("net_qty"), F.lit(None).cast("long").alias("net_value_krw"), F.lit(1).alias("buy_value_krw"), F.lit(1).alias("sell_value_krw"))
    return t.select("seq", v.snapshot_violation("program_trade").alias("violation"))


@register("p17_rename_legacy", f"with {TICKS} select seq, price as last_price from ticks")
def p17_rename_legacy(spark, sf_dir):
    return v.rename_legacy(ticks(spark, sf_dir).select("seq", "price"), {"price": "last_price", "absent": "other"})


@register(
    "v5_schedule_faults",
    """with r as (select o_custkey::varchar as market, cast(o_orderdate as date) as d, o_orderkey % 101 - 1 as t, o_orderkey % 89 - 1 as u, o_orderkey as seq from orders), l as (select *, lag(d) over (partition by market order by seq) as before from r)
select market, 'uncovered_start' as fault from r group by 1 having min(d) > date '1994-01-01' union all select distinct market, 'not_increasing' from l where d <= before union all select distinct market, 'negative_rate' from r where t < 0 or u < 0""",
)
def v5_schedule_faults(spark, sf_dir):
    """Orders as a schedule of rates by customer, in the order of their keys."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("market"), F.to_date("o_orderdate").alias("effective_from"), (key % 101 - 1).alias("transaction_bps"), (key % 89 - 1).alias("rural_bps"), key.alias("seq"))
    return v.schedule_faults(rows, F.to_date(F.lit("1994-01-01")))


@register("s11_plausible_height", f"with {BARS}, d as (select date, count(*) as rows from bars group by 1), s as (select * from d where day(date) % 2 = 0), i as (select * from d where day(date) % 2 = 1) select i.date, i.rows, coalesce((select arg_max(s.rows, s.date) from s where s.date < i.date), (select arg_min(s.rows, s.date) from s where s.date > i.date)) as reference, i.rows >= 0.9 * coalesce((select arg_max(s.rows, s.date) from s where s.date < i.date), (select arg_min(s.rows, s.date) from s where s.date > i.date)) as plausible from i")
def s11_plausible_height(spark, sf_dir):
    days = daily_bars(spark, sf_dir).groupBy("date").agg(F.count("*").alias("rows"))
    return v.plausible_height(days.where("day(date) % 2 = 0"), days.where("day(date) % 2 = 1"))


_INTENT = f"{COUNTED}, ci as (select seq, symbol, case when seq % 2 = 0 then 'BUY' else 'SELL' end as side, case when seq % 5 = 0 then 'MARKET' else 'LIMIT' end as order_type, cvolume - 2 as qty, case when seq % 5 <> 0 or seq % 35 = 0 then price end as limit_price, price as last, recv_wall_ns // 1000000000 as sec from counted)"
_STEP = "case when {p} >= 500000 then 1000 when {p} >= 200000 then 500 when {p} >= 50000 then 100 when {p} >= 20000 then 50 when {p} >= 5000 then 10 when {p} >= 2000 then 5 else 1 end"


def _intents(spark, sf_dir):
    s = F.col("seq")
    return counted_ticks(spark, sf_dir).select(
        "seq", "symbol", F.when(s % 2 == 0, "BUY").otherwise("SELL").alias("side"), F.when(s % 5 == 0, "MARKET").otherwise("LIMIT").alias("order_type"), (F.col("cvolume") - 2).alias("qty"),
        F.when((s % 5 != 0) | (s % 35 == 0), F.col("price")).alias("limit_price"), F.col("price").alias("last"), div(F.col("recv_wall_ns"), 1_000_000_000).alias("at"),
    )


@register(
    "v4_pre_trade",
    f"""with {_INTENT} select seq, case when seq % 101 = 0 then 'KILL_SWITCH' when seq % 53 = 0 then 'ACCOUNT_MISMATCH' when seq % 47 = 0 then 'UNKNOWN_PENDING' when symbol like '%77' then 'SYMBOL_NOT_ALLOWED' when qty < 1 then 'QTY_INVALID'
 when (order_type = 'LIMIT') = (limit_price is null) then 'PRICE_INVALID' when seq % 43 = 0 then 'TRADING_HALTED' when last >= 1 and {_STEP.format(p='last')} <> case when seq % 41 = 0 then 3 else {_STEP.format(p='last')} end then 'TICK_TABLE_MISMATCH'
 when order_type = 'LIMIT' and not coalesce(limit_price >= 1 and limit_price % ({_STEP.format(p='limit_price')}) = 0, false) then 'PRICE_OFF_TICK' when order_type = 'LIMIT' and (limit_price < 100 or limit_price > 20000) then 'PRICE_OUT_OF_BAND'
 when seq % 37 = 0 then 'ORDER_RATE_LIMIT' when side = 'BUY' and seq % 31 = 0 then 'DAILY_LOSS_LIMIT' when qty * last > 600000 then 'NOTIONAL_LIMIT' when side = 'BUY' and (50 + qty) * last > 900000 then 'POSITION_LIMIT' when side = 'BUY' and qty * last + 10 > 400000 then 'INSUFFICIENT_CASH' when side = 'SELL' and qty > 50 then 'INSUFFICIENT_POSITION' end as reject from ci""",
)
def v4_pre_trade(spark, sf_dir):
    from tickloom.functions.scalars import tick_of

    s = F.col("seq")
    rows = _intents(spark, sf_dir).withColumns(
        {"kill_switch": s % 101 == 0, "submit_block_reason": F.when(s % 53 == 0, "x"), "unknown_pending": s % 47 == 0, "symbol_allowed": ~F.col("symbol").like("%77"), "halted": s % 43 == 0, "tick": F.when(s % 41 == 0, 3).otherwise(F.coalesce(tick_of(F.col("last")), F.lit(1))), "lower_limit": F.lit(100), "upper_limit": F.lit(20000), "orders_last_minute": F.when(s % 37 == 0, 9).otherwise(0), "realized_pnl_krw": F.when(s % 31 == 0, -1000).otherwise(0), "position_qty": F.lit(50), "open_buy_qty": F.lit(0), "open_sell_qty": F.lit(0), "est_commission_krw": F.lit(10), "orderable_cash_krw": F.lit(400000)}
    )
    return rows.select("seq", x.reject_code({"orders_per_minute": 5, "daily_loss": 1000, "order_notional": 600_000, "position_notional": 900_000}, F.col("last")).alias("reject"))


@register("x12_orders_in_minute", f"with {_INTENT} select seq, count(*) over (partition by symbol order by sec range between 60 preceding and current row) - 1 as n from ci")
def x12_orders_in_minute(spark, sf_dir):
    return x.orders_in_last_minute(_intents(spark, sf_dir), ["symbol"], "at").select("seq", F.col("orders_last_minute").alias("n"))


_LEVELS = "lv as (select vec_id, label, case when vec_id % 2 = 0 then 'BUY' else 'SELL' end as side, 40 + vec_id % 90 as qty, case when vec_id % 3 > 0 then case when vec_id % 2 = 0 then 1004 else 996 end end as lim, unnest(range(1, 11)) as i, embedding from embeddings), lq as (select vec_id, side, qty, lim, i, case when side = 'BUY' then 1000 + i else 1000 - i end as price, abs(cast(floor(embedding[i] * 100) as int)) as size from lv), ls as (select *, case when lim is not null and ((side = 'BUY' and price > lim) or (side = 'SELL' and price < lim)) then 0 else size end as s from lq), lt as (select *, greatest(0, least(s, qty - coalesce(sum(s) over (partition by vec_id order by i rows between unbounded preceding and 1 preceding), 0))) as take from ls)"


@register("x9_paper_fills", f"with {_LEVELS} select vec_id, cast(sum(take) as bigint) as filled, cast(sum(take * price) as bigint) as amount from lt group by vec_id")
def x9_paper_fills(spark, sf_dir):
    e, i = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    buy = i % 2 == 0
    levels = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda n: F.struct(F.when(buy, n + 1000).otherwise(-n + 1000).alias("price"), F.abs(F.floor(F.get("embedding", n - 1) * 100)).alias("size")))
    rows = e.select("vec_id", F.when(buy, "BUY").otherwise("SELL").alias("side"), (i % 90 + 40).alias("qty"), F.when(i % 3 > 0, F.when(buy, 1004).otherwise(996)).alias("limit_price"), levels.alias("levels"))
    return x.paper_fills(rows, ["vec_id"])


@register("x10_position_ledger")
def x10_position_ledger(spark, sf_dir):
    fills = counted_ticks(spark, sf_dir).select("symbol", "seq", F.when(F.col("seq") % 3 == 0, "SELL").otherwise("BUY").alias("side"), F.col("cvolume").alias("fill_qty"), (F.col("cvolume") * F.col("price")).alias("amount_krw"))
    return x.position_ledger(fills, 15, 18)


@register("x11_order_status", "with o as (select o_orderkey, 10 as ordered, o_orderkey % 13 as filled, case when o_orderkey % 4 = 0 then 0 else 10 - o_orderkey % 13 end as remaining, case when o_orderkey % 6 = 0 then 2 else 0 end as rejected, o_orderkey % 9 = 0 as cancelled from orders) select o_orderkey, case when filled > ordered then 'INVALID' when filled = ordered then 'FILLED' when (cancelled or rejected > 0 or remaining = 0) and filled = 0 and rejected > 0 and not cancelled then 'REJECTED' when cancelled or rejected > 0 or remaining = 0 then 'CANCELLED' when filled > 0 then 'PARTIALLY_FILLED' else 'ACCEPTED' end as status from o")
def x11_order_status(spark, sf_dir):
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(o, F.lit(10).alias("ordered_qty"), (o % 13).alias("filled_qty"), F.when(o % 4 == 0, 0).otherwise(10 - o % 13).alias("remaining_qty"), F.when(o % 6 == 0, 2).otherwise(0).alias("rejected_qty"), (o % 9 == 0).alias("cancelled"))
    return rows.select("o_orderkey", x.order_status().alias("status"))


_STATES = ["PENDING_SUBMIT", "UNKNOWN", "ACCEPTED", "PARTIALLY_FILLED", "FILLED", "CANCELLED", "REJECTED"]
_MOVES = ", ".join(f"('{a}', '{b}')" for a, bs in x.TRANSITIONS.items() for b in bs)


@register("x11_transitions", f"with {TICKS}, s as (select seq, {_STATES}[1 + cvolume % {len(_STATES)}] as b, {_STATES}[1 + (lag(cvolume) over (partition by symbol order by recv_wall_ns, seq)) % {len(_STATES)}] as a from ticks) select seq, a, b, a = b or (a, b) in (select (m1, m2) from (values {_MOVES}) m(m1, m2)) as allowed from s where a is not null")
def x11_transitions(spark, sf_dir):
    """Each tick's volume as a state of its symbol's order, against the one before."""
    state = F.get(F.array(*map(F.lit, _STATES)), (F.col("cvolume") % len(_STATES)).cast("int"))
    rows = ticks(spark, sf_dir).withColumn("b", state)
    moves = rows.withColumn("a", F.lag("b").over(Window.partitionBy("symbol").orderBy("recv_wall_ns", "seq"))).where("a is not null")
    return moves.select("seq", "a", "b", x.transition_allowed(F.col("a"), F.col("b")).alias("allowed"))


@register("j14_reconcile", "with a as (select l_suppkey as symbol, cast(sum(cast(l_quantity as bigint)) as bigint) as q from lineitem where l_linenumber < 7 group by 1), b as (select l_suppkey as symbol, cast(sum(cast(l_quantity as bigint)) as bigint) as q from lineitem where l_orderkey % 100 > 0 and l_suppkey % 5 > 0 group by 1) select coalesce(a.symbol, b.symbol) as symbol, coalesce(a.q, 0) as ledger_qty, coalesce(b.q, 0) as broker_qty from a full join b on a.symbol = b.symbol where coalesce(a.q, 0) <> coalesce(b.q, 0)")
def j14_reconcile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    book = lambda rows: rows.groupBy(F.col("l_suppkey").alias("symbol")).agg(F.sum("q").alias("qty"))
    return x.reconcile(book(li.where("l_linenumber < 7")), book(li.where("l_orderkey % 100 > 0 and l_suppkey % 5 > 0")))


_SESS = "sess as (select distinct cast(o_orderdate as date) as date from orders where dayofweek(o_orderdate) between 1 and 5 and day(o_orderdate) % 7 <> 3)"
_EXP = f"{_SESS}, sec as (select date, date_trunc('month', date)::date as m, date_trunc('month', date)::date + ((4 - dayofweek(date_trunc('month', date)) + 7) % 7)::int + 7 as th from sess), ex as (select m, max(date) as e from sec where date <= th group by m)"


def _sessions(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct().where("dayofweek(date) between 2 and 6 and day(date) % 7 <> 3")


@register("f11_calendar_tags", f"with {_EXP}, t as (select sess.date, e is not null as x from sess left join ex on ex.e = sess.date), l as (select *, lag(x) over (order by date) as bx, lag(date) over (order by date) as bd from t) select date, x as is_derivatives_expiry, x and month(date) in (3, 6, 9, 12) as is_quad_witching, coalesce(bx and month(date) in (6, 12) and month(bd) in (6, 12), false) as is_rebalance_effective from l")
def f11_calendar_tags(spark, sf_dir):
    return c.calendar_tags(_sessions(spark, sf_dir))


_TAX = ", ".join(f"(date '{d}', '{m}', {a + b})" for d, m, a, b in c.SELL_TAX)


@register("f12_sell_tax", f"with {_SESS}, st as (select date, lead(date, 2) over (order by date) as settles from sess), tr as (select o_orderkey, cast(o_orderdate as date) + 9496 as date0, cast(o_orderdate as date) as date, case o_orderkey % 3 when 0 then 'KOSPI' when 1 then 'KOSDAQ' else 'ETF' end as market from orders), tx as (select effective_from - 9496 as since, market, bps from (values {_TAX}) v(effective_from, market, bps)) select o_orderkey, settles, (select arg_max(bps, since) from tx where tx.market = tr.market and since <= settles) as total_bps from tr join st using (date)")
def f12_sell_tax(spark, sf_dir):
    trades = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.expr("case o_orderkey % 3 when 0 then 'KOSPI' when 1 then 'KOSDAQ' else 'ETF' end").alias("market"))
    schedule = c.sell_tax_schedule(spark).withColumn("effective_from", F.date_sub("effective_from", 9496))
    return c.sell_tax(trades, _sessions(spark, sf_dir), schedule).select("o_orderkey", "settles", "total_bps")


_JOBS = "jb as (select n_nationkey as job, n_nationkey * 100 as s, n_nationkey * 100 + n_regionkey * 700 + 350 as e, 60 + n_regionkey * 30 as ev, n_nationkey % 2 = 0 as inc from nation), jt as (select job, e, unnest(case when inc then range(s, e + 1, ev) else range(s, e, ev) end) as due from jb), jn as (select job, due, coalesce(lead(due) over (partition by job order by due), e) as na from jt)"


@register("f14_due_jobs", f"with {_JOBS} select job, due as due_s, na as not_after_s, case when due > 1500 then 'later' when na <= 1500 then 'expired' else 'due' end as state from jn")
def f14_due_jobs(spark, sf_dir):
    n, r = F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long")
    jobs = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("job"), (n * 100).alias("start_s"), (n * 100 + r * 700 + 350).alias("end_s"), (r * 30 + 60).alias("every_s"), (n % 2 == 0).alias("inclusive"))
    return c.due_jobs(jobs, 1500)


_HEALTH = f"{TICKS}, he as (select seq, vendor, 1000 as now, case when seq % 23 = 0 then null else 1000 - seq % 18 end as updated, seq % 29 = 0 as circuit, seq % 31 = 0 as rejected, seq % 19 <> 0 as running, seq % 13 <> 0 as connected, seq % 5 <> 0 as insession, case when seq % 11 <> 0 then 1000 - seq % 40 end as lastf, case when seq % 17 = 0 then 1000 - seq % 50 end as pend, (seq % 80) / 10.0::double as lag, case when vendor = 'ls' then 10 else 30 end as lim, case when seq % 3 = 0 then 990 else 100 end as openw, seq % 7 * 6 as a1, seq % 9 * 5 as a2 from ticks)"


@register("x5_source_status", f"with {_HEALTH} select seq, case when updated is null or now - updated > 15 then 'UNKNOWN' when circuit or rejected or not running then 'DEAD' when not connected then 'SILENT' when not insession then 'HEALTHY' when lastf is null and now - openw > 30 then 'SILENT' when now - lastf > lim then 'SILENT' when now - openw > 30 and now < 2000 and ((a1 > lim and a2 <= lim) or (a2 > lim and a1 <= lim)) then 'SILENT' when now - pend > 20 then 'LAGGING' when lag > 5.0 then 'LAGGING' else 'HEALTHY' end as status from he")
def x5_source_status(spark, sf_dir):
    s = F.col("seq")
    rows = ticks(spark, sf_dir).select("seq", "vendor", F.when(s % 23 != 0, 1000 - s % 18).alias("updated_s"), (s % 29 == 0).alias("circuit_open"), (s % 31 == 0).alias("auth_rejected"), (s % 19 != 0).alias("running"), (s % 13 != 0).alias("connected"), (s % 5 != 0).alias("in_session"), F.when(s % 11 != 0, 1000 - s % 40).alias("last_frame_s"), F.when(s % 17 == 0, 1000 - s % 50).alias("pending_since_s"), ((s % 80) / F.lit(10.0)).alias("lag_p50_s"), F.when(s % 3 == 0, 990).otherwise(100).alias("session_open_s"), F.lit(2000).alias("close_s"), F.array(s % 7 * 6, s % 9 * 5).alias("stream_ages_s"))
    return rows.select("seq", k.source_status(F.lit(1000)).alias("status"))


@register("x14_shard_verdicts", "with s as (select c_custkey as key, c_nationkey as venue, c_custkey % 7 > 0 as running, case when c_custkey % 3 = 0 then 900 - c_custkey % 400 when c_nationkey % 4 = 0 then 200 end as j, 100 + c_custkey % 300 as st, c_custkey % 4 as rs from customer), t as (select *, case when running then greatest(0, 1000 - greatest(150, coalesce(j, 150), st)) end as silent from s), u as (select *, coalesce(silent > 300, false) as stale, count(*) filter (running) over (partition by venue) as live, count(*) filter (coalesce(silent > 300, false)) over (partition by venue) as ns from t) select key, silent as silent_s, case when not running then 'not_running' when live >= 2 and ns = live then 'venue_wide_silence' when stale and rs >= 3 then 'budget_exhausted' when stale then 'stale' else 'ok' end as verdict from u")
def x14_shard_verdicts(spark, sf_dir):
    n = F.col("c_custkey")
    shards = table(spark, sf_dir, "customer").select(n.alias("key"), F.col("c_nationkey").alias("venue"), (n % 7 > 0).alias("running"), F.when(n % 3 == 0, 900 - n % 400).when(F.col("c_nationkey") % 4 == 0, 200).alias("last_journal_s"), (n % 300 + 100).alias("started_s"), (n % 4).alias("restarts"))
    return k.shard_verdicts(shards, 1000, 150, 300, 3).select("key", "silent_s", "verdict")


@register("x15_resolve_venues", f"with {TICKS} select seq, conn_id = first_value(conn_id) over (partition by symbol order by seq) as admitted from ticks")
def x15_resolve_venues(spark, sf_dir):
    return k.resolve_venues(ticks(spark, sf_dir).select("seq", F.col("symbol").alias("feed"), F.col("conn_id").alias("venue"))).select("seq", "admitted")


@register("x2_lag_alerts", f"with {TICKS}, w as (select vendor as stream, dt as start, count(*) as samples, quantile_cont((seq % 97) / 10.0::double, 0.5) as p50 from ticks group by all), m as (select *, case when samples >= 60 then case when p50 > 5.0 then true when p50 <= 4.6 then false end end as mk from w) select stream, start, samples, coalesce(last_value(mk ignore nulls) over (partition by stream order by start rows unbounded preceding), false) as alerted from m".replace("p50 <= 4.6", "p50 <= 2.5"))
def x2_lag_alerts(spark, sf_dir):
    windows = ticks(spark, sf_dir).groupBy(F.col("vendor").alias("stream"), F.col("dt").alias("start")).agg(F.count("*").alias("samples"), F.percentile((F.col("seq") % 97) / F.lit(10.0), F.lit(0.5)).alias("p50_s"))
    return k.lag_alerts(windows, 5.0, 60).select("stream", "start", "samples", "alerted")


@register("x3_outages", f"with {TICKS}, l as (select symbol, recv_wall_ns as gap_end, lag(recv_wall_ns) over (partition by symbol order by recv_wall_ns) as gap_start from ticks) select symbol, gap_start, gap_end from l where gap_end - gap_start > 86400000000000")
def x3_outages(spark, sf_dir):
    return k.outage_gaps(ticks(spark, sf_dir), ["symbol"], "recv_wall_ns", 86_400_000_000_000)


def controller_steps(spark, sf_dir):
    status = first_case([(F.col("cvolume") < 15, F.lit("SILENT")), (F.col("cvolume") < 20, F.lit("DEAD")), (F.col("cvolume") < 25, F.lit("UNKNOWN"))], "HEALTHY")
    return ticks(spark, sf_dir).select(F.col("vendor").alias("group_id"), div(F.col("recv_wall_ns"), 1_000_000_000).alias("step_s"), status.alias("status")).dropDuplicates(["group_id", "step_s"])


@register("x6_controller")
def x6_controller(spark, sf_dir):
    return k.run_controller(controller_steps(spark, sf_dir))


#: Days are steps, vendors groups of the symbols they trade, of two feeds with few free pairs; a symbol needs two pairs.
_ADMIT = f"""{TICKS}, mb as (select dt as step, vendor as group_id, symbol, min(seq) as place from ticks group by all), pr as (select *, case group_id when 'ls' then 1 when 'kis' then 2 when 'db' then 2 else 3 end as priority from mb),
c as (select step, 6 + 2 * (row_number() over (order by step) % 5) as a, 4 + 2 * (row_number() over (order by step) % 3) as b, row_number() over (order by step) % 4 <> 0 as up from (select distinct step from mb)),
fa as (select *, row_number() over (partition by step order by priority, group_id, place, symbol) as r from pr where symbol::bigint % 5 <> 0), ga as (select step, 'f1' as feed, group_id, symbol from fa join c using (step) where up and 2 * r <= a),
fb as (select *, row_number() over (partition by step order by priority, group_id, place, symbol) as r from pr where group_id <> 'toss' and (step, group_id, symbol) not in (select (step, group_id, symbol) from ga)), gb as (select step, 'f2' as feed, group_id, symbol from fb join c using (step) where 2 * r <= b)"""


@register("x6_admission", f"with {_ADMIT} select * from ga union all select * from gb")
def x6_admission(spark, sf_dir):
    rows = ticks(spark, sf_dir).groupBy(F.col("dt").alias("step"), F.col("vendor").alias("group_id"), "symbol").agg(F.min("seq").alias("place"))
    group = F.col("group_id")
    members = rows.withColumns({"priority": F.when(group == "ls", 1).when(group.isin("kis", "db"), 2).otherwise(3), "width": F.lit(2), "secondaries": F.when(group == "toss", F.array(F.lit("f1"))).otherwise(F.array(F.lit("f1"), F.lit("f2")))})
    day = F.row_number().over(Window.orderBy("step"))
    held = rows.where("cast(symbol as long) % 5 = 0").groupBy("step").agg(F.collect_set("symbol").alias("held"))
    days = rows.select("step").distinct().withColumn("k", day)
    one = days.select("step", F.lit("f1").alias("feed"), (6 + 2 * (F.col("k") % 5)).alias("free"), (F.col("k") % 4 != 0).alias("healthy")).join(held, "step", "left")
    two = days.select("step", F.lit("f2").alias("feed"), (4 + 2 * (F.col("k") % 3)).alias("free"), F.lit(True).alias("healthy"), F.lit(None).cast("array<string>").alias("held"))
    return admit(members, one.unionByName(two), ["f1", "f2"])
