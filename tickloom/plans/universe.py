"""Queries of the universe: features, events, core, follow-up, tiers, snapshots, admissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import universe as u
from tickloom.plans.registry import BARS, register
from tickloom.sources.adapters import daily_bars

SECTION = "case when symbol like '%3' then '관리종목(소속부없음)' when symbol like '%7' then 'SPAC(소속부없음)' end"
KIND = "case when symbol like '%5' and day(date) % 2 = 0 then '우선주' when symbol like '%1' then '보통주' end"


def bars(spark, sf_dir) -> DataFrame:
    return daily_bars(spark, sf_dir).withColumns({"section": F.expr(SECTION), "stock_cert_kind": F.expr(KIND)})


FEATURES = f"""{BARS}, cb as (select *, {SECTION} as section0, {KIND} as kind0 from bars where volume > 0 and close > 0 and abs(daily_change_pct) <= 31.0),
c1 as (select *, last_value(section0 ignore nulls) over o as section, last_value(kind0 ignore nulls) over o as stock_cert_kind,
  case when count(*) over m = 20 then quantile_cont(trade_value_100m, 0.5) over m end as tv_median_20, lag(close) over (partition by symbol order by date) as before from cb
  window o as (partition by symbol order by date rows between unbounded preceding and current row), m as (partition by symbol order by date rows between 19 preceding and current row)),
c2 as (select *, case when before > 0 then base_price / before else 1.0 end as ratio from c1),
c3 as (select *, product(ratio) over (partition by symbol order by date rows between unbounded preceding and current row) as moved from c2),
c4 as (select *, close / moved as norm from c3),
featured as (select symbol, date, close, volume, trade_value_100m, daily_change_pct, section, stock_cert_kind, tv_median_20, trade_value_100m / nullif(tv_median_20, 0) as tv_ratio,
  case when count(*) over b = 59 then greatest(moved * max(norm) over b, close) end as close_max_60, case when count(*) over b = 59 then least(moved * min(norm) over b, close) end as close_min_60 from c4
  window b as (partition by symbol order by date rows between 59 preceding and 1 preceding)),
okc as (select * from featured where (stock_cert_kind is null or stock_cert_kind = '보통주') and (section is null or section not in ('관리종목(소속부없음)', 'SPAC(소속부없음)', '투자주의환기종목(소속부없음)'))),
ev0 as (select *, list_filter([case when daily_change_pct >= 29 then 'limit_up' end, case when daily_change_pct >= 10 then 'surge10' end, case when tv_ratio >= 5 and daily_change_pct >= 5 then 'volsurge' end, case when close >= close_max_60 and daily_change_pct >= 5 then 'newhigh60' end,
  case when daily_change_pct <= -29 then 'limit_down' end, case when daily_change_pct <= -10 then 'plunge10' end, case when tv_ratio >= 5 and daily_change_pct <= -5 then 'volsurge_down' end, case when close <= close_min_60 and daily_change_pct <= -5 then 'newlow60' end], lambda x: x is not null) as why from okc),
ev as (select *, case when daily_change_pct > 0 then 'up' else 'down' end as direction from ev0 where len(why) > 0 and trade_value_100m >= {{floor}})"""
#: The adapter's values are far below the policy's floor, so the queries use one of their own.
FLOOR = 0.02


def _sql(body: str) -> str:
    return f"with {FEATURES.format(floor=FLOOR)} {body}"


def _featured(spark, sf_dir) -> DataFrame:
    return u.selection_features(bars(spark, sf_dir))


def _whole(name: str, scale: int = 1000):
    return F.floor(F.col(name) * scale + 0.5).cast("long").alias(name)


def _whole_sql(name: str, scale: int = 1000) -> str:
    return f"cast(floor({name} * {scale} + 0.5) as bigint) as {name}"


@register("f1_selection_features", _sql(f"select symbol, date, section, stock_cert_kind, {_whole_sql('tv_median_20', 1000000)}, {_whole_sql('close_max_60')}, {_whole_sql('close_min_60')}, {_whole_sql('tv_ratio')} from featured"))
def f1_selection_features(spark, sf_dir):
    return _featured(spark, sf_dir).select("symbol", "date", "section", "stock_cert_kind", _whole("tv_median_20", 1_000_000), _whole("close_max_60"), _whole("close_min_60"), _whole("tv_ratio"))


_ACTION = """c as (select *, round(daily_change_pct, 2) as pct from bars where abs(daily_change_pct) <= 31), i as (select symbol, date, close, close / (1.0 + daily_change_pct / 100.0) as implied, lag(close) over (partition by symbol order by date) as before from c),
r as (select *, case when before is null then 1.0 when abs(implied / before - 1.0) <= 0.005 then 1.0 else implied / before end as ratio from i),
m as (select *, product(ratio) over (partition by symbol order by date rows between unbounded preceding and current row) as moved from r)"""


@register("f2_implied_base", f"with {BARS}, {_ACTION} select symbol, date, case when count(*) over b = 59 then cast(floor(greatest(moved * max(close / moved) over b, close) * 100 + 0.5) as bigint) end as close_max_60 from m window b as (partition by symbol order by date rows between 59 preceding and 1 preceding)")
def f2_implied_base(spark, sf_dir):
    return u.selection_features(daily_bars(spark, sf_dir).drop("base_price")).select("symbol", "date", _whole("close_max_60", 100))


@register("f3_events", _sql("select symbol, date, why as selection_reasons, direction from ev"))
def f3_events(spark, sf_dir):
    return u.event_rows(_featured(spark, sf_dir), liquidity=FLOOR).select("symbol", "date", "selection_reasons", "direction")


@register("t1_select_universe", _sql("select symbol, date, cast(row_number() over (partition by date order by trade_value_100m desc, symbol) as int) as priority, row_number() over (partition by date order by trade_value_100m desc, symbol) <= 3 as selected, direction from ev"))
def t1_select_universe(spark, sf_dir):
    return u.select_universe(_featured(spark, sf_dir), 3, liquidity=FLOOR).select("symbol", "date", "priority", "selected", "direction")


_DAYS = "days as (select date, row_number() over (order by date) as day from (select distinct date from featured))"
_CORE = f"""{_DAYS}, rk as (select okc.date, symbol, day, row_number() over (partition by okc.date order by tv_median_20 desc, symbol) as core_rank from okc join days using (date) where tv_median_20 is not null),
gd as (select *, day - row_number() over (partition by symbol order by day) as run from rk where core_rank <= 8),
core as (select date, symbol, core_rank from (select *, max(case when core_rank <= 4 then day end) over (partition by symbol, run order by day) as entered from gd) where entered > day - 20)"""
_FOLLOW = """ft as (select okc.date, okc.symbol, day, ev.direction from okc join days using (date) left join ev on ev.date = okc.date and ev.symbol = okc.symbol),
fo as (select date, symbol, day - max(case when direction is not null then day end) over w as follow_age, last_value(direction ignore nulls) over w as direction from ft window w as (partition by symbol order by day rows between unbounded preceding and 1 preceding)),
follow as (select * from fo where follow_age <= 5)"""


@register("f4_core_panel", _sql(f", {_CORE} select date, symbol, cast(core_rank as int) as core_rank from core"))
def f4_core_panel(spark, sf_dir):
    return u.core_panel(_featured(spark, sf_dir), 4, 8, 20)


@register("f5_follow_up", _sql(f", {_DAYS}, {_FOLLOW} select date, symbol, follow_age, direction from follow"))
def f5_follow_up(spark, sf_dir):
    return u.follow_up(_featured(spark, sf_dir), 5, liquidity=FLOOR)


_TIERS = f""", {_CORE}, {_FOLLOW}, al as (select * from core full join (select date, symbol, why, direction as ed from ev) using (date, symbol) full join (select date, symbol, follow_age, direction as fd from follow) using (date, symbol) left join (select date, symbol, trade_value_100m from featured) using (date, symbol)),
ti as (select *, case when core_rank is not null then 'core' when why is not null then 'event' else 'follow' end as tier from al),
pr as (select *, row_number() over (partition by date order by case tier when 'core' then 0 when 'event' then 1 else 2 end, core_rank, case when tier = 'follow' then follow_age else 0 end, case when tier <> 'core' then trade_value_100m else 0 end desc, symbol) as priority from ti)
select date, symbol, tier, cast(core_rank as int) as core_rank, coalesce(ed, fd) as direction, cast(priority as int) as priority, priority <= 5 as selected,
  list_concat(list_concat(coalesce(why, []), case when tier = 'core' then ['core'] else [] end), case when follow_age is not null and (why is not null or core_rank is null) then ['follow:' || follow_age::varchar] else [] end) as selection_reasons from pr"""


@register("t2_tiers", _sql(_TIERS))
def t2_tiers(spark, sf_dir):
    return u.select_tiers(_featured(spark, sf_dir), 5, 4, 8, 20, 5, liquidity=FLOOR).select("date", "symbol", "tier", "core_rank", "direction", "priority", "selected", "selection_reasons")


@register("f7_replay", _sql(f"{_TIERS.replace('select date, symbol, tier', ', res as (select date, symbol, tier')}) select date, count(*) as n, count(*) filter (selected) as kept, count(*) filter (tier = 'core') as core, date < (select min(date) from featured) + interval 60 day as short_warmup from res group by date"))
def f7_replay(spark, sf_dir):
    featured = _featured(spark, sf_dir)
    start = featured.agg(F.min("date").alias("start"))
    days = u.select_tiers(featured, 5, 4, 8, 20, 5, liquidity=FLOOR).groupBy("date").agg(F.count("*").alias("n"), F.count_if("selected").alias("kept"), F.count_if(F.col("tier") == "core").alias("core"))
    return days.join(F.broadcast(start)).select("date", "n", "kept", "core", (F.col("date") < F.date_add("start", 60)).alias("short_warmup"))


@register("a16_ineligible_symbols", f"with {BARS}, c as (select symbol, date, {SECTION} as section, {KIND} as kind from bars), l as (select symbol, arg_max(kind, date) filter (kind is not null) as kind, arg_max(section, date) filter (section is not null) as section from c group by 1) select symbol from l where kind <> '보통주' or section in ('관리종목(소속부없음)', 'SPAC(소속부없음)', '투자주의환기종목(소속부없음)')")
def a16_ineligible_symbols(spark, sf_dir):
    return u.ineligible_symbols(bars(spark, sf_dir))


@register("a15_listing_context", f"with {BARS} select symbol, min(date) as first_date, case when min(date) = date '1995-06-01' and (select min(date) from bars) < date '1995-06-01' then 'listed_today' when min(date) < date '1995-06-01' then 'established' else 'unknown' end as status from bars group by 1")
def a15_listing_context(spark, sf_dir):
    return u.listing_context(daily_bars(spark, sf_dir), F.to_date(F.lit("1995-06-01")))


_AMOUNT = "a as (select date, symbol, row_number() over (partition by date order by trade_value_100m desc, symbol) as rank, trade_value_100m as trade_value, daily_change_pct as change_pct from bars), ta as (select * from a where rank <= 6), fl as (select * from (select date, symbol, row_number() over (partition by date order by change_pct desc, symbol) as rank, trade_value, change_pct from a) where rank <= 6)"


@register("t3_ranking_snapshot", f"with {BARS}, {_AMOUNT}, m as (select coalesce(ta.date, fl.date) as date, coalesce(ta.symbol, fl.symbol) as symbol, ta.rank as ta_rank, fl.rank as fl_rank, coalesce(fl.change_pct, ta.change_pct) as change_pct from ta full join fl on ta.date = fl.date and ta.symbol = fl.symbol), o as (select *, row_number() over (partition by date order by case when change_pct >= 29 then 0 else 1 end, ta_rank nulls last, fl_rank nulls last, symbol) as position from m) select date, symbol, cast(position as int) as position, cast(ta_rank as int) as ta_rank, cast(fl_rank as int) as fl_rank, list_filter([case when change_pct >= 29 then 'limit_up' end, case when ta_rank is not null then 'trade_amount' end, case when fl_rank is not null then 'fluctuation' end], lambda x: x is not null) as selection_reasons from o where position <= 8")
def t3_ranking_snapshot(spark, sf_dir):
    from pyspark.sql import Window

    rows = daily_bars(spark, sf_dir).select("date", "symbol", F.col("trade_value_100m").alias("trade_value"), F.col("daily_change_pct").alias("change_pct"))
    top = lambda c: rows.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(F.col(c).desc(), "symbol"))).where("rank <= 6")
    return u.ranking_snapshot(top("trade_value"), top("change_pct"), 8, ("date",)).select("date", "symbol", "position", "ta_rank", "fl_rank", "selection_reasons")


@register("t4_best_by_value", "with r as (select o_orderstatus as market, lpad((o_custkey % 500)::varchar, 6, '0') as symbol, cast(round(o_totalprice * 100) as bigint) as trade_value, o_orderkey as seq from orders), b as (select *, row_number() over (partition by market, symbol order by trade_value desc, seq) as n from r), c as (select market, symbol, trade_value, row_number() over (partition by market order by trade_value desc, symbol) as position from b where n = 1) select market, symbol, trade_value, cast(position as int) as position from c where position <= 40")
def t4_best_by_value(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderstatus").alias("market"), F.lpad((F.col("o_custkey") % 500).cast("string"), 6, "0").alias("symbol"), F.round(F.col("o_totalprice") * 100).cast("long").alias("trade_value"), F.col("o_orderkey").alias("seq"))
    return u.best_by_value(rows, 40, ("market",)).select("market", "symbol", "trade_value", "position")


@register("t5_admissions", f"with {BARS}, q as (select date, symbol, trade_value_100m, daily_change_pct, symbol like '%3' as ineligible from bars where abs(daily_change_pct) >= 5 and trade_value_100m >= 0.02), n as (select *, row_number() over (partition by date, ineligible order by trade_value_100m desc, symbol) as k from q) select date, symbol, case when not ineligible then case when k <= 2 then 'ls' when k <= 5 then 'kis' end end as feed, case when ineligible then 'ineligible' when k > 5 then 'capacity' else 'admitted' end as status, case when daily_change_pct > 0 then 'up' else 'down' end as direction from n")
def t5_admissions(spark, sf_dir):
    rows = daily_bars(spark, sf_dir).select("date", "symbol", F.col("trade_value_100m").alias("trade_value"), F.col("daily_change_pct").alias("change_pct"), F.col("symbol").like("%3").alias("ineligible"))
    return u.admissions(rows, [("ls", 2), ("kis", 3)], 5.0, 0.02, ("date",)).select("date", "symbol", "feed", "status", "direction")


@register("p12_qualifies", f"with {BARS} select date, symbol from bars where abs(daily_change_pct) >= 12.5 and trade_value_100m >= 0.05")
def p12_qualifies(spark, sf_dir):
    return daily_bars(spark, sf_dir).where((F.abs("daily_change_pct") >= 12.5) & (F.col("trade_value_100m") >= 0.05)).select("date", "symbol")


@register("t6_shards", "with p as (select c_nationkey as nation, c_custkey as seq, c_custkey % 3 as tier, row_number() over (partition by c_nationkey order by c_custkey % 3, c_custkey) - 1 as n from customer) select nation, seq, case when n < 4 * 10 - 3 then n // 10 end as shard from p")
def t6_shards(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("seq"), (F.col("c_custkey") % 3).alias("tier"))
    return u.shard_blocks(rows, 10, 4, 3, keys=("nation",)).select("nation", "seq", "shard")


@register("p14_security_status", "with s as (select p_partkey, p_partkey % 5 = 0 as m, p_partkey % 7 = 0 as h, p_partkey % 11 = 0 as l, p_partkey % 13 = 0 as so, case when p_partkey % 6 = 0 then '57' end as sc, p_partkey % 4 <> 0 as ca, '0' || (p_partkey % 5)::varchar as w from part) select p_partkey, m or h or l or so as exclude, case w when '00' then 'none' when '01' then 'caution' when '02' then 'warning' when '03' then 'risk' else 'unknown' end as warning_level, list_sort(list_filter([case when m then 'managed' end, case when h then 'halted' end, case when l then 'liquidation' end, case when so then 'short_overheated' end, case when sc = '57' then 'margin_100' end, case when not ca then 'credit_unavailable' end], lambda x: x is not null)) as flags from s")
def p14_security_status(spark, sf_dir):
    k = F.col("p_partkey")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(k, (k % 5 == 0).alias("managed"), (k % 7 == 0).alias("trading_halted"), (k % 11 == 0).alias("liquidation_trading"), (k % 13 == 0).alias("short_overheated"), F.when(k % 6 == 0, "57").alias("status_code"), (k % 4 != 0).alias("credit_available"), F.concat(F.lit("0"), (k % 5).cast("string")).alias("market_warning_code"))
    return u.classify_status(rows).select("p_partkey", "exclude", "warning_level", "flags")
