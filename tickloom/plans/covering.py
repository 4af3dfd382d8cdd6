"""Queries of coverage, allocation, probe statistics and the remaining aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import seconds_of
from tickloom.operators import coverage as c
from tickloom.operators import universe as u
from tickloom.plans.registry import BARS, COUNTED, TICKS, register, table
from tickloom.sources.adapters import counted_ticks, daily_bars, ticks

#: Stored rows: all bars but every fifth day and one symbol's.
_ST = f"{BARS}, st as (select symbol, date from bars where day(date) % 5 <> 0 and symbol not like '%8'), cv as (select symbol, min(date) as first_date, max(date) as last_date from st group by 1)"


def _bars(spark, sf_dir):
    return daily_bars(spark, sf_dir).select("symbol", "date")


def _stored(spark, sf_dir):
    return _bars(spark, sf_dir).where("day(date) % 5 <> 0 and symbol not like '%8'")


@register("a17_coverage", f"with {_ST} select * from cv")
def a17_coverage(spark, sf_dir):
    return c.date_coverage(_stored(spark, sf_dir))


@register("a17_needing_backfill", f"with {_ST} select distinct symbol from bars where symbol not in (select symbol from cv where first_date <= date '1995-03-01')")
def a17_needing_backfill(spark, sf_dir):
    return c.needing_backfill(_bars(spark, sf_dir).select("symbol").distinct(), c.date_coverage(_stored(spark, sf_dir)), F.to_date(F.lit("1995-03-01")))


_GAPS = f"{_ST}, rc as (select date from (select distinct date from bars) order by date desc limit 200), ga as (select b.symbol, b.date from bars b join rc using (date) join cv using (symbol) where b.date >= first_date except select symbol, date from st)"


@register("a18_expected_gaps", f"with {_GAPS} select symbol, list_sort(list(date)) as missing from ga group by symbol")
def a18_expected_gaps(spark, sf_dir):
    stored = _stored(spark, sf_dir)
    return c.expected_gaps(_bars(spark, sf_dir), c.date_coverage(stored), stored, 200)


@register("j3_expected_pairs", f"with {_ST} select b.symbol, b.date from bars b join cv using (symbol) where b.date >= first_date")
def j3_expected_pairs(spark, sf_dir):
    return _bars(spark, sf_dir).join(c.date_coverage(_stored(spark, sf_dir)), "symbol").where("date >= first_date").select("symbol", "date")


@register("a19_accepted_empty", f"with {_ST} select symbol, date from (select symbol, date, count(*) over (partition by date) as n from bars where day(date) % 5 = 0) where n <= 0.2 * 100")
def a19_accepted_empty(spark, sf_dir):
    return c.accepted_empty(_bars(spark, sf_dir).where("day(date) % 5 = 0"), 100, 0.2)


@register("a29_fetch_floors", f"with {_GAPS}, a as (select symbol, max(date) as last_date from st group by 1), b as (select symbol, min(date) as gap_floor from ga group by 1), k as (select distinct symbol, date '2001-01-01' as floor from bars where symbol like '%1') select symbol, least((last_date + interval 1 day)::date, gap_floor, floor) as fetch_from, coalesce(last_date < date '2001-06-01', true) as stale from a full join b using (symbol) full join k using (symbol)")
def a29_fetch_floors(spark, sf_dir):
    stored = _stored(spark, sf_dir)
    gaps = c.expected_gaps(_bars(spark, sf_dir), c.date_coverage(stored), stored, 200).select("symbol", F.explode("missing").alias("date"))
    candidates = _bars(spark, sf_dir).where("symbol like '%1'").select("symbol").distinct().withColumn("floor", F.to_date(F.lit("2001-01-01")))
    return c.fetch_floors(stored, gaps, candidates, F.to_date(F.lit("2001-06-01")))


_UN = f"{TICKS}, pe as (select distinct symbol, dt::date as day, vendor from ticks where lost or vendor = 'ls'), ta as (select symbol, dt::date as day, count(*) as attempts from ticks where lost group by all)"


@register("a30_repair_units", f"with {_UN}, t as (select day, vendor, max(coalesce(attempts, 0)) as attempts from pe left join ta using (symbol, day) group by all) select day, vendor, attempts, date_diff('day', day, date '2024-01-20') > 7 as overdue, attempts >= 3 as exhausted from t")
def a30_repair_units(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("day", F.to_date("dt"))
    attempts = t.where("lost").groupBy("symbol", "day").agg(F.count("*").alias("attempts"))
    return c.repair_units(t.where("lost or vendor = 'ls'").select("symbol", "day", "vendor").distinct(), attempts, F.to_date(F.lit("2024-01-20")), 7, 3)


_ARM = "pr as (select c_nationkey as shard, c_custkey as pair from customer), ac as (select c_nationkey as shard, c_custkey as pair, 500 + c_custkey % 300 as ack_s from customer where c_custkey % 40 > 0 or c_nationkey % 3 > 0), op as (select n_nationkey as shard, 780 as open_s, 400 + n_nationkey * 20 as started_s from nation)"


@register("a31_prearm", f"with {_ARM}, s as (select shard, max(a) as armed_s, count(*) as pairs, count(*) filter (a is null) as un from (select pr.shard, pr.pair, min(ack_s) as a from pr left join ac using (shard, pair) group by all) group by 1) select op.shard, armed_s, coalesce(un, 0) as unacked, case when pairs is null or un > 0 then 'UNVERIFIABLE' when started_s > open_s then 'LATE_START' when armed_s > open_s then 'LATE_ACK' else 'ARMED' end as status from op left join s using (shard)")
def a31_prearm(spark, sf_dir):
    cu = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("shard"), F.col("c_custkey").alias("pair"))
    acks = cu.where("pair % 40 > 0 or shard % 3 > 0").withColumn("ack_s", F.col("pair") % 300 + 500)
    opens = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("shard"), F.lit(780).alias("open_s"), (F.col("n_nationkey") * 20 + 400).alias("started_s"))
    return c.prearm_status(cu, acks, opens)


def _manifests(spark, sf_dir):
    one = ticks(spark, sf_dir).groupBy("dt", "symbol", "vendor").agg(F.count("*").alias("n"))
    streams = one.groupBy("dt", "symbol").agg(F.map_from_entries(F.collect_list(F.struct("vendor", "n"))).alias("m"))
    return streams.groupBy("dt").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "m"))).alias("frame_counts"))


@register("a27_frame_counts", f"with {TICKS} select symbol, vendor as stream, count(*) as frames from ticks group by all")
def a27_frame_counts(spark, sf_dir):
    return c.frame_counts(_manifests(spark, sf_dir))


@register("a26_silent_symbols", f"with {TICKS} select lpad(c_custkey::varchar, 6, '0') as symbol from customer where lpad(c_custkey::varchar, 6, '0') not in (select symbol from ticks)")
def a26_silent_symbols(spark, sf_dir):
    accepted = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("symbol"))
    return c.silent_symbols(accepted, c.frame_counts(_manifests(spark, sf_dir)))


@register("a28_controller_counts", f"with {TICKS} select vendor, count(*) filter (conn_id = 'c0') as c0, count(*) filter (conn_id = 'c1') as c1 from ticks group by vendor")
def a28_controller_counts(spark, sf_dir):
    return c.controller_counts(ticks(spark, sf_dir).withColumn("event", F.col("conn_id")), ["c0", "c1"])


_SEC = "(cast(substr(hms, 1, 2) as int) * 3600 + cast(substr(hms, 3, 2) as int) * 60 + cast(substr(hms, 5, 2) as int))"


@register("a24_lag_stats", f"with {TICKS} select dt, vendor, quantile_disc(cvolume / 4.0::double, 0.5) as p50_s, quantile_disc(cvolume / 4.0::double, 0.99) as p99_s, cast(max({_SEC}) - min({_SEC}) + 1 - count(distinct {_SEC}) as bigint) as hole_seconds from ticks group by all")
def a24_lag_stats(spark, sf_dir):
    return c.lag_stats(ticks(spark, sf_dir).withColumns({"lag_s": F.col("cvolume") / F.lit(4.0), "second": seconds_of(F.col("hms"))}), ["dt", "vendor"])


@register("a25_rate_stats", f"with {TICKS}, w as (select vendor, recv_wall_ns, count(*) over (partition by vendor order by recv_wall_ns range between 3599999999999 preceding and current row) as n from ticks) select vendor, max(n) as peak, count(*) as frames, count(*) / ((max(recv_wall_ns) - min(recv_wall_ns)) / 1e9) as mean_rate from w group by vendor")
def a25_rate_stats(spark, sf_dir):
    return c.rate_stats(ticks(spark, sf_dir), ["vendor"], 3_600_000_000_000)


@register("a23_book_completeness", "with b as (select label, list_filter(list_transform(embedding[1:10], lambda x: cast(floor(x * 1000) as int)), lambda x: x > 0) as a, list_filter(list_transform(embedding[11:20], lambda x: cast(floor(x * 1000) as int)), lambda x: x > 0) as b from embeddings), f as (select label, len(a) + len(b) as n, coalesce(b[1] >= a[1], false) as crossed, len(list_filter(range(1, len(a)), lambda i: a[i] >= a[i + 1])) > 0 or len(list_filter(range(1, len(b)), lambda i: b[i] <= b[i + 1])) > 0 as messy from b) select label, count(*) as books, cast(sum(n) as bigint) as levels, count(*) filter (crossed) as crossed, count(*) filter (messy) as non_monotone, sum(n) / (count(*) * 20)::double as completeness from f group by label")
def a23_book_completeness(spark, sf_dir):
    cut = lambda lo: F.transform(F.slice("embedding", lo, 10), lambda x: F.floor(x * 1000).cast("int"))
    return c.book_completeness(table(spark, sf_dir, "embeddings").select("label", cut(1).alias("asks"), cut(11).alias("bids")), ["label"], 10)


@register("a32_gates", f"with {TICKS}, g as (select dt, 'frames' as name, count(*) >= 320 as passed from ticks group by dt union all select dt, 'vendors', count(distinct vendor) = 5 from ticks group by dt union all select dt, 'lost', count(*) filter (lost) < 75 from ticks group by dt) select dt, bool_and(passed) as passed, list_sort(coalesce(list(name) filter (not passed), [])) as failed from g group by dt")
def a32_gates(spark, sf_dir):
    days = ticks(spark, sf_dir).groupBy("dt").agg((F.count("*") >= 320).alias("frames"), (F.countDistinct("vendor") == 5).alias("vendors"), (F.count_if("lost") < 75).alias("lost"))
    return c.gates(days.unpivot("dt", ["frames", "vendors", "lost"], "name", "passed"), ["dt"])


@register("a33_latest_trade", f"with {COUNTED} select symbol, arg_max(price, seq) as buy, arg_max(cvolume, seq) as sell, arg_max(price - cvolume, seq) as net from counted group by symbol")
def a33_latest_trade(spark, sf_dir):
    rows = counted_ticks(spark, sf_dir).select("symbol", "seq", F.col("price").alias("buy"), F.col("cvolume").alias("sell"), (F.col("price") - F.col("cvolume")).alias("net"))
    return c.latest_trade(rows, ["symbol"], "seq").drop("seq")


@register("x13_certified_days", f"with {TICKS}, d as (select symbol, dt as day, count(*) as rows from ticks group by all) select *, min(day) over (partition by symbol) < day as complete from d")
def x13_certified_days(spark, sf_dir):
    return c.certified_days(ticks(spark, sf_dir).select("symbol", F.col("dt").alias("day")), ["symbol"])


_TARGETS = f"{BARS}, un as (select symbol, date from bars where date >= date '2000-01-01'), dn as (select symbol, date from bars where volume % 2 = 0), em as (select symbol, date from bars where volume % 7 = 0), rp as (select symbol, date from bars where volume % 6 = 0), co as (select symbol, count(*) as cost from bars group by 1)"


@register("f9_plan_targets", f"with {_TARGETS}, o as (select symbol, date from un except select symbol, date from em), m as (select o.*, (symbol, date) in (select (symbol, date) from rp) as repair, (symbol, date) in (select (symbol, date) from dn) as done from o) select symbol, date, repair, cast(row_number() over (partition by date order by repair desc, cost, symbol) as int) as place from m join co using (symbol) where repair or not done")
def f9_plan_targets(spark, sf_dir):
    b = daily_bars(spark, sf_dir)
    cost = b.groupBy("symbol").agg(F.count("*").alias("cost"))
    return c.plan_targets(b.where("date >= date'2000-01-01'"), b.where("volume % 2 = 0"), b.where("volume % 7 = 0"), b.where("volume % 6 = 0"), cost)


@register("f10_session_targets", f"with {BARS}, s as (select date, lag(date) over (order by date) as before from (select distinct date from bars)) select s.date, b.symbol from s join bars b on b.date = s.before")
def f10_session_targets(spark, sf_dir):
    return c.previous_session_targets(_bars(spark, sf_dir), _bars(spark, sf_dir))


@register("f15_membership", f"with {BARS}, l as (select symbol, arg_max(trade_value_100m, date) as v, row_number() over (order by symbol) - 1 as n from bars group by 1), s as (select symbol, v, case when n < 60 then n // 20 end as shard from l where symbol not like '%9' union all select symbol, v, null from l where symbol like '%9') select symbol, case when shard = 0 then 'A' when shard is not null then 'B' else 'C' end as tier, shard, cast(round_even(v * 1e8, 0) as bigint) as trade_value_krw from s")
def f15_membership(spark, sf_dir):
    last = daily_bars(spark, sf_dir).groupBy("symbol").agg(F.max_by("trade_value_100m", "date").alias("trade_value_100m"))
    numbered = last.withColumn("_n", F.row_number().over(Window.orderBy("symbol")) - 1)
    shards = numbered.where("symbol not like '%9'").select("symbol", F.when(F.col("_n") < 60, F.floor(F.col("_n") / 20)).cast("long").alias("shard"))
    return c.membership_tiers(shards, last.where("symbol like '%9'"), last)


@register("t7_common_cap", "with v as (select n_regionkey as venue, count(*) as symbols from customer join nation on c_nationkey = n_nationkey group by 1), k as (select cap, sum(ceil(least(symbols, cap) / 40.0)) as n from v, (select unnest(range(1, 1001)) as cap) group by cap), b as (select max(cap) as cap from k where n <= 20) select venue, cap, cast(ceil(least(symbols, cap) / 40.0) as bigint) as shards from v, b")
def t7_common_cap(spark, sf_dir):
    venues = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("venue")).agg(F.count("*").alias("symbols"))
    return c.largest_common_cap(venues, 20, 40, 1000)


_QUOTA = "qp as (select c_custkey as seq, c_custkey % 4 as block, c_custkey % 3 = 0 as covered from customer), qn as (select count(*) as n from qp), qd as (select block, count(*) as d, max(case block when 0 then n * 4 // 15 when 1 then n * 2 // 15 when 2 then n * 5 // 15 else n * 4 // 25 end) as q from qp, qn group by block)"


@register("t8_quota_order", f"with recursive {_QUOTA}, cr as (select 0::bigint as block, (select q from qd where block = 0)::bigint as room union all select cr.block + 1, (select q from qd where qd.block = cr.block + 1) + greatest(0, cr.room - (select d from qd where qd.block = cr.block)) from cr where cr.block < 3), p as (select *, row_number() over (partition by block order by covered, seq) as place from qp) select p.seq, p.block, cast(place as int) as place, place <= room as taken from p join cr using (block)")
def t8_quota_order(spark, sf_dir):
    k = F.col("c_custkey")
    pairs = table(spark, sf_dir, "customer").select(k.alias("seq"), (k % 4).alias("block"), (k % 3 == 0).alias("covered"))
    n = pairs.count()
    return c.quota_order(pairs, [n * 4 // 15, n * 2 // 15, n * 5 // 15, n * 4 // 25]).select("seq", "block", "place", "taken")


@register("t13_eod_targets", f"with {TICKS} select symbol, min(recv_wall_ns) as first_seen, min(cvolume) as best_rank from ticks where symbol not in (select symbol from ticks where dt = '2024-01-02') and symbol not like '%5' group by symbol order by 2, 3, 1 limit 25")
def t13_eod_targets(spark, sf_dir):
    t = ticks(spark, sf_dir)
    ranked = t.select("symbol", F.col("recv_wall_ns").alias("seen_at"), F.col("cvolume").alias("rank"))
    return c.eod_targets(ranked, t.where("dt = '2024-01-02'"), t.where("symbol like '%5'"), 25)


@register("p15_origins", f"with {TICKS} select seq, case conn_id when 'c0' then 'rest_snapshot' when 'c1' then case when lost then 'rest_minute' else 'rest_backfill' end else 'ws_realtime' end as of_path, case vendor when 'ls' then 'ws_realtime' when 'kis' then 'rest_backfill' when 'db' then 'rest_backfill' end as of_source from ticks")
def p15_origins(spark, sf_dir):
    path = F.concat(F.expr("case conn_id when 'c0' then 'snapshot' when 'c1' then if(lost, 'history/minute', 'history/tick_tape') else concat(vendor, '/krx/regular/trades') end"), F.lit("/dt="), F.col("dt"))
    source = F.expr("case vendor when 'ls' then 'live' when 'kis' then 'topup' when 'db' then 'ls_peer' end")
    return ticks(spark, sf_dir).select("seq", c.origin_of_path(path).alias("of_path"), c.origin_of_source(source).alias("of_source"))


@register("j5_exclude_tagged", "with s as (select s_suppkey, s_suppkey % 4 = 0 as exclude from supplier where s_suppkey % 5 > 0) select distinct l_suppkey as symbol, exclude from lineitem left join s on s_suppkey = l_suppkey where exclude is null or not exclude")
def j5_exclude_tagged(spark, sf_dir):
    tags = table(spark, sf_dir, "supplier").where("s_suppkey % 5 > 0").select(F.col("s_suppkey").alias("symbol"), (F.col("s_suppkey") % 4 == 0).alias("exclude"))
    selected = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("symbol")).distinct()
    return selected.join(tags, "symbol", "left").join(tags.where("exclude").select("symbol"), "symbol", "left_anti")


@register("j12_as_of_plan", f"with {TICKS}, p as (select symbol, recv_wall_ns as since, seq as plan from ticks where vendor = 'kis'), d as (select symbol, recv_wall_ns, seq from ticks where lost) select d.seq, coalesce((select arg_max(p.plan, (p.since, p.plan)) from p where p.symbol = d.symbol and p.since <= d.recv_wall_ns), (select arg_min(p.plan, (p.since, p.plan)) from p where p.symbol = d.symbol)) as plan from d")
def j12_as_of_plan(spark, sf_dir):
    t = ticks(spark, sf_dir)
    order = Window.partitionBy("symbol").orderBy("recv_wall_ns", "seq")
    plan = F.when(F.col("vendor") == "kis", F.col("seq"))
    before = F.last(plan, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    any_ = F.first(plan, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.withColumns({"plan": F.coalesce(before, any_)}).where("lost").select("seq", "plan")


@register("j16_three_way", f"with {BARS}, a as (select symbol, count(*) as core from bars where volume > 60 group by 1), b as (select symbol, count(*) as event from bars where daily_change_pct > 20 and symbol not like '%1' group by 1), f as (select symbol, count(*) as follow from bars where n > 3 group by 1) select symbol, core, event, follow, case when core is not null then 'core' when event is not null then 'event' else 'follow' end as tier from a full join b using (symbol) full join f using (symbol)")
def j16_three_way(spark, sf_dir):
    b = daily_bars(spark, sf_dir)
    n = lambda rows, name: rows.groupBy("symbol").agg(F.count("*").alias(name))
    rows = n(b.where("volume > 60"), "core").join(n(b.where("daily_change_pct > 20 and symbol not like '%1'"), "event"), "symbol", "full").join(n(b.where("n > 3"), "follow"), "symbol", "full")
    return rows.withColumn("tier", F.when(F.col("core").isNotNull(), "core").when(F.col("event").isNotNull(), "event").otherwise("follow"))


@register("f6_lookahead", f"with {BARS} select symbol, date from bars where date <= date '1999-12-31'")
def f6_lookahead(spark, sf_dir):
    rows = _bars(spark, sf_dir).where("date <= date'1999-12-31'")
    return u.check_lookahead(rows, F.to_date(F.lit("1999-12-31")))


@register("w9_previous_slot", f"with {COUNTED} select symbol, cum, coalesce(lag(cum) over (partition by symbol order by cum), 0) as before from live")
def w9_previous_slot(spark, sf_dir):
    live = counted_ticks(spark, sf_dir).where("not lost").dropDuplicates(["symbol", "cum"])
    return live.select("symbol", "cum", F.lag("cum", 1, 0).over(Window.partitionBy("symbol").orderBy("cum")).alias("before"))


@register("u2_union_sets", f"with {TICKS} select symbol from ticks where vendor = 'ls' union select symbol from ticks where vendor = 'kis'")
def u2_union_sets(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.where("vendor = 'ls'").select("symbol").union(t.where("vendor = 'kis'").select("symbol")).distinct()


@register("u3_except_sets", f"with {TICKS} select symbol, dt from ticks where vendor = 'ls' except select symbol, dt from ticks where vendor = 'kis'")
def u3_except_sets(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.where("vendor = 'ls'").select("symbol", "dt").subtract(t.where("vendor = 'kis'").select("symbol", "dt"))


@register("u5_except_all", f"with {TICKS} select symbol, conn_id from ticks where vendor = 'ls' except all select symbol, conn_id from ticks where vendor = 'kis'")
def u5_except_all(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.where("vendor = 'ls'").select("symbol", "conn_id").exceptAll(t.where("vendor = 'kis'").select("symbol", "conn_id"))


@register("u6_intersect", f"with {TICKS} select symbol, cvolume from ticks where vendor = 'ls' intersect select symbol, cvolume from ticks where vendor = 'kis'")
def u6_intersect(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return t.where("vendor = 'ls'").select("symbol", "cvolume").intersect(t.where("vendor = 'kis'").select("symbol", "cvolume"))
