"""Queries of the streaming monitors: the stored events are streamed once through each, and the table it wrote is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.scalars import div
from tickloom.operators import monitoring as mo
from tickloom.plans.registry import TICKS, register
from tickloom.sources.adapters import VENDOR_OF, ticks
from tickloom.sources.scratch import scratch, staged
from tickloom.streaming import late
from tickloom.streaming import monitors as m


def _stream(spark, sf_dir, delay="60 days"):
    """The tick adapter's rows in time order as a file stream, with ``ts``."""
    path = scratch(spark, "stream")
    rows = ticks(spark, sf_dir).withColumn("ts", F.timestamp_micros(div(F.col("recv_wall_ns"), 1000)))
    rows.repartitionByRange(4, "ts").write.parquet(path)
    return m.with_time(spark.readStream.schema(rows.schema).parquet(path), delay)


#: Rows of a slice of :func:`_sliced`.
SLICE_ROWS = 1_000_000


def _sliced(rows, at, tag, most=None):
    """``rows`` as a file stream in slices of ``at``, one a trigger, so no trigger has more than about ``most`` rows."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, tag)
    parts = -(-rows.count() // (most or SLICE_ROWS))
    bounds = sorted(set(rows.approxQuantile(at, [k / parts for k in range(1, parts)], 0.001))) if parts > 1 else []
    read = spark.readStream.schema(rows.schema)
    if not bounds:
        rows.repartitionByRange(3, at).write.parquet(path)
        return read.parquet(path)
    kept = scratch(spark, tag)
    place = sum((F.when(F.col(at) >= F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0))
    rows.withColumn("_slice", place).write.partitionBy("_slice").parquet(kept)
    # files are read in the order in which they are written
    for k in range(len(bounds) + 1):
        spark.read.schema(rows.schema).parquet(f"{kept}/_slice={k}").coalesce(1).write.mode("append").parquet(path)
    return read.option("maxFilesPerTrigger", 1).parquet(path)


def _timed(spark, sf_dir):
    """As :func:`_stream`, in slices."""
    rows = ticks(spark, sf_dir).withColumn("ts", F.timestamp_micros(div(F.col("recv_wall_ns"), 1000)))
    return m.with_time(_sliced(rows, "recv_wall_ns", "stream"), "60 days")


_TS = f"{TICKS}, ev as (select *, make_timestamp(recv_wall_ns // 1000) as ts from ticks)"
_START = "epoch_us(time_bucket(interval '{w}', ts)) as start_us"


@register("x1_health", f"with {_TS}, w as (select vendor as feed, cvolume / 4.0::double as lag_s, epoch_us(ts) // 43200000000 * 43200000000 - k * 43200000000 as start_us from ev, (select unnest([0, 1]) as k)) select feed, start_us, count(*) as frames, case when count(*) >= 20 then quantile_disc(lag_s, 0.5) end as p50_s, case when count(*) >= 20 then quantile_disc(lag_s, 0.99) end as p99_s from w group by all")
def x1_health(spark, sf_dir):
    frames = _stream(spark, sf_dir).withColumns({"feed": F.col("vendor"), "lag_s": F.col("cvolume") / F.lit(4.0)})
    out = m.run_available(m.health(frames, "24 hours", "12 hours"), scratch(spark, "x1"), "complete")
    return out.select("feed", F.unix_micros("start").alias("start_us"), "frames", "p50_s", "p99_s")


@register("x2_lag_windows", f"with {_TS} select vendor as stream, epoch_us(ts) // 21600000000 * 21600000000 as start_us, count(*) as samples, quantile_cont(cvolume / 4.0::double, 0.5) as p50_s from ev group by all")
def x2_lag_windows(spark, sf_dir):
    frames = _stream(spark, sf_dir).withColumns({"stream": F.col("vendor"), "lag_s": F.col("cvolume") / F.lit(4.0)})
    out = m.run_available(m.lag_windows(frames, "6 hours"), scratch(spark, "x2"), "complete")
    return out.select("stream", F.unix_micros("start").alias("start_us"), "samples", "p50_s")


@register("x3_sessions", f"with {_TS}, l as (select symbol, ts, case when ts - lag(ts) over w < interval 12 hour then 0 else 1 end as fresh from ev window w as (partition by symbol order by ts)), g as (select *, sum(fresh) over (partition by symbol order by ts rows unbounded preceding) as n from l) select symbol as feed, min(epoch_us(ts)) as start_us, max(epoch_us(ts)) as last_us, count(*) as frames from g group by symbol, n")
def x3_sessions(spark, sf_dir):
    out = m.run_available(m.sessions(_stream(spark, sf_dir).withColumn("feed", F.col("symbol")), "12 hours"), scratch(spark, "x3"), "complete")
    return out.select("feed", F.unix_micros("start").alias("start_us"), F.unix_micros("last").alias("last_us"), "frames")


@register("d3_stream_dedup", f"with {TICKS} select conn_id, seq as conn_seq from ticks")
def d3_stream_dedup(spark, sf_dir):
    frames = _stream(spark, sf_dir).withColumn("conn_seq", F.col("seq"))
    twice = frames.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return m.run_available(m.unique_frames(twice), scratch(spark, "d3")).select("conn_id", "conn_seq")


#: Feeds are watched from 09:00 to 15:20 of each day, half an hour of silence raises an alarm; times in microseconds.
_LIMIT, _HOUR = 1_800_000_000, 3_600_000_000
_SILENT = f"""{TICKS}, fr as (select vendor as feed, recv_wall_ns // 1000 as t from ticks), fi as (select feed, min(t) as first from fr group by 1),
dy as (select distinct epoch_us(strptime(dt, '%Y-%m-%d')) as d from ticks), sp as (select feed, greatest(d + 9 * {_HOUR}, first) as lo, d + 15 * {_HOUR} + 20 * 60000000 as hi from fi, dy where d + 15 * {_HOUR} + 20 * 60000000 > first),
mk as (select feed, lo, hi, lo as t from sp union all select sp.feed, lo, hi, t from sp join fr on fr.feed = sp.feed and t >= lo and t < hi),
nx as (select feed, t, (coalesce(lead(t) over (partition by feed, lo order by t), hi) - t - 1) // {_LIMIT} as n from mk),
al as (select feed, t + k * {_LIMIT} as alarm_at, t as silent_since from (select feed, t, unnest(range(1, n + 1)) as k from nx where n > 0))"""


def _watched(rows):
    """Start and end of the watch of each day of ``rows``."""
    day = F.unix_micros(F.to_timestamp("dt"))
    return rows.select("dt").distinct().select((day + 9 * _HOUR).alias("start"), (day + 15 * _HOUR + 20 * 60_000_000).alias("end"))


@register("x4_silence_alarms", f"with {_SILENT} select * from al")
def x4_silence_alarms(spark, sf_dir):
    rows = ticks(spark, sf_dir)
    day = F.unix_micros(F.to_timestamp("dt"))
    days = rows.select("dt").distinct().withColumn("feed", F.explode(F.array(*map(F.lit, VENDOR_OF.values())))).select("feed", (day + 9 * _HOUR).alias("start"), (day + 15 * _HOUR + 20 * 60_000_000).alias("end"))
    return mo.silence_alarms(rows.select(F.col("vendor").alias("feed"), div(F.col("recv_wall_ns"), 1000).alias("at")), days, _LIMIT, 24 * _HOUR)


@register("x4_silence_stream", f"with {_SILENT} select * from al where alarm_at < ((select max(t) from fr) - {_HOUR}) // 1000 * 1000")
def x4_silence_stream(spark, sf_dir):
    windows = sorted((r.start, r.end) for r in _watched(ticks(spark, sf_dir)).collect())  # a row per session day
    frames = _stream(spark, sf_dir, "1 hours").select(F.col("vendor").alias("feed"), div(F.col("recv_wall_ns"), 1000).alias("at"), "ts")
    return m.run_available(m.silence(frames, windows, _LIMIT), scratch(spark, "x4"))


_DAY = 86_400_000_000_000
_LAGS = f"""{TICKS}, fr as (select vendor as stream, recv_wall_ns, seq, conn_id, symbol, case when seq % 19 <> 0 then seq * seq % 97 / 10.0::double end as lag_s, row_number() over (partition by vendor order by recv_wall_ns, seq) as n from ticks),
sa as (select stream, recv_wall_ns // {_DAY} as w, conn_id, symbol, lag_s from fr where n % 8 = 0 and lag_s is not null), la as (select stream, max(w) as last from sa group by 1),
tp as (select stream, w, max(row(n, conn_id)) as t from (select stream, w, conn_id, count(*) as n from sa group by all) group by all), mk as (select sa.*, struct_extract(t, 2) as top from sa join tp using (stream, w)),
sh as (select distinct a.stream, a.w, a.conn_id from mk a join mk b on a.stream = b.stream and a.w = b.w and a.symbol = b.symbol and b.conn_id = b.top where a.conn_id <> a.top),
ju as (select stream, w, count(*) as samples, quantile_cont(lag_s, 0.5) as p50_s, max(lag_s) as max_s from sa where (stream, w, conn_id) not in (select (stream, w, conn_id) from sh) group by all having count(*) >= 2),
sy as (select ju.*, case when p50_s > 6 then 1 when p50_s <= 3 then 0 end as says from ju join la using (stream) where w < last),
st as (select *, coalesce(last_value(says ignore nulls) over (partition by stream order by w rows unbounded preceding), 0) as state from sy), bf as (select *, coalesce(lag(state) over (partition by stream order by w), 0) as before from st),
ep as (select stream, w as "window", case when state = 1 then 'CRITICAL' else 'RECOVERED' end as status, p50_s, max_s, samples from bf where state <> before)"""


def _late(rows):
    seq = F.col("seq")
    return rows.withColumns({"stream": F.col("vendor"), "lag_s": F.when(seq % 19 != 0, seq * seq % 97 / F.lit(10.0))})


@register("x2_lag_episodes", f"with {_LAGS} select * from ep")
def x2_lag_episodes(spark, sf_dir):
    return mo.lag_episodes(mo.judged_lags(mo.lag_samples(_late(ticks(spark, sf_dir)), _DAY, _DAY), 2), 6.0)


@register("x2_lag_stream", f"with {_LAGS} select * from ep")
def x2_lag_stream(spark, sf_dir):
    return m.run_available(m.lag_alerts(_late(_timed(spark, sf_dir)), 6.0, _DAY, 2), scratch(spark, "x2a"))


_KIND = "case when seq % 10 = 9 then 'snapshot' when seq % 23 = 0 then 'acks' when seq % 31 = 0 then 'connected' when seq % 37 = 0 then 'disconnected' else 'frame' end"


@register(
    "x1_tracker",
    f"""with {TICKS}, e as (select vendor as feed, recv_wall_ns as t, seq, {_KIND} as kind, case when seq % 13 <> 0 then cvolume / 4.0::double end as lag, row_number() over (partition by vendor order by recv_wall_ns, seq) as rn from ticks),
f as (select *, count(*) filter (kind = 'frame') over o as fn, count(*) filter (kind = 'disconnected') over o as dn, coalesce(last_value(case kind when 'connected' then true when 'disconnected' then false end ignore nulls) over o, false) as connected,
  last_value(case when kind = 'disconnected' then 'r' || seq::varchar end ignore nulls) over o as last_disconnect_reason, last_value(case when kind = 'frame' then t end ignore nulls) over o as last_frame_ns from e window o as (partition by feed order by rn rows unbounded preceding)),
g as (select *, cast(coalesce(sum(seq % 4) filter (kind = 'acks') over p, 0) as bigint) as planned_pairs, cast(coalesce(sum(seq % 3) filter (kind = 'acks') over p, 0) as bigint) as accepted_pairs, cast(coalesce(sum(seq % 2) filter (kind = 'acks') over p, 0) as bigint) as rejected_pairs from f window p as (partition by feed, dn order by rn rows unbounded preceding)),
s as (select g.*, (select count(*) from f x where x.feed = g.feed and x.rn < g.rn and x.kind = 'frame' and x.t // 1000000000 >= g.t // 1000000000 - 172800) as window_frames,
  (select list_sort(list(x.lag)) from f x where x.feed = g.feed and x.rn < g.rn and x.kind = 'frame' and x.fn % 8 = 0 and x.lag is not null and x.t >= g.t - 172800000000000) as lags from g where kind = 'snapshot')
select feed, t as "at", connected, dn as disconnects_total, last_disconnect_reason, fn as frames_total, last_frame_ns, window_frames, case when len(lags) >= 20 then lags[(50 * len(lags) + 99) // 100] end as lag_p50_s, case when len(lags) >= 20 then lags[(99 * len(lags) + 99) // 100] end as lag_p99_s,
  coalesce(len(lags), 0) as lag_samples, planned_pairs, accepted_pairs, rejected_pairs from s""",
)
def x1_tracker(spark, sf_dir):
    seq = F.col("seq")
    kind = F.expr(_KIND)
    acks = {c: F.when(kind == "acks", seq % n) for c, n in (("planned", 4), ("accepted", 3), ("rejected", 2))}
    events = _timed(spark, sf_dir).select(F.col("vendor").alias("feed"), F.col("recv_wall_ns").alias("at"), "seq", kind.alias("kind"), F.when(seq % 13 != 0, F.col("cvolume") / F.lit(4.0)).alias("lag_s"), F.when(kind == "disconnected", F.concat(F.lit("r"), seq.cast("string"))).alias("reason"), *[v.alias(c) for c, v in acks.items()])
    return m.run_available(m.health_snapshots(events, window_s=172_800), scratch(spark, "x1t")).drop("pairs_pending_since_ns")


@register("x8_late_windows", f"with {_TS}, w as (select vendor as feed, epoch_us(ts) // 21600000000 * 21600000000 as start_us, cvolume from ev) select feed, start_us, count(*) as frames, cast(sum(cvolume) as bigint) as volume from w where start_us + 21600000000 <= (select max(epoch_us(ts)) from ev) // 1000 * 1000 - 43200000000 group by all")
def x8_late_windows(spark, sf_dir):
    """Every fiftieth tick comes when all others have: the stream's windows lack it, the repair of the touched ones has it."""
    path, kept = scratch(spark, "late"), scratch(spark, "kept")
    rows = ticks(spark, sf_dir).select("vendor", "cvolume", "seq", F.timestamp_micros(div(F.col("recv_wall_ns"), 1000)).alias("ts")).withColumnRenamed("vendor", "feed")
    rows.where("seq % 50 <> 0").repartitionByRange(4, "ts").write.parquet(f"{path}/a")
    rows.where("seq % 50 = 0").coalesce(1).write.parquet(f"{path}/b")
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    sums = (F.count("*").alias("frames"), F.sum("cvolume").alias("volume"))
    told = m.run_available(late.closed_windows(stream(), ["feed"], "6 hours", "12 hours", *sums), scratch(spark, "x8"))
    frames = late.keep_frames(stream(), kept, 21_600_000_000, 43_200_000_000)
    windows, _ = late.repaired_windows(told, frames, lambda df: df.groupBy("feed", "start").agg(*sums))
    return windows.select("feed", F.unix_micros("start").alias("start_us"), "frames", "volume")


@register("x6_failover_stream")
def x6_failover_stream(spark, sf_dir):
    from tickloom.plans.trading import controller_steps

    steps = staged(controller_steps(spark, sf_dir), "steps")
    return m.run_available(m.failover(_sliced(steps, "step_s", "steps")), scratch(spark, "x6"))
