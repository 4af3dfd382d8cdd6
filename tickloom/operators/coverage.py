"""Coverage and completeness: what is stored, what is missing, what is to be fetched next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case, require


def date_coverage(stored: DataFrame) -> DataFrame:
    """First and last stored date of each symbol."""
    return stored.groupBy("symbol").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def needing_backfill(targets: DataFrame, coverage: DataFrame, floor) -> DataFrame:
    """Targets without rows, or whose first is after the floor."""
    return targets.join(coverage.where(F.col("first_date") <= F.lit(floor)).select("symbol"), "symbol", "left_anti")


def expected_gaps(bars: DataFrame, coverage: DataFrame, stored: DataFrame, sessions: int) -> DataFrame:
    """(symbol, missing): traded days since a symbol's coverage began that aren't stored, within the last ``sessions`` days."""
    recent = bars.select("date").distinct().withColumn("_n", F.row_number().over(Window.orderBy(F.col("date").desc()))).where(F.col("_n") <= sessions).select("date")
    expected = bars.join(F.broadcast(recent), "date", "left_semi").join(coverage, "symbol").where("date >= first_date").select("symbol", "date")
    return expected.subtract(stored.select("symbol", "date")).groupBy("symbol").agg(F.array_sort(F.collect_list("date")).alias("missing"))


def accepted_empty(pairs: DataFrame, tracked: int, share: float) -> DataFrame:
    """Refetched pairs (symbol, date) that stayed empty and are accepted: a day on which over ``share`` of the tracked symbols did is a fault, not a fact."""
    return pairs.withColumn("_n", F.count("*").over(Window.partitionBy("date"))).where(F.col("_n") <= share * F.lit(tracked)).drop("_n")


def fetch_floors(stored: DataFrame, gaps: DataFrame, candidates: DataFrame, complete_through) -> DataFrame:
    """Per symbol the first date to fetch: the least of the day after its last, its first gap and its candidate's floor; stale if behind."""
    a = stored.groupBy("symbol").agg(F.max("date").alias("last_date"))
    b = gaps.groupBy("symbol").agg(F.min("date").alias("gap_floor"))
    c = candidates.select("symbol", F.col("floor").alias("candidate_floor"))
    rows = a.join(b, "symbol", "full").join(c, "symbol", "full")
    return rows.select("symbol", F.least(F.date_add("last_date", 1), F.col("gap_floor"), F.col("candidate_floor")).alias("fetch_from"), F.coalesce(F.col("last_date") < F.lit(complete_through), F.lit(True)).alias("stale"))


def repair_units(pending: DataFrame, attempts: DataFrame, today, max_age: int, max_attempts: int) -> DataFrame:
    """(day, vendor) units with pending symbols that are past their age or their attempts."""
    tries = pending.join(attempts, ["symbol", "day"], "left").groupBy("day", "vendor").agg(F.max(F.coalesce("attempts", F.lit(0))).alias("attempts"))
    return tries.withColumns({"overdue": F.date_diff(F.lit(today), F.col("day")) > max_age, "exhausted": F.col("attempts") >= max_attempts})


def prearm_status(pairs: DataFrame, acks: DataFrame, opens: DataFrame) -> DataFrame:
    """Per shard whether all its pairs were acknowledged before the open: by the latest of the pairs' first acknowledgements.

    ``pairs``: shard, pair; ``acks``: shard, pair, ack_s; ``opens``: shard, open_s, started_s.
    """
    first = acks.groupBy("shard", "pair").agg(F.min("ack_s").alias("ack_s"))
    shards = pairs.join(first, ["shard", "pair"], "left").groupBy("shard").agg(F.max("ack_s").alias("armed_s"), F.count("*").alias("pairs"), F.count_if(F.col("ack_s").isNull()).alias("unacked"))
    rows = opens.join(shards, "shard", "left")
    status = first_case([(F.col("pairs").isNull() | (F.col("unacked") > 0), F.lit("UNVERIFIABLE")), (F.col("started_s") > F.col("open_s"), F.lit("LATE_START")), (F.col("armed_s") > F.col("open_s"), F.lit("LATE_ACK"))], "ARMED")
    return rows.select("shard", "armed_s", F.coalesce("unacked", F.lit(0)).alias("unacked"), status.alias("status"))


def frame_counts(manifests: DataFrame) -> DataFrame:
    """(symbol, stream, frames) summed over manifests with a map of maps; null frames if any manifest kept none."""
    tracked = manifests.agg(F.count_if(F.col("frame_counts").isNull()).alias("_untracked"))
    rows = manifests.select(F.explode("frame_counts").alias("symbol", "_streams")).select("symbol", F.explode("_streams").alias("stream", "frames"))
    sums = rows.groupBy("symbol", "stream").agg(F.sum("frames").alias("frames"))
    return sums.join(F.broadcast(tracked)).select("symbol", "stream", F.when(F.col("_untracked") == 0, F.col("frames")).alias("frames"))


def silent_symbols(accepted: DataFrame, counts: DataFrame) -> DataFrame:
    """Accepted symbols without a frame on any stream."""
    sums = counts.groupBy("symbol").agg(F.sum("frames").alias("frames"))
    return accepted.join(sums, "symbol", "left").where(F.coalesce("frames", F.lit(0)) == 0).select("symbol")


def controller_counts(log: DataFrame, events: list[str]) -> DataFrame:
    """How often each event stands in the log, by vendor."""
    return log.groupBy("vendor").agg(*[F.count_if(F.col("event") == e).alias(e) for e in events])


def lag_stats(lags: DataFrame, keys: list[str]) -> DataFrame:
    """Nearest-rank median and 99th percentile of lags, and the seconds without events in the span seen."""
    rank = lambda p: F.expr(f"percentile_disc({p}) within group (order by lag_s)")
    return lags.groupBy(*keys).agg(rank(0.5).alias("p50_s"), rank(0.99).alias("p99_s"), (F.max("second") - F.min("second") + 1 - F.countDistinct("second")).alias("hole_seconds"))


def rate_stats(frames: DataFrame, keys: list[str], window_ns: int) -> DataFrame:
    """The most frames in a sliding window of time, and the mean rate over the span."""
    window = Window.partitionBy(*keys).orderBy("recv_wall_ns").rangeBetween(-(window_ns - 1), 0)
    rows = frames.withColumn("_n", F.count("*").over(window))
    span = (F.max("recv_wall_ns") - F.min("recv_wall_ns")) / F.lit(1e9)
    return rows.groupBy(*keys).agg(F.max("_n").alias("peak"), F.count("*").alias("frames"), F.try_divide(F.count("*"), span).alias("mean_rate"))


def book_completeness(books: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """Mean share of populated levels of books (asks, bids: arrays), and how many are crossed or out of order; empty levels are removed first."""
    live = lambda c: F.filter(c, lambda x: x > 0)
    rows = books.withColumns({"_a": live("asks"), "_b": live("bids")})
    pairs = lambda c, bad: F.exists(F.sequence(F.lit(1), F.greatest(F.size(c), F.lit(1)) - 1 + F.lit(1)), lambda i: F.coalesce(bad(F.get(c, i - 1), F.get(c, i)), F.lit(False)))
    messy = pairs(F.col("_a"), lambda x, y: x >= y) | pairs(F.col("_b"), lambda x, y: x <= y)
    crossed = F.coalesce(F.get("_b", F.lit(0)) >= F.get("_a", F.lit(0)), F.lit(False))
    filled = (F.size("_a") + F.size("_b")).cast("long")
    return rows.groupBy(*keys).agg(F.count("*").alias("books"), F.sum(filled).alias("levels"), F.count_if(crossed).alias("crossed"), F.count_if(messy).alias("non_monotone")).withColumn("completeness", F.col("levels") / (F.col("books") * 2 * levels))


def gates(criteria: DataFrame, keys: list[str]) -> DataFrame:
    """Whether all criteria (name, passed) of a key hold; a key without any fails."""
    return criteria.groupBy(*keys).agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"), F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("name")))).alias("failed"))


def latest_trade(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The row of greatest ``at`` of each key, failing the query where net isn't buy minus sell."""
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), at).alias("_row")).select(*keys, "_row.*")
    good = F.coalesce(F.col("net") == F.col("buy") - F.col("sell"), F.lit(False))
    return require(last, ~good, "net is not buy minus sell")


def certified_days(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Days of a key proven complete: rows of the day, and an older row that shows the walk passed its start."""
    days = rows.groupBy(*keys, "day").agg(F.count("*").alias("rows"))
    oldest = F.min("day").over(Window.partitionBy(*keys))
    return days.withColumn("complete", (F.col("rows") > 0) & (oldest < F.col("day")))


def plan_targets(universe: DataFrame, done: DataFrame, accepted: DataFrame, repair: DataFrame, cost: DataFrame) -> DataFrame:
    """Pairs (symbol, date) still to fetch, in order: repairs first, then by day, cost and symbol.

    Done pairs are left out unless under repair; accepted empty ones too.
    """
    keys = ["symbol", "date"]
    open_ = universe.select(*keys).distinct().join(accepted, keys, "left_anti")
    marked = open_.join(done.select(*keys).distinct().withColumn("_done", F.lit(True)), keys, "left").join(repair.select(*keys).distinct().withColumn("_repair", F.lit(True)), keys, "left").join(cost, "symbol", "left")
    rows = marked.where("_done is null or _repair is not null").withColumn("repair", F.col("_repair").isNotNull())
    order = Window.partitionBy("date").orderBy(F.col("repair").desc(), F.coalesce("cost", F.lit(0)), "symbol")
    return rows.withColumn("place", F.row_number().over(order)).select(*keys, "repair", "place")


def previous_session_targets(universe: DataFrame, sessions: DataFrame) -> DataFrame:
    """(date, symbol): each session with the universe of the session before it."""
    order = sessions.select("date").distinct().withColumn("_before", F.lag("date").over(Window.orderBy("date"))).where("_before is not null")
    return universe.select(F.col("date").alias("_before"), "symbol").join(F.broadcast(order), "_before").select("date", "symbol")


def membership_tiers(shards: DataFrame, dropped: DataFrame, values: DataFrame) -> DataFrame:
    """Tier A on shard 0, B on the others, C for overflow and policy drops, with the value in whole won."""
    a = shards.select("symbol", F.when(F.col("shard") == 0, "A").when(F.col("shard").isNotNull(), "B").otherwise("C").alias("tier"), "shard")
    c = dropped.select("symbol", F.lit("C").alias("tier"), F.lit(None).cast("long").alias("shard"))
    return a.unionByName(c).join(values, "symbol", "left").select("symbol", "tier", "shard", F.bround(F.col("trade_value_100m") * 1e8).cast("long").alias("trade_value_krw"))


def largest_common_cap(venues: DataFrame, credentials: int, width: int, limit: int) -> DataFrame:
    """The largest cap of symbols per venue (venue, symbols) whose shards of ``width`` fit the credentials, and the shards each then takes."""
    caps = venues.sparkSession.range(1, limit + 1).withColumnRenamed("id", "cap")
    need = caps.join(F.broadcast(venues)).groupBy("cap").agg(F.sum(F.ceil(F.least("symbols", "cap") / width)).alias("shards"))
    best = need.where(F.col("shards") <= credentials).agg(F.max("cap").alias("cap"))
    return venues.join(F.broadcast(best)).select("venue", "cap", F.ceil(F.least("symbols", "cap") / width).alias("shards"))


def quota_order(pairs: DataFrame, quotas: list[int]) -> DataFrame:
    """Pairs (block, covered, seq) by block: uncovered first, each block's quota, what a block leaves unused carried to the next.

    The carry is a running maximum of cumulated quota less cumulated demand: no loop.
    """
    place = F.row_number().over(Window.partitionBy("block").orderBy("covered", "seq"))
    quota = first_case([(F.col("block") == i, F.lit(q)) for i, q in enumerate(quotas)], 0)
    demand = pairs.groupBy("block").agg(F.count("*").alias("_demand")).withColumn("_quota", quota)
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.sum(F.col("_quota") - F.col("_demand")).over(upto)
    low = demand.withColumn("_gap", gap).withColumn("_least", F.least(F.lit(0), F.min("_gap").over(upto)))
    before = Window.orderBy("block")
    carry = F.coalesce(F.lag("_gap").over(before) - F.lag("_least").over(before), F.lit(0))
    room = low.withColumn("_room", F.col("_quota") + carry).select("block", "_room")
    return pairs.withColumn("place", place).join(F.broadcast(room), "block").withColumn("taken", F.col("place") <= F.col("_room")).drop("_room")


def eod_targets(ranked: DataFrame, barred: DataFrame, base: DataFrame, n: int) -> DataFrame:
    """Symbols ranked today but without bars and not in the base set, by first seen, best rank and symbol."""
    rows = ranked.join(barred.select("symbol").distinct(), "symbol", "left_anti").join(base.select("symbol").distinct(), "symbol", "left_anti")
    return rows.groupBy("symbol").agg(F.min("seen_at").alias("first_seen"), F.min("rank").alias("best_rank")).orderBy("first_seen", "best_rank", "symbol").limit(n)


#: Fixed: the origins, the vendors whose folders hold live frames, and the fewest parts of a path below the root of stored frames.
REALTIME, BACKFILL, MINUTE, SNAPSHOT = "ws_realtime", "rest_backfill", "rest_minute", "rest_snapshot"
LIVE_VENDORS = ("kis", "ls", "db", "toss", "kiwoom")
VENDOR_DEPTH, SNAPSHOT_DEPTH, HISTORY_DEPTH = 5, 2, 3


def origin_of_path(path):
    """Where the rows of a stored file come from, by its path below the root; a path of rows of several origins, or of none known, fails the query."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    deep = lambda n: F.size(parts) >= n
    top, second = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    fail = lambda text: F.raise_error(F.concat(F.lit(text), path)).cast("string")
    return first_case(
        [
            ((top == "derived") & (second == "ticks_repaired"), fail("rows of several origins: ")),
            ((top == "snapshot") & deep(SNAPSHOT_DEPTH), F.lit(SNAPSHOT)),
            ((top == "history") & (second == "tick_tape") & deep(HISTORY_DEPTH), F.lit(BACKFILL)),
            ((top == "history") & (second == "minute") & deep(HISTORY_DEPTH), F.lit(MINUTE)),
            (top.isin(*LIVE_VENDORS) & deep(VENDOR_DEPTH), F.lit(REALTIME)),
            (path.isNotNull(), fail("no known origin: ")),
        ]
    )


def origin_of_source(source):
    """A repaired row's origin: live rows are realtime, those of any other source backfill; null stays null."""
    return F.when(source == "live", REALTIME).when(source.isNotNull(), BACKFILL)
