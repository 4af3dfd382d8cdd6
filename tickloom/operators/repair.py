"""Filling lost trades from peers and tapes, and merging the fills into the counter's free slots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case, reasons
from tickloom.operators.dedup import multiset_minus
from tickloom.operators.digest import BLOCK_ROWS, table_digest
from tickloom.operators.groups import begins, whole_groups
from tickloom.operators.intervals import island_ids, points_in

_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


#: Cumulative volume, and seconds of a day, in which trades are matched with the spans they may lie in.
VOLUME_BIN, SECOND_BIN = 10_000, 3600


def peer_fill(gaps: DataFrame, peers: DataFrame) -> DataFrame:
    """Trades of peers inside each gap's span of cumulative volume, where they can be its trades.

    ``gaps``: symbol, interval_id, missing_trades, acml_prev, acml_next_before. ``peers``: symbol, peer (rank, first wins),
    acml, price, qty, conflated. Plain peers are pooled, the first counting where two have a trade at the same cumulative
    volume; an interval is refused if their quantities exceed its span or their trades its count. Where no plain peer has
    a trade, conflated peers are tried one by one, and the first whose trades match count and span exactly is taken.
    """
    spans = gaps.where("missing_trades > 0 and acml_next_before > acml_prev").select("symbol", "interval_id", "missing_trades", F.col("acml_prev").alias("lo"), F.col("acml_next_before").alias("hi"))
    inside = points_in(peers, spans, ["symbol"], "acml", VOLUME_BIN)
    keys, span = ["symbol", "interval_id"], F.col("hi") - F.col("lo")
    plain = F.max(~F.col("conflated")).over(Window.partitionBy(*keys).rowsBetween(*_ALL))
    order = Window.partitionBy(*keys, "acml", "conflated").orderBy("peer", "price", "qty")
    marked = inside.withColumns({"_plain": plain, "_n": F.row_number().over(order)}).where(F.col("conflated") != F.col("_plain")).where("conflated or _n = 1")
    # plain trades are one group, each conflated peer's a group of its own
    group = Window.partitionBy(*keys, F.when(F.col("conflated"), F.col("peer"))).rowsBetween(*_ALL)
    sums = marked.withColumns({"_n": F.count("*").over(group), "_qty": F.sum("qty").over(group)})
    fits = (F.col("_qty") <= span) & (F.col("_n") <= F.col("missing_trades"))
    exact = (F.col("_qty") == span) & (F.col("_n") == F.col("missing_trades"))
    taken = sums.where(F.when(F.col("conflated"), exact).otherwise(fits))
    first = F.min("peer").over(Window.partitionBy(*keys).rowsBetween(*_ALL))
    return taken.withColumn("_first", first).where("not conflated or peer = _first").select("symbol", "interval_id", "peer", "acml", "price", "qty")


def residual_gaps(gaps: DataFrame, fills: DataFrame, quantity: str = "qty") -> DataFrame:
    """Gaps with what a first fill has recovered taken off: its trades (``prior_recovered``) and their volume."""
    zero = F.lit(0).cast("long")
    got = fills.groupBy("symbol", "interval_id").agg(F.count("*").alias("prior_recovered"), F.sum(quantity).alias("_qty"))
    left = {"prior_recovered": F.coalesce("prior_recovered", zero), "missing_trades": F.greatest(zero, F.col("missing_trades") - F.coalesce("prior_recovered", zero)), "volume_deficit": F.greatest(zero, F.coalesce("volume_deficit", zero) - F.coalesce("_qty", zero))}
    return gaps.drop("prior_recovered").join(got, ["symbol", "interval_id"], "left").withColumns(left).drop("_qty")


def trim_surplus(pool: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the rows of a pool beyond ``keep``: the one that explains the volume over ``deficit``, else the smallest, late ones first."""
    group = Window.partitionBy(*keys)
    rows = pool.withColumns({"_size": F.count("*").over(group), "_sum": F.sum("volume").over(group)})
    drop = F.col("_size") - F.col("keep")
    explains = (drop == 1) & (F.col("deficit") > 0) & (F.col("volume") == F.col("_sum") - F.col("deficit"))
    rows = rows.withColumns({"_drop": drop, "_last": F.max(F.when(explains, F.struct("ts", "tape_seq"))).over(group), "_small": F.row_number().over(group.orderBy("volume", F.col("ts").desc(), F.col("tape_seq").desc()))})
    gone = F.when(F.col("_last").isNotNull(), F.struct("ts", "tape_seq") == F.col("_last")).otherwise(F.col("_small") <= F.col("_drop"))
    return rows.where(~gone).drop("_size", "_sum", "_drop", "_last", "_small")


def tape_fill(gaps: DataFrame, tape: DataFrame, received: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(fills, outcomes) of gaps from the tapes of one or several sources.

    ``gaps``: symbol, interval_id, ts_prev, ts_next, missing_trades, volume_deficit; ``tape``: symbol, ts, price, volume,
    tape_seq, and ``source`` (rank, first wins) where there are several; ``received``: symbol, ts, price, volume of the live
    feed. Gaps whose seconds touch are one cluster: tape trades in its seconds that the feed hasn't received are pooled, the
    first source with any supplies them all, they are trimmed to the cluster's missing count, and handed to its gaps in time
    order by comparing running sums with row numbers. Without ``received`` only seconds strictly inside a cluster are taken,
    since those at its ends may be held already. ``prior_recovered`` of a gap (see :func:`residual_gaps`) counts as recovered
    in its outcome; gaps that miss nothing are left out.
    """
    zero, strict = F.lit(0).cast("long"), received is None
    prior = F.coalesce("prior_recovered", zero) if "prior_recovered" in gaps.columns else zero
    rows = gaps.where("missing_trades > 0").withColumns({"lo": F.col("ts_prev"), "hi": F.col("ts_next"), "recovered_prior": prior})
    clusters = island_ids(rows, ["symbol"], tie="interval_id")
    by = ["symbol", "island"]
    spans = clusters.groupBy(*by).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("missing_trades").alias("keep"), F.sum("volume_deficit").alias("deficit"))
    several = "source" in tape.columns
    pool = points_in(tape if several else tape.withColumn("source", F.lit(0)), spans, ["symbol"], "ts", SECOND_BIN, low_open=strict, high_open=strict)
    if received is not None:
        pool = multiset_minus(pool, received, ["symbol", "ts", "price", "volume"], ["tape_seq"], apart=("source",))
    first = F.min("source").over(Window.partitionBy(*by))
    pool = pool.withColumn("_first", first).where("source = _first").drop("_first")
    sizes = pool.groupBy(*by).agg(F.count("*").alias("pooled"), F.min("source").alias("source"))
    kept = trim_surplus(pool, by).withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy("ts", "tape_seq")))
    order = Window.partitionBy(*by).orderBy("lo", "hi", "interval_id")
    upto = F.sum("missing_trades").over(order.rowsBetween(Window.unboundedPreceding, 0))
    members = clusters.join(sizes, by, "left").withColumns({"_upto": upto, "_from": upto - F.col("missing_trades"), "_last": F.row_number().over(order) == F.count("*").over(Window.partitionBy(*by)), "_all": F.sum("missing_trades").over(Window.partitionBy(*by))})
    fills = kept.join(members.select(*by, "interval_id", "_from", "_upto"), by).where((F.col("_k") > F.col("_from")) & (F.col("_k") <= F.col("_upto")))
    have = F.least(F.coalesce("pooled", F.lit(0)), F.col("_all"))
    recovered = F.greatest(F.lit(0), F.least(F.col("missing_trades"), have - F.col("_from")))
    surplus = F.when(F.col("_last"), F.greatest(F.lit(0), F.coalesce("pooled", F.lit(0)) - F.col("_all"))).otherwise(0)
    outcomes = members.withColumns({"recovered": recovered + F.col("recovered_prior"), "surplus": surplus, "missing_trades": F.col("missing_trades") + F.col("recovered_prior")})
    status = first_case([(F.col("surplus") > 0, F.lit("over")), (F.col("recovered") == 0, F.lit("none")), (F.col("recovered") < F.col("missing_trades"), F.lit("partial"))], "full")
    outcomes = outcomes.withColumns({"residual": F.greatest(F.lit(0), F.col("missing_trades") - F.col("recovered")), "status": status})
    more = [*(["recovered_prior"] if "prior_recovered" in gaps.columns else []), *(["source"] if several else [])]
    return fills.select("symbol", "interval_id", "ts", "price", "volume", "tape_seq", *(["source"] if several else [])), outcomes.select("symbol", "interval_id", "missing_trades", "recovered", "residual", "surplus", "status", *more)


def summarize_fill(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.count("*").alias("intervals"), *[F.sum(n).alias(n) for n in ("missing_trades", "recovered", "residual")])


def repaired_loss(gaps: DataFrame, outcomes: DataFrame, totals: DataFrame) -> DataFrame:
    """Per symbol the confirmed loss left after the fill, and its share of the trades that the counter shows."""
    sure = gaps.where("kind = 'confirmed'").join(outcomes.select("symbol", "interval_id", "recovered"), ["symbol", "interval_id"], "left")
    left = sure.groupBy("symbol").agg(F.sum(F.col("missing_trades") - F.least(F.coalesce("recovered", F.lit(0)), F.col("missing_trades"))).alias("residual"))
    rows = totals.select("symbol", "status", "trades_observed", "missing").join(left, "symbol", "left").withColumn("residual", F.coalesce("residual", F.lit(0)))
    return rows.withColumn("residual_ratio", F.coalesce(F.try_divide(F.col("residual"), F.col("trades_observed")), F.lit(0.0)))


def repaired_verdict(loss: DataFrame, warn: float = 1e-4, fail: float = 5e-3, symbol_fail: float = 5e-2, least_trades: int = 100) -> DataFrame:
    """One row: the session's loss after the fill, its reasons, and PASS, WARN or FAIL.

    ``loss``: rows of :func:`repaired_loss`. What is left counts for every symbol, trades only for those with a counter, and
    only these, from ``least_trades`` on, are judged alone; the worst of them is named and the others counted. A session
    without trades passes.
    """
    ok = F.col("status") == "OK"
    breach = ok & (F.col("trades_observed") >= least_trades) & (F.col("trades_observed") > 0) & (F.col("residual_ratio") > symbol_fail)
    worst = F.struct((-F.col("residual_ratio")).alias("r"), (-F.col("residual")).alias("c"), F.col("symbol").alias("s"), F.col("trades_observed").alias("t"))
    one = loss.agg(F.coalesce(F.sum("residual"), F.lit(0)).alias("residual"), F.coalesce(F.sum(F.when(ok, F.col("trades_observed"))), F.lit(0)).alias("trades"), F.count_if(breach).alias("breaching"), F.min(F.when(breach, worst)).alias("_worst"))
    one = one.withColumn("loss_ratio", F.coalesce(F.try_divide(F.col("residual"), F.col("trades")), F.lit(0.0)))
    share = F.concat_ws("/", F.col("residual").cast("string"), F.col("trades").cast("string"))
    others = F.when(F.col("breaching") > 1, F.concat(F.lit("+"), (F.col("breaching") - 1).cast("string"))).otherwise("")
    named = F.concat(F.lit("residual_symbol_loss_exceeded:"), F.col("_worst.s"), F.lit(":"), (-F.col("_worst.c")).cast("string"), F.lit("/"), F.col("_worst.t").cast("string"), others)
    any_trades = F.col("trades") > 0
    failed = F.array_compact(F.array(F.when(any_trades & (F.col("loss_ratio") > fail), F.concat(F.lit("residual_loss_exceeded:"), share)), F.when(any_trades & (F.col("breaching") > 0), named)))
    one = one.withColumn("_failed", failed).withColumn("_warned", any_trades & (F.size("_failed") == 0) & (F.col("loss_ratio") > warn))
    reasons = F.when(F.col("_warned"), F.array(F.concat(F.lit("residual_loss_warn:"), share))).otherwise(F.col("_failed"))
    status = first_case([(F.size("_failed") > 0, F.lit("FAIL")), (F.col("_warned"), F.lit("WARN"))], "PASS")
    return one.select("residual", "trades", "loss_ratio", reasons.alias("reasons"), status.alias("status"))


#: Counters of a day in which live ticks are matched with gaps.
COUNTER_BIN = 10_000


def _next_free(batches):
    """Fills of overlapping gaps in time order: each takes the least counter of its gap that is still free.

    A group's ``_taken`` rows, counters of live ticks, come before its fills. A taken counter points at the one after it, so
    a run of them is passed once.
    """
    by = ["symbol", "island"]
    for rows in whole_groups(batches, by):
        new = np.zeros(len(rows), dtype=bool)
        new[begins(rows, by)] = True
        after: dict[int, int] = {}
        fills = ~rows["_taken"].to_numpy(dtype=bool)
        found: list[int | None] = []
        for first, fill, cum, lo, hi in zip(new.tolist(), fills.tolist(), *(rows[c].fillna(0).astype("int64").tolist() for c in ("cum", "_lo", "_hi")), strict=True):
            if first:
                after = {}
            if not fill:
                after[cum] = cum + 1
                continue
            slot, passed = lo + 1, []
            while slot in after:
                passed.append(slot)
                slot = after[slot]
            for p in passed:
                after[p] = slot
            found.append(slot if slot < hi else None)
            if slot < hi:
                after[slot] = slot + 1
        yield rows[fills].assign(cum=pd.array(found, dtype="Int64")).drop(columns=["_taken", "_lo", "_hi", "island"])


def place_fills(live: DataFrame, fills: DataFrame, gaps: DataFrame) -> DataFrame:
    """The fills with ``fate`` and ``cum``: ``placed`` on a free counter of their gap, ``late_live`` or ``overfill`` without one.

    ``live``: symbol, cum, price, volume, ts, recv_wall_ns; ``fills``: symbol, interval_id, ts, price, volume, tape_seq;
    ``gaps``: symbol, interval_id, cum_prev, cum_next. A live tick inside a gap came late: it takes one fill of its second,
    price and volume off; of live ticks with one counter only the first does. Free are the gap's counters that no live tick
    holds. Of a gap that overlaps no other, the k-th fill left takes the k-th of them; gaps that overlap draw from one pool,
    their fills in time order each taking the least counter of its own gap that no fill before has. What finds none is overfill.
    """
    first = live.groupBy("symbol", "cum").agg(F.min(F.struct("recv_wall_ns", "ts", "price", "volume")).alias("_first")).select("symbol", "cum", "_first.ts", "_first.price", "_first.volume")
    spans = gaps.select("symbol", "interval_id", F.col("cum_prev").alias("lo"), F.col("cum_next").alias("hi"))
    late = points_in(first, spans, ["symbol"], "cum", COUNTER_BIN, high_open=True)
    twin = ["symbol", "interval_id", "ts", "price", "volume"]
    numbered = fills.withColumn("_n", F.row_number().over(Window.partitionBy(*twin).orderBy("tape_seq")))
    marked = numbered.join(late.groupBy(*twin).agg(F.count("*").alias("_have")), twin, "left").withColumn("_late", F.col("_n") <= F.coalesce("_have", F.lit(0)))
    islands = island_ids(spans.join(fills.select("symbol", "interval_id").distinct(), ["symbol", "interval_id"]), ["symbol"], "open", tie="interval_id")
    islands = islands.withColumn("_alone", F.count("*").over(Window.partitionBy("symbol", "island")) == 1)
    marked = marked.join(islands.withColumnsRenamed({"lo": "_lo", "hi": "_hi"}), ["symbol", "interval_id"], "left")
    alone = F.col("_late") | F.coalesce("_alone", F.lit(True))

    # gaps that overlap none: rows are numbered on both sides
    slots = islands.where("_alone").select("symbol", "interval_id", F.explode(F.when(F.col("hi") - F.col("lo") > 1, F.sequence(F.col("lo") + 1, F.col("hi") - 1))).alias("cum"))
    free = slots.join(first.select("symbol", "cum"), ["symbol", "cum"], "left_anti")
    free = free.withColumn("_k", F.row_number().over(Window.partitionBy("symbol", "interval_id").orderBy("cum"))).withColumn("_late", F.lit(False))
    order = Window.partitionBy("symbol", "interval_id", "_late").orderBy("ts", "tape_seq")
    placed = marked.where(alone).withColumn("_k", F.row_number().over(order)).join(free, ["symbol", "interval_id", "_late", "_k"], "left").select(*fills.columns, "cum", "_late")

    # gaps that overlap: a group is one union of them
    pools = islands.where("not _alone").groupBy("symbol", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    taken = points_in(first.select("symbol", "cum"), pools, ["symbol"], "cum", COUNTER_BIN, high_open=True).select("symbol", "island", "cum", F.lit(True).alias("_taken"))
    open_ = marked.where(~alone).select(*fills.columns, "island", "_lo", "_hi", F.lit(False).alias("_taken")).unionByName(taken, allowMissingColumns=True)
    kinds = ", ".join([*[f"{c} {open_.schema[c].dataType.simpleString()}" for c in fills.columns], "cum long"])
    ordered = open_.select(*fills.columns, "island", "_lo", "_hi", "_taken", "cum").repartition("symbol", "island").sortWithinPartitions("symbol", "island", F.col("_taken").desc(), "ts", "tape_seq", "interval_id")
    shared = ordered.mapInPandas(_next_free, kinds).withColumn("_late", F.lit(False))
    both = placed.unionByName(shared)
    fate = first_case([(F.col("_late"), F.lit("late_live")), (F.col("cum").isNull(), F.lit("overfill"))], "placed")
    return both.withColumn("fate", fate).select(*fills.columns, "cum", "fate")


def with_fills(live: DataFrame, placed: DataFrame) -> DataFrame:
    """Live ticks and the fills of :func:`place_fills` that have a counter, in one table."""
    none = F.lit(None).cast("long")
    a = live.select("symbol", "cum", "ts", "price", "volume", F.lit("live").alias("source"), none.alias("interval_id"), "recv_wall_ns")
    b = placed.where("fate = 'placed'").select("symbol", "cum", "ts", "price", "volume", F.lit("tape").alias("source"), F.col("interval_id").cast("long").alias("interval_id"), none.alias("recv_wall_ns"))
    return a.unionByName(b)


def repaired_ticks(live: DataFrame, fills: DataFrame, gaps: DataFrame) -> DataFrame:
    """Live ticks and fills in one table, each fill on a free counter of its gap; see :func:`place_fills`."""
    return with_fills(live, place_fills(live, fills, gaps))


def repair_outcome(live: DataFrame, placed: DataFrame, received: int, recovered: int, tolerance: float = 0.02) -> DataFrame:
    """One row: how many rows a repair has, dropped as late or as overfill, and whether it may be used.

    ``placed``: :func:`place_fills`; ``received`` and ``recovered`` are what the session's audit and its fill counted. A
    repair is a MISMATCH, with the first reason that holds, if either count differs or if more than ``tolerance`` of the
    fills found no counter.
    """
    rows = live.select(F.lit("live").alias("fate")).unionByName(placed.select("fate"))
    names = {"live": "live_rows", "placed": "filled_rows", "late_live": "deduped_late_live", "overfill": "overfill_dropped"}
    one = rows.agg(F.count_if(F.col("fate") != "live").alias("fills"), *[F.count_if(F.col("fate") == v).alias(n) for v, n in names.items()])
    reasons = [(F.col("fills") != recovered, "gapfill_rows_ne_recovered"), (F.col("live_rows") != received, "live_rows_ne_received"), (F.col("overfill_dropped") > tolerance * F.col("fills"), "overfill_over_tolerance")]
    one = one.withColumn("reason", F.coalesce(*[F.when(c, F.lit(n)) for c, n in reasons]))
    return one.withColumn("status", F.when(F.col("reason").isNull(), "OK").otherwise("MISMATCH"))


def repair_valid(repaired: DataFrame, summary: DataFrame, audit: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: whether a repaired table may be used, with what is against it.

    ``summary``: one row of status, live_rows, filled_rows, topup_rows, audit_trades_received and audit_digest, the
    :func:`tickloom.operators.digest.table_digest` of the audit that the repair was made from; ``audit`` is that table as it
    is now. A changed audit, a row too few or too many, and live rows that the audit did not count make it invalid.
    """
    have = repaired.agg(F.count("*").alias("rows"))
    one = summary.join(have).join(table_digest(audit, block_rows).select("digest"))
    against = [
        ("status", F.coalesce(F.col("status") != "OK", F.lit(True))),
        ("live_rows", F.coalesce((F.col("live_rows") < 0) | (F.col("live_rows") != F.col("audit_trades_received")), F.lit(True))),
        ("rows", F.coalesce(F.col("rows") != F.col("live_rows") + F.col("filled_rows") + F.coalesce("topup_rows", F.lit(0)), F.lit(True))),
        ("audit", F.coalesce(F.col("audit_digest") != F.col("digest"), F.lit(True))),
    ]
    return one.withColumn("against", reasons(against)).select("rows", "live_rows", "filled_rows", "against", (F.size("against") == 0).alias("valid"))


def tape_surplus(live_counts: DataFrame, tape_counts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more trades on the tape than received, and how many."""
    joined = tape_counts.join(live_counts, keys, "left").withColumn("surplus", F.col("n") - F.coalesce("have", F.lit(0)))
    return joined.where("surplus > 0")


TOPUP_SCHEMA = "symbol string, cum long, ts long, price long, volume long, tape_seq long"


def _place(rows: pd.DataFrame) -> pd.DataFrame:
    """Two pointers over one symbol: each surplus trade takes the first free slot whose neighbours' seconds bracket it."""
    slots = rows[rows["kind"] == "slot"].sort_values("cum")
    trades = rows[rows["kind"] == "trade"].sort_values(["ts", "tape_seq"])
    out, at, cums = [], 0, slots[["cum", "lo", "hi"]].to_numpy()
    for t in trades.itertuples():
        while at < len(cums) and cums[at][2] < t.ts:
            at += 1
        if at < len(cums) and cums[at][1] <= t.ts:
            out.append((t.symbol, int(cums[at][0]), int(t.ts), int(t.price), int(t.volume), int(t.tape_seq)))
            at += 1
    return pd.DataFrame(out, columns=["symbol", "cum", "ts", "price", "volume", "tape_seq"])


def tape_topup(slots: DataFrame, trades: DataFrame) -> DataFrame:
    """Surplus trades (symbol, ts, price, volume, tape_seq) on free slots (symbol, cum, lo, hi); greedy in time order within a symbol."""
    none = F.lit(None).cast("long")
    a = slots.select("symbol", F.lit("slot").alias("kind"), "cum", "lo", "hi", none.alias("ts"), none.alias("price"), none.alias("volume"), none.alias("tape_seq"))
    b = trades.select("symbol", F.lit("trade").alias("kind"), none.alias("cum"), none.alias("lo"), none.alias("hi"), "ts", "price", "volume", "tape_seq")
    return a.unionByName(b).groupBy("symbol").applyInPandas(_place, TOPUP_SCHEMA)


def day_repair_state(units: DataFrame) -> DataFrame:
    """``state`` of (day, vendor) units from what exists for them."""
    state = first_case([(~F.col("audited"), F.lit("unaudited")), (F.col("missing") == 0, F.lit("clean")), (~F.col("tape_done"), F.lit("tape_pending")), (~F.col("filled"), F.lit("gapfill_pending")), (~F.col("merged"), F.lit("merge_pending"))], "repaired")
    return units.withColumn("state", state)


def select_minutes(frames: DataFrame, primary: str | dict[str, str], demoted: DataFrame | None = None, min_frames: int = 1, advantage: int = 5, conflated=(), mixed=(), windows: DataFrame | None = None, at: str = "minute", inside: str | None = None) -> DataFrame:
    """One source per (symbol, minute): the primary, unless it is demoted or a secondary has a clear advantage.

    ``frames``: symbol, minute, vendor, frames, and any of dt, venue, session and kind, by which it is also kept apart;
    ``primary`` may be by venue. ``demoted``: symbol, demoted_at. ``windows``: vendor, symbol, start, end; a vendor named there
    is eligible inside its windows only. Both are compared with the column ``at`` and may have ``dt``. ``inside`` instead names
    a column of ``frames`` that says whether a row is eligible by its windows. Conflated sources
    count only without a lossless one, in books as any other; mixed-venue sources only without another, in books never; ties
    go to the first name.
    """
    days = [c for c in ("dt",) if c in frames.columns]
    keys = [*days, *[c for c in ("venue", "session", "kind") if c in frames.columns], "symbol", "minute"]
    rows = frames.where("frames > 0")
    if isinstance(primary, str):
        named = F.lit(primary)
    else:
        named = F.coalesce(*[F.when(F.col("venue") == v, F.lit(p)) for v, p in primary.items()], F.lit(None).cast("string"))
        rows = rows.where(F.col("venue").isin(*primary))
    rows = rows.withColumn("_primary", F.col("vendor") == named)
    if windows is not None:
        by = [c for c in days if c in windows.columns]
        managed = windows.select(*by, "vendor").distinct().withColumn("_managed", F.lit(True))
        asked = rows.select("vendor", *keys, *([at] if at not in keys else [])).distinct()
        spans = windows.join(asked, [*by, "vendor", "symbol"]).where((F.col(at) >= F.col("start")) & (F.col(at) < F.col("end"))).select("vendor", *keys).distinct().withColumn("_open", F.lit(True))
        rows = rows.join(managed, [*by, "vendor"], "left").join(spans, ["vendor", *keys], "left")
        eligible = F.col("_primary") | F.col("_managed").isNull() | F.col("_open").isNotNull()
    else:
        eligible = F.col("_primary") | F.col(inside) if inside else F.lit(True)
    group = Window.partitionBy(*keys).rowsBetween(*_ALL)
    tick = F.col("kind") == "tick" if "kind" in keys else F.lit(True)
    rows = rows.withColumns({"_mixed": F.col("vendor").isin(*mixed) if mixed else F.lit(False), "_conflated": tick & F.col("vendor").isin(*conflated) if conflated else F.lit(False)})
    rows = rows.withColumn("_eligible", eligible & (F.col("_primary") | tick | ~F.col("_mixed")))
    rows = rows.withColumn("_single", F.max(F.col("_eligible") & ~F.col("_mixed")).over(group)).withColumn("_eligible", F.col("_eligible") & (F.col("_primary") | ~F.col("_mixed") | ~F.col("_single")))
    rows = rows.withColumn("_lossless", F.max(F.col("_eligible") & ~F.col("_conflated")).over(group)).withColumn("_eligible", F.col("_eligible") & (F.col("_primary") | ~F.col("_conflated") | ~F.col("_lossless")))
    order = Window.partitionBy(*keys).orderBy(F.when(F.col("_eligible") & ~F.col("_primary"), F.col("frames")).desc_nulls_last(), "vendor")
    best = rows.withColumn("_n", F.row_number().over(order)).groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("_primary"), F.col("frames"))), F.lit(0)).alias("frames_primary"),
        F.max(F.when((F.col("_n") == 1) & F.col("_eligible") & ~F.col("_primary"), F.struct("frames", "vendor"))).alias("_best"),
        *([F.first(at).alias("_at")] if at not in keys else []),
    )
    if demoted is not None:
        best = best.join(demoted, [*[c for c in days if c in demoted.columns], "symbol"], "left")
    moment = F.col("_at" if at not in keys else at)
    down = F.coalesce(moment >= F.col("demoted_at"), F.lit(False)) if demoted is not None else F.lit(False)
    frames_best = F.col("_best.frames")
    forced = F.coalesce(F.col("_best").isNotNull() & down & (frames_best >= min_frames), F.lit(False))
    better = F.coalesce(frames_best >= F.col("frames_primary") + advantage, F.lit(False))
    reason = first_case([(forced, F.lit("demoted")), (better & (F.col("frames_primary") == 0), F.lit("secondary_only")), (better, F.lit("primary_gap")), (F.col("frames_primary") >= min_frames, F.lit("primary_ok"))], "no_better_source")
    chosen = F.when(forced | better, F.col("_best.vendor")).otherwise(named)
    crossed = tick & chosen.isin(*mixed) if mixed else F.lit(False)
    return best.select(*keys, chosen.alias("selected_vendor"), named.alias("primary_vendor"), reason.alias("reason"), "frames_primary", F.when(forced | better, frames_best).otherwise(F.col("frames_primary")).alias("frames_selected"), crossed.alias("mixed_venue"))


def feed_quality(days: DataFrame, session_minutes: int) -> DataFrame:
    """Availability of each (day, vendor): minutes with frames over the session's, at most 1, to four places half-even."""
    return days.withColumn("availability", F.bround(F.least(F.lit(1.0), F.col("minutes") / F.lit(session_minutes)), 4))


def trailing_days_below(quality: DataFrame, days: DataFrame, floor: float) -> DataFrame:
    """Per vendor the run of days below ``floor`` that ends on the newest day; a day without a row breaks it."""
    numbered = days.select("dt").distinct().withColumn("_day", F.row_number().over(Window.orderBy(F.col("dt").desc())))
    low = quality.where(F.col("availability") < floor).join(numbered, "dt").withColumn("_n", F.row_number().over(Window.partitionBy("vendor").orderBy("_day")))
    runs = low.where("_n = _day").groupBy("vendor").agg(F.count("*").alias("days_below"))
    return quality.select("vendor").distinct().join(runs, "vendor", "left").select("vendor", F.coalesce("days_below", F.lit(0)).alias("days_below"))


def visible_from(rows: DataFrame, visibility: DataFrame, at: str, since: str = "visible_at") -> DataFrame:
    """Rows at or after their symbol's visibility; a null time stays only where the symbol is visible all session (null)."""
    return rows.join(visibility, "symbol").where(F.col(since).isNull() | (F.col(at) >= F.col(since)))


def venue_mixed_seconds(trades: DataFrame) -> DataFrame:
    """``mixed`` where a (symbol, second) has trades of two venues; null without a second."""
    window = Window.partitionBy("symbol", "second")
    return trades.withColumn("mixed", F.when(F.col("second").isNotNull(), F.min("venue").over(window) != F.max("venue").over(window)))
