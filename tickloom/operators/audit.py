"""Session audit: lost trades by the venue's counter, latency minutes, and loss totals."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case
from tickloom.functions.scalars import reasons as named_reasons
from tickloom.operators.groups import begins, whole_groups
from tickloom.operators.intervals import event_holes, merge_intervals, overlapping, with_previous
from tickloom.sources.scratch import staged

INTERVAL_CAP, RESET_FRAMES = 500, 3
#: Counters of a symbol that one task orders.
COUNTER_BIN = 1 << 20


def counter_gaps(live: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Loss intervals of feeds in counter order without resets: one row where the counter jumps by more than one.

    ``live`` has symbol, cum, volume, cvolume, hms, recv_wall_ns, conn_id. A deficit of volume confirms the loss, else only
    the count shows it. Late, repeated or reset counters need :func:`counter_ledger`.
    """
    keys = keys or ["symbol"]
    fields = ["cum", "volume", "hms", "recv_wall_ns", "conn_id"]
    rows = with_previous(live, keys, "cum", fields, COUNTER_BIN).withColumns({f"{n}_prev": F.col(f"previous.{n}") for n in fields})
    missing = F.col("cum") - F.col("cum_prev") - 1
    deficit = F.greatest(F.lit(0), F.col("volume") - F.col("volume_prev") - F.col("cvolume"))
    return rows.where(missing >= 1).select(
        *keys,
        F.when(deficit > 0, "confirmed").otherwise("count_only").alias("kind"),
        missing.alias("missing_trades"),
        deficit.alias("volume_deficit"),
        "cum_prev",
        F.col("cum").alias("cum_next"),
        F.col("hms_prev").alias("chetime_prev"),
        F.col("hms").alias("chetime_next"),
        F.col("recv_wall_ns_prev").alias("recv_prev_ns"),
        F.col("recv_wall_ns").alias("recv_next_ns"),
        (F.col("conn_id") != F.col("conn_id_prev")).alias("conn_changed"),
        F.col("volume_prev").alias("acml_prev"),
        (F.col("volume") - F.col("cvolume")).alias("acml_next_before"),
    )


#: Per interval (nulls where a segment has none) and, repeated on each of its rows, what is known of the whole segment.
_INTERVAL = "kind string, missing_trades long, volume_deficit long, cum_prev long, cum_next long, chetime_prev string, chetime_next string, recv_prev_ns long, recv_next_ns long, conn_changed boolean, acml_prev long, acml_next_before long"
_SEGMENT = "frames long, accepted long, duplicates long, regressions long, resets long, trades long, net_missing long, cum_least long, cum_most long"
_COPY_OF = ("cum", "volume", "cvolume", "price", "hms")


class _Segment:
    """The frames of one segment, a table or its columns in order of arrival, and the ledger of what its counter leaves out.

    Most of a feed are stretches in which the counter only rises; those are handled as arrays. What is decided frame by
    frame is the rest: copies, frames that arrive late, and counters that fall.
    """

    def __init__(self, frames: pd.DataFrame | dict[str, np.ndarray]):
        if isinstance(frames, pd.DataFrame):
            self.rows = frames.sort_values(["recv_wall_ns", "seq"], kind="stable", ignore_index=True)
            frames = {c: self.rows[c].to_numpy() for c in (*_COPY_OF, "recv_wall_ns", "conn_id")}
        self.of, self.cum = frames, frames["cum"].astype(np.int64)
        #: Open intervals by their lower counter, in order, so that a counter finds its own by bisection.
        self.lows: list[int] = []
        self.open: dict[int, list] = {}
        self.closed: list[list] = []
        self.n = {"accepted": 0, "duplicates": 0, "regressions": 0, "resets": 0}
        self.spans: list[tuple[int, int]] = []
        self.before_reset: tuple[int, int] = (0, 0)

    def copies(self, i: int, j: int | None) -> bool:
        return j is not None and all(self.of[c][i] == self.of[c][j] for c in _COPY_OF)

    def jump(self, i: int, j: int) -> None:
        """The counter went from row ``i`` to row ``j``."""
        missing = int(self.cum[j] - self.cum[i]) - 1
        if missing > 0:
            low = int(self.cum[i])
            if low in self.open:  # the counter was reset and passes the same value again
                self.closed.append(self.open.pop(low))
                self.lows.remove(low)
            short = max(0, int(self.of["volume"][j]) - int(self.of["volume"][i]) - int(self.of["cvolume"][j]))
            insort(self.lows, low)
            self.open[low] = [i, j, missing, short, short > 0]

    def holding(self, value: int) -> list | None:
        """The open interval with bounds around ``value``, them included."""
        for at in (bisect_right(self.lows, value) - 1, bisect_left(self.lows, value) - 1):
            if at >= 0 and value <= self.cum[self.open[self.lows[at]][1]]:
                return self.open[self.lows[at]]
        return None

    def fill(self, i: int, interval: list) -> None:
        interval[2] -= 1
        interval[3] = max(0, interval[3] - int(self.of["cvolume"][i]))
        if not interval[2]:
            low = int(self.cum[interval[0]])
            self.lows.remove(low)
            del self.open[low]

    def run(self) -> None:
        cum, conns = self.cum, self.of["conn_id"]
        breaks = np.append(np.flatnonzero(np.diff(cum) <= 0) + 1, len(cum))
        seen: set = set()
        head = tail = None  # rows of the highest counter, and of the last one in order
        fallen: list[int] = []
        first, extra = None, 0
        i = 0
        while i < len(cum):
            if head is None or cum[i] > cum[head]:
                # a rising stretch: nothing in it can be late or a copy
                end = int(breaks[np.searchsorted(breaks, i, "right")])
                if head is None:
                    first = i
                else:
                    self.jump(head, i)
                for k in (np.flatnonzero(np.diff(cum[i:end]) > 1) + i).tolist():
                    self.jump(k, k + 1)
                seen.update(set(conns[i:end].tolist()))
                self.n["accepted"] += end - i
                head = tail = end - 1
                fallen.clear()
                i = end
                continue
            interval = self.holding(int(cum[i]))
            below = cum[i] < cum[head]
            if self.copies(i, tail) or self.copies(i, fallen[-1] if fallen else None):
                self.n["duplicates"] += 1
            elif (conns[i] != conns[head] and conns[i] in seen) or (below and interval is not None):
                if interval is not None and cum[interval[0]] < cum[i] < cum[interval[1]]:
                    self.fill(i, interval)
                    self.n["accepted"] += 1
                else:
                    self.n["duplicates"] += 1
            else:
                seen.add(conns[i])
                self.n["accepted"] += 1
                if below:
                    self.n["regressions"] += 1
                    fallen = [*fallen, i][-RESET_FRAMES:]
                    if len(fallen) == RESET_FRAMES and all(cum[x] <= cum[y] for x, y in zip(fallen, fallen[1:])):
                        self.spans.append((first, head))
                        self.n["resets"] += 1
                        for x, y in zip(fallen, fallen[1:]):
                            self.jump(x, y)
                        first, head, tail, fallen = fallen[0], fallen[-1], i, []
                else:  # the same counter again, with other fields
                    fallen.clear()
                    head = tail = i
            i += 1
        if first is not None:
            self.spans.append((first, head))

    def facts(self) -> tuple[list[tuple], list[int]]:
        """Its intervals as (row before, row after, missing, deficit, sure), and its counts in the order of ``_SEGMENT``."""
        self.run()
        trades = sum(int(self.cum[b] - self.cum[a]) + 1 for a, b in self.spans)
        return [*self.closed, *self.open.values()], [len(self.cum), *self.n.values(), trades, trades - self.n["accepted"], int(self.cum.min()), int(self.cum.max())]

    def table(self) -> pd.DataFrame:
        return _ledgers(self.rows, [])


def _names(kinds: str) -> list[str]:
    return [c.split()[0] for c in kinds.split(", ")]


def _ledgers(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """The ledger of whole segments that lie one after another, each in order of arrival.

    Segments in which the counter only rises are handled together as arrays; the others one by one.
    """
    of = {c: rows[c].to_numpy() for c in (*_COPY_OF, "recv_wall_ns", "conn_id")}
    cum = of["cum"] = rows["cum"].astype("int64").to_numpy()
    begin = begins(rows, keys)
    end = np.append(begin[1:], len(rows))
    segment = np.repeat(np.arange(len(begin)), end - begin)
    step, same = np.diff(cum), segment[1:] == segment[:-1]
    falls = np.zeros(len(begin), dtype=bool)
    falls[segment[1:][same & (step <= 0)]] = True
    frames, least, most = end - begin, cum[begin], cum[end - 1]
    zero, trades = np.zeros_like(frames), most - least + 1
    facts = np.stack([frames, frames, zero, zero, zero, trades, trades - frames, least, most], axis=1)
    low = np.flatnonzero(same & (step > 1) & ~falls[segment[1:]])
    short = np.maximum(0, (rows["volume"].iloc[low + 1].astype("int64").to_numpy() - rows["volume"].iloc[low].astype("int64").to_numpy()) - rows["cvolume"].iloc[low + 1].astype("int64").to_numpy())
    found = [np.stack([segment[low], low, low + 1, step[low] - 1, short, short > 0], axis=1)]
    for n in np.flatnonzero(falls).tolist():
        a, b = int(begin[n]), int(end[n])
        intervals, facts[n] = _Segment({c: v[a:b] for c, v in of.items()}).facts()
        found.append(np.array([(n, a + i, a + j, *x) for i, j, *x in intervals], dtype=np.int64).reshape(-1, 6))
    at, i, j, missing, deficit, sure = np.concatenate(found).astype(np.int64).T
    less = lambda x, y: pd.array(x.iloc[y].astype("int64"), dtype="Int64")
    out = pd.DataFrame({"kind": np.where(sure == 1, "confirmed", "count_only"), "missing_trades": pd.array(missing, dtype="Int64"), "volume_deficit": pd.array(deficit, dtype="Int64")}).assign(
        cum_prev=pd.array(cum[i], dtype="Int64"), cum_next=pd.array(cum[j], dtype="Int64"), chetime_prev=of["hms"][i], chetime_next=of["hms"][j],
        recv_prev_ns=less(rows["recv_wall_ns"], i), recv_next_ns=less(rows["recv_wall_ns"], j), conn_changed=pd.array(of["conn_id"][i] != of["conn_id"][j], dtype="boolean"),
        acml_prev=less(rows["volume"], i), acml_next_before=less(rows["volume"], j) - less(rows["cvolume"], j),
    )
    # a segment without an interval has one row of nulls
    none = np.setdiff1d(np.arange(len(begin)), at)
    out, at = out.reindex(range(len(at) + len(none))), np.concatenate([at, none])
    out["kind"] = out["kind"].astype(object).where(out["kind"].notna(), None)
    heads = rows[keys].iloc[begin[at]].reset_index(drop=True)
    counts = pd.DataFrame(facts[at], columns=_names(_SEGMENT))
    return pd.concat([heads, out[_names(_INTERVAL)], counts], axis=1)


def _days(df: DataFrame) -> list[str]:
    """The column of the day, where a table has one."""
    return [c for c in ("dt",) if c in df.columns]


def counter_ledger(frames: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """The exact ledger of feeds with late frames, regressions and resets: an ordered fold per segment of ``keys``.

    A late frame fills the interval that holds its counter; three falling frames that rise among themselves are a reset.
    One row per interval with the segment's counters, or one without an interval; no interval is left out, however many
    there are. Copies by (conn_id, conn_seq) are to be dropped before. A group is one phase of one symbol's session, the unit
    whose order matters: ``keys`` are symbol, phase and, where ``frames`` has it, the day ``dt``. Groups follow each other in a
    sorted partition, so many small ones are one call; a task holds a batch of rows and the group that goes on.
    """
    keys = keys or ("symbol", "phase", *_days(frames))
    kinds = [f"{k} {frames.schema[k].dataType.simpleString()}" for k in keys]

    def fold(batches):
        for rows in whole_groups(batches, list(keys)):
            yield _ledgers(rows, list(keys))

    used = [*keys, *(c for c in (*_COPY_OF, "recv_wall_ns", "seq", "conn_id") if c not in keys)]
    ordered = frames.select(*used).repartition(*keys).sortWithinPartitions(*keys, "recv_wall_ns", "seq")
    return ordered.mapInPandas(fold, ", ".join([*kinds, _INTERVAL, _SEGMENT]))


_LOST = ("intervals", "missing", "confirmed_missing", "count_only_missing", "volume_deficit")


def _losses() -> list:
    """Sums of the intervals of a group, by kind."""
    kind = lambda k: F.sum(F.when(F.col("kind") == k, F.col("missing_trades")).otherwise(0))
    return [F.count("kind").alias("intervals"), F.sum("missing_trades").alias("missing"), kind("confirmed").alias("confirmed_missing"), kind("count_only").alias("count_only_missing"), F.sum("volume_deficit").alias("volume_deficit")]


def _ledger(seen: DataFrame, by: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    """Per symbol status, trades, losses by kind and the confirmed share; ``seen``: symbol, frames, varied, trades_observed, net_missing and the losses."""
    rows = seen.withColumns({n: F.coalesce(n, F.lit(0)) for n in _LOST})
    status = F.when((F.col("frames") == 0) | ((F.col("frames") > 1) & ~F.col("varied")), "NO_COUNTER").otherwise("OK")
    share = F.coalesce(F.try_divide(F.col("confirmed_missing"), F.col("trades_observed")), F.lit(0.0))
    return rows.select(*by, status.alias("status"), "frames", "trades_observed", *_LOST, "net_missing", share.alias("loss_ratio"), *more)


def loss_totals(live: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per symbol of a feed in counter order: the trades that its counter shows, those missing by kind, and the share of confirmed losses.

    A jump of the count alone is no sure loss, so it has no part in ``loss_ratio``. A counter that never moves is none:
    the symbol's status is NO_COUNTER, and sessions leave it out.
    """
    span = F.max("cum") - F.min("cum")
    seen = live.groupBy("symbol").agg(F.count("*").alias("frames"), (span > 0).alias("varied"), (span + 1).alias("trades_observed"), (span + 1 - F.count("*")).alias("net_missing"))
    return _ledger(seen.join(gaps.groupBy("symbol").agg(*_losses()), "symbol", "left"), ["symbol"])


def ledger_totals(ledger: DataFrame, manifest: DataFrame | None = None, cap: int = INTERVAL_CAP, regular: str = "regular") -> DataFrame:
    """:func:`loss_totals` of the exact ledger, a row per symbol and, where the ledger has it, day.

    Trades, losses and deficit are those of the ``regular`` phase; ``frames`` (without copies), ``duplicates``,
    ``regressions`` and ``resets`` are of all phases, and so are the intervals, of which :func:`top_intervals` names ``cap``:
    ``intervals_truncated`` is how many it leaves out. A counter that is the same in all phases is none.
    ``manifest``: symbol (and day), ``manifest_frames``, what the session's manifest counted; null where it names no symbol.
    """
    by = [*_days(ledger), "symbol"]
    counts = ("frames", "accepted", "duplicates", "regressions", "resets", "trades", "net_missing", "cum_least", "cum_most")
    segments = ledger.groupBy(*by, "phase").agg(*[F.first(c).alias(c) for c in counts], *_losses())
    open_ = lambda c: F.coalesce(F.sum(F.when(F.col("phase") == regular, F.col(c))), F.lit(0))
    seen = segments.groupBy(*by).agg(
        F.sum("accepted").alias("frames"), (F.max("cum_most") > F.min("cum_least")).alias("varied"), open_("trades").alias("trades_observed"), open_("net_missing").alias("net_missing"),
        *[F.sum(c).alias(c) for c in ("duplicates", "regressions", "resets")], F.greatest(F.lit(0), F.sum("intervals") - cap).alias("intervals_truncated"), *[open_(c).alias(c) for c in _LOST],
    )
    more: tuple[str, ...] = ("duplicates", "regressions", "resets", "intervals_truncated")
    if manifest is not None:
        seen, more = seen.join(manifest.select(*by, "manifest_frames"), by, "left"), (*more, "manifest_frames")
    return _ledger(seen, by, more)


def session_totals(totals: DataFrame) -> DataFrame:
    """A row for a session (day): the sums over symbols with a counter, how many lost trades, how many have no counter."""
    ok = F.col("status") == "OK"
    total = lambda c: F.coalesce(F.sum(F.when(ok, c)), F.lit(0))
    lost = F.col("confirmed_missing") + F.col("count_only_missing") > 0
    one = totals.groupBy(*_days(totals)).agg(F.count_if(ok).alias("symbols"), F.count_if(ok & lost).alias("symbols_with_loss"), F.count_if(~ok).alias("symbols_without_counter"), *[total(F.col(c)).alias(c) for c in ("trades_observed", "confirmed_missing", "count_only_missing", "volume_deficit")], total(F.greatest("net_missing", F.lit(0))).alias("net_missing_positive"))
    return one.withColumn("loss_ratio", F.coalesce(F.try_divide(F.col("confirmed_missing"), F.col("trades_observed")), F.lit(0.0)))


def latency_minutes(frames: DataFrame) -> DataFrame:
    """(stream, minute, conn_id): frames, and the lower median, least and most of ``latency_s``."""
    return frames.groupBy("stream", "minute_kst", "conn_id").agg(F.count("*").alias("count"), F.expr("percentile_disc(0.5) within group (order by latency_s)").alias("p50_s"), F.min("latency_s").alias("min_s"), F.max("latency_s").alias("max_s"), F.min("recv_wall_ns").alias("first_ns"), F.max("recv_wall_ns").alias("last_ns"), F.collect_set("symbol").alias("symbols"))


def merge_connections(minutes: DataFrame) -> DataFrame:
    """By (stream, minute): the connection with the most frames is judged with those that don't overlap it; others are secondary.

    A connection is secondary if it overlaps the dominant one in time and shares a symbol with it.
    """
    by = ["stream", "minute_kst"]
    order = Window.partitionBy(*by).orderBy(F.col("count").desc(), F.col("conn_id").desc())
    top = F.first(F.struct("first_ns", "last_ns", "symbols", "conn_id")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = minutes.withColumn("_top", top)
    overlaps = (F.col("first_ns") <= F.col("_top.last_ns")) & (F.col("last_ns") >= F.col("_top.first_ns")) & F.arrays_overlap("symbols", "_top.symbols")
    second = (F.col("conn_id") != F.col("_top.conn_id")) & overlaps
    rows = rows.withColumn("_second", second)
    judged = lambda c: F.when(~F.col("_second"), F.col(c))
    return rows.groupBy(*by).agg(F.sum(judged("count")).alias("count"), F.max(F.when(F.col("conn_id") == F.col("_top.conn_id"), F.col("p50_s"))).alias("p50_s"), F.max(judged("max_s")).alias("max_s"), F.min(judged("min_s")).alias("min_s"), F.coalesce(F.sum(F.when(F.col("_second"), F.col("count"))), F.lit(0)).alias("secondary_count"), F.max(F.when(F.col("_second"), F.col("max_s"))).alias("secondary_max_s"))


def latency_breaches(minutes: DataFrame, start: str, end: str, threshold: float) -> DataFrame:
    """Minutes in [start, end) whose largest latency is above the threshold."""
    return minutes.where((F.substring("minute_kst", 12, 5) >= start) & (F.substring("minute_kst", 12, 5) < end) & (F.col("max_s") > threshold))


def tail_silence(last_second: DataFrame, auction_second: int) -> DataFrame:
    """Seconds from a key's last regular tick to the closing auction, none below 0."""
    return last_second.withColumn("tail_silence_s", F.greatest(F.lit(0), F.lit(auction_second) - F.col("second")))


#: Nanoseconds in which outages meet the ledger's intervals.
OUTAGE_BIN = 600_000_000_000


def outage_split(outages: DataFrame, gaps: DataFrame, bounds: DataFrame, keys: list[str], regular: str = "regular") -> DataFrame:
    """Per session (``keys``) of ``bounds`` the seconds of its outages, and how they divide into silent ones and such with losses.

    ``outages``: keys, gap_start_ns, gap_end_ns of the manifest; ``bounds``: keys, open_ns, close_ns. Outages are clipped to
    the session and merged where they touch. One during which the ledger has an interval of the regular phase (``gaps``:
    keys, phase, recv_prev_ns, recv_next_ns) lost trades, any other was silent. A session without outages has zeros.
    """
    clipped = outages.join(bounds, keys).select(*keys, F.greatest("gap_start_ns", "open_ns").alias("lo"), F.least("gap_end_ns", "close_ns").alias("hi")).where("lo < hi")
    merged = merge_intervals(clipped, keys).select(*keys, F.col("lo").alias("start"), F.col("hi").alias("end"))
    windows = gaps.where(F.col("phase") == regular).select(*keys, F.least("recv_prev_ns", "recv_next_ns").alias("lo"), F.greatest("recv_prev_ns", "recv_next_ns").alias("hi"))
    lost = overlapping(merged, windows, keys, OUTAGE_BIN).withColumn("_lost", F.lit(True))
    seconds = lambda c: F.coalesce(F.sum(F.when(c, F.col("end") - F.col("start"))), F.lit(0)) / 1e9
    marked = merged.join(lost, [*keys, "start", "end"], "left").withColumn("_lost", F.coalesce("_lost", F.lit(False)))
    split = marked.groupBy(*keys).agg(seconds(F.lit(True)).alias("outage_s"), seconds(~F.col("_lost")).alias("silent_s"), seconds(F.col("_lost")).alias("loss_s"), F.count_if(~F.col("_lost")).alias("silent_spans"))
    none = {"outage_s": F.lit(0.0), "silent_s": F.lit(0.0), "loss_s": F.lit(0.0), "silent_spans": F.lit(0)}
    return bounds.select(*keys).join(split, keys, "left").withColumns({c: F.coalesce(c, v) for c, v in none.items()})


def gap_budget(
    totals: DataFrame, warn: float = 1e-4, fail: float = 5e-3, symbol_fail: float = 5e-2, least_trades: int = 100, tail_silence_s: float = 0.0, most_silence_s: float = 600.0,
    outage_s: float = 0.0, most_outage_s: float = 600.0, partial: bool = False, sessions: DataFrame | None = None, keys: tuple[str, ...] = (),
) -> DataFrame:
    """A row per session: its confirmed loss, its worst symbol, the reasons, and PASS, WARN or FAIL against the budget.

    Symbols without a counter are left out. A symbol is judged from ``least_trades`` on; of those over ``symbol_fail`` the
    worst is named and the others counted. A PARTIAL audit also fails by the seconds of outage; without any trades these
    alone decide, which is the ``legacy`` basis. ``sessions`` has, by ``keys``, what is known besides the totals: outage_s,
    silent_s, loss_s, silent_spans (see :func:`outage_split`), tail_silence_s and audit_status; an audit that is neither OK
    nor PARTIAL counts as none. Without it all totals are one session with the seconds given.
    """
    by = list(keys)
    ok = totals.where("status = 'OK'")
    judged = (F.col("trades_observed") >= least_trades) & (F.col("trades_observed") > 0)
    # the least symbol of equals, so the greatest of its negative place
    one = ok.withColumn("_breach", judged & (F.col("loss_ratio") > symbol_fail)).groupBy(*by).agg(
        F.coalesce(F.sum("confirmed_missing"), F.lit(0)).alias("confirmed"),
        F.coalesce(F.sum("trades_observed"), F.lit(0)).alias("trades"),
        F.count_if("_breach").alias("breaching"),
        F.min(F.when(F.col("_breach"), F.struct((-F.col("loss_ratio")).alias("r"), (-F.col("confirmed_missing")).alias("c"), F.col("symbol").alias("s"), F.col("trades_observed").alias("t")))).alias("_worst"),
    )
    if sessions is None:
        one = one.withColumns({"outage_s": F.lit(outage_s), "silent_s": F.lit(0.0), "loss_s": F.lit(outage_s), "silent_spans": F.lit(0), "tail_silence_s": F.lit(tail_silence_s), "audit_status": F.lit("PARTIAL" if partial else "OK")})
    else:
        one = sessions.join(one, by, "left") if by else sessions.join(one)
    matched = F.coalesce(F.col("audit_status").isin("OK", "PARTIAL"), F.lit(False))
    known = lambda c, none: F.when(matched, F.coalesce(c, F.lit(none))).otherwise(F.lit(none))
    one = one.withColumns({"confirmed": known("confirmed", 0), "trades": known("trades", 0), "breaching": known("breaching", 0), "_worst": F.when(matched, F.col("_worst")), "tail_silence_s": known("tail_silence_s", 0.0), "silent_s": known("silent_s", 0.0), "silent_spans": known("silent_spans", 0)})
    one = one.withColumns({"loss_s": F.when(matched, F.col("loss_s")).otherwise(F.col("outage_s")), "loss_ratio": F.coalesce(F.try_divide(F.col("confirmed"), F.col("trades")), F.lit(0.0)), "worst_symbol": F.col("_worst.s")})
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    whole = lambda c: F.floor(c).cast("long")
    late, torn = F.col("outage_s") > most_outage_s, F.col("audit_status") == "PARTIAL"
    ledger = F.col("trades") > 0
    others = F.when(F.col("breaching") > 1, text("+", F.col("breaching") - 1)).otherwise("")
    failing = [
        (late & (torn | ~ledger), text("gap_exceeded:", whole(F.col("outage_s")), F.lit("s"))),
        (ledger & (F.col("loss_ratio") > fail), text("trade_loss_exceeded:", F.col("confirmed"), "/", F.col("trades"))),
        (ledger & (F.col("breaching") > 0), text("symbol_loss_exceeded:", F.col("worst_symbol"), ":", -F.col("_worst.c"), "/", F.col("_worst.t"), others)),
        (ledger & (F.col("tail_silence_s") > most_silence_s), text("tail_silence_exceeded:", whole(F.col("tail_silence_s")), F.lit("s"))),
    ]
    one = one.withColumn("_failed", F.array_compact(F.array(*[F.when(c, v) for c, v in failing])))
    warned = ledger & (F.size("_failed") == 0) & (F.col("loss_ratio") > warn)
    reasons = F.when(warned, F.array(text("trade_loss_warn:", F.col("confirmed"), "/", F.col("trades")))).otherwise(F.col("_failed"))
    status = first_case([(F.size("_failed") > 0, F.lit("FAIL")), (warned, F.lit("WARN"))], "PASS")
    basis = F.when(ledger, F.when(torn, "ledger+legacy").otherwise("ledger")).otherwise("legacy")
    more = ["outage_s", "silent_s", "loss_s", "silent_spans", "tail_silence_s"] if sessions is not None else []
    return one.select(*by, "confirmed", "trades", "loss_ratio", "breaching", "worst_symbol", reasons.alias("reasons"), basis.alias("basis"), status.alias("status"), *more)


def session_reconciliation(sessions: DataFrame, totals: DataFrame, manifests: DataFrame, journals: DataFrame, streams: list[str], keys: list[str], mode: str = "enforce", most_outage_s: float = 600.0, **budget) -> DataFrame:
    """A row per session: what its collection left out, the verdict of the gap budget, and whether the session holds.

    ``sessions``: as for :func:`gap_budget`, with ``repair_pending``; ``manifests``: keys, readable; ``journals``: keys,
    stream, of files that are there. Missing and unreadable manifests and missing streams fail a session whatever its
    losses. With ``mode`` "off", or without a usable audit, the seconds of outage alone decide; "shadow" also says what
    "enforce" would. A session that fails for lost trades only, with its repair pending, holds as PENDING_REPAIR.
    """
    if mode not in ("off", "shadow", "enforce"):
        raise ValueError(f"mode {mode!r} is not known")
    # an unreadable manifest has no outages to count
    there = manifests.groupBy(*keys).agg(F.min(F.coalesce("readable", F.lit(False))).alias("_readable"))
    have = journals.where(F.col("stream").isin(*streams)).groupBy(*keys).agg(F.collect_set("stream").alias("_streams"))
    rows = sessions.join(there, keys, "left").withColumn("outage_s", F.when(F.col("_readable"), F.col("outage_s")).otherwise(0.0))
    verdict = gap_budget(totals, sessions=rows, keys=tuple(keys), most_outage_s=most_outage_s, **budget).withColumnsRenamed({"reasons": "_reasons", "status": "_status"})
    rows = rows.select(*keys, "_readable", F.coalesce("repair_pending", F.lit(False)).alias("_pending")).join(have, keys, "left").join(verdict, keys)
    held = F.coalesce("_streams", F.array().cast("array<string>"))
    structural = [("manifest_missing", F.col("_readable").isNull()), *[(f"journal_missing:{x}", ~F.array_contains(held, x)) for x in streams], ("manifest_unreadable", ~F.col("_readable"))]
    outage = F.when(F.col("outage_s") > most_outage_s, F.array(F.concat(F.lit("gap_exceeded:"), F.floor("outage_s").cast("string"), F.lit("s")))).otherwise(F.array().cast("array<string>"))
    legacy = F.lit(mode != "enforce") | (F.col("basis") == "legacy")
    rows = rows.withColumns({"structural": named_reasons(structural), "reasons": F.when(legacy, outage).otherwise(F.col("_reasons"))})
    lossy = F.exists("reasons", lambda x: ~(x.startswith("trade_loss_exceeded:") | x.startswith("symbol_loss_exceeded:")))
    failed = F.when(legacy, F.size("reasons") > 0).otherwise(F.col("_status") == "FAIL")
    repaired = ~legacy & failed & F.col("_pending") & ~lossy
    status = first_case([(F.size("structural") > 0, F.lit("FAIL")), (repaired, F.lit("PENDING_REPAIR")), (failed, F.lit("FAIL")), (~legacy & (F.col("_status") == "WARN"), F.lit("WARN"))], "PASS")
    would = F.when(F.lit(mode == "shadow") & (F.col("basis") != "legacy"), F.col("_status"))
    return rows.select(*keys, "structural", "reasons", F.when(legacy, "legacy").otherwise(F.col("basis")).alias("basis"), would.alias("would"), status.alias("status"), (status != "FAIL").alias("holds"), "outage_s", "silent_s", "loss_s", "silent_spans")


def top_intervals(gaps: DataFrame, n: int = INTERVAL_CAP) -> DataFrame:
    """A symbol's largest intervals, of a day where ``gaps`` has it."""
    order = Window.partitionBy(*_days(gaps), "symbol").orderBy(F.col("missing_trades").desc(), "recv_prev_ns")
    return gaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def longest_holes(holes: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """A key's longest holes."""
    order = Window.partitionBy(*keys).orderBy(F.col("seconds").desc(), "start")
    return holes.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def session_status(frames: DataFrame, regular: str = "regular") -> DataFrame:
    """A row per session: UNAVAILABLE without a frame of the regular phase, PARTIAL if a file was torn, else OK, with the reason."""
    facts = frames.groupBy(*_days(frames)).agg(F.count("*").alias("rows"), F.count_if("torn").alias("torn_rows"), F.max(F.when(F.col("phase") == regular, F.col("recv_wall_ns"))).alias("last_regular_tick_recv_ns"))
    none = F.col("last_regular_tick_recv_ns").isNull()
    case = lambda a, b, c: first_case([(none, F.lit(a)), (F.col("torn_rows") > 0, F.lit(b))], c)
    return facts.withColumns({"status": case("UNAVAILABLE", "PARTIAL", "OK"), "reason": case("no_decodable_records", "truncated", "ok")})


def session_audit(frames: DataFrame, hole_start: int, hole_end: int, least_hole: int, regular: str = "regular", manifest: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a session's audit: ``gaps``, ``ledger``, ``totals``, ``latency``, ``holes`` and ``status``.

    ``frames``: symbol, phase, cum, volume, cvolume, price, hms, recv_wall_ns, seq, conn_id, stream, minute_kst, latency_s,
    second, torn, and ``dt`` where there are several days, each a session. Losses come from the exact ledger, which is
    written once for all tables that are made of it.
    """
    days = _days(frames)
    ledger = staged(counter_ledger(frames), "ledger")
    totals = staged(ledger_totals(ledger, manifest, regular=regular), "ledger-totals")
    gaps = top_intervals(ledger.where("kind is not null").drop(*_names(_SEGMENT)))
    holes = event_holes(frames.select(*days, "stream", "second"), [*days, "stream"], hole_start, hole_end, least_hole)
    return {"gaps": gaps, "ledger": totals, "totals": session_totals(totals), "latency": merge_connections(latency_minutes(frames)), "holes": holes, "status": session_status(frames, regular)}


def session_check(totals: DataFrame, outages: DataFrame, expected: DataFrame, max_outage_s: int) -> DataFrame:
    """A status row per expected (symbol): missing from the totals, too long out, over its loss budget, or fine.

    ``outages``: symbol, seconds; ``totals`` as of :func:`loss_totals`.
    """
    rows = expected.join(totals, "symbol", "left").join(outages, "symbol", "left")
    status = first_case([(F.col("trades_observed").isNull(), F.lit("NO_FRAMES")), (F.coalesce("seconds", F.lit(0)) > max_outage_s, F.lit("OUTAGE")), (F.col("loss_ratio") > 5e-2, F.lit("LOSS"))], "OK")
    return rows.select("symbol", status.alias("status"))
