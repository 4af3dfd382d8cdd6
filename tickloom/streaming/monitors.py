"""Feed monitors as Structured Streaming: windowed health and lag, deduplication, and the failover machine with kept state."""

from __future__ import annotations

import json
import pickle
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.operators.control import STEP_SCHEMA, Failover, FailoverRules, advance_group
from tickloom.operators.monitoring import SNAPSHOT, Health, Lag, Silence


def with_time(frames: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Frames with a watermark on ``ts``; the stored frames stay the truth, so late rows may be left out of a monitor."""
    return frames.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def health(frames: DataFrame, width: str = "60 seconds", slide: str = "30 seconds", least: int = 20) -> DataFrame:
    """Frames and nearest-rank lag percentiles of each feed in sliding windows; percentiles need ``least`` samples."""
    rank = lambda p: F.expr(f"percentile_disc({p}) within group (order by lag_s)")
    rows = frames.groupBy(F.window("ts", width, slide), "feed").agg(F.count("*").alias("frames"), F.count("lag_s").alias("samples"), rank(0.5).alias("_p50"), rank(0.99).alias("_p99"))
    enough = F.col("samples") >= least
    return rows.select("feed", F.col("window.start").alias("start"), "frames", F.when(enough, F.col("_p50")).alias("p50_s"), F.when(enough, F.col("_p99")).alias("p99_s"))


def lag_windows(frames: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Samples and median lag of each stream in tumbling windows."""
    rows = frames.groupBy(F.window("ts", width), "stream").agg(F.count("*").alias("samples"), F.percentile("lag_s", F.lit(0.5)).alias("p50_s"))
    return rows.select("stream", F.col("window.start").alias("start"), "samples", "p50_s")


def sessions(frames: DataFrame, gap: str) -> DataFrame:
    """Runs of frames of a feed without a silence of ``gap``."""
    rows = frames.groupBy(F.session_window("ts", gap), "feed").agg(F.count("*").alias("frames"), F.max("ts").alias("last"))
    return rows.select("feed", F.col("session_window.start").alias("start"), "last", "frames")


def unique_frames(frames: DataFrame) -> DataFrame:
    """The first arrival of each (conn_id, conn_seq) within the watermark."""
    return frames.dropDuplicatesWithinWatermark(["conn_id", "conn_seq"])


def failover(steps: DataFrame, rules: FailoverRules | None = None) -> DataFrame:
    """The failover machine over a stream of (group_id, step_s, status); each group's machine is its state."""
    used = rules or FailoverRules()
    fields = list(asdict(Failover()))

    def advance(key, frames, state: GroupState):
        machine = Failover(**dict(zip(fields, state.get, strict=True))) if state.exists else Failover()
        rows = pd.concat(list(frames))
        out = advance_group(machine, rows, used)
        state.update(tuple(asdict(machine).values()))
        yield out

    kinds = ", ".join(f"{n} {'string' if n == 'state' else 'long'}" for n in fields)
    return steps.groupBy("group_id").applyInPandasWithState(advance, STEP_SCHEMA, kinds, "append", GroupStateTimeout.NoTimeout)


def silence(frames: DataFrame, windows: list[tuple[int, int]], limit: int) -> DataFrame:
    """Alarms of :func:`tickloom.operators.monitoring.silence_alarms` while the frames (feed, at, ts with a watermark) come, times in microseconds.

    ``windows`` are the sessions in which feeds are watched, in order. An alarm is told once the watermark has passed it, by
    a frame or by a timer of event time, so frames that come out of order within the watermark raise none. A feed's state is
    the runs of its frames behind which none can change: as many as limits fit into the watermark's delay, and one more.
    """

    def watch(key, batches, state: GroupState):
        machine = Silence(windows, limit, *(json.loads(state.get[0]) if state.exists else ()))
        for rows in batches:
            machine.add(rows["at"].tolist())
        passed = state.getCurrentWatermarkMs() * 1000
        found = machine.alarms(passed) if passed > 0 else []
        state.update((json.dumps([machine.runs, machine.done]),))
        due = machine.next_alarm()
        if due is not None:
            state.setTimeoutTimestamp(max(due, passed) // 1000 + 1)
        if found:
            yield pd.DataFrame([(key[0], *x) for x in found], columns=["feed", "alarm_at", "silent_since"])

    return frames.groupBy("feed").applyInPandasWithState(watch, "feed string, alarm_at long, silent_since long", "held string", "append", GroupStateTimeout.EventTimeTimeout)


def _in_order(batches, by: list[str]):
    """A group's rows of one trigger in order; how many there can be is bounded by the source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``."""
    return pd.concat(list(batches)).sort_values(by, kind="stable")


def lag_alerts(frames: DataFrame, threshold: float, window_ns: int, least: int = 5) -> DataFrame:
    """Turns of each stream's lag as its frames (stream, recv_wall_ns, seq, conn_id, symbol, lag_s) come, triggers in order of time.

    A stream's state is its counters and the samples of its open window.
    """

    def observe(key, batches, state: GroupState):
        machine = pickle.loads(state.get[0]) if state.exists else Lag(threshold, window_ns, least)  # noqa: S301  its own state
        rows = _in_order(batches, ["recv_wall_ns", "seq"])
        lags = [None if pd.isna(x) else float(x) for x in rows["lag_s"]]
        turns = [(key[0], *t) for t in (machine.observe(*x) for x in zip(rows["recv_wall_ns"].tolist(), rows["conn_id"].tolist(), rows["symbol"].tolist(), lags, strict=True)) if t]
        state.update((pickle.dumps(machine),))
        if turns:
            yield pd.DataFrame(turns, columns=["stream", "window", "status", "p50_s", "max_s", "samples"])

    return frames.groupBy("stream").applyInPandasWithState(observe, "stream string, window long, status string, p50_s double, max_s double, samples long", "held binary", "append", GroupStateTimeout.NoTimeout)


def health_snapshots(events: DataFrame, **settings) -> DataFrame:
    """Snapshots of each feed's health as its events come, triggers in order of time.

    ``events``: feed, at (nanoseconds), seq, kind (frame, connected, disconnected, acks, snapshot), lag_s, reason, planned,
    accepted, rejected. A feed's state holds a count for each second of the window and a bounded number of sampled lags.
    """

    def follow(key, batches, state: GroupState):
        machine = pickle.loads(state.get[0]) if state.exists else Health(**settings)  # noqa: S301  its own state
        out = []
        for e in _in_order(batches, ["at", "seq"]).itertuples():
            if e.kind == "frame":
                machine.frame(int(e.at), None if pd.isna(e.lag_s) else float(e.lag_s))
            elif e.kind == "connected":
                machine.connect()
            elif e.kind == "disconnected":
                machine.disconnect(e.reason)
            elif e.kind == "acks":
                machine.acks(int(e.at), *(0 if pd.isna(x) else int(x) for x in (e.planned, e.accepted, e.rejected)))
            elif e.kind == "snapshot":
                out.append((key[0], *machine.snapshot(int(e.at))))
        state.update((pickle.dumps(machine),))
        if out:
            yield pd.DataFrame(out, columns=["feed", *[c.split()[0] for c in SNAPSHOT.split(", ")]])

    return events.groupBy("feed").applyInPandasWithState(follow, f"feed string, {SNAPSHOT}", "held binary", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over all input there is into a table under ``path`` and return it; ``complete`` results replace the table each time.

    A batch has a folder of its own, which it replaces if it runs again after a failure, so no row is stored twice.
    """
    table = f"{path}/table"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={0 if mode == 'complete' else number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(table).select(*stream.columns)
