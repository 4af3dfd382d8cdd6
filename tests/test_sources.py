"""Line files of compressed frames, strict and tolerant; keyed month tables; conflicts and guards that fail a query."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import dedup, universe, validation
from tickloom.sources import l0, store


def rows(n, start=0):
    return [{"raw": f"r{i}", "recv_mono_ns": i, "recv_wall_ns": i, "conn_id": "c", "conn_seq": i, "vendor": "ls", "tr_id": "H0STCNT0"} for i in range(start, start + n)]


def folder(tmp_path):
    d = tmp_path / "ls/krx/regular/H0STCNT0/dt=2024-01-02"
    d.mkdir(parents=True)
    return d


def test_files_of_many_frames(spark, tmp_path):
    l0.write_zstd_frames(str(folder(tmp_path) / "09.jsonl.zst"), [rows(5), rows(5, 5)])
    got = l0.read_strict(spark, str(tmp_path)).collect()
    assert len(got) == 10 and {(r.venue, r.session, r.stream, r.symbol) for r in got} == {("krx", "regular", "H0STCNT0", "")}


def test_null_in_a_required_column_fails(spark, tmp_path):
    bad = rows(2)
    bad[1]["conn_id"] = None
    l0.write_zstd_frames(str(folder(tmp_path) / "09.jsonl.zst"), [bad])
    with pytest.raises(Exception, match="required"):
        l0.read_strict(spark, str(tmp_path)).collect()


def test_torn_file_keeps_what_was_written(spark, tmp_path):
    d = folder(tmp_path)
    l0.write_zstd_frames(str(d / "09.jsonl.zst"), [rows(50), rows(50, 50)], tear=20)
    l0.write_zstd_frames(str(d / "10.jsonl.zst"), [rows(3, 200)])
    got = l0.decode_envelopes(l0.read_tolerant(spark, str(tmp_path))).collect()
    torn = [r for r in got if r.truncated]
    assert 50 <= len(torn) < 100 and len(got) - len(torn) == 3 and [r.conn_seq for r in torn] == list(range(len(torn)))


def test_upsert_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "bars")
    make = lambda data: spark.createDataFrame(data, "date string, symbol string, close double").withColumn("date", F.to_date("date"))
    assert store.upsert_months(spark, path, make([("2024-01-02", "A", 1.0), ("2024-02-02", "A", 2.0)]), ["date", "symbol"]) == 2
    kept = {p.name for p in (tmp_path / "bars/month=2024-01").iterdir() if p.suffix == ".parquet"}
    assert store.upsert_months(spark, path, make([("2024-02-02", "A", 3.0), ("2024-02-03", "B", 4.0)]), ["date", "symbol"]) == 1
    schema = make([]).schema
    assert sorted((r.symbol, r.close) for r in store.scan_months(spark, path, schema).collect()) == [("A", 1.0), ("A", 3.0), ("B", 4.0)]
    assert kept == {p.name for p in (tmp_path / "bars/month=2024-01").iterdir() if p.suffix == ".parquet"}
    scan = store.scan_months(spark, path, schema, "2024-02-01", "2024-02-28")
    assert "PartitionFilters: [isnotnull(month" in scan._jdf.queryExecution().executedPlan().toString()


def test_two_payloads_of_a_key_fail(spark):
    df = spark.createDataFrame([("c", 1, "a", 0), ("c", 1, "b", 1)], "conn_id string, conn_seq long, raw string, pos int")
    with pytest.raises(Exception, match="two payloads"):
        dedup.dedup_l0(df, ["pos"]).collect()
    assert dedup.dedup_l0(df, ["pos"], strict=False).first().raw == "a"


def test_guards(spark):
    late = spark.createDataFrame([("A", "2024-01-05")], "symbol string, date string").withColumn("date", F.to_date("date"))
    with pytest.raises(Exception, match="lookahead"):
        universe.check_lookahead(late, F.to_date(F.lit("2024-01-04"))).collect()
    with pytest.raises(ValueError):
        validation.rename_legacy(spark.createDataFrame([(1, 2)], "old int, new int"), {"old": "new"})
    from tickloom.operators.decode import decode

    with pytest.raises(Exception, match="unsupported vendor"):
        decode(spark.createDataFrame([("x", "zzz")], "raw string, vendor string")).collect()


def test_partitioning_does_not_change_results(spark):
    from tests.oracle import DATA, spark_rows
    from tickloom.plans import QUERIES

    one = spark_rows(QUERIES["o2_counter_gaps"](spark, str(DATA / "sf0.001")))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert spark_rows(QUERIES["o2_counter_gaps"](spark, str(DATA / "sf0.001"))) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_stream_equals_batch(spark):
    from tests.oracle import DATA, spark_rows
    from tickloom.plans import QUERIES

    sf = str(DATA / "sf0.001")
    assert spark_rows(QUERIES["x6_failover_stream"](spark, sf)) == spark_rows(QUERIES["x6_controller"](spark, sf))


def test_guards_hold_whichever_columns_are_read(spark, tmp_path):
    from tickloom.operators import coverage

    late = spark.createDataFrame([("A", "2024-01-05")], "symbol string, date string").withColumn("date", F.to_date("date"))
    two = spark.createDataFrame([("c", 1, "a", 0), ("c", 1, "b", 1)], "conn_id string, conn_seq long, raw string, pos int")
    bad = rows(2)
    bad[1]["conn_id"] = None
    l0.write_zstd_frames(str(folder(tmp_path) / "09.jsonl.zst"), [bad])
    trade = spark.createDataFrame([("A", 1, 5, 3, 1)], "symbol string, at long, buy long, sell long, net long")
    for df, text in ((universe.check_lookahead(late, F.to_date(F.lit("2024-01-04"))), "lookahead"), (dedup.dedup_l0(two, ["pos"]), "two payloads"), (l0.read_strict(spark, str(tmp_path)), "required"), (coverage.latest_trade(trade, ["symbol"], "at"), "net is not")):
        with pytest.raises(Exception, match=text):
            df.count()
        with pytest.raises(Exception, match=text):
            df.select(df.columns[0]).collect()


def test_log_lines(spark, tmp_path):
    d = tmp_path / "log"
    d.mkdir()
    (d / "a.jsonl").write_text('{"n": 1}\n\n[5]\n{"n": 2}\n{"n": ')
    (d / "b.jsonl").write_text('{"n": 3}\n')
    assert sorted(r.n for r in l0.read_log(spark, str(d), "n long").collect()) == [1, 2, 3]
    (d / "b.jsonl").write_text('{"n": 3}\n{"n": \n')
    with pytest.raises(ValueError, match="malformed"):
        l0.read_log(spark, str(d), "n long")
    (d / "b.jsonl").write_text('{"n": \n{"n": 3}')
    with pytest.raises(ValueError, match="malformed"):
        l0.read_log(spark, str(d), "n long")
    assert sorted(r.n for r in l0.read_log(spark, str(d), "n long", strict=False).collect()) == [1, 2, 3]


def test_templates_and_copies(spark):
    paths = {
        "l0/kis/dt=2024-01-02/09.jsonl": ("l0/kis/dt=*/{hh}.jsonl", "2024-01-02"),
        "x/20240105.parquet": ("x/*.parquet", "2024-01-05"),
        "x/run-2024-03/005930.csv": ("x/run-2024-03/{sym}.csv", None),
        "x/2024-03/BTCUSDT.csv": ("x/*/{sym}.csv", "2024-03"),
        "202401.zip": ("*.zip", "2024-01"),
        "y/day=run_1.gz/deadbeef12": ("y/day=*.gz/*", None),
    }
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: (r.t, r.d) for r in df.select("path", store.path_template(F.col("path")).alias("t"), store.path_date(F.col("path")).alias("d")).collect()}
    assert got == paths
    listing = [("a", 10, None), ("a", 10, None), ("b", 10, "x"), ("b", 10, "x"), ("c", 10, None), ("c", 99, None), ("d", 1, "x")]
    kinds = {r.name: r.kind for r in store.duplicate_names(spark.createDataFrame(listing, "name string, bytes long, md5 string")).collect()}
    assert kinds == {"a": "conflicting", "b": "identical", "c": "conflicting"}


def test_origins(spark):
    from tickloom.operators import coverage

    paths = {"snapshot/ohlcv/dt=2026-11-20": "rest_snapshot", "history/tick_tape/dt=2026-11-20": "rest_backfill", "history/minute/dt=2026-11-20": "rest_minute", "kis/krx/regular/H0STCNT0/dt=2026-11-20": "ws_realtime"}
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r.path: r.o for r in df.select("path", coverage.origin_of_path(F.col("path")).alias("o")).collect()} == paths
    for p in ("derived/ticks_repaired/dt=2026-11-20", "snapshot", "history/tick_tape", "kis/krx/dt=2026-11-20", "other/a/b/c/d"):
        with pytest.raises(Exception, match="origin"):
            spark.createDataFrame([(p,)], "path string").select(coverage.origin_of_path(F.col("path"))).collect()


def test_vendor_names_of_quotes(spark):
    import json

    from tickloom.operators.decode import db_quotes

    body = {"ShrnIscd": "005930", "BsopHour": "101500", "TotalAskprsqn": "1000", "TotalBidprsqn": "900"} | {f"{p}{k}": str(k) for p in ("Askp", "Bidp", "AskpRsqn", "BidpRsqn") for k in range(1, 11)}
    r = db_quotes(spark.createDataFrame([(json.dumps({"body": body}),)], "raw string")).first()
    assert (r.shcode, r.hotime, r.totofferrem, r.totbidrem, r.offerho10) == ("005930", 101500, 1000, 900, 10)


def test_a_batch_that_runs_again_stores_its_rows_once(spark, tmp_path):
    from tickloom.streaming import monitors

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    stream = lambda: spark.readStream.schema("id long").parquet(src)
    assert monitors.run_available(stream(), out).count() == 5
    for f in (tmp_path / "out/state/commits").iterdir():  # as if the driver was lost before the batch was committed
        f.unlink()
    assert sorted(r.id for r in monitors.run_available(stream(), out).collect()) == [0, 1, 2, 3, 4]


def test_part_keys_of_over_six_digits_are_rows_of_their_own(spark, tmp_path):
    from tests.oracle import compare
    from tickloom import plans

    parts = [(k, 1 + k % 7, 900.0 + k % 5) for k in [*range(999_990, 1_000_060), 3, 100_000]]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    assert compare(spark, plans.QUERIES["s20_trading_rows"], plans.ORACLE["s20_trading_rows"], str(tmp_path)) == len(parts)
