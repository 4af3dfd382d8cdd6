"""What a row needs for many of its columns is computed once, not once a column."""

import re

from pyspark.sql import functions as F

from tickloom.operators import decode as d
from tickloom.operators.quality import quote_flags, quote_summary
from tickloom.sources import l0


def _optimized(df) -> str:
    """The optimized plan, written out whole."""
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.debug.maxToStringFields")


def test_a_path_is_matched_once_for_all_fields_of_its_route(spark, tmp_path):
    spark.range(3).select(F.lit("x").alias("raw"), *[F.col("id").alias(n) for n in ("recv_mono_ns", "recv_wall_ns", "conn_seq")], *[F.lit("a").alias(n) for n in ("conn_id", "vendor", "tr_id")]).write.json(f"{tmp_path}/ls/nxt/aftermarket/H0/dt=2024-01-01")
    df = l0.read_strict(spark, str(tmp_path))
    assert [tuple(r) for r in df.select("venue", "session", "stream").distinct().collect()] == [("nxt", "aftermarket", "a")]
    # one for the folders, and at most two in the branch of paths without a known session
    assert _optimized(df).count("regexp_extract(") <= 3


def test_routes_are_those_of_the_pattern_tried_from_every_character(spark):
    paths = ["file:/x/ls/nxt/aftermarket/H0/dt=1/a", "ls/nxt/regular/H0/dt=1/a", "nxt/regular/H0/dt=1/a", "/a/b/c/d/dt=1/ls/krx/premarket/T/dt=2/x", "/ls/krx/regular/T/dt=/a", "/ls/krx/regular/T/dt=1", "dt=1/a", "T/dt=1/a", "//T/dt=1/a", "/ls//regular/T/dt=1/a", "/q/dt=5/ls/krx/regular/T/dt=1/a", "/ls/krx/regular/dt=3/dt=4/a", "/a b/ls/krx/regular/T/xdt=1/dt=2/a", ""]
    r = l0.route(F.col("p"))
    got = {x.p: (x.vendor, x.venue, x.session, x.stream) for x in spark.createDataFrame([(p,) for p in paths], "p string").select("p", *[r[n].alias(n) for n in r]).collect()}
    for p in paths:
        m, old = re.search("([^/]+)/([^/]+)/([^/]+)/([^/]+)/dt=[^/]+/", p), re.search("([^/]+)/dt=[^/]+/", p)
        assert got[p] == (m.groups() if m and m[3] in l0.SESSIONS else (None, "krx", "regular", old[1] if old else None)), p


def test_a_payload_is_split_once_for_all_its_fields(spark):
    raw = "^".join(["005930", "090000", "0", *[str(100 + k) for k in range(10)], *[str(99 - k) for k in range(10)], *["1"] * 20, "10", "x"])
    df = spark.createDataFrame([(raw,), ("a^b",), (None,), (raw.rpartition("^")[0],)], "raw string")
    quotes = d.kis_quotes(df)
    assert [(r.shcode, r.hotime, r.offerho10, r.bidho10, r.bidrem10, r.totofferrem, r.totbidrem) for r in quotes.collect()] == [("005930", 90000, 109, 90, 1, 10, None), *[(None,) * 7] * 3]
    for out in (quotes, d.kis_ticks(df), quote_summary(quote_flags(quotes.withColumn("dt", F.lit("d"))), "dt")):
        assert "_parts" not in out.columns
        assert _optimized(out).count("split(") <= 2
