"""Streams in slices give what one trigger with all rows does; the controller's fold goes on from batch to batch."""

import pytest

from tests.oracle import DATA, compare
from tickloom import plans
from tickloom.operators import monitoring
from tickloom.plans import streams


@pytest.mark.parametrize("name", ["x1_tracker", "x2_lag_stream"])
def test_slices(spark, monkeypatch, name):
    monkeypatch.setattr(streams, "SLICE_ROWS", 400)
    assert compare(spark, plans.QUERIES[name], plans.ORACLE[name], str(DATA / "sf0.001")) > 0


def test_controller_in_batches_and_slices(spark, monkeypatch):
    sf = str(DATA / "sf0.001")
    want = sorted(map(tuple, plans.QUERIES["x6_controller"](spark, sf).collect()))
    monkeypatch.setattr(streams, "SLICE_ROWS", 400)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert want == sorted(map(tuple, plans.QUERIES["x6_controller"](spark, sf).collect()))
        assert want == sorted(map(tuple, plans.QUERIES["x6_failover_stream"](spark, sf).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_snapshot_sums_and_sorts_nothing_again():
    """A window of very many seconds costs a snapshot no more than a short one."""
    h = monitoring.Health(window_s=10**9, every=1, most=5, least=1)
    for n in range(20):
        h.frame(n * monitoring.NS, float(n * 7 % 20))
    assert h.in_window == 20 and h.ordered == sorted(lag for _, lag in h.lags) and len(h.ordered) == 5
    assert h.snapshot(20 * monitoring.NS)[6:10] == (20, h.ordered[2], h.ordered[4], 5)
