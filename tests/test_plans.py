"""Every registered query equals its SQL on the smallest tables; those without SQL run and give rows."""

import pytest

from tests.oracle import DATA, compare
from tickloom import plans


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    sf = str(DATA / "sf0.001")
    if name in plans.ORACLE:
        assert compare(spark, plans.QUERIES[name], plans.ORACLE[name], sf) > 0
    else:
        assert plans.QUERIES[name](spark, sf).count() > 0


def test_flagship(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["symbol", "trades_observed", "missing", "loss_ratio"] and rows.count() > 0
