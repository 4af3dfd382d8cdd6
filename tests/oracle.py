"""Compares registered queries with their SQL on DuckDB: columns by name, rows as multisets, doubles rounded."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

DATA = Path("/root/testdata")


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.10g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, _plain(v)) for k, v in x.items()))
    if hasattr(x, "asDict"):
        return _plain(x.asDict())
    if type(x).__name__ == "Decimal":
        return _plain(float(x))
    return x


def duck_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(x) for x in r) for r in df.select(*names).collect())


def compare(spark, query, sql: str, sf_dir: str) -> int:
    """Rows compared; raises on any difference."""
    names, want = duck_rows(sql, sf_dir)
    have_names, have = spark_rows(query(spark, sf_dir))
    assert have_names == names, (have_names, names)
    missing, extra = want - have, have - want
    assert not missing and not extra, f"{sum(missing.values())} missing, {sum(extra.values())} extra of {sum(want.values())}: {list(missing)[:2]} against {list(extra)[:2]}"
    return sum(have.values())
