"""Driver contract smoke: entry() runs; every query has a callable; oracles are keyed by queries."""

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r["day_segment"] for r in rows} <= {"weekend", "weekday"} and len(rows) == 2


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
