"""Core registered queries vs their DuckDB oracles on the smallest data set."""

import sys
import os

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import canon  # noqa: E402
from staylens.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
CORE = ["clean_listings", "rejected_calendar", "calendar_summary", "listing_master", "dim_host",
        "report_occupancy_proxy_distribution", "snapshot_diff", "eda_market_concentration",
        "stats_kruskal_neighbourhood_price", "validation_listing_master", "cdc_scd2_history",
        "profile_iqr_outliers"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    od = con.execute(E.oracle_sql()[name]).df()
    sc, sr = canon(sp)
    oc, orr = canon(od)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr
