"""Registered queries against their SQL twins; set ALL_QUERIES=1 for every one of them."""

import os

import duckdb
import pytest
from conftest import DATA

from dwellgrid.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SOME = [
    "gbt_rows",
    "forecast_or_reason",
    "validation_stats",
    "visits_lenient",
    "visits_clean",
    "occupancy_grid_keyed",
    "event_occupancy_keyed",
    "longest_segment",
    "supervised_csv_roundtrip",
    "split_bounds",
    "exact_features_batch_keyed",
    "prediction_eligibility",
    "duration_worst",
    "dwell_stats",
    "dwell_by_category",
    "daily_detail",
    "daily_detail_keyed",
    "mismatch_days_keyed",
    "hourly_net_flow_keyed",
    "prediction_eligibility_keyed",
    "exact_features_latest",
    "targets_raw",
    "grid_null_audit",
    "hourly_counts_filled",
    "pacf",
    "baseline_previous_day",
    "promotion_decision",
    "parse_events",
]
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("ALL_QUERIES") else SOME)
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted((tuple(r) for r in found.fetchall()), key=repr)
    ours = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert ours == theirs
