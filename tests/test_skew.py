"""A third of all rows in one instant, one bucket, one series, one value or one pair."""

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwellgrid.operators import asof, features, grid, profile
from dwellgrid.plans.catalog import S
from dwellgrid.settings import Settings

SITE = Settings().keyed("site")
HOT = "timestamp_ntz'2024-01-05 08:00:00.123456'"


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 visits over 40 days: a third of them equal in everything."""
    start = "timestamp_ntz'2024-01-01 00:00:00' + (id * 7919 % 3456000) * INTERVAL '1' SECOND"
    return spark.range(0, 30000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS site",
        f"if(id % 3 = 0, {HOT}, {start}) AS entry_time",
        f"if(id % 3 = 0, {HOT} + INTERVAL '25' MINUTE, {start} + (id % 400) * INTERVAL '1' MINUTE) AS exit_time",
        "if(id % 3 = 0, 'RED', 'GREEN') AS risk_category",
        "cast(if(id % 3 = 0, 25, id % 400) AS double) AS duration_min",
    )


def brute_occupancy(v, keys):
    moves = v.selectExpr(*keys, "entry_time AS timestamp", "1L AS change").union(
        v.selectExpr(*keys, "exit_time", "-1L")
    )
    summed = moves.groupBy(*keys, "timestamp").agg(F.sum("change").alias("change"))
    w = Window.partitionBy(*keys).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    return summed.withColumn("active_vehicles", F.sum("change").over(w))


@pytest.mark.parametrize("s", [Settings(), SITE], ids=["one", "keyed"])
def test_event_occupancy(skewed, s):
    ours = grid.event_occupancy(skewed, s)
    names = [*s.keys, "timestamp", "change", "active_vehicles"]
    assert rows_of(ours, *names) == rows_of(brute_occupancy(skewed, list(s.keys)), *names)


def test_grid_keeps_every_visit(skewed):
    check = {r.site: r for r in grid.conservation_check(grid.occupancy_grid(skewed, SITE), SITE).collect()}
    assert sum(r.total_arrivals for r in check.values()) == 30000
    assert check["hot"].total_arrivals == 10000 and all(r.final_active == 0 for r in check.values())
    assert grid.occupancy_grid(skewed.filter("site = 'hot'"), S).count() == 2


def test_counts_at_probes(skewed):
    probes = skewed.selectExpr("site", "entry_time + INTERVAL '10' MINUTE AS probe_ts").distinct()
    probes = probes.filter("probe_ts < timestamp_ntz'2024-01-06 00:00:00'")
    got = asof.counts_at(skewed, probes, SITE).selectExpr("site", "probe_ts", "entered - left AS inside")
    occupancy = brute_occupancy(skewed, ["site"])
    # The last state at or before each probe.
    both = occupancy.selectExpr("site", "timestamp", "active_vehicles", "0 AS probe").union(
        probes.selectExpr("site", "probe_ts", "null", "1")
    )
    w = Window.partitionBy("site").orderBy("timestamp", "probe")
    expected = both.select(
        "*", F.last("active_vehicles", ignorenulls=True).over(w).alias("inside")
    ).filter("probe = 1")
    assert rows_of(got) == rows_of(expected.selectExpr("site", "timestamp", "coalesce(inside, 0L)"))


def test_percentiles_and_duplicates(skewed):
    ours = profile.dwell_by_category(skewed)
    plain = skewed.groupBy("risk_category").agg(
        F.count("duration_min"), *[F.percentile("duration_min", p) for p in (0.5, 0.75, 0.9, 0.95)]
    )
    assert rows_of(ours) == rows_of(plain)
    assert profile.duplicate_members(skewed, ["entry_time", "exit_time"]).filter("site = 'hot'").count() == 10000
    assert profile.duplicate_rows(skewed, skewed.columns).first()[0] >= 9999


def test_wide_frame_of_sparse_series(spark, skewed):
    """Two visits half a year apart: whole chunks without any movement are filled."""
    v = skewed.limit(1).selectExpr("'a' AS site", "entry_time", "exit_time", "risk_category", "duration_min")
    late = v.selectExpr(
        "site", "entry_time + INTERVAL '180' DAY AS entry_time", "exit_time + INTERVAL '180' DAY AS exit_time",
        "risk_category", "duration_min",
    )
    wide = features.wide_frame(v.union(late), SITE)
    lo, hi, n = wide.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first()
    assert n == (hi - lo).total_seconds() / 900 + 1
    assert wide.filter("active_vehicles NOT IN (0, 1)").count() == 0
    assert wide.filter("active_vehicles = 1").count() == 2 * wide.filter("active_vehicles = 1 AND timestamp < timestamp_ntz'2024-03-01'").count()
