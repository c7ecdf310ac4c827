from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import DATA, rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwellgrid.functions.running import running_total
from dwellgrid.functions.timecols import floor_to
from dwellgrid.operators import features, grid, profile, reliability, supervised
from dwellgrid.plans import catalog
from dwellgrid.plans.catalog import S


def hm(text):
    return datetime.fromisoformat(f"2024-01-01 {text}")


def test_one_visit(make_visits):
    g = grid.occupancy_grid(make_visits([("2024-01-01 10:07:00", "2024-01-01 10:52:00")]))
    assert rows_of(g, "timestamp", "arrivals", "exits", "active_vehicles") == [
        (hm("10:00"), 1, 0, 1),
        (hm("10:15"), 0, 0, 1),
        (hm("10:30"), 0, 0, 1),
        (hm("10:45"), 0, 1, 0),
    ]


def test_bounds_belong_to_the_bucket_they_start(make_visits):
    g = grid.occupancy_grid(make_visits([("2024-01-01 10:15:00", "2024-01-01 10:30:00")]))
    assert rows_of(g, "timestamp", "active_vehicles") == [(hm("10:15"), 1), (hm("10:30"), 0)]


def test_same_bucket_and_silent_gap(make_visits):
    v = make_visits(
        [
            ("2024-01-01 10:01:00", "2024-01-01 10:09:00"),
            ("2024-01-01 13:01:00", "2024-01-01 13:09:00"),
        ]
    )
    g = grid.occupancy_grid(v)
    assert g.count() == 13
    assert {r.net_flow for r in g.collect()} == {0}
    assert rows_of(grid.gap_histogram(g)) == [(15, 12)]


def test_event_occupancy_sums_equal_instants(make_visits):
    v = make_visits(
        [
            ("2024-01-01 10:00:00", "2024-01-01 10:30:00"),
            ("2024-01-01 10:30:00", "2024-01-01 11:00:00"),
        ]
    )
    assert rows_of(grid.event_occupancy(v), "timestamp", "change", "active_vehicles") == [
        (hm("10:00"), 1, 1),
        (hm("10:30"), 0, 1),
        (hm("11:00"), -1, 0),
    ]


def test_flooring_before_1970_and_in_other_zones(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'1969-12-31 23:59:59.5' AS t UNION ALL SELECT timestamp_ntz'2024-03-10 02:31:00.25'"
    ).selectExpr(f"{floor_to('t', 900)} AS b")
    expected = [(datetime(1969, 12, 31, 23, 45),), (datetime(2024, 3, 10, 2, 30),)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert rows_of(df) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("levels", [[], ["b"], ["a", "b"]])
def test_running_total_equals_plain_window(spark, levels):
    df = spark.range(500).selectExpr(
        "if(id % 3 = 0, null, id % 3) AS k", "id AS o", "id * 7 % 11 AS v", "id div 100 AS a", "id div 10 AS b"
    )
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("t", F.sum("v").over(w))
    ours = running_total(df, ["o"], {"t": "v"}, ["k"], levels)
    assert rows_of(ours, "k", "o", "t") == rows_of(plain, "k", "o", "t")


def test_chunk_length_does_not_matter(spark):
    v = catalog.visits(spark, DATA)
    frames = [
        rows_of(features.wide_frame(v, replace(S, chunk_days=days))) for days in (1, 3, 400)
    ]
    assert frames[0] == frames[1] == frames[2]


def test_keyed_frame_is_the_union_of_single_frames(spark):
    v = catalog.visits(spark, DATA, "event_type")
    keyed = features.wide_frame(v, catalog.KEYED)
    for kind in ("view", "error"):
        alone = features.wide_frame(v.filter(F.col("event_type") == kind), S)
        assert rows_of(keyed.filter(F.col("event_type") == kind).drop("event_type")) == rows_of(alone)


@pytest.fixture(scope="module")
def wide(spark):
    from dwellgrid.sources import storage

    return storage.written(catalog.wide_of(spark, DATA), "wide")


def test_rolling_mean_times_four_is_the_hourly_sum(wide):
    for c in ("arrivals", "exits", "net_flow"):
        wrong = wide.filter(f"NOT (rolling_mean_{c}_1h * 4 <=> cast({c}_1h AS double))")
        assert wrong.count() == 0


def test_masks_at_the_gap_edges(wide):
    rows = {r.timestamp: r for r in wide.collect()}

    def at(text):
        return rows[datetime.fromisoformat(text)]

    # The last good row before the weekend has targets only inside it: all null.
    last = at("2024-01-12 23:45:00")
    assert last.is_reliable and last.target_15m is None and last.lag_15m is not None
    first = at("2024-01-15 12:00:00")
    assert first.is_reliable and first.lag_15m is None and first.arrivals_15m is None
    second = at("2024-01-15 12:15:00")
    assert second.lag_15m == first.active_vehicles and second.arrivals_15m == first.arrivals
    assert second.arrivals_30m is None and second.occupancy_change_15m is not None
    assert at("2024-01-15 12:45:00").arrivals_1h is None
    assert at("2024-01-15 13:00:00").arrivals_1h is not None
    # A day later the 24 h lag reads the first reliable row.
    assert at("2024-01-16 11:45:00").lag_24h is None
    assert at("2024-01-16 12:00:00").lag_24h == first.active_vehicles
    # Values in the bad period are kept.
    assert at("2024-01-13 10:00:00").active_vehicles is not None


def test_targets_equal_the_future(wide):
    audit = supervised.target_audit(wide, supervised.long_set(wide, S), S).collect()
    assert len(audit) == 6 and all(r.checked > 0 and r.mismatches == 0 for r in audit)


def test_split_is_complete_and_ordered(wide):
    long = supervised.long_set(wide, S)
    parts = supervised.split(long, S)
    assert sum(p.count() for p in parts) == long.count()
    supervised.check_split(long, S)
    with pytest.raises(ValueError, match="test"):
        supervised.check_split(long, replace(S, validation_end="2030-01-01 00:00:00"))


def test_flag_by_table_equals_flag_by_list(spark):
    g = catalog.grid_of(spark, DATA)
    periods = spark.createDataFrame(S.bad_periods(), "start string, end string").selectExpr(
        "cast(start AS timestamp_ntz) AS start", "cast(end AS timestamp_ntz) AS end"
    )
    assert rows_of(reliability.flag_from_table(g, periods, S)) == rows_of(reliability.flag(g, S))
    # Bounds between bucket starts: only starts inside the period count.
    odd = periods.selectExpr("start + INTERVAL '1' MINUTE AS start", "end + INTERVAL '1' MINUTE AS end").limit(1)
    bad = reliability.flag_from_table(g, odd, S).filter("NOT is_reliable")
    lo, hi = bad.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert hi - lo == timedelta(hours=24) - timedelta(minutes=15) and lo.minute == 15


def test_overlap_is_open_at_the_start(spark):
    rows = [
        ("2024-01-12 20:00:00", "2024-01-13 00:00:00", False),
        ("2024-01-12 20:00:00", "2024-01-13 00:00:01", True),
        ("2024-01-14 10:00:00", "2024-01-14 10:00:00", False),
        ("2024-01-15 12:00:00", "2024-01-15 13:00:00", False),
        ("2024-01-15 11:59:59", "2024-01-15 13:00:00", True),
    ]
    df = spark.createDataFrame(rows, "a string, b string, hit boolean").selectExpr(
        "cast(a AS timestamp_ntz) AS entry_time", "cast(b AS timestamp_ntz) AS exit_time", "hit"
    )
    assert reliability.interval_overlap(df, S).filter("hit != overlaps_bad").count() == 0


def test_ties_midnight_and_week(make_visits):
    v = make_visits(
        [
            ("2024-01-01 01:00:00", "2024-01-01 01:20:00"),
            ("2024-01-01 05:00:00", "2024-01-01 05:20:00"),
            ("2024-01-01 23:50:00", "2024-01-02 00:10:00"),
            ("2024-01-02 08:00:00", "2024-01-02 08:10:00"),
        ]
    )
    g = grid.occupancy_grid(v, S)
    peaks = {r.date.day: r.peak_hour for r in profile.daily_occupancy(g, S).collect()}
    assert peaks[1] == 1
    states = {r.date.day: (r.starting_occupancy, r.ending_occupancy) for r in profile.daily_state(v, S).collect()}
    assert states == {1: (0, 1), 2: (1, 0)}
    week = make_visits([(f"2024-01-{d:02d} 09:00:00", f"2024-01-{d:02d} 09:10:00") for d in range(1, 8)])
    days = {r.entry_date.day: r.day_of_week for r in profile.with_calendar(week).collect()}
    assert days == {d: d - 1 for d in range(1, 8)}


def test_duplicates(make_visits):
    a, b = ("2024-01-01 09:00:00", "2024-01-01 09:10:00"), ("2024-01-01 09:00:00", "2024-01-01 09:20:00")
    v = make_visits([(*a, "RED"), (*a, "GREEN"), (*b, "RED"), (*b, "RED"), ("2024-01-01 10:00:00", "2024-01-01 10:01:00")])
    assert profile.duplicate_members(v, ["entry_time", "exit_time"]).count() == 4
    assert profile.duplicate_rows(v, v.columns).first()[0] == 1


def test_bucket_width_is_a_parameter(spark):
    with pytest.raises(ValueError):
        replace(S, bucket_minutes=4)
    v = catalog.visits(spark, DATA)
    fine = features.wide_frame(v, replace(S, bucket_minutes=5))
    coarse = features.wide_frame(v, S)
    # The end of a 15-minute bucket is the end of its third 5-minute bucket.
    both = coarse.select("timestamp", "active_vehicles", "is_reliable").join(
        fine.selectExpr("timestamp - INTERVAL '10' MINUTE AS timestamp", "active_vehicles AS a", "lag_1h"), "timestamp"
    )
    assert both.count() > 2800 and both.filter("a != active_vehicles").count() == 0
    lagged = fine.selectExpr("timestamp + INTERVAL '1' HOUR AS timestamp", "active_vehicles AS before", "is_reliable AS ok")
    joined = fine.filter("lag_1h IS NOT NULL").join(lagged, "timestamp")
    assert joined.filter("before != lag_1h OR NOT ok").count() == 0
    assert joined.count() == lagged.filter("ok").join(fine, "timestamp").count() > 0


def test_rows_of_an_instant_meet_before_they_are_aggregated(make_visits):
    """The wide aggregation buffers are not laid out in the tasks that count movements."""
    from dwellgrid.operators import asof

    visits = make_visits([("2026-09-01 10:00:00", "2026-09-01 10:40:00"), ("2026-09-01 10:20:00", "2026-09-01 11:00:00")])
    found = asof.features_at(visits, visits.selectExpr("entry_time AS prediction_time"))
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "partial_max" in line)
    below = next(line for line in plan[at + 1 :] if "Project" not in line)
    assert "Exchange hashpartitioning(prediction_time" in below
    rows = sorted((str(r["prediction_time"]), r["active_vehicles"], r["arrivals_30m"]) for r in found.collect())
    assert rows == [("2026-09-01 10:00:00", 1, 1)] * 6 + [("2026-09-01 10:20:00", 2, 2)] * 6
