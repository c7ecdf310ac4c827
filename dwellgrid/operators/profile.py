"""Descriptive queries over visits and over the occupancy grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.quantiles import percentiles
from dwellgrid.functions.running import running_total
from dwellgrid.functions.timecols import minutes_between, ts_lit
from dwellgrid.operators.grid import movements
from dwellgrid.settings import Settings

# Percentiles and thresholds of the dwell report.
DWELL_PERCENTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
TAIL_PERCENTILES = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
CATEGORY_PERCENTILES = {"median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}
TAIL_THRESHOLDS = (600.0, 700.0, 710.0, 719.0, 719.9)
EXTREME_DWELL = 600.0
SKETCH_BITS = 14  # 2**14 registers, a standard error under one per cent
HISTOGRAM_BINS = 72


def _count() -> Column:
    return F.count(F.lit(1))


def is_complete_day(day: Column, s: Settings = Settings()) -> Column:
    return ~day.isin([F.lit(d).cast("date") for d in s.bad_dates])


def with_calendar(visits: DataFrame) -> DataFrame:
    """Entry date, hour, day name and weekday number of every visit."""
    entry = F.col("entry_time")
    return visits.withColumns(
        {
            "entry_date": F.to_date(entry),
            "entry_hour": F.hour(entry),
            "entry_day": F.date_format(entry, "EEEE"),
            "day_of_week": F.weekday(entry),
        }
    )


def complete_days(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    return with_calendar(visits).filter(is_complete_day(F.col("entry_date"), s))


# ---- durations -------------------------------------------------------------------------


def _with_difference(visits: DataFrame) -> DataFrame:
    computed = minutes_between("entry_time", "exit_time")
    return visits.selectExpr(
        "*", f"{computed} AS computed_min", f"duration_min - {computed} AS difference_min"
    )


def duration_check(visits: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """How far the stored durations are from the timestamps."""
    gap = F.abs(F.col("difference_min"))
    return _with_difference(visits).agg(
        F.max(gap).alias("max_abs_diff"),
        F.avg(gap).alias("mean_abs_diff"),
        F.count_if(gap > tolerance).alias("over_tolerance"),
    )


def duration_worst(visits: DataFrame, n: int = 10) -> DataFrame:
    gap = F.abs(F.col("difference_min"))
    return (
        _with_difference(visits)
        .select("entry_time", "exit_time", "duration_min", "computed_min", "difference_min")
        .orderBy(F.desc(F.round(gap, 9)), "entry_time", "exit_time", "duration_min")
        .limit(n)
    )


# ---- quality ---------------------------------------------------------------------------


def _values_of(visits: DataFrame, columns: list[str], more: str = "") -> DataFrame:
    """One row per row and column: the column's name and its value as text."""
    cells = ", ".join(f"struct('{c}' AS column_name, cast(`{c}` AS string) AS value)" for c in columns)
    return visits.selectExpr(*([more] if more else []), f"inline(array({cells}))")


def quality_summary(visits: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Missing count, missing percent and distinct count per column.

    Exact counts come from one aggregation per value, map-side first, so that a frequent value is one row per
    task; approximate ones from sketches, which shuffle nothing but themselves.
    """
    if approximate:
        found = united_sketches(_sketches(_values_of(visits, columns), ["column_name"]))
    else:
        per_value = _values_of(visits, columns).groupBy("column_name", "value").agg(_count().alias("__n"))
        found = per_value.groupBy("column_name").agg(
            F.sum("__n").alias("n"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("__n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("distinct_values"),
        )
    return found.select(
        "column_name",
        "missing",
        (F.col("missing") * 100.0 / F.col("n")).alias("missing_pct"),
        "distinct_values",
    )


def _sketches(values: DataFrame, by: list[str]) -> DataFrame:
    return values.groupBy(*by).agg(
        _count().alias("n"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.hll_sketch_agg("value", F.lit(SKETCH_BITS)).alias("sketch"),
    )


def daily_sketches(visits: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, missing values and a distinct-count sketch per entry day and column, to be stored.

    A new day adds rows to the stored table; nothing that was counted is read again.
    """
    return _sketches(_values_of(visits, columns, "to_date(entry_time) AS day"), ["day", "column_name"])


def united_sketches(sketches: DataFrame) -> DataFrame:
    """Rows, missing values and distinct values per column, over any set of sketches."""
    return sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )


def timestamp_quality(visits: DataFrame) -> DataFrame:
    return visits.agg(
        F.count_if(F.col("entry_time").isNull()).alias("missing_entry"),
        F.count_if(F.col("exit_time").isNull()).alias("missing_exit"),
        F.count_if(F.col("entry_time") >= F.col("exit_time")).alias("entry_not_before_exit"),
        F.count_if(F.col("duration_min") <= 0).alias("duration_not_positive"),
        F.min("entry_time").alias("earliest_entry"),
        F.max("entry_time").alias("latest_entry"),
        F.min("exit_time").alias("earliest_exit"),
        F.max("exit_time").alias("latest_exit"),
    )


def duplicate_rows(visits: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that repeat an earlier row in all ``columns``; equal rows meet map-side first."""
    return (
        visits.groupBy(*columns)
        .agg(_count().alias("__n"))
        .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def duplicate_groups(visits: DataFrame, columns: list[Column | str]) -> DataFrame:
    """Values of ``columns`` that occur more than once, with the number of copies."""
    return visits.groupBy(*columns).agg(_count().alias("copies")).filter("copies > 1")


def duplicate_members(visits: DataFrame, columns: list[str]) -> DataFrame:
    """Every row whose ``columns`` occur more than once, all copies kept.

    The repeated values are found by counting, then joined back: a value with very many
    copies is one counted row on one side, and the copies stay spread over the scan if that
    side is small, or over the skew-split partitions of the join if it is not.
    """
    repeated = duplicate_groups(visits, columns).select(
        *[F.col(c).alias(f"__d_{c}") for c in columns]
    )
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__d_{c}"))
    return visits.join(repeated, same, "left_semi")


def category_counts(visits: DataFrame, column: str = "risk_category") -> DataFrame:
    return visits.groupBy(column).agg(_count().alias("n")).orderBy(F.desc("n"), column)


# ---- dwell -----------------------------------------------------------------------------


def describe(df: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    """Rows (statistic, value): count, mean, std, min, the percentiles, max."""
    v = F.col(value)
    basic = df.agg(
        F.count(v).cast("double").alias("count"),
        F.avg(v).alias("mean"),
        F.stddev(v).alias("std"),
        F.min(v).cast("double").alias("min"),
        F.max(v).cast("double").alias("max"),
    )

    def rows(names: list[str]) -> Column:
        return F.inline(
            F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in names])
        )

    tail = percentiles(df, value, probs)
    return basic.select(rows(["count", "mean", "std", "min", "max"])).unionByName(
        tail.select(rows(list(probs)))
    )


def dwell_stats(visits: DataFrame) -> DataFrame:
    return describe(visits, "duration_min", DWELL_PERCENTILES)


def dwell_histogram(visits: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in ``bins`` equal bins between the smallest and largest value; empty bins too."""
    v = F.col("duration_min")
    lo, hi = visits.agg(F.min(v)).scalar(), visits.agg(F.max(v)).scalar()
    # The last bin is closed on both sides, the others are half-open.
    bin_no = F.least(F.floor((v - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    counted = visits.filter(v.isNotNull()).groupBy(F.coalesce(bin_no, F.lit(0)).alias("bin")).agg(
        _count().alias("n")
    )
    every = visits.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).cast("bigint").alias("n")
    )
    return counted.unionByName(every).groupBy("bin").agg(F.sum("n").alias("n"))


def dwell_tail_counts(visits: DataFrame, thresholds: tuple[float, ...] = TAIL_THRESHOLDS) -> DataFrame:
    """Visits at or above each threshold, and their share in percent."""
    v = F.col("duration_min")
    stats = visits.agg(
        _count().alias("__n"),
        *[F.count_if(v >= t).alias(f"__t{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                F.col(f"__t{i}").alias("n"),
                (F.col(f"__t{i}") * 100.0 / F.col("__n")).alias("share_pct"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return stats.select(F.inline(rows))


def dwell_tail_percentiles(visits: DataFrame, threshold: float = EXTREME_DWELL) -> DataFrame:
    return percentiles(
        visits.filter(F.col("duration_min") >= threshold), "duration_min", TAIL_PERCENTILES
    )


def top_dwell(visits: DataFrame, n: int = 20) -> DataFrame:
    return (
        visits.select("duration_min", "entry_time", "exit_time", "risk_category")
        .orderBy(F.desc("duration_min"), "entry_time", "exit_time", "risk_category")
        .limit(n)
    )


def extreme_by_category(visits: DataFrame, threshold: float = EXTREME_DWELL) -> DataFrame:
    total, extreme = _count(), F.count_if(F.col("duration_min") >= threshold)
    return visits.groupBy("risk_category").agg(
        total.alias("total_vehicles"),
        extreme.alias("extreme_vehicles"),
        (extreme * 100.0 / total).alias("extreme_percentage"),
    )


def dwell_by_category(visits: DataFrame) -> DataFrame:
    return percentiles(visits, "duration_min", CATEGORY_PERCENTILES, ["risk_category"])


def weekday_dwell(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Count, median and P90 of the dwell of complete days, Monday first."""
    return percentiles(
        complete_days(visits, s),
        "duration_min",
        {"median_dwell": 0.50, "p90_dwell": 0.90},
        ["day_of_week", "entry_day"],
    ).orderBy("day_of_week")


# ---- arrivals --------------------------------------------------------------------------


def daily_arrivals(visits: DataFrame) -> DataFrame:
    return (
        visits.groupBy(F.to_date("entry_time").alias("entry_date"))
        .agg(_count().alias("arrivals"), F.max("entry_time").alias("latest_entry"))
        .orderBy("entry_date")
    )


def busiest_days(visits: DataFrame, n: int = 10, s: Settings | None = None) -> DataFrame:
    """The ``n`` largest and ``n`` smallest days; only complete days if settings are given."""
    days = daily_arrivals(visits).select("entry_date", "arrivals")
    if s is not None:
        days = days.filter(is_complete_day(F.col("entry_date"), s))
    top = days.orderBy(F.desc("arrivals"), "entry_date").limit(n)
    low = days.orderBy("arrivals", "entry_date").limit(n)
    return top.withColumn("side", F.lit("largest")).unionByName(
        low.withColumn("side", F.lit("smallest"))
    )


def daily_coverage(visits: DataFrame) -> DataFrame:
    """Arrivals, first and last entry and hours with an entry, per day."""
    hourly = visits.groupBy(
        F.to_date("entry_time").alias("entry_date"), F.hour("entry_time").alias("entry_hour")
    ).agg(
        _count().alias("n"), F.min("entry_time").alias("lo"), F.max("entry_time").alias("hi")
    )
    return hourly.groupBy("entry_date").agg(
        F.sum("n").alias("arrivals"),
        F.min("lo").alias("first_entry"),
        F.max("hi").alias("last_entry"),
        _count().alias("active_hours"),
    )


def hourly_counts(visits: DataFrame) -> DataFrame:
    """Arrivals per day and hour, with zero for the hours of a day without any."""
    found = visits.groupBy(
        F.to_date("entry_time").alias("entry_date"), F.hour("entry_time").alias("entry_hour")
    ).agg(_count().alias("n"))
    hours = F.sequence(F.lit(0), F.lit(23))
    empty = (
        found.select("entry_date")
        .distinct()
        .select("entry_date", F.explode(hours).alias("entry_hour"), F.lit(0).cast("bigint").alias("n"))
    )
    return found.unionByName(empty).groupBy("entry_date", "entry_hour").agg(F.sum("n").alias("n"))


def complete_day_summary(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    days = daily_arrivals(visits).filter(is_complete_day(F.col("entry_date"), s))
    return days.agg(
        _count().alias("complete_days"),
        F.avg("arrivals").alias("mean_arrivals"),
        F.min("arrivals").alias("min_arrivals"),
        F.max("arrivals").alias("max_arrivals"),
    )


def hourly_avg_arrivals(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Mean arrivals per hour of a complete day, with the busiest and quietest hour marked."""
    by_hour = (
        complete_days(visits, s)
        .groupBy("entry_date", "entry_hour")
        .agg(_count().alias("n"))
    )
    days = by_hour.agg(F.count_distinct("entry_date")).scalar()
    averages = by_hour.groupBy("entry_hour").agg((F.sum("n") / days).alias("avg_arrivals"))
    # 24 rows at most from here on.
    up = Window.orderBy("avg_arrivals", "entry_hour")
    down = Window.orderBy(F.desc("avg_arrivals"), "entry_hour")
    return averages.select(
        "entry_hour",
        "avg_arrivals",
        (F.row_number().over(down) == 1).alias("is_busiest"),
        (F.row_number().over(up) == 1).alias("is_quietest"),
    )


def weekday_arrivals(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Total arrivals, observed days and mean per weekday, Monday first."""
    per_day = (
        complete_days(visits, s)
        .groupBy(*s.keys, "day_of_week", "entry_day", "entry_date")
        .agg(_count().alias("n"))
    )
    return (
        per_day.groupBy(*s.keys, "day_of_week", "entry_day")
        .agg(
            F.sum("n").alias("total_arrivals"),
            _count().alias("observed_days"),
            (F.sum("n") / _count()).alias("average_arrivals"),
        )
        .orderBy("day_of_week")
    )


# ---- occupancy -------------------------------------------------------------------------


def observed_grid(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Grid rows of complete days on which somebody arrived, with date and hour."""
    day = Window.partitionBy(*s.keys, "date")
    return (
        grid.withColumns({"date": F.to_date("timestamp"), "hour": F.hour("timestamp")})
        .filter(is_complete_day(F.col("date"), s))
        .withColumn("__came", F.sum("arrivals").over(day))
        .filter("__came > 0")
        .drop("__came")
    )


def hourly_occupancy(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Mean and maximum occupancy per hour outside the bad days, with the peak hours marked."""
    hours = (
        grid.filter(is_complete_day(F.to_date("timestamp"), s))
        .groupBy(*s.keys, F.hour("timestamp").alias("hour"))
        .agg(
            F.avg("active_vehicles").alias("average_occupancy"),
            F.max("active_vehicles").alias("maximum_occupancy"),
        )
    )
    # 24 rows a series.
    series = Window.partitionBy(*s.keys)
    by_mean = series.orderBy(F.desc("average_occupancy"), "hour")
    by_max = series.orderBy(F.desc("maximum_occupancy"), "hour")
    return hours.select(
        "*",
        (F.row_number().over(by_mean) == 1).alias("is_mean_peak"),
        (F.row_number().over(by_max) == 1).alias("is_max_peak"),
    )


def hourly_net_flow(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Mean over days of the hourly sums, and the sign of the net flow."""
    sums = (
        observed_grid(grid, s)
        .groupBy(*s.keys, "date", "hour")
        .agg(*[F.sum(c).alias(c) for c in ("arrivals", "exits", "net_flow")])
    )
    means = sums.groupBy(*s.keys, "hour").agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("arrivals", "exits", "net_flow")]
    )
    return means.withColumn("flow_sign", F.signum("avg_net_flow").cast("int"))


def daily_occupancy(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Flow sums, mean, maximum and hour of the first maximum for every observed day."""
    return (
        observed_grid(grid, s)
        .groupBy(*s.keys, "date")
        .agg(
            F.sum("arrivals").alias("arrivals"),
            F.sum("exits").alias("exits"),
            F.sum("net_flow").alias("net_flow"),
            F.avg("active_vehicles").alias("average_occupancy"),
            F.max("active_vehicles").alias("maximum_occupancy"),
            F.hour(
                F.min_by("timestamp", F.struct(-F.col("active_vehicles"), F.col("timestamp")))
            ).alias("peak_hour"),
        )
    )


def peak_hour_counts(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    return daily_occupancy(grid, s).groupBy(*s.keys, "peak_hour").agg(_count().alias("days"))


def top_occupancy_days(grid: DataFrame, n: int = 10, s: Settings = Settings()) -> DataFrame:
    """The ``n`` days of each series with the highest maximum."""
    days = daily_occupancy(grid, s).select(
        *s.keys, "date", "average_occupancy", "maximum_occupancy", "peak_hour"
    )
    order = [F.desc("maximum_occupancy"), F.col("date")]
    if not s.keys:
        return days.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(*s.keys).orderBy(*order))
    return days.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")


def weekday_occupancy(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    ts = F.col("timestamp")
    return (
        observed_grid(grid, s)
        .groupBy(*s.keys, F.weekday(ts).alias("day_of_week"), F.date_format(ts, "EEEE").alias("day"))
        .agg(
            F.avg("active_vehicles").alias("average_occupancy"),
            F.max("active_vehicles").alias("maximum_occupancy"),
        )
        .orderBy(*s.keys, "day_of_week")
    )


def weekday_comparison(visits: DataFrame, grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Weekday arrivals next to weekday occupancy, each ranked from high to low."""
    arrivals = weekday_arrivals(visits, s).select(*s.keys, "day_of_week", "average_arrivals")
    # A weekday with arrivals on a complete day has grid rows. Seven rows a series.
    joined = left_join(arrivals, weekday_occupancy(grid, s), s.keys, ["day_of_week"])
    series = Window.partitionBy(*s.keys)
    return joined.select(
        "*",
        F.rank().over(series.orderBy(F.desc("average_arrivals"))).alias("arrival_rank"),
        F.rank().over(series.orderBy(F.desc("average_occupancy"))).alias("occupancy_rank"),
    )


def _opposed(grid: DataFrame, s: Settings) -> DataFrame:
    """Days of ``daily_occupancy`` on opposite sides of the medians of their series, with ``kind``."""
    arrivals, occupancy = F.col("arrivals"), F.col("average_occupancy")
    # One row per day and series: the days of a century fit one task.
    series = Window.partitionBy(*s.keys)
    mid_arrivals, mid_occupancy = F.median(arrivals).over(series), F.median(occupancy).over(series)
    kind = F.when(
        (arrivals > mid_arrivals) & (occupancy < mid_occupancy), "high arrivals, low occupancy"
    ).when((arrivals < mid_arrivals) & (occupancy > mid_occupancy), "low arrivals, high occupancy")
    return daily_occupancy(grid, s).withColumn("kind", kind).filter("kind IS NOT NULL")


def mismatch_days(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Days whose arrivals and occupancy lie on opposite sides of their series' medians."""
    return _opposed(grid, s).select(
        *s.keys, "date", "arrivals", "average_occupancy", "maximum_occupancy", "kind"
    )


def daily_detail(visits: DataFrame, grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Flow, mean dwell and occupancy of the mismatch days."""
    dwell = (
        complete_days(visits, s)
        .groupBy(*s.keys, F.col("entry_date").alias("date"))
        .agg(F.avg("duration_min").alias("average_dwell"))
    )
    days = _opposed(grid, s).drop("peak_hour", "kind")
    return left_join(days, dwell, s.keys, ["date"])


def daily_state(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Occupancy just before each observed complete day and just before the next one."""
    changes = (
        movements(visits, s)
        .groupBy(*s.keys, F.to_date("ts").alias("date"))
        .agg(F.sum("arrivals").alias("__came"), F.expr("sum(arrivals - exits)").alias("__change"))
    )
    # One row per day and series: the days of a century fit one task.
    total = running_total(changes, ["date"], {"ending_occupancy": "__change"}, s.keys)
    return total.filter(is_complete_day(F.col("date"), s) & (F.col("__came") > 0)).selectExpr(
        *s.keys,
        "date",
        "ending_occupancy - __change AS starting_occupancy",
        "ending_occupancy",
    )


def single_day_hours(visits: DataFrame, day: str) -> DataFrame:
    """Arrivals per hour of one day."""
    start = ts_lit(day)
    inside = f"entry_time >= {start} AND entry_time < {start} + INTERVAL '1' DAY"
    return visits.filter(inside).groupBy(F.hour("entry_time").alias("entry_hour")).agg(
        _count().alias("n")
    )
