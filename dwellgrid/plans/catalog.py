"""Every registered query: a name and a function from (session, data folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellgrid.functions.timecols import floor_to, ts_lit
from dwellgrid.operators import (
    asof,
    clean,
    evaluate,
    features,
    grid,
    lagstats,
    models,
    profile,
    reliability,
    supervised,
)
from dwellgrid.settings import Settings
from dwellgrid.sources import storage
from dwellgrid.sources import visits as sources
from dwellgrid.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# The event table covers 2024-01-01 to 2024-01-30; its unreliable weekend and split bounds.
S = Settings(
    bad_dates=("2024-01-13", "2024-01-14"),
    washouts=(("2024-01-15 00:00:00", "2024-01-15 12:00:00"),),
    train_end="2024-01-22 00:00:00",
    validation_end="2024-01-26 12:00:00",
)
KEYED = S.keyed("event_type")
# The category of raw visits is null where it is unknown: a series of its own.
NULL_KEYED = S.keyed("risk_category")
INSTANT = "2024-01-20 03:41:12"
FLOW_BOUNDS = ("2024-01-25 09:17:00", "2024-01-25 10:17:00")
FROM_TIME = "2024-01-20 00:00:00"
ACF_LAGS = 672

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that the order of a sum does not show."""
    return df.selectExpr(
        *[f"round({c}, {digits}) + 0.0D AS {c}" if kind == "double" else c for c, kind in df.dtypes]
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def raw_visits(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Visits with the category still null where it is unknown."""
    return sources.from_events(events(spark, sf), *keep)


def visits(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return sources.filled(raw_visits(spark, sf, *keep))


def raw_text(spark: SparkSession, sf: str) -> DataFrame:
    """Visits under the raw headers, as text, with some cells that break a rule per event type."""
    kind = F.col("event_type")
    v = raw_visits(spark, sf, "event_type")
    entry, leave = F.col("entry_time").cast("string"), F.col("exit_time").cast("string")
    swapped = kind == "purchase"
    return v.select(
        F.when(kind == "view", "n/a").when(swapped, leave).otherwise(entry).alias("Entry Time"),
        F.when(swapped, entry).otherwise(leave).alias("Exit Time"),
        F.col("risk_category").alias("Risk Category"),
        F.when(kind == "click", "n/a").otherwise(F.col("duration_min").cast("string")).alias("Duration in Min"),
    )


def grid_of(spark: SparkSession, sf: str) -> DataFrame:
    return grid.occupancy_grid(visits(spark, sf), S)


def keyed_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The grid of every category, the null one included, as a stored table."""
    return storage.written(grid.occupancy_grid(raw_visits(spark, sf), NULL_KEYED), "grid")


def flagged_of(spark: SparkSession, sf: str) -> DataFrame:
    return features.flagged_grid(visits(spark, sf), S)


def wide_of(spark: SparkSession, sf: str) -> DataFrame:
    return features.wide_frame(visits(spark, sf), S)


def long_of(spark: SparkSession, sf: str) -> DataFrame:
    return supervised.long_set(wide_of(spark, sf), S)


def flagged_table(spark: SparkSession, sf: str) -> DataFrame:
    """The flagged grid as a stored table, for analyses that read it several times.

    The visits are then scanned once, and no plan repeats the way from visits to grid.
    """
    return storage.written(flagged_of(spark, sf), "grid")


def wide_table(spark: SparkSession, sf: str) -> DataFrame:
    return storage.written(wide_of(spark, sf), "wide")


# ---- sources and cleaning --------------------------------------------------------------


@query
def visits_scan(spark, sf):
    return visits(spark, sf)


@query
def visits_csv_roundtrip(spark, sf):
    path = storage.new_path(spark, "visits") + ".csv"
    v = raw_visits(spark, sf)
    header = {short: raw for raw, short in clean.RAW_NAMES.items()}
    sources.write_csv(v.withColumnsRenamed(header), path)
    return clean.typed(sources.load(spark, path))


@query
def supervised_csv_roundtrip(spark, sf):
    path = storage.new_path(spark, "supervised") + ".csv"
    rows = long_of(spark, sf)
    sources.write_csv(rows, path)
    return rounded(sources.read_csv(spark, path, rows.schema))


@query
def supervised_parquet_roundtrip(spark, sf):
    return rounded(storage.written(long_of(spark, sf), "supervised"))


@query
def visits_clean(spark, sf):
    return clean.typed(raw_text(spark, sf))


@query
def validation_stats(spark, sf):
    return clean.validation_stats(clean.typed(raw_text(spark, sf)))


@query
def visits_lenient(spark, sf):
    return clean.lenient(raw_text(spark, sf))


@query
def visits_from_time(spark, sf):
    return clean.from_exit_time(visits(spark, sf), FROM_TIME)


@query
def recent_history(spark, sf):
    return clean.recent_history(visits(spark, sf), 24)


@query
def replay_head(spark, sf):
    return clean.replay_head(visits(spark, sf), 100)


@query
def latest_event_time(spark, sf):
    return clean.latest_event_time(visits(spark, sf))


# ---- grid ------------------------------------------------------------------------------


@query
def bucket_floor(spark, sf):
    return visits(spark, sf).selectExpr(
        "entry_time",
        f"{floor_to('entry_time', S.bucket_seconds)} AS entry_bucket",
        f"{floor_to('exit_time', S.bucket_seconds)} AS exit_bucket",
    )


@query
def arrivals_15m(spark, sf):
    return grid.arrivals_by_bucket(visits(spark, sf), S)


@query
def exits_15m(spark, sf):
    return grid.exits_by_bucket(visits(spark, sf), S)


@query
def time_grid(spark, sf):
    return grid.time_grid(visits(spark, sf), S)


@query
def flow_grid(spark, sf):
    return grid.flow_grid(visits(spark, sf), S)


@query
def occupancy_grid(spark, sf):
    return grid_of(spark, sf)


@query
def occupancy_grid_keyed(spark, sf):
    return grid.occupancy_grid(visits(spark, sf, "event_type"), KEYED)


@query
def event_occupancy(spark, sf):
    return grid.event_occupancy(visits(spark, sf), S)


@query
def event_occupancy_keyed(spark, sf):
    return grid.event_occupancy(visits(spark, sf, "event_type"), KEYED)


@query
def occupancy_summary(spark, sf):
    return grid.occupancy_summary(grid_of(spark, sf), S)


@query
def conservation_check(spark, sf):
    return grid.conservation_check(grid_of(spark, sf), S)


@query
def grid_gap_check(spark, sf):
    return grid.gap_histogram(grid_of(spark, sf), S)


@query
def flow_summary(spark, sf):
    return grid.flow_summary(visits(spark, sf), S)


# ---- reliability -----------------------------------------------------------------------


@query
def reliability_flag(spark, sf):
    return flagged_of(spark, sf)


@query
def reliability_flag_table(spark, sf):
    periods = spark.createDataFrame(S.bad_periods(), "start string, end string").select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end")
    )
    return reliability.flag_from_table(grid_of(spark, sf), periods, S)


@query
def reliability_counts(spark, sf):
    return reliability.reliability_counts(flagged_of(spark, sf), S)


@query
def bad_period_counts(spark, sf):
    return reliability.bad_period_counts(grid_of(spark, sf), S)


@query
def reliable_segments(spark, sf):
    return reliability.reliable_segments(flagged_table(spark, sf), S)


@query
def longest_segment(spark, sf):
    return reliability.longest_segment(flagged_table(spark, sf), S)


@query
def interval_overlap(spark, sf):
    return reliability.interval_overlap(visits(spark, sf), S)


# ---- features --------------------------------------------------------------------------


@query
def occupancy_lags_raw(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.raw_lags, s=S)
    return df.select("timestamp", "active_vehicles", *S.lag_names)


@query
def occupancy_lags(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.masked_lags, s=S)
    return df.select("timestamp", *S.lag_names)


@query
def flow_windows(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.flow_sums, s=S)
    return df.select("timestamp", *S.flow_names)


@query
def occupancy_change(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.masked_lags, s=S)
    return features.with_changes(df).select("timestamp", *S.change_names)


@query
def rolling_means(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.rolling_means, s=S)
    return rounded(df.select("timestamp", *S.rolling_names))


@query
def calendar_features(spark, sf):
    return features.with_calendar(grid.time_grid(visits(spark, sf), S))


@query
def targets_raw(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.targets_raw, s=S)
    return df.select("timestamp", *S.target_names)


@query
def grid_null_audit(spark, sf):
    """Null counts of the columns that the wide frame adds to the grid, and of the grid's own."""
    wide = wide_of(spark, sf)
    return supervised.null_counts(wide, wide.columns)


@query
def targets(spark, sf):
    df = features.with_windows(flagged_of(spark, sf), features.targets, s=S)
    return df.select("timestamp", *S.target_names)


@query
def wide_frame(spark, sf):
    return rounded(wide_of(spark, sf))


@query
def wide_frame_keyed(spark, sf):
    return rounded(features.wide_frame(visits(spark, sf, "event_type"), KEYED))


# ---- supervised set --------------------------------------------------------------------


@query
def supervised_180m(spark, sf):
    return rounded(supervised.one_horizon(wide_of(spark, sf), 180, S))


@query
def supervised_long(spark, sf):
    return rounded(long_of(spark, sf))


@query
def rows_by_horizon(spark, sf):
    return supervised.rows_by_horizon(long_of(spark, sf))


@query
def split_counts(spark, sf):
    return supervised.split_counts(long_of(spark, sf), S)


@query
def split_bounds(spark, sf):
    return supervised.split_bounds(supervised.one_horizon(wide_table(spark, sf), 180, S), S)


@query
def split_ranges(spark, sf):
    return supervised.split_ranges(long_of(spark, sf), S)


@query
def target_audit(spark, sf):
    wide = wide_table(spark, sf)
    return supervised.target_audit(wide, supervised.long_set(wide, S), S)


@query
def supervised_null_audit(spark, sf):
    return supervised.null_audit(long_of(spark, sf), S)


# ---- exact-time features ---------------------------------------------------------------


@query
def active_at(spark, sf):
    v = visits(spark, sf)
    return v.agg(asof.active_at(INSTANT).alias("active")).selectExpr(
        f"{ts_lit(INSTANT)} AS prediction_time", "active"
    )


@query
def flow_between(spark, sf):
    return visits(spark, sf).agg(
        asof.arrivals_between(*FLOW_BOUNDS).alias("arrivals"),
        asof.exits_between(*FLOW_BOUNDS).alias("exits"),
    )


@query
def exact_features_one(spark, sf):
    return rounded(asof.features_at_one(visits(spark, sf), INSTANT, S))


@query
def exact_features_latest(spark, sf):
    return rounded(asof.features_at_latest(visits(spark, sf), S))


@query
def prediction_eligibility_keyed(spark, sf):
    """As below, per category; visits without category are a series of their own."""
    v = raw_visits(spark, sf)
    back = F.col("exit_time") - F.expr("INTERVAL '1' DAY")
    instants = v.select("risk_category", back.alias("prediction_time"))
    return asof.eligibility(v, instants, NULL_KEYED)


@query
def prediction_eligibility(spark, sf):
    """Every exit time moved back by a day, so that some lie before the first entry."""
    v = visits(spark, sf)
    instants = v.select((F.col("exit_time") - F.expr("INTERVAL '1' DAY")).alias("prediction_time"))
    return asof.eligibility(v, instants, S)


@query
def exact_features_batch(spark, sf):
    """The features every arriving visitor would have seen."""
    v = visits(spark, sf)
    return rounded(asof.features_at(v, v.select(F.col("entry_time").alias("prediction_time")), S))


@query
def exact_features_batch_keyed(spark, sf):
    v = visits(spark, sf, "event_type")
    instants = v.select("event_type", F.col("entry_time").alias("prediction_time"))
    return rounded(asof.features_at(v, instants, KEYED))


def _periods(rows: DataFrame, s: Settings) -> DataFrame:
    """The periods of the settings as a table, for each series of ``rows``."""
    each = ", ".join(f"struct({ts_lit(a)} AS start, {ts_lit(b)} AS end)" for a, b in s.bad_periods())
    return rows.select(*s.keys).distinct().selectExpr(*s.keys, f"inline(array({each}))")


@query
def wide_frame_periods(spark, sf):
    """The keyed wide frame with the bad periods of each series in a table."""
    v = visits(spark, sf, "event_type")
    return rounded(features.wide_frame(v, KEYED, _periods(v, KEYED)))


@query
def prediction_eligibility_periods(spark, sf):
    """The keyed eligibility with the bad periods in a table; one series has a null key."""
    v = raw_visits(spark, sf)
    back = F.col("exit_time") - F.expr("INTERVAL '1' DAY")
    instants = v.select("risk_category", back.alias("prediction_time"))
    return asof.eligibility(v, instants, NULL_KEYED, _periods(v, NULL_KEYED))


@query
def exact_features_periods(spark, sf):
    """The keyed features at every arrival with the bad periods in a table."""
    v = visits(spark, sf, "event_type")
    instants = v.select("event_type", F.col("entry_time").alias("prediction_time"))
    return rounded(asof.features_at(v, instants, KEYED, _periods(v, KEYED)))


# ---- profile ---------------------------------------------------------------------------


@query
def duration_check(spark, sf):
    return rounded(profile.duration_check(visits(spark, sf), 0.0005))


@query
def duration_worst(spark, sf):
    return rounded(profile.duration_worst(visits(spark, sf)), 9)


@query
def quality_summary(spark, sf):
    return rounded(profile.quality_summary(raw_visits(spark, sf), clean.VISIT_COLUMNS))


@query
def quality_sketch_errors(spark, sf):
    """Missing values and rows from daily sketches united, and whether distinct counts are within 3 %."""
    v = raw_visits(spark, sf)
    exact = profile.quality_summary(v, clean.VISIT_COLUMNS).select(
        "column_name", F.col("distinct_values").alias("exact")
    )
    daily = storage.written(profile.daily_sketches(v, clean.VISIT_COLUMNS), "sketches")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(0.03 * F.col("exact"), F.lit(0.5))
    return profile.united_sketches(daily).join(exact, "column_name").select(
        "column_name", "n", "missing", near.alias("within_3_pct")
    )


@query
def timestamp_quality(spark, sf):
    return profile.timestamp_quality(raw_visits(spark, sf))


@query
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(raw_visits(spark, sf), list(clean.VISIT_COLUMNS))


@query
def duplicate_pairs(spark, sf):
    return profile.duplicate_members(visits(spark, sf), ["entry_time", "exit_time"])


@query
def duplicate_pairs_minute(spark, sf):
    """Rows that share entry and exit minute with another row."""
    v = visits(spark, sf).selectExpr(
        "*",
        f"{floor_to('entry_time', 60)} AS entry_minute",
        f"{floor_to('exit_time', 60)} AS exit_minute",
    )
    return profile.duplicate_members(v, ["entry_minute", "exit_minute"])


@query
def category_counts(spark, sf):
    return profile.category_counts(raw_visits(spark, sf))


@query
def dwell_stats(spark, sf):
    return rounded(profile.dwell_stats(visits(spark, sf)))


@query
def dwell_histogram(spark, sf):
    return profile.dwell_histogram(visits(spark, sf))


@query
def dwell_tail_counts(spark, sf):
    return rounded(profile.dwell_tail_counts(visits(spark, sf), (60.0, 120.0, 240.0, 300.0, 600.0)))


@query
def dwell_tail_percentiles(spark, sf):
    return rounded(profile.dwell_tail_percentiles(visits(spark, sf), 120.0))


@query
def top_dwell(spark, sf):
    return profile.top_dwell(visits(spark, sf))


@query
def extreme_by_category(spark, sf):
    return rounded(profile.extreme_by_category(raw_visits(spark, sf), 120.0))


@query
def dwell_by_category(spark, sf):
    return rounded(profile.dwell_by_category(raw_visits(spark, sf)))


@query
def visit_calendar(spark, sf):
    return profile.with_calendar(visits(spark, sf)).select(
        "entry_time", "entry_date", "entry_hour", "entry_day", "day_of_week"
    )


@query
def daily_arrivals(spark, sf):
    return profile.daily_arrivals(visits(spark, sf))


@query
def busiest_days(spark, sf):
    return profile.busiest_days(visits(spark, sf), 5, S)


@query
def daily_coverage(spark, sf):
    return profile.daily_coverage(visits(spark, sf))


@query
def single_day_hours(spark, sf):
    return profile.single_day_hours(visits(spark, sf), "2024-01-13")


@query
def hourly_counts_filled(spark, sf):
    return profile.hourly_counts(visits(spark, sf))


@query
def complete_day_summary(spark, sf):
    return rounded(profile.complete_day_summary(visits(spark, sf), S))


@query
def daily_arrival_stats(spark, sf):
    days = profile.daily_arrivals(visits(spark, sf))
    return rounded(profile.describe(days, "arrivals", {"p25": 0.25, "p50": 0.5, "p75": 0.75}))


@query
def hourly_avg_arrivals(spark, sf):
    return rounded(profile.hourly_avg_arrivals(visits(spark, sf), S))


@query
def weekday_arrivals(spark, sf):
    return rounded(profile.weekday_arrivals(visits(spark, sf), S))


@query
def hourly_occupancy(spark, sf):
    return rounded(profile.hourly_occupancy(grid_of(spark, sf), S))


@query
def hourly_net_flow(spark, sf):
    return rounded(profile.hourly_net_flow(grid_of(spark, sf), S))


@query
def daily_occupancy(spark, sf):
    return rounded(profile.daily_occupancy(grid_of(spark, sf), S))


@query
def peak_hour_counts(spark, sf):
    return profile.peak_hour_counts(grid_of(spark, sf), S)


@query
def top_occupancy_days(spark, sf):
    return rounded(profile.top_occupancy_days(grid_of(spark, sf), 10, S))


@query
def weekday_occupancy(spark, sf):
    return rounded(profile.weekday_occupancy(grid_of(spark, sf), S))


@query
def weekday_comparison(spark, sf):
    return rounded(profile.weekday_comparison(visits(spark, sf), grid_of(spark, sf), S))


@query
def hourly_net_flow_keyed(spark, sf):
    return rounded(profile.hourly_net_flow(keyed_grid(spark, sf), NULL_KEYED))


@query
def mismatch_days_keyed(spark, sf):
    return rounded(profile.mismatch_days(keyed_grid(spark, sf), NULL_KEYED))


@query
def daily_detail_keyed(spark, sf):
    v = raw_visits(spark, sf)
    return rounded(profile.daily_detail(v, keyed_grid(spark, sf), NULL_KEYED))


@query
def top_occupancy_days_keyed(spark, sf):
    return rounded(profile.top_occupancy_days(keyed_grid(spark, sf), s=NULL_KEYED))


@query
def weekday_comparison_keyed(spark, sf):
    v = raw_visits(spark, sf)
    return rounded(profile.weekday_comparison(v, keyed_grid(spark, sf), NULL_KEYED))


@query
def hourly_occupancy_keyed(spark, sf):
    return rounded(profile.hourly_occupancy(keyed_grid(spark, sf), NULL_KEYED))


@query
def mismatch_days(spark, sf):
    return rounded(profile.mismatch_days(flagged_table(spark, sf), S))


@query
def daily_detail(spark, sf):
    return rounded(profile.daily_detail(visits(spark, sf), flagged_table(spark, sf), S))


@query
def daily_state(spark, sf):
    return profile.daily_state(visits(spark, sf), S)


@query
def weekday_dwell(spark, sf):
    return rounded(profile.weekday_dwell(visits(spark, sf), S))


# ---- autocorrelation -------------------------------------------------------------------


@query
def acf_at_horizons(spark, sf):
    return rounded(lagstats.acf_at(flagged_of(spark, sf), s=S))


@query
def acf_full(spark, sf):
    return rounded(lagstats.acf_pairwise(flagged_of(spark, sf), ACF_LAGS, S))


@query
def acf_standard(spark, sf):
    return rounded(lagstats.acf_standard(flagged_table(spark, sf), ACF_LAGS, S))


@query
def pacf(spark, sf):
    return rounded(lagstats.pacf(flagged_table(spark, sf), ACF_LAGS, S))


# ---- baselines and metrics -------------------------------------------------------------


def _fixed_forecasts(spark, sf) -> DataFrame:
    """Long rows with forecasts made from their own features."""
    return long_of(spark, sf).withColumns(
        {
            "point": F.col("active_vehicles"),
            "p50": F.col("lag_15m"),
            "p90": F.greatest("active_vehicles", "lag_15m") + 3.0,
        }
    )


@query
def baseline_persistence(spark, sf):
    return rounded(evaluate.point_metrics(evaluate.persistence(long_of(spark, sf), S)))


@query
def baseline_hourly_mean(spark, sf):
    return rounded(evaluate.point_metrics(evaluate.hourly_mean(supervised.long_set(wide_table(spark, sf), S), S)))


@query
def baseline_previous_day(spark, sf):
    return rounded(evaluate.previous_day_metrics(supervised.long_set(wide_table(spark, sf), S), S))


@query
def metric_summary(spark, sf):
    by_horizon = evaluate.point_metrics(evaluate.persistence(long_of(spark, sf), S))
    return rounded(evaluate.metric_summary(by_horizon))


@query
def quantile_metrics(spark, sf):
    return rounded(evaluate.quantile_metrics(_fixed_forecasts(spark, sf), "p90", 0.90))


@query
def quantile_summary(spark, sf):
    by_horizon = evaluate.quantile_metrics(_fixed_forecasts(spark, sf), "p50", 0.50)
    return rounded(evaluate.quantile_summary(by_horizon))


@query
def quantile_crossing(spark, sf):
    rows = _fixed_forecasts(spark, sf)
    return evaluate.quantile_crossing(rows, low="p50", high="point")


@query
def promotion_decision(spark, sf):
    """The hourly mean as candidate against persistence as the active model."""
    long = supervised.long_set(wide_table(spark, sf), S)

    def summary(version: str, scored: DataFrame) -> DataFrame:
        return evaluate.metric_summary(evaluate.point_metrics(scored)).select(
            F.lit(version).alias("version"), "mean_mae", "mean_mse"
        )

    return rounded(
        evaluate.promotion(
            summary("v002", evaluate.hourly_mean(long, S)),
            summary("v001", evaluate.persistence(long, S)),
        )
    )


@query
def peak_of_fixed(spark, sf):
    """The peak rule on forecasts that SQL can repeat: the horizon with the highest target."""
    one = F.struct("horizon_minutes", F.col("target").alias("point_prediction"))
    records = (
        long_of(spark, sf)
        .groupBy(F.col("timestamp").alias("prediction_time"))
        .agg(models.peak_of(one).alias("peak_forecast"))
    )
    return models.with_peak_time(records).select("prediction_time", "peak_forecast.*")


# ---- models ----------------------------------------------------------------------------

PARAMS = models.TreeParams()


def _sets(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training, validation and test rows, from one stored table that every boosting round reads."""
    return supervised.split(storage.written(long_of(spark, sf), "long"), S)


def _boosted_metrics(
    sets: tuple[DataFrame, DataFrame, DataFrame], names: list[str], params: models.TreeParams = PARAMS
) -> DataFrame:
    train, validation, test = sets
    model = models.fit_boosted(train, validation, names, params)
    return evaluate.point_metrics(models.score(model, test))


def _bundle(spark, sf) -> tuple[models.Bundle, DataFrame, DataFrame]:
    """The three forecasts, with validation and test rows."""
    train, validation, test = _sets(spark, sf)
    return models.fit_bundle(train, validation, PARAMS, S), validation, test


@query
def gbt_point(spark, sf):
    return _boosted_metrics(_sets(spark, sf), S.model_features)


@query
def gbt_p50(spark, sf):
    train, validation, test = _sets(spark, sf)
    median = replace(PARAMS, alpha=0.5)
    model = models.fit_boosted(train, validation, S.model_features, median)
    return evaluate.quantile_metrics(models.score(model, test), "prediction", 0.50)


@query
def gbt_p90(spark, sf):
    bundle, _, test = _bundle(spark, sf)
    return evaluate.quantile_metrics(models.score_bundle(bundle, test), "p90", 0.90)


@query
def gbt_metrics(spark, sf):
    bundle, _, test = _bundle(spark, sf)
    return models.bundle_metrics(bundle, test)


def _clocks(spark, sf) -> DataFrame:
    """The start of every bucket in which somebody arrived, as instants to forecast from."""
    return grid.arrivals_by_bucket(visits(spark, sf), S).select(
        F.col("timestamp").alias("prediction_time")
    )


def _forecasts(spark, sf) -> DataFrame:
    bundle, _, _ = _bundle(spark, sf)
    return models.forecasts(bundle, visits(spark, sf), _clocks(spark, sf), S)


@query
def forecast_at(spark, sf):
    return _forecasts(spark, sf).select(
        "model_version", "prediction_time", "current_active_vehicles", F.inline("forecast")
    )


@query
def forecast_peak(spark, sf):
    return _forecasts(spark, sf).select(
        "model_version", "prediction_time", "current_active_vehicles", "peak_forecast.*"
    )


@query
def gbt_single_horizon(spark, sf):
    """One model for three hours and one for six, without the horizon as input."""
    sets = _sets(spark, sf)
    three, six = (
        _boosted_metrics(
            tuple(d.filter(F.col("horizon_minutes") == minutes) for d in sets),
            S.base_features,
            models.SINGLE_HORIZON,
        )
        for minutes in (180, 360)
    )
    return three.unionByName(six)


@query
def param_search(spark, sf):
    """All sampled configurations, each fitted in full."""
    train, validation, _ = _sets(spark, sf)
    return models.search(train, validation, S.model_features, models.sample_params(base=PARAMS))


@query
def feature_importance(spark, sf):
    train, validation, _ = _sets(spark, sf)
    point = models.fit_boosted(train, validation, S.model_features, PARAMS)
    return models.feature_importance(spark, point)


@query
def permutation_importance(spark, sf):
    train, validation, _ = _sets(spark, sf)
    point = models.fit_boosted(train, validation, S.model_features, PARAMS)
    return models.permutation_importance(point, validation)


@query
def gbt_reduced(spark, sf):
    return _boosted_metrics(_sets(spark, sf), models.REDUCED_FEATURES)


@query
def rf_benchmark(spark, sf):
    train, _, test = _sets(spark, sf)
    model = models.fit_forest(train, S.model_features, params=PARAMS)
    return evaluate.point_metrics(models.score_forest(model, test, S.model_features))


@query
def leafwise_benchmark(spark, sf):
    """The second booster: best leaf first."""
    return _boosted_metrics(_sets(spark, sf), S.model_features, models.LEAFWISE)


@query
def leafwise_search(spark, sf):
    """All sampled configurations of the second booster."""
    train, validation, _ = _sets(spark, sf)
    return models.search(train, validation, S.model_features, models.sample_leafwise())


@query
def gbt_rows(spark, sf):
    """Test rows by horizon that were forecast, and how many break what every forecast has to keep."""
    bundle, _, test = _bundle(spark, sf)
    scored = models.score_bundle(bundle, test)
    bad = " OR ".join(f"{c} IS NULL OR isnan({c}) OR abs({c}) > 1e9" for c in ("point", "p50", "p90"))
    return scored.groupBy("horizon_minutes").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("p90") < F.col("p50")).alias("crossed"),
        F.count_if(F.expr(bad)).alias("unusable"),
    )


@query
def forecast_or_reason(spark, sf):
    """Every instant asked for, with its number of horizons forecast or the reason for none."""
    bundle, _, _ = _bundle(spark, sf)
    v = visits(spark, sf)
    early = v.agg((F.min("entry_time") - F.expr("INTERVAL '1' HOUR")).alias("prediction_time"))
    asked = _clocks(spark, sf).unionByName(early)
    return models.forecasts_or_reasons(bundle, v, asked, S).select(
        "prediction_time",
        "is_eligible",
        "reason",
        F.coalesce(F.size("forecast"), F.lit(0)).cast("long").alias("n_horizons"),
        "current_active_vehicles",
    )


# ---- stream ----------------------------------------------------------------------------


@query
def parse_events(spark, sf):
    """The stream parser on a static copy of the messages, some of them malformed."""
    v = raw_visits(spark, sf, "event_type").withColumn(
        "event_time", F.when(F.col("event_type") == "view", F.col("entry_time"))
    )
    good = sources.as_json_values(v.filter("event_type != 'click'"), "event_time")
    cut = v.filter("event_type = 'click'").select(
        F.concat(F.lit('{"entry_time": "'), F.col("entry_time").cast("string")).alias("value")
    )
    return ingest.parse_events(good.unionByName(cut))
