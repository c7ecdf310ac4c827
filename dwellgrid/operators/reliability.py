"""Reliability flags, reliable segments and interval tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.running import drop_halo, halo, in_chunk, running_total
from dwellgrid.functions.timecols import floor_index, floor_to, ts_lit
from dwellgrid.settings import Settings


def in_bad_period(ts: str, s: Settings = Settings(), back: int = 0) -> str:
    """Whether the instant ``back`` minutes before ``ts`` lies in a listed half-open period.

    The minutes go into the literals, so that a row costs comparisons only.
    """
    hits = [
        f"({ts} >= {ts_lit(a, back)} AND {ts} < {ts_lit(b, back)})" for a, b in s.bad_periods()
    ]
    return f"({' OR '.join(hits) or 'false'})"


def overlaps_bad_period(
    start: str, end: str, s: Settings = Settings(), start_back: int = 0, end_back: int = 0
) -> str:
    """Whether the interval (start, end], which must not be empty, overlaps a bad period.

    Both ends may lie some minutes before the given expressions.
    """
    hits = [
        f"({start} < {ts_lit(b, start_back)} AND {end} > {ts_lit(a, end_back)})"
        for a, b in s.bad_periods()
    ]
    return f"({' OR '.join(hits) or 'false'})"


def flag(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Add ``is_reliable``; no value is changed."""
    return grid.selectExpr("*", f"NOT {in_bad_period('timestamp', s)} AS is_reliable")


def flag_from_table(grid: DataFrame, bad_periods: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``flag`` with the periods in a table of ``start, end`` and the series keys.

    Periods become the set of buckets whose start they hold, so the match is an equi-join
    of any size rather than a range join.
    """
    step = f"INTERVAL '{s.bucket_seconds}' SECOND"
    # The first bucket start at or after a bound, for both bounds; the end is left out.
    first, after = (
        floor_to(f"({c} + {step} - INTERVAL '0.000001' SECOND)", s.bucket_seconds)
        for c in ("start", "end")
    )
    bad = (
        bad_periods.selectExpr(*s.keys, f"{first} AS __a", f"{after} - {step} AS __b")
        .filter("__a <= __b")
        .selectExpr(*s.keys, f"explode(sequence(__a, __b, {step})) AS timestamp")
        .distinct()
        .withColumn("__bad", F.lit(True))
    )
    return (
        left_join(grid, bad, s.keys, ["timestamp"])
        .withColumn("is_reliable", F.col("__bad").isNull())
        .drop("__bad")
    )


PERIODS = "__periods"


def with_near_periods(
    instants: DataFrame, bad_periods: DataFrame, minutes: int, s: Settings = Settings(), ts: str = "prediction_time"
) -> DataFrame:
    """Add the array of the series' periods that reach into the ``minutes`` before each distinct instant.

    Both sides are laid out by day, so the match is an equi-join of any size; a day without a period
    in a series sends nothing. The arrays hold what lies near one instant.
    """
    points = instants.select(*s.keys, ts).distinct()
    laid = points.selectExpr(
        "*", f"explode(sequence(to_date({ts} - INTERVAL '{minutes}' MINUTE), to_date({ts}))) AS __day"
    )
    days = bad_periods.filter("start < end").selectExpr(
        *s.keys, "start", "end", "explode(sequence(to_date(start), to_date(end))) AS __day"
    )
    found = left_join(laid, days, s.keys, ["__day"])
    near = F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "end")))
    return found.groupBy(*s.keys, ts).agg(near.alias(PERIODS))


def in_near_period(ts: str, back: int = 0) -> str:
    """``in_bad_period`` on the array of ``with_near_periods``."""
    t = f"({ts} - INTERVAL '{back}' MINUTE)"
    return f"exists({PERIODS}, p -> {t} >= p.start AND {t} < p.end)"


def overlaps_near_period(ts: str, start_back: int, end_back: int) -> str:
    """Whether the interval between the two instants before ``ts`` overlaps a period of the array."""
    a, b = (f"({ts} - INTERVAL '{m}' MINUTE)" for m in (start_back, end_back))
    return f"exists({PERIODS}, p -> {a} < p.end AND {b} > p.start)"


def reliability_counts(flagged: DataFrame, s: Settings = Settings()) -> DataFrame:
    return flagged.groupBy(*s.keys, "is_reliable").agg(F.count(F.lit(1)).alias("intervals"))


def bad_period_counts(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Grid rows inside each listed period."""
    cases = " ".join(
        f"WHEN timestamp >= {ts_lit(a)} AND timestamp < {ts_lit(b)} THEN '{a}'"
        for a, b in s.bad_periods()
    )
    return (
        grid.selectExpr(*s.keys, f"CASE {cases} END AS period_start")
        .filter("period_start IS NOT NULL")
        .groupBy(*s.keys, "period_start")
        .agg(F.count(F.lit(1)).alias("intervals"))
    )


def with_segment(flagged: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Number the runs of equal ``is_reliable`` from 1 within each series."""
    near = halo(flagged, "timestamp", s.chunk_seconds, s.bucket_seconds)
    before = f"lag(is_reliable) {in_chunk(s.keys, 'timestamp')}"
    starts = f"coalesce(cast({before} != is_reliable AS bigint), 1L) AS __starts"
    marked = drop_halo(near.selectExpr("*", starts)).selectExpr(
        "*", f"{floor_index('timestamp', s.chunk_seconds)} AS __part"
    )
    return running_total(
        marked, ["timestamp"], {"segment_id": "__starts"}, s.keys, ["__part"]
    ).drop("__starts")


def reliable_segments(flagged: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Start, end and length of every reliable run, longest first."""
    return (
        with_segment(flagged, s)
        .filter("is_reliable")
        .groupBy(*s.keys, "segment_id")
        .agg(
            F.min("timestamp").alias("start_ts"),
            F.max("timestamp").alias("end_ts"),
            F.count(F.lit(1)).alias("observations"),
        )
        .orderBy(F.desc("observations"), "start_ts")
    )


def longest_segment(flagged: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of each series' longest reliable run (the earliest one on ties)."""
    numbered = with_segment(flagged, s).filter("is_reliable")
    sizes = numbered.groupBy(*s.keys, "segment_id").agg(F.count(F.lit(1)).alias("__n"))
    best = sizes.withColumn(
        "__rank",
        F.row_number().over(
            Window.partitionBy(*s.keys).orderBy(F.desc("__n"), "segment_id")
        ),
    ).filter("__rank = 1")
    best = best.select(*[F.col(k).alias(f"__k_{k}") for k in s.keys], F.col("segment_id").alias("__best"))
    same = F.col("segment_id") == F.col("__best")
    for k in s.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return numbered.join(best, same, "left_semi")


def interval_overlap(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Whether each stay (entry, exit] overlaps a bad period."""
    overlaps = f"exit_time > entry_time AND {overlaps_bad_period('entry_time', 'exit_time', s)}"
    return visits.selectExpr("*", f"{overlaps} AS overlaps_bad")


def masked(column: str) -> Column:
    return F.when(F.col("is_reliable"), F.col(column))
