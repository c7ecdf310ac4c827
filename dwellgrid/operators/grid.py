"""Regular time buckets and occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.functions.running import drop_halo, halo, in_chunk, running_total
from dwellgrid.functions.timecols import floor_index, interval_start
from dwellgrid.settings import Settings


def movements(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Two rows per visit: one arrival at its entry time, one exit at its exit time."""
    return visits.selectExpr(
        *s.keys, "stack(2, entry_time, 1L, 0L, exit_time, 0L, 1L) AS (ts, arrivals, exits)"
    )


def _numbered_flow(visits: DataFrame, s: Settings) -> DataFrame:
    """Arrivals and exits per bucket number with any movement, in one scan of the visits."""
    return (
        movements(visits, s)
        .selectExpr(
            *s.keys, f"{floor_index('ts', s.bucket_seconds)} AS bucket", "arrivals", "exits"
        )
        .groupBy(*s.keys, "bucket")
        .agg(F.sum("arrivals").alias("arrivals"), F.sum("exits").alias("exits"))
    )


def bucket_flow(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Arrivals and exits of every bucket with any movement.

    Rows are grouped by bucket number; only the groups are turned into timestamps.
    """
    start = interval_start("bucket", s.bucket_seconds)
    return _numbered_flow(visits, s).selectExpr(
        *s.keys, f"{start} AS timestamp", "arrivals", "exits"
    )


def _by_bucket(visits: DataFrame, column: str, name: str, s: Settings) -> DataFrame:
    bucket = F.expr(floor_index(column, s.bucket_seconds)).alias("bucket")
    counts = visits.groupBy(*s.keys, bucket).agg(F.count(F.lit(1)).alias(name))
    start = interval_start("bucket", s.bucket_seconds)
    return counts.selectExpr(*s.keys, f"{start} AS timestamp", name)


def arrivals_by_bucket(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    return _by_bucket(visits, "entry_time", "arrivals", s)


def exits_by_bucket(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    return _by_bucket(visits, "exit_time", "exits", s)


def _buckets_per_chunk(s: Settings) -> int:
    return max(1, s.chunk_seconds // s.bucket_seconds)


def _all_buckets(flow: DataFrame, s: Settings) -> DataFrame:
    """Every bucket from the first to the last one of each series.

    The flow is reduced to one row per chunk of buckets. These few rows give the bounds of the
    series, the chunks in which nothing happened, and the number inside before each chunk
    (``carry``). Chunks are then unfolded into buckets one by one, so no array is long.
    """
    n = _buckets_per_chunk(s)
    chunks = flow.groupBy(*s.keys, F.expr(f"floor(bucket / {n})").alias("part")).agg(
        F.min("bucket").alias("lo"),
        F.max("bucket").alias("hi"),
        F.expr("sum(arrivals - exits)").alias("own"),
    )
    by = f"PARTITION BY {', '.join(s.keys)}" if s.keys else ""
    spans = chunks.selectExpr(
        *s.keys,
        "part",
        "own",
        f"min(lo) OVER ({by}) AS first",
        f"max(hi) OVER ({by}) AS last",
        f"sum(own) OVER ({by} ORDER BY part ROWS UNBOUNDED PRECEDING) AS after",
        f"coalesce(lead(part) OVER ({by} ORDER BY part), part + 1) AS next",
    )
    each = spans.selectExpr("*", "explode(sequence(part, next - 1)) AS p")
    return each.selectExpr(
        *s.keys,
        "p AS part",
        f"explode(sequence(greatest(first, p * {n}), least(last, p * {n} + {n - 1}))) AS bucket",
        "if(p = part, after - own, after) AS carry",
    )


def _dense(visits: DataFrame, s: Settings) -> DataFrame:
    """Every bucket with its flow and the carry of its chunk, partitioned by series and chunk.

    The aggregation here and any window per chunk run on the one shuffle asked for.
    """
    flow = _numbered_flow(visits, s)
    part = f"floor(bucket / {_buckets_per_chunk(s)}) AS part"
    rows = flow.selectExpr(*s.keys, part, "bucket", "arrivals", "exits", "cast(null AS bigint) AS carry")
    empty = _all_buckets(flow, s).selectExpr(*s.keys, "part", "bucket", "0L", "0L", "carry")
    return (
        rows.union(empty)
        .repartition(*s.keys, "part")
        .groupBy(*s.keys, "part", "bucket")
        .agg(
            F.sum("arrivals").alias("arrivals"),
            F.sum("exits").alias("exits"),
            F.max("carry").alias("carry"),
        )
    )


def time_grid(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    start = interval_start("bucket", s.bucket_seconds)
    buckets = _all_buckets(_numbered_flow(visits, s), s)
    return buckets.selectExpr(*s.keys, f"{start} AS timestamp")


def flow_grid(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The complete grid with arrivals, exits (zero where nothing happened) and net flow."""
    start = interval_start("bucket", s.bucket_seconds)
    return _dense(visits, s).selectExpr(
        *s.keys, f"{start} AS timestamp", "arrivals", "exits", "arrivals - exits AS net_flow"
    )


def occupancy_grid(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The grid with ``active_vehicles``: everyone inside at the end of the bucket.

    A running sum within the chunk on top of the number inside before it.
    """
    by = ", ".join([*s.keys, "part"])
    inside = f"sum(arrivals - exits) OVER (PARTITION BY {by} ORDER BY bucket ROWS UNBOUNDED PRECEDING)"
    return _dense(visits, s).selectExpr(
        *s.keys,
        f"{interval_start('bucket', s.bucket_seconds)} AS timestamp",
        "arrivals",
        "exits",
        "arrivals - exits AS net_flow",
        f"carry + {inside} AS active_vehicles",
    )


def event_occupancy(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Occupancy after every instant with a movement.

    Instants have microsecond resolution and are summed first, so one chunk of
    ``fine_seconds`` is bounded however many visits fall into it.
    """
    changes = (
        movements(visits, s)
        .selectExpr(*s.keys, "ts AS timestamp", "arrivals - exits AS change")
        .groupBy(*s.keys, "timestamp")
        .sum("change")
        .selectExpr(
            *s.keys,
            "timestamp",
            "`sum(change)` AS change",
            f"{floor_index('timestamp', 86400)} AS __day",
            f"{floor_index('timestamp', s.fine_seconds)} AS __fine",
        )
    )
    return running_total(
        changes, ["timestamp"], {"active_vehicles": "change"}, s.keys, ["__day", "__fine"]
    )


def occupancy_summary(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    return grid.groupBy(*s.keys).agg(
        F.count(F.lit(1)).alias("intervals"),
        F.min("active_vehicles").alias("min_active"),
        F.max("active_vehicles").alias("max_active"),
        F.max_by("active_vehicles", "timestamp").alias("final_active"),
    )


def conservation_check(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Everybody who came has to have left again by the last bucket."""
    return grid.groupBy(*s.keys).agg(
        F.sum("arrivals").alias("total_arrivals"),
        F.sum("exits").alias("total_exits"),
        F.sum("net_flow").alias("total_net_flow"),
        F.min("active_vehicles").alias("min_active"),
        F.max_by("active_vehicles", "timestamp").alias("final_active"),
    )


def gap_histogram(grid: DataFrame, s: Settings = Settings()) -> DataFrame:
    """How often each distance between neighbouring grid rows occurs, in minutes."""
    near = halo(grid.select(*s.keys, "timestamp"), "timestamp", s.chunk_seconds, s.bucket_seconds)
    before = f"lag(timestamp) {in_chunk(s.keys, 'timestamp')}"
    gaps = near.selectExpr("*", f"cast(cast(timestamp - {before} AS interval minute) AS bigint) AS gap_minutes")
    return (
        drop_halo(gaps)
        .filter("gap_minutes IS NOT NULL")
        .groupBy(*s.keys, "gap_minutes")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def flow_summary(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Arrivals and exits of the buckets that occur, newest first (no grid)."""
    return (
        bucket_flow(visits, s)
        .withColumnRenamed("timestamp", "bucket")
        .orderBy(F.desc("bucket"), *s.keys)
    )
