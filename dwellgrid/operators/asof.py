"""Features at exact instants, for one instant or for any number in one job.

Since every exit is at or after its entry, the number inside at ``t`` is the number of
entries up to ``t`` minus the number of exits up to ``t``; flows over (a, b] are differences
of the same counts. So each instant only needs both running counts at a few offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.running import running_total, window
from dwellgrid.functions.timecols import at, calendar, floor_index, named, shift, ts_lit
from dwellgrid.operators.grid import movements
from dwellgrid.operators.reliability import (
    in_bad_period,
    in_near_period,
    overlaps_bad_period,
    overlaps_near_period,
    with_near_periods,
)
from dwellgrid.settings import FLOW_MINUTES, LAG_MINUTES, Settings

# Minutes before the instant at which the counts are read.
PAST_MINUTES = (15, 30, 45, 60)
STEP = 15
OFFSETS = (0, 15, 30, 45, 60, 75, 120, 180, 240, 360, 1440)


class HistoryError(ValueError):
    """The instant has no reliable history to build features from."""


def active_at(t) -> Column:
    return F.expr(f"count_if(entry_time <= {ts_lit(t)} AND exit_time > {ts_lit(t)})")


def arrivals_between(a, b) -> Column:
    return F.expr(f"count_if(entry_time > {ts_lit(a)} AND entry_time <= {ts_lit(b)})")


def exits_between(a, b) -> Column:
    return F.expr(f"count_if(exit_time > {ts_lit(a)} AND exit_time <= {ts_lit(b)})")


def ineligible_reason(
    ts: str, seen_entry: str | None = None, s: Settings = Settings(), near: bool = False
) -> str:
    """The first rule an instant breaks, or null if features can be built.

    Periods are those of the settings, or with ``near`` those of the array of ``with_near_periods``.
    """

    def inside(m: int) -> str:
        return in_near_period(ts, m) if near else in_bad_period(ts, s, m)

    def overlap(a: int, b: int) -> str:
        return overlaps_near_period(ts, a, b) if near else overlaps_bad_period(ts, ts, s, a, b)

    rules = [(inside(0), "instant unreliable")]
    rules += [(inside(m), f"{name} unreliable") for name, m in LAG_MINUTES]
    rules += [(overlap(m, 0), f"flow {label} unreliable") for label, m in FLOW_MINUTES]
    rules += [(inside(m), "rolling unreliable") for m in PAST_MINUTES]
    rules += [(overlap(m + STEP, m), "rolling unreliable") for m in PAST_MINUTES]
    if seen_entry is not None:
        rules.append((f"NOT ({seen_entry})", "before first entry"))
    return f"CASE {' '.join(f'WHEN {rule} THEN {text!r}' for rule, text in rules)} END"


def _fine_moves(visits: DataFrame, s: Settings) -> DataFrame:
    return movements(visits, s).selectExpr(
        *s.keys, "ts", "arrivals", "exits", f"{floor_index('ts', s.fine_seconds)} AS __fine"
    )


def fine_totals(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Arrivals and exits per series and fine chunk; a busy chunk is one partial row per task."""
    sums = _fine_moves(visits, s).groupBy(*s.keys, "__fine").sum("arrivals", "exits")
    return sums.toDF(*s.keys, "fine", "arrivals", "exits")


def counts_at(
    visits: DataFrame, probes: DataFrame, s: Settings = Settings(), totals: DataFrame | None = None
) -> DataFrame:
    """Add ``entered`` and ``left``, the counts up to and including ``probe_ts``.

    ``probes`` has the series keys, ``probe_ts`` and any columns to carry along. The visits
    are reduced map-side to movements per fine chunk, whose totals give the count before a
    chunk. Then movements in chunks with probes and the probes are put in order within their chunks.

    ``totals`` (rows of ``fine_totals``, a chunk any number of times) spares the first of the two reads,
    and of the visits only those are read that end in or after the chunk of the earliest probe.
    """
    keys = list(s.keys)
    if totals is None:
        totals = fine_totals(visits, s)
    else:
        earliest = probes.agg(F.min("probe_ts")).first()[0]
        if earliest is not None:
            visits = visits.filter(f"exit_time >= {ts_lit(earliest)} - INTERVAL '{s.fine_seconds}' SECOND")
    moves = _fine_moves(visits, s)
    points = probes.selectExpr("*", f"{floor_index('probe_ts', s.fine_seconds)} AS __fine")
    probed = points.select(*keys, "__fine").distinct()

    # Chunk totals, with a zero row for each chunk that holds a probe.
    per_chunk = totals.selectExpr(*keys, "fine AS __fine", "arrivals", "exits")
    marks = probed.selectExpr(*keys, "__fine", "0L", "0L", "1")
    chunks = (
        per_chunk.selectExpr("*", "0 AS __probed")
        .union(marks)
        .groupBy(*keys, "__fine")
        .sum("arrivals", "exits", "__probed")
        .toDF(*keys, "__fine", "arrivals", "exits", "__probed")
        .selectExpr("*", f"__fine * {s.fine_seconds} div 86400 AS __coarse")
    )
    heads = (
        running_total(chunks, ["__fine"], {"__a": "arrivals", "__x": "exits"}, keys, ["__coarse"])
        .filter("__probed > 0")
        .selectExpr(*keys, "__fine", "__a - arrivals AS arrivals", "__x - exits AS exits")
    )

    near = probed.selectExpr("__fine AS __p_fine", *[f"{k} AS __p_{k}" for k in keys])
    same = " AND ".join(["__fine = __p_fine", *[f"{k} <=> __p_{k}" for k in keys]])
    moves = moves.join(near, F.expr(same), "left_semi")
    # Movements at the same microsecond meet map-side, so a busy instant is one row.
    inside = (
        moves.groupBy(*keys, "__fine", "ts")
        .sum("arrivals", "exits")
        .toDF(*keys, "__fine", "ts", "arrivals", "exits")
    )
    # Order in a chunk: the count before it, then time, movements ahead of probes.
    carried = [c for c in probes.columns if c not in keys]
    kinds = dict(probes.dtypes)
    blank = [f"cast(null AS {kinds[c]}) AS {c}" for c in carried]
    rows = (
        heads.selectExpr(
            *keys, "__fine", "0 AS __kind", "cast(null AS timestamp_ntz) AS ts", "arrivals", "exits", *blank
        )
        .union(inside.selectExpr(*keys, "__fine", "1", "ts", "arrivals", "exits", *blank))
        .union(points.selectExpr(*keys, "__fine", "2", "probe_ts", "0L", "0L", *carried))
    )
    over = window([*keys, "__fine"], ["least(__kind, 1)", "ts", "__kind"])[:-1]
    over += " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        rows.selectExpr(
            *keys,
            *carried,
            "__kind",
            f"sum(arrivals) {over} AS entered",
            f"sum(exits) {over} AS left",
        )
        .filter("__kind = 2")
        .drop("__kind")
    )


def _instant_counts(
    visits: DataFrame, instants: DataFrame, s: Settings, totals: DataFrame | None = None
) -> DataFrame:
    """One row per distinct instant with ``e_<offset>`` and ``x_<offset>`` counts."""
    keys = list(s.keys)
    offsets = ", ".join(str(m) for m in OFFSETS)
    probes = (
        instants.select(*keys, "prediction_time")
        .distinct()
        .selectExpr(*keys, "prediction_time", f"explode(array({offsets})) AS __offset")
        .selectExpr("*", f"{shift('prediction_time', '-__offset')} AS probe_ts")
    )
    # An instant's rows meet before they are spread over columns: before that no two of them share a task.
    counted = counts_at(visits, probes, s, totals).drop("probe_ts").repartition(*keys, "prediction_time")
    cell = "max(CASE WHEN __offset = {m} THEN {c} END)"
    return counted.groupBy(*keys, "prediction_time").agg(
        *[F.expr(cell.format(m=m, c="entered")).alias(f"e_{m}") for m in OFFSETS],
        *[F.expr(cell.format(m=m, c="left")).alias(f"x_{m}") for m in OFFSETS],
    )


def _feature_columns() -> dict[str, str]:
    def inside(m: int) -> str:
        return f"(e_{m} - x_{m})"

    out = {"active_vehicles": inside(0)}
    out |= {name: inside(m) for name, m in LAG_MINUTES}
    out |= {f"arrivals_{label}": f"e_0 - e_{m}" for label, m in FLOW_MINUTES}
    out |= {f"exits_{label}": f"x_0 - x_{m}" for label, m in FLOW_MINUTES}
    out |= {f"net_flow_{label}": f"{inside(0)} - {inside(m)}" for label, m in FLOW_MINUTES}
    for label, m in (("15m", 15), ("1h", 60), ("2h", 120)):
        out[f"occupancy_change_{label}"] = f"{inside(0)} - {inside(m)}"
    # Four 15-minute windows that end 15 to 60 minutes before the instant.
    out["rolling_mean_occupancy_1h"] = f"({' + '.join(inside(m) for m in PAST_MINUTES)}) / 4.0D"
    out["rolling_mean_arrivals_1h"] = "(e_15 - e_75) / 4.0D"
    out["rolling_mean_exits_1h"] = "(x_15 - x_75) / 4.0D"
    out["rolling_mean_net_flow_1h"] = f"({inside(15)} - {inside(75)}) / 4.0D"
    return out | calendar("prediction_time")


def _with_horizons(counts: DataFrame, s: Settings) -> DataFrame:
    """Turn the counts of an instant into its features, one row per horizon."""
    horizons = ", ".join(str(m) for m in s.horizons)
    return counts.selectExpr(
        *s.keys,
        "prediction_time",
        *named(_feature_columns()),
        f"explode(array({horizons})) AS horizon_minutes",
    ).select(*s.keys, "prediction_time", *s.model_features)


def eligibility(
    visits: DataFrame, instants: DataFrame, s: Settings = Settings(), bad_periods: DataFrame | None = None
) -> DataFrame:
    """Per distinct instant whether a forecast is possible, and if not, why.

    ``bad_periods`` (series keys, start, end) takes the place of the periods of the settings.
    """
    keys = list(s.keys)
    first = visits.groupBy(*keys).agg(F.min("entry_time").alias("__first"))
    points = _points(instants, s, bad_periods)
    if keys:
        points = left_join(points, first, keys)
    else:
        points = points.withColumn("__first", first.select("__first").scalar())
    seen = "coalesce(__first <= prediction_time, false)"
    reason = ineligible_reason("prediction_time", seen, s, bad_periods is not None)
    return points.selectExpr(*keys, "prediction_time", f"{reason} AS reason").selectExpr(
        *keys, "prediction_time", "reason IS NULL AS is_eligible", "reason"
    )


def _points(instants: DataFrame, s: Settings, bad_periods: DataFrame | None) -> DataFrame:
    """The distinct instants, with the periods near them if these come from a table."""
    if bad_periods is None:
        return instants.select(*s.keys, "prediction_time").distinct()
    return with_near_periods(instants, bad_periods, max(OFFSETS), s)


def features_at(
    visits: DataFrame,
    instants: DataFrame,
    s: Settings = Settings(),
    bad_periods: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The 29 model features of every eligible instant, one row per horizon.

    ``bad_periods`` is that of ``eligibility``, ``totals`` that of ``counts_at``.
    """
    reason = ineligible_reason("prediction_time", s=s, near=bad_periods is not None)
    usable = _points(instants, s, bad_periods).filter(f"({reason}) IS NULL")
    # An instant before the first entry has seen nobody.
    return _with_horizons(_instant_counts(visits, usable, s, totals).filter("e_0 > 0"), s)


def features_at_latest(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The same at the latest event of each series."""
    last = F.greatest(F.max("entry_time"), F.max("exit_time"))
    return features_at(visits, visits.groupBy(*s.keys).agg(last.alias("prediction_time")), s)


def features_at_one(visits: DataFrame, instant, s: Settings = Settings()) -> DataFrame:
    """The same for a single instant, by one conditional aggregation without a shuffle of visits."""
    t = at(instant)
    counts = []
    for m in OFFSETS:
        then = ts_lit(t, -m)
        counts.append(F.expr(f"count_if(entry_time <= {then})").alias(f"e_{m}"))
        counts.append(F.expr(f"count_if(exit_time <= {then})").alias(f"x_{m}"))
    row = visits.agg(*counts).selectExpr("*", f"{ts_lit(t)} AS prediction_time")
    one = row.filter(f"({ineligible_reason('prediction_time', 'e_0 > 0', s)}) IS NULL")
    return _with_horizons(one, Settings(bucket_minutes=s.bucket_minutes))


def require_history(visits: DataFrame, instant, s: Settings = Settings()) -> None:
    """Raise with the reason if no features can be built at ``instant``."""
    t = at(instant)
    seen = f"coalesce(first <= {ts_lit(t)}, false)"
    row = visits.agg(F.min("entry_time").alias("first")).selectExpr(
        f"{ineligible_reason(ts_lit(t), seen, s)} AS reason"
    )
    reason = row.first()["reason"]
    if reason is not None:
        raise HistoryError(f"no features at {t}: {reason}")
