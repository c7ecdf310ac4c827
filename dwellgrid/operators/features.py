"""Masked lags, trailing windows, calendar columns and future targets on the flagged grid.

Every window function of a frame is evaluated in one pass over the same chunked order, and
a value is null unless all the grid rows it is made from exist and are reliable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from dwellgrid.functions.running import drop_halo, halo, in_chunk
from dwellgrid.functions.timecols import calendar, named
from dwellgrid.operators import grid as grids
from dwellgrid.operators import reliability
from dwellgrid.settings import (
    CHANGE_LAGS,
    FLOW_COLUMNS,
    FLOW_MINUTES,
    LAG_MINUTES,
    ROLLING_COLUMNS,
    ROLLING_MINUTES,
    Settings,
)

Maker = Callable[[Settings], dict[str, str]]


def _here(s: Settings) -> str:
    return in_chunk(s.keys, "timestamp")


def _before(k: int, s: Settings) -> str:
    """The ``k`` rows before the current one."""
    return in_chunk(s.keys, "timestamp", (-k, -1))


def _all_reliable(k: int, s: Settings) -> str:
    """True when the ``k`` rows before exist and are all reliable."""
    return f"count_if(is_reliable) {_before(k, s)} = {k}"


def _if_reliable(function: str, k: int, s: Settings) -> str:
    """The occupancy ``k`` rows away, if that row exists and is reliable."""
    w = _here(s)
    return f"CASE WHEN {function}(is_reliable, {k}) {w} THEN {function}(active_vehicles, {k}) {w} END"


def raw_lags(s: Settings) -> dict[str, str]:
    w = _here(s)
    return {name: f"lag(active_vehicles, {s.steps(m)}) {w}" for name, m in LAG_MINUTES}


def masked_lags(s: Settings) -> dict[str, str]:
    return {name: _if_reliable("lag", s.steps(m), s) for name, m in LAG_MINUTES}


def flow_sums(s: Settings) -> dict[str, str]:
    out = {}
    for column in FLOW_COLUMNS:
        for label, minutes in FLOW_MINUTES:
            k = s.steps(minutes)
            out[f"{column}_{label}"] = (
                f"CASE WHEN {_all_reliable(k, s)} THEN sum({column}) {_before(k, s)} END"
            )
    return out


def rolling_means(s: Settings) -> dict[str, str]:
    k = s.steps(ROLLING_MINUTES)
    return {
        f"rolling_mean_{name}_1h": f"CASE WHEN {_all_reliable(k, s)} THEN avg({column}) {_before(k, s)} END"
        for name, column in ROLLING_COLUMNS
    }


def targets_raw(s: Settings) -> dict[str, str]:
    """The occupancy at every horizon, whatever the reliability of that row."""
    w = _here(s)
    return {f"target_{m}m": f"lead(active_vehicles, {s.steps(m)}) {w}" for m in s.horizons}


def targets(s: Settings) -> dict[str, str]:
    return {f"target_{m}m": _if_reliable("lead", s.steps(m), s) for m in s.horizons}


def with_windows(flagged: DataFrame, *makers: Maker, s: Settings = Settings()) -> DataFrame:
    """Add the columns of ``makers``, computed per time chunk."""
    back = max(m for _, m in LAG_MINUTES) * 60
    ahead = max(s.horizons) * 60
    near = halo(flagged, "timestamp", s.chunk_seconds, back, ahead)
    columns = {name: text for make in makers for name, text in make(s).items()}
    return drop_halo(near.selectExpr("*", *named(columns)))


def changes() -> dict[str, str]:
    """Occupancy change against a lag; null where the lag is."""
    return {f"occupancy_change_{w}": f"active_vehicles - lag_{w}" for w in CHANGE_LAGS}


def with_changes(lagged: DataFrame) -> DataFrame:
    return lagged.selectExpr("*", *named(changes()))


def with_calendar(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *named(calendar("timestamp")))


def flagged_grid(
    visits: DataFrame, s: Settings = Settings(), bad_periods: DataFrame | None = None
) -> DataFrame:
    """The grid with its flags, by the periods of the settings or of a table (series keys, start, end)."""
    grid = grids.occupancy_grid(visits, s)
    if bad_periods is None:
        return reliability.flag(grid, s)
    return reliability.flag_from_table(grid, bad_periods, s)


def wide_frame(
    visits: DataFrame, s: Settings = Settings(), bad_periods: DataFrame | None = None
) -> DataFrame:
    """Clean visits to one row per bucket with 28 features and 6 targets."""
    df = with_windows(
        flagged_grid(visits, s, bad_periods), masked_lags, flow_sums, rolling_means, targets, s=s
    )
    derived = {**changes(), **calendar("timestamp")}
    grid = ["timestamp", "arrivals", "exits", "net_flow", "active_vehicles", "is_reliable"]
    names = [*grid, *s.base_features[1:], *s.target_names]
    return df.selectExpr(
        *s.keys, *[f"{derived[n]} AS {n}" if n in derived else n for n in names]
    )
