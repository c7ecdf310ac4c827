"""One frozen object with every tunable value of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Lookbacks, window widths and horizons in minutes, unreliable dates and
# split bounds that results have to agree with.
LAG_MINUTES = (
    ("lag_15m", 15),
    ("lag_30m", 30),
    ("lag_1h", 60),
    ("lag_2h", 120),
    ("lag_3h", 180),
    ("lag_4h", 240),
    ("lag_6h", 360),
    ("lag_24h", 1440),
)
FLOW_MINUTES = (("15m", 15), ("30m", 30), ("1h", 60))
ROLLING_MINUTES = 60
SHORTEST = 15
FLOW_COLUMNS = ("arrivals", "exits", "net_flow")
CHANGE_LAGS = ("15m", "1h", "2h")
ROLLING_COLUMNS = (
    ("occupancy", "active_vehicles"),
    ("arrivals", "arrivals"),
    ("exits", "exits"),
    ("net_flow", "net_flow"),
)
CALENDAR = ("hour", "day_of_week", "is_weekend")
HORIZON_MINUTES = (15, 30, 60, 120, 180, 360)


@dataclass(frozen=True)
class Settings:
    """Parameters of the occupancy pipeline.

    ``keys`` names the columns that identify a series; empty means one series.
    ``chunk_days`` is the length of the time chunks in which ordered windows
    over the grid run, ``fine_seconds`` the same for event-level running counts.
    """

    keys: tuple[str, ...] = ()
    bucket_minutes: int = 15
    bad_dates: tuple[str, ...] = ("2026-08-22", "2026-08-23")
    washouts: tuple[tuple[str, str], ...] = (("2026-08-24 00:00:00", "2026-08-24 12:00:00"),)
    train_end: str = "2026-09-05 04:45:00"
    validation_end: str = "2026-09-11 18:00:00"
    chunk_days: int = 7
    fine_seconds: int = 60

    def __post_init__(self) -> None:
        if self.bucket_minutes < 1 or SHORTEST % self.bucket_minutes:
            raise ValueError(f"a bucket has to divide {SHORTEST} minutes")

    def steps(self, minutes: int) -> int:
        """Grid rows in a number of minutes."""
        return minutes // self.bucket_minutes

    @property
    def bucket_seconds(self) -> int:
        return self.bucket_minutes * 60

    @property
    def chunk_seconds(self) -> int:
        return self.chunk_days * 86400

    @property
    def lag_names(self) -> list[str]:
        return [name for name, _ in LAG_MINUTES]

    @property
    def flow_names(self) -> list[str]:
        return [f"{c}_{w}" for c in FLOW_COLUMNS for w, _ in FLOW_MINUTES]

    @property
    def change_names(self) -> list[str]:
        return [f"occupancy_change_{w}" for w in CHANGE_LAGS]

    @property
    def rolling_names(self) -> list[str]:
        return [f"rolling_mean_{name}_1h" for name, _ in ROLLING_COLUMNS]

    @property
    def horizons(self) -> tuple[int, ...]:
        return HORIZON_MINUTES

    @property
    def target_names(self) -> list[str]:
        return [f"target_{m}m" for m in self.horizons]

    @property
    def base_features(self) -> list[str]:
        """The 28 model inputs that do not depend on the horizon, in model order."""
        return [
            "active_vehicles",
            *self.lag_names,
            *self.flow_names,
            *self.change_names,
            *self.rolling_names,
            *CALENDAR,
        ]

    @property
    def model_features(self) -> list[str]:
        return [*self.base_features, "horizon_minutes"]

    def bad_periods(self) -> list[tuple[str, str]]:
        """All unreliable periods as half-open ``[start, end)`` text pairs."""
        from datetime import date, timedelta

        days = [
            (f"{d} 00:00:00", f"{date.fromisoformat(d) + timedelta(days=1)} 00:00:00")
            for d in self.bad_dates
        ]
        return days + list(self.washouts)

    def keyed(self, *keys: str) -> Settings:
        return replace(self, keys=tuple(keys))
