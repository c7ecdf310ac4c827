"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# Fixed values, stated here again so that an error in the package's own doesn't hide: lags, windows, horizons
# and instants in minutes, the unreliable periods, the split bounds and the columns in model order.
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
FLOW_COLUMNS = ("arrivals", "exits", "net_flow")
PAST_MINUTES = (15, 30, 45, 60)
OFFSETS = (0, 15, 30, 45, 60, 75, 120, 180, 240, 360, 1440)
HORIZONS = (15, 30, 60, 120, 180, 360)
STUDY_LAGS = (
    ("15 min", 15),
    ("30 min", 30),
    ("1 hour", 60),
    ("2 hours", 120),
    ("3 hours", 180),
    ("4 hours", 240),
    ("6 hours", 360),
    ("24 hours", 1440),
    ("7 days", 10080),
)
BAD_DATES = ("2024-01-13", "2024-01-14")
BAD_PERIODS = (
    ("2024-01-13 00:00:00", "2024-01-14 00:00:00"),
    ("2024-01-14 00:00:00", "2024-01-15 00:00:00"),
    ("2024-01-15 00:00:00", "2024-01-15 12:00:00"),
)
TRAIN_END = "2024-01-22 00:00:00"
VALIDATION_END = "2024-01-26 12:00:00"
INSTANT = "2024-01-20 03:41:12"
FLOW_BOUNDS = ("2024-01-25 09:17:00", "2024-01-25 10:17:00")
FROM_TIME = "2024-01-20 00:00:00"
LAG_NAMES = [name for name, _ in LAG_MINUTES]
FLOW_NAMES = [f"{c}_{w}" for c in FLOW_COLUMNS for w, _ in FLOW_MINUTES]
CHANGE_NAMES = [f"occupancy_change_{w}" for w in ("15m", "1h", "2h")]
ROLLING_NAMES = [f"rolling_mean_{c}_1h" for c in ("occupancy", "arrivals", "exits", "net_flow")]
TARGET_NAMES = [f"target_{m}m" for m in HORIZONS]
BASE_FEATURES = [
    "active_vehicles",
    *LAG_NAMES,
    *FLOW_NAMES,
    *CHANGE_NAMES,
    *ROLLING_NAMES,
    "hour",
    "day_of_week",
    "is_weekend",
]
MODEL_FEATURES = [*BASE_FEATURES, "horizon_minutes"]

W = "INTERVAL 15 MINUTE"
ACF_LAGS = 672  # a week of quarter hours
STEPS = [(name, m // 15) for name, m in LAG_MINUTES]


def r(x: str, digits: int = 6) -> str:
    return f"(round({x}, {digits}) + 0.0)"


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def bucket(x: str) -> str:
    return f"time_bucket({W}, {x})"


def bad(x: str) -> str:
    return "(" + " OR ".join(f"({x} >= {ts(a)} AND {x} < {ts(b)})" for a, b in BAD_PERIODS) + ")"


def overlap(a: str, b: str) -> str:
    hits = " OR ".join(f"({a} < {ts(hi)} AND {b} > {ts(lo)})" for lo, hi in BAD_PERIODS)
    return f"({b} > {a} AND ({hits}))"


def complete(day: str) -> str:
    return f"{day} NOT IN ({', '.join(f'DATE {chr(39)}{d}{chr(39)}' for d in BAD_DATES)})"


RAW = """raw AS (
  SELECT ts AS entry_time,
         ts + to_microseconds(CAST(round(value*60,1)*1000000 AS BIGINT)) AS exit_time,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS risk_category,
         value AS duration_min, event_type
  FROM events),
visits AS (
  SELECT entry_time, exit_time, coalesce(risk_category, 'UNKNOWN') AS risk_category, duration_min, event_type
  FROM raw)"""


def grid_ctes(keys: tuple[str, ...] = ()) -> str:
    """moves, flow, occ, flagged and wide; one series or one per key."""
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    using = ", ".join([*keys, "timestamp"])
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    lags = [
        f"CASE WHEN lag(is_reliable, {n}) OVER w THEN lag(active_vehicles, {n}) OVER w END AS {name}"
        for name, n in STEPS
    ]

    def frame(n: int) -> str:
        return f"OVER ({part}ORDER BY timestamp ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"

    def full(n: int) -> str:
        return f"sum(CAST(is_reliable AS INTEGER)) {frame(n)} = {n}"

    flows = [
        f"CASE WHEN {full(n)} THEN CAST(sum({c}) {frame(n)} AS BIGINT) END AS {c}_{label}"
        for c in FLOW_COLUMNS
        for label, n in ((label, m // 15) for label, m in FLOW_MINUTES)
    ]
    means = [
        f"CASE WHEN {full(4)} THEN avg({c}) {frame(4)} END AS rolling_mean_{name}_1h"
        for name, c in (
            ("occupancy", "active_vehicles"),
            ("arrivals", "arrivals"),
            ("exits", "exits"),
            ("net_flow", "net_flow"),
        )
    ]
    targets = [
        f"CASE WHEN lead(is_reliable, {m // 15}) OVER w THEN lead(active_vehicles, {m // 15}) OVER w END AS target_{m}m"
        for m in HORIZONS
    ]
    return f"""{RAW},
moves AS (
  SELECT {k}entry_time AS ts, 1 AS a, 0 AS x FROM visits UNION ALL
  SELECT {k}exit_time, 0, 1 FROM visits),
flow AS (
  SELECT {k}{bucket('ts')} AS timestamp, CAST(sum(a) AS BIGINT) AS arrivals, CAST(sum(x) AS BIGINT) AS exits
  FROM moves GROUP BY {k}{bucket('ts')}),
spine AS (
  SELECT {k}unnest(generate_series(lo, hi, {W})) AS timestamp
  FROM (SELECT {k}min(timestamp) AS lo, max(timestamp) AS hi FROM flow {group})),
grid AS (
  SELECT {k}timestamp, coalesce(arrivals, 0) AS arrivals, coalesce(exits, 0) AS exits,
         coalesce(arrivals, 0) - coalesce(exits, 0) AS net_flow
  FROM spine LEFT JOIN flow USING ({using})),
occ AS (
  SELECT *, CAST(sum(net_flow) OVER ({part}ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS BIGINT) AS active_vehicles
  FROM grid),
flagged AS (SELECT *, NOT {bad('timestamp')} AS is_reliable FROM occ),
lagged AS (
  SELECT *, {', '.join(lags)}, {', '.join(flows)}, {', '.join(means)}, {', '.join(targets)}
  FROM flagged WINDOW w AS ({part}ORDER BY timestamp)),
wide AS (
  SELECT *, active_vehicles - lag_15m AS occupancy_change_15m, active_vehicles - lag_1h AS occupancy_change_1h,
         active_vehicles - lag_2h AS occupancy_change_2h,
         CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
         CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend
  FROM lagged)"""


GRID = grid_ctes()
_FEATURES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in BASE_FEATURES)
_FULL = " AND ".join(["is_reliable", *[f"{c} IS NOT NULL" for c in BASE_FEATURES]])
LONG = (
    GRID
    + ",\nlong AS ("
    + " UNION ALL ".join(
        f"SELECT timestamp, {_FEATURES}, {m} AS horizon_minutes, CAST(target_{m}m AS DOUBLE) AS target "
        f"FROM wide WHERE {_FULL} AND target_{m}m IS NOT NULL"
        for m in HORIZONS
    )
    + f"""),
split AS (
  SELECT *, CASE WHEN timestamp < {ts(TRAIN_END)} THEN 'train'
                 WHEN timestamp < {ts(VALIDATION_END)} THEN 'validation' ELSE 'test' END AS split,
         timestamp + to_minutes(horizon_minutes) AS at_time
  FROM long)"""
)
def observed_ctes(keys: tuple[str, ...] = ()) -> str:
    """observed, days and mismatch on top of the grid; one series or one per key."""
    k = "".join(f"{c}, " for c in keys)
    middle = f"mids USING ({', '.join(keys)})" if keys else "mids ON TRUE"
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"""{grid_ctes(keys)},
came AS (SELECT DISTINCT {k}CAST(entry_time AS DATE) AS date FROM visits),
observed AS (
  SELECT * FROM (SELECT *, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hr FROM occ) AS o
  SEMI JOIN came USING ({k}date) WHERE {complete('date')}),
days AS (
  SELECT {k}date, CAST(sum(arrivals) AS BIGINT) AS arrivals, CAST(sum(exits) AS BIGINT) AS exits,
         CAST(sum(net_flow) AS BIGINT) AS net_flow, avg(active_vehicles) AS average_occupancy,
         max(active_vehicles) AS maximum_occupancy,
         CAST(hour(arg_min(timestamp, (-active_vehicles, timestamp))) AS INTEGER) AS peak_hour
  FROM observed GROUP BY {k}date),
mids AS (SELECT {k}median(arrivals) AS ma, median(average_occupancy) AS mo FROM days {group}),
mismatch AS (
  SELECT {k}date, arrivals, average_occupancy, maximum_occupancy,
         CASE WHEN arrivals > ma AND average_occupancy < mo THEN 'high arrivals, low occupancy'
              WHEN arrivals < ma AND average_occupancy > mo THEN 'low arrivals, high occupancy' END AS kind
  FROM days JOIN {middle})"""


OBSERVED = observed_ctes()
BY_CATEGORY = observed_ctes(("risk_category",))
# Visits without category are the series with a null key.
CATEGORY = "nullif(risk_category, 'UNKNOWN') AS risk_category"
CAL = (
    RAW
    + f""",
cal AS (
  SELECT *, CAST(entry_time AS DATE) AS entry_date, CAST(hour(entry_time) AS INTEGER) AS entry_hour,
         dayname(entry_time) AS entry_day, CAST(isodow(entry_time) - 1 AS INTEGER) AS day_of_week
  FROM visits),
full_days AS (SELECT * FROM cal WHERE {complete('entry_date')})"""
)


def instant_ctes(instants: str, keys: tuple[str, ...] = ()) -> str:
    """Counts before each instant and offset by as-of join, then the 29 features."""
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    on = "".join(f"p.{c} = c.{c} AND " for c in keys)
    pk = "".join(f"p.{c}, " for c in keys)
    e = {m: f"max(CASE WHEN o = {m} THEN e END)" for m in OFFSETS}
    x = {m: f"max(CASE WHEN o = {m} THEN x END)" for m in OFFSETS}
    cols = ", ".join([f"{e[m]} AS e{m}, {x[m]} AS x{m}" for m in OFFSETS])
    n = {m: f"(e{m} - x{m})" for m in OFFSETS}
    f = [f"{n[0]} AS active_vehicles"]
    f += [f"{n[m]} AS {name}" for name, m in LAG_MINUTES]
    f += [f"e0 - e{m} AS arrivals_{label}" for label, m in FLOW_MINUTES]
    f += [f"x0 - x{m} AS exits_{label}" for label, m in FLOW_MINUTES]
    f += [f"(e0 - e{m}) - (x0 - x{m}) AS net_flow_{label}" for label, m in FLOW_MINUTES]
    f += [f"{n[0]} - {n[m]} AS occupancy_change_{label}" for label, m in (("15m", 15), ("1h", 60), ("2h", 120))]
    f += [
        f"({n[15]} + {n[30]} + {n[45]} + {n[60]}) / 4.0::DOUBLE AS rolling_mean_occupancy_1h",
        "(e15 - e75) / 4.0::DOUBLE AS rolling_mean_arrivals_1h",
        "(x15 - x75) / 4.0::DOUBLE AS rolling_mean_exits_1h",
        "((e15 - e75) - (x15 - x75)) / 4.0::DOUBLE AS rolling_mean_net_flow_1h",
        "CAST(hour(prediction_time) AS INTEGER) AS hour",
        "CAST(isodow(prediction_time) - 1 AS INTEGER) AS day_of_week",
        "CAST(isodow(prediction_time) >= 6 AS INTEGER) AS is_weekend",
    ]
    return f"""{grid_ctes(keys)},
counts AS (
  SELECT {k}ts, CAST(sum(sum(a)) OVER ({part}ORDER BY ts) AS BIGINT) AS e,
         CAST(sum(sum(x)) OVER ({part}ORDER BY ts) AS BIGINT) AS x
  FROM moves GROUP BY {k}ts),
instants AS ({instants}),
probes AS (
  SELECT {k}prediction_time, o, prediction_time - to_minutes(o) AS at
  FROM instants, (SELECT unnest({list(OFFSETS)}) AS o) WHERE {reason('prediction_time')} IS NULL),
found AS (
  SELECT {pk}p.prediction_time, p.o, coalesce(c.e, 0) AS e, coalesce(c.x, 0) AS x
  FROM probes p ASOF LEFT JOIN counts c ON {on}p.at >= c.ts),
at_instant AS (SELECT {k}prediction_time, {cols} FROM found GROUP BY {k}prediction_time),
exact AS (
  SELECT {k}prediction_time, {', '.join(f)}, horizon_minutes
  FROM at_instant, (SELECT unnest({list(HORIZONS)}) AS horizon_minutes) WHERE e0 > 0)"""


def reason(t: str, seen: str | None = None) -> str:
    def back(m: int) -> str:
        return f"({t} - INTERVAL {m} MINUTE)"

    rules = [(bad(t), "instant unreliable")]
    rules += [(bad(back(m)), f"{name} unreliable") for name, m in LAG_MINUTES]
    rules += [(overlap(back(m), t), f"flow {label} unreliable") for label, m in FLOW_MINUTES]
    rules += [(bad(back(m)), "rolling unreliable") for m in PAST_MINUTES]
    rules += [(overlap(back(m + 15), back(m)), "rolling unreliable") for m in PAST_MINUTES]
    if seen:
        rules.append((f"NOT ({seen})", "before first entry"))
    return "(CASE " + " ".join(f"WHEN {c} THEN '{text}'" for c, text in rules) + " END)"


def _wide_select(names: list[str], doubles: tuple[str, ...] = ()) -> str:
    return ", ".join(f"{r(c)} AS {c}" if c in doubles else c for c in names)


MEANS = tuple(ROLLING_NAMES)
VISIT = "entry_time, exit_time, risk_category, duration_min"
METRICS = (
    f"{r('avg(abs(target - p))')} AS mae, {r('avg((target - p) * (target - p))')} AS mse, "
    f"{r('sqrt(avg((target - p) * (target - p)))')} AS rmse"
)
LONG_COLS = ["timestamp", *BASE_FEATURES, "horizon_minutes", "target"]
BASE = ["timestamp", "arrivals", "exits", "net_flow", "active_vehicles", "is_reliable"]
PACF_LAGS = ACF_LAGS


def _q(p: float, v: str = "duration_min") -> str:
    return r(f"quantile_cont({v}, {p})")


def _dirty() -> str:
    entry = "CASE event_type WHEN 'view' THEN NULL WHEN 'purchase' THEN exit_time ELSE entry_time END"
    leave = "CASE event_type WHEN 'purchase' THEN entry_time ELSE exit_time END"
    return f"""{RAW},
dirty AS (
  SELECT {entry} AS entry_time, {leave} AS exit_time, risk_category,
         CASE WHEN event_type = 'click' THEN NULL ELSE duration_min END AS duration_min
  FROM visits)"""


def _shares(thresholds: list[float]) -> str:
    return " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS threshold, count(*) FILTER (duration_min >= {t}) AS n, "
        f"{r(f'count(*) FILTER (duration_min >= {t}) * 100.0::DOUBLE / count(*)')} AS share_pct FROM visits"
        for t in thresholds
    )


def _quality() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
        f"{r(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)')} AS missing_pct, "
        f"count(DISTINCT {c}) AS distinct_values FROM raw"
        for c in VISIT.split(", ")
    )


def _describe(source: str, v: str, probs: dict[str, float]) -> str:
    rows = {
        "count": f"CAST(count({v}) AS DOUBLE)",
        "mean": f"avg({v})",
        "std": f"stddev_samp({v})",
        "min": f"CAST(min({v}) AS DOUBLE)",
        "max": f"CAST(max({v}) AS DOUBLE)",
        **{name: f"quantile_cont(CAST({v} AS DOUBLE), {p})" for name, p in probs.items()},
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS statistic, {r(x)} AS value FROM {source}" for name, x in rows.items()
    )


def _acf_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS horizon, {k} AS lag_steps, {r('corr(x, y)')} AS autocorrelation, "
        f"count(x + y) AS valid_pairs FROM (SELECT x, lag(x, {k}) OVER (ORDER BY timestamp) AS y FROM series)"
        for label, k in ((label, m // 15) for label, m in STUDY_LAGS)
    )


SERIES = GRID + """,
series AS (SELECT timestamp, CASE WHEN is_reliable THEN CAST(active_vehicles AS DOUBLE) END AS x FROM flagged)"""

SEGMENTS = GRID + """,
marks AS (
  SELECT *, CASE WHEN lag(is_reliable) OVER (ORDER BY timestamp) = is_reliable THEN 0 ELSE 1 END AS starts FROM flagged),
seg AS (SELECT *, CAST(sum(starts) OVER (ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM marks),
segments AS (
  SELECT segment_id, min(timestamp) AS start_ts, max(timestamp) AS end_ts, count(*) AS observations
  FROM seg WHERE is_reliable GROUP BY segment_id)"""


def _cov(source: str) -> str:
    """Autocovariance times n of column x of ``source`` (numbered by i) at lags 0..ACF_LAGS."""
    return f"""mean AS (SELECT avg(x) AS m, count(*) AS n FROM {source}),
cov AS (
  SELECT k, sum((a.x - m) * (b.x - m)) / any_value(n) AS c, any_value(n) AS n
  FROM {source} a, (SELECT unnest(range({ACF_LAGS + 1})) AS k) l, {source} b, mean
  WHERE b.i = a.i - k GROUP BY k)"""


PACF = (
    SEGMENTS
    + f""",
part AS (
  SELECT CAST(active_vehicles AS DOUBLE) AS x, row_number() OVER (ORDER BY timestamp) AS i FROM seg
  WHERE segment_id = (SELECT segment_id FROM segments ORDER BY observations DESC, segment_id LIMIT 1)),
{_cov('part')},
rho AS (SELECT list(c / c0 ORDER BY k) AS rr, any_value(n) AS n FROM cov, (SELECT c AS c0 FROM cov WHERE k = 0)),
dl(k, phi, rest, last) AS (
  SELECT 1, [rr[2]], 1.0 - rr[2] * rr[2], rr[2] FROM rho
  UNION ALL
  SELECT k + 1,
         list_append(list_transform(phi, lambda v, j: v - nxt * phi[k + 1 - j]), nxt),
         rest * (1.0 - nxt * nxt), nxt
  FROM (SELECT k, phi, rest,
               (rr[k + 2] - list_sum(list_transform(phi, lambda v, j: v * rr[k + 2 - j]))) / rest AS nxt
        FROM dl, rho WHERE k < {ACF_LAGS})),
parts AS (SELECT 0 AS k, 1.0::DOUBLE AS v UNION ALL SELECT k, last FROM dl)"""
)

H = 1.959963984540054


def oracle_sql() -> dict[str, str]:
    keyed = grid_ctes(("event_type",))
    wide_cols = [*BASE, *BASE_FEATURES[1:], *TARGET_NAMES]
    exact_doubles = ", ".join(
        f"{r(c)} AS {c}" if c in MEANS else c for c in ["prediction_time", *MODEL_FEATURES]
    )
    out = {
        "visits_scan": (RAW, f"SELECT {VISIT} FROM visits"),
        "visits_csv_roundtrip": (RAW, f"SELECT {VISIT} FROM visits"),
        "supervised_csv_roundtrip": (LONG, f"SELECT {_wide_select(LONG_COLS, MEANS)} FROM long"),
        "supervised_parquet_roundtrip": (LONG, f"SELECT {_wide_select(LONG_COLS, MEANS)} FROM long"),
        "visits_clean": (_dirty(), "SELECT * FROM dirty"),
        "validation_stats": (
            _dirty(),
            "SELECT count(*) AS visits, count(*) FILTER (entry_time IS NULL) AS broken_entry, "
            "count(*) FILTER (exit_time IS NULL) AS broken_exit, count(*) FILTER (duration_min IS NULL) AS broken_duration, "
            "count(*) FILTER (exit_time < entry_time) AS broken_order FROM dirty",
        ),
        "visits_lenient": (
            _dirty(),
            "SELECT * FROM dirty WHERE entry_time IS NOT NULL AND exit_time IS NOT NULL "
            "AND duration_min IS NOT NULL AND exit_time >= entry_time",
        ),
        "visits_from_time": (RAW, f"SELECT {VISIT} FROM visits WHERE exit_time >= {ts(FROM_TIME)}"),
        "recent_history": (
            RAW,
            f"SELECT {VISIT} FROM visits WHERE exit_time >= "
            "(SELECT greatest(max(entry_time), max(exit_time)) FROM visits) - INTERVAL 24 HOUR",
        ),
        "replay_head": (
            RAW,
            f"SELECT {VISIT} FROM visits ORDER BY exit_time, entry_time, duration_min, risk_category LIMIT 100",
        ),
        "latest_event_time": (
            RAW,
            "SELECT greatest(max(entry_time), max(exit_time)) AS latest_event_time FROM visits",
        ),
        "bucket_floor": (
            RAW,
            f"SELECT entry_time, {bucket('entry_time')} AS entry_bucket, {bucket('exit_time')} AS exit_bucket FROM visits",
        ),
        "arrivals_15m": (
            RAW,
            f"SELECT {bucket('entry_time')} AS timestamp, count(*) AS arrivals FROM visits GROUP BY 1",
        ),
        "exits_15m": (
            RAW,
            f"SELECT {bucket('exit_time')} AS timestamp, count(*) AS exits FROM visits GROUP BY 1",
        ),
        "time_grid": (GRID, "SELECT timestamp FROM spine"),
        "flow_grid": (GRID, "SELECT * FROM grid"),
        "occupancy_grid": (GRID, "SELECT * FROM occ"),
        "occupancy_grid_keyed": (keyed, "SELECT * FROM occ"),
        "event_occupancy": (
            GRID,
            "SELECT timestamp, change, CAST(sum(change) OVER (ORDER BY timestamp) AS BIGINT) AS active_vehicles FROM "
            "(SELECT ts AS timestamp, CAST(sum(a - x) AS BIGINT) AS change FROM moves GROUP BY ts)",
        ),
        "event_occupancy_keyed": (
            keyed,
            "SELECT event_type, timestamp, change, "
            "CAST(sum(change) OVER (PARTITION BY event_type ORDER BY timestamp) AS BIGINT) AS active_vehicles FROM "
            "(SELECT event_type, ts AS timestamp, CAST(sum(a - x) AS BIGINT) AS change FROM moves GROUP BY event_type, ts)",
        ),
        "occupancy_summary": (
            GRID,
            "SELECT count(*) AS intervals, min(active_vehicles) AS min_active, max(active_vehicles) AS max_active, "
            "arg_max(active_vehicles, timestamp) AS final_active FROM occ",
        ),
        "conservation_check": (
            GRID,
            "SELECT CAST(sum(arrivals) AS BIGINT) AS total_arrivals, CAST(sum(exits) AS BIGINT) AS total_exits, "
            "CAST(sum(net_flow) AS BIGINT) AS total_net_flow, min(active_vehicles) AS min_active, "
            "arg_max(active_vehicles, timestamp) AS final_active FROM occ",
        ),
        "grid_gap_check": (
            GRID,
            "SELECT gap AS gap_minutes, count(*) AS n FROM (SELECT CAST(date_diff('minute', "
            "lag(timestamp) OVER (ORDER BY timestamp), timestamp) AS BIGINT) AS gap FROM occ) WHERE gap IS NOT NULL GROUP BY gap",
        ),
        "flow_summary": (GRID, "SELECT timestamp AS bucket, arrivals, exits FROM flow"),
        "reliability_flag": (GRID, "SELECT * FROM flagged"),
        "reliability_flag_table": (GRID, "SELECT * FROM flagged"),
        "reliability_counts": (
            GRID,
            "SELECT is_reliable, count(*) AS intervals FROM flagged GROUP BY is_reliable",
        ),
        "bad_period_counts": (
            GRID,
            " UNION ALL ".join(
                f"SELECT '{a}' AS period_start, count(*) AS intervals FROM occ "
                f"WHERE timestamp >= {ts(a)} AND timestamp < {ts(b)} HAVING count(*) > 0"
                for a, b in BAD_PERIODS
            ),
        ),
        "reliable_segments": (SEGMENTS, "SELECT * FROM segments"),
        "longest_segment": (
            SEGMENTS,
            "SELECT timestamp, arrivals, exits, net_flow, active_vehicles, is_reliable, segment_id FROM seg "
            "WHERE segment_id = (SELECT segment_id FROM segments ORDER BY observations DESC, segment_id LIMIT 1)",
        ),
        "interval_overlap": (
            RAW,
            f"SELECT {VISIT}, {overlap('entry_time', 'exit_time')} AS overlaps_bad FROM visits",
        ),
        "occupancy_lags_raw": (
            GRID,
            "SELECT timestamp, active_vehicles, "
            + ", ".join(f"lag(active_vehicles, {n}) OVER (ORDER BY timestamp) AS {name}" for name, n in STEPS)
            + " FROM occ",
        ),
        "occupancy_lags": (GRID, f"SELECT timestamp, {', '.join(LAG_NAMES)} FROM wide"),
        "flow_windows": (GRID, f"SELECT timestamp, {', '.join(FLOW_NAMES)} FROM wide"),
        "occupancy_change": (GRID, f"SELECT timestamp, {', '.join(CHANGE_NAMES)} FROM wide"),
        "rolling_means": (GRID, f"SELECT timestamp, {_wide_select(list(MEANS), MEANS)} FROM wide"),
        "calendar_features": (GRID, "SELECT timestamp, hour, day_of_week, is_weekend FROM wide"),
        "targets_raw": (
            GRID,
            "SELECT timestamp, "
            + ", ".join(f"lead(active_vehicles, {m // 15}) OVER (ORDER BY timestamp) AS target_{m}m" for m in HORIZONS)
            + " FROM occ",
        ),
        "grid_null_audit": (
            GRID,
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM wide" for c in wide_cols
            ),
        ),
        "targets": (GRID, f"SELECT timestamp, {', '.join(TARGET_NAMES)} FROM wide"),
        "wide_frame": (GRID, f"SELECT {_wide_select(wide_cols, MEANS)} FROM wide"),
        "wide_frame_keyed": (keyed, f"SELECT event_type, {_wide_select(wide_cols, MEANS)} FROM wide"),
        "supervised_180m": (
            LONG,
            f"SELECT {_wide_select([c for c in LONG_COLS if c != 'horizon_minutes'], MEANS)} FROM long WHERE horizon_minutes = 180",
        ),
        "supervised_long": (LONG, f"SELECT {_wide_select(LONG_COLS, MEANS)} FROM long"),
        "rows_by_horizon": (LONG, "SELECT horizon_minutes, count(*) AS n FROM long GROUP BY 1"),
        "split_counts": (LONG, "SELECT split, horizon_minutes, count(*) AS n FROM split GROUP BY 1, 2"),
        "gbt_rows": (
            LONG,
            "SELECT horizon_minutes, count(*) AS n, 0::BIGINT AS crossed, 0::BIGINT AS unusable "
            "FROM split WHERE split = 'test' GROUP BY 1",
        ),
        "forecast_or_reason": (
            RAW,
            "SELECT t AS prediction_time, why IS NULL AS is_eligible, why AS reason, "
            "CASE WHEN why IS NULL THEN 6 ELSE 0 END::BIGINT AS n_horizons, "
            "CASE WHEN why IS NULL THEN inside::DOUBLE END AS current_active_vehicles FROM ("
            f"SELECT t, {reason('t', 't >= first')} AS why, "
            "(SELECT count(*) FILTER (entry_time <= t) - count(*) FILTER (exit_time <= t) FROM visits) AS inside FROM ("
            f"SELECT DISTINCT {bucket('entry_time')} AS t FROM visits UNION SELECT min(entry_time) - INTERVAL 1 HOUR FROM visits), "
            "(SELECT min(entry_time) AS first FROM visits))",
        ),
        "split_bounds": (
            LONG,
            "SELECT max(CASE WHEN i = floor(n * 0.70) + 1 THEN timestamp END) AS train_end, "
            "max(CASE WHEN i = floor(n * 0.85) + 1 THEN timestamp END) AS validation_end FROM "
            "(SELECT timestamp, row_number() OVER (ORDER BY timestamp) AS i, CAST(count(*) OVER () AS DOUBLE) AS n "
            "FROM long WHERE horizon_minutes = 180)",
        ),
        "split_ranges": (
            LONG,
            "SELECT split, min(timestamp) AS first_ts, max(timestamp) AS last_ts, count(*) AS n FROM split GROUP BY split",
        ),
        "target_audit": (
            LONG,
            "SELECT horizon_minutes, count(*) AS checked, "
            "count(*) FILTER (w.active_vehicles IS NULL OR w.active_vehicles <> s.target) AS mismatches "
            "FROM split s LEFT JOIN wide w ON w.timestamp = s.at_time GROUP BY horizon_minutes",
        ),
        "supervised_null_audit": (
            LONG,
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM long"
                for c in [*MODEL_FEATURES, "target"]
            ),
        ),
        "active_at": (
            RAW,
            f"SELECT {ts(INSTANT)} AS prediction_time, count(*) FILTER (entry_time <= {ts(INSTANT)} "
            f"AND exit_time > {ts(INSTANT)}) AS active FROM visits",
        ),
        "flow_between": (
            RAW,
            "SELECT "
            + ", ".join(
                f"count(*) FILTER ({c} > {ts(FLOW_BOUNDS[0])} AND {c} <= {ts(FLOW_BOUNDS[1])}) AS {name}"
                for c, name in (("entry_time", "arrivals"), ("exit_time", "exits"))
            )
            + " FROM visits",
        ),
        "exact_features_one": (
            instant_ctes(f"SELECT {ts(INSTANT)} AS prediction_time"),
            f"SELECT {exact_doubles} FROM exact",
        ),
        "exact_features_latest": (
            instant_ctes("SELECT greatest(max(entry_time), max(exit_time)) AS prediction_time FROM visits"),
            f"SELECT {exact_doubles} FROM exact",
        ),
        "prediction_eligibility_keyed": (
            RAW,
            f"SELECT {CATEGORY}, prediction_time, why IS NULL AS is_eligible, why AS reason FROM "
            f"(SELECT risk_category, prediction_time, {reason('prediction_time', 'prediction_time >= first')} AS why FROM "
            "(SELECT DISTINCT risk_category, exit_time - INTERVAL 1 DAY AS prediction_time FROM visits) JOIN "
            "(SELECT risk_category, min(entry_time) AS first FROM visits GROUP BY 1) USING (risk_category))",
        ),
        "prediction_eligibility": (
            RAW,
            f"SELECT prediction_time, why IS NULL AS is_eligible, why AS reason FROM (SELECT prediction_time, "
            f"{reason('prediction_time', 'prediction_time >= first')} AS why FROM "
            "(SELECT DISTINCT exit_time - INTERVAL 1 DAY AS prediction_time FROM visits), "
            "(SELECT min(entry_time) AS first FROM visits))",
        ),
        "exact_features_batch": (
            instant_ctes("SELECT DISTINCT entry_time AS prediction_time FROM visits"),
            f"SELECT {exact_doubles} FROM exact",
        ),
        "exact_features_batch_keyed": (
            instant_ctes(
                "SELECT DISTINCT event_type, entry_time AS prediction_time FROM visits", ("event_type",)
            ),
            f"SELECT event_type, {exact_doubles} FROM exact",
        ),
        "duration_check": (
            RAW,
            f"SELECT {r('max(d)')} AS max_abs_diff, {r('avg(d)')} AS mean_abs_diff, count(*) FILTER (d > 0.0005) AS over_tolerance "
            "FROM (SELECT abs(duration_min - date_diff('microsecond', entry_time, exit_time) / 60000000.0::DOUBLE) AS d FROM visits)",
        ),
        "duration_worst": (
            RAW,
            f"SELECT entry_time, exit_time, {r('duration_min', 9)} AS duration_min, {r('c', 9)} AS computed_min, "
            f"{r('duration_min - c', 9)} AS difference_min FROM (SELECT *, "
            "date_diff('microsecond', entry_time, exit_time) / 60000000.0::DOUBLE AS c FROM visits) "
            "ORDER BY round(abs(duration_min - c), 9) DESC, entry_time, exit_time, visits_order LIMIT 10".replace(
                "visits_order", "duration_min"
            ),
        ),
        "quality_summary": (RAW, _quality()),
        "quality_sketch_errors": (
            RAW,
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER ({c} IS NULL) AS missing, "
                "true AS within_3_pct FROM raw"
                for c in ("entry_time", "exit_time", "risk_category", "duration_min")
            ),
        ),
        "timestamp_quality": (
            RAW,
            "SELECT count(*) FILTER (entry_time IS NULL) AS missing_entry, count(*) FILTER (exit_time IS NULL) AS missing_exit, "
            "count(*) FILTER (entry_time >= exit_time) AS entry_not_before_exit, "
            "count(*) FILTER (duration_min <= 0) AS duration_not_positive, min(entry_time) AS earliest_entry, "
            "max(entry_time) AS latest_entry, min(exit_time) AS earliest_exit, max(exit_time) AS latest_exit FROM raw",
        ),
        "duplicate_rows": (
            RAW,
            "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM "
            "(SELECT count(*) AS n FROM raw GROUP BY entry_time, exit_time, risk_category, duration_min)",
        ),
        "duplicate_pairs": (
            RAW,
            f"SELECT {VISIT} FROM (SELECT *, count(*) OVER (PARTITION BY entry_time, exit_time) AS c FROM visits) WHERE c > 1",
        ),
        "duplicate_pairs_minute": (
            RAW,
            f"SELECT {VISIT}, entry_minute, exit_minute FROM (SELECT *, count(*) OVER (PARTITION BY entry_minute, exit_minute) AS c "
            "FROM (SELECT *, date_trunc('minute', entry_time) AS entry_minute, date_trunc('minute', exit_time) AS exit_minute "
            "FROM visits)) WHERE c > 1",
        ),
        "category_counts": (RAW, "SELECT risk_category, count(*) AS n FROM raw GROUP BY 1"),
        "dwell_stats": (
            RAW,
            _describe("visits", "duration_min", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}),
        ),
        "dwell_histogram": (
            RAW,
            "SELECT CAST(b AS INTEGER) AS bin, count(v) AS n FROM (SELECT unnest(range(72)) AS b) "
            "LEFT JOIN (SELECT duration_min AS v, least(floor((duration_min - lo) / ((hi - lo) / 72)), 71) AS k FROM visits, "
            "(SELECT min(duration_min) AS lo, max(duration_min) AS hi FROM visits)) ON k = b GROUP BY b",
        ),
        "dwell_tail_counts": (RAW, _shares([60.0, 120.0, 240.0, 300.0, 600.0])),
        "dwell_tail_percentiles": (
            RAW,
            f"SELECT count(*) AS n, {_q(0.5)} AS p50, {_q(0.75)} AS p75, {_q(0.9)} AS p90, {_q(0.95)} AS p95, "
            f"{_q(0.99)} AS p99 FROM visits WHERE duration_min >= 120",
        ),
        "top_dwell": (
            RAW,
            "SELECT duration_min, entry_time, exit_time, risk_category FROM visits "
            "ORDER BY duration_min DESC, entry_time, exit_time, risk_category LIMIT 20",
        ),
        "extreme_by_category": (
            RAW,
            "SELECT risk_category, count(*) AS total_vehicles, count(*) FILTER (duration_min >= 120) AS extreme_vehicles, "
            f"{r('count(*) FILTER (duration_min >= 120) * 100.0::DOUBLE / count(*)')} AS extreme_percentage FROM raw GROUP BY 1",
        ),
        "dwell_by_category": (
            RAW,
            f"SELECT risk_category, count(duration_min) AS n, {_q(0.5)} AS median, {_q(0.75)} AS p75, {_q(0.9)} AS p90, "
            f"{_q(0.95)} AS p95 FROM raw GROUP BY 1",
        ),
        "visit_calendar": (CAL, "SELECT entry_time, entry_date, entry_hour, entry_day, day_of_week FROM cal"),
        "daily_arrivals": (
            CAL,
            "SELECT entry_date, count(*) AS arrivals, max(entry_time) AS latest_entry FROM cal GROUP BY 1",
        ),
        "busiest_days": (
            CAL,
            "SELECT * FROM (SELECT entry_date, count(*) AS arrivals, 'largest' AS side FROM full_days GROUP BY 1 "
            "ORDER BY arrivals DESC, entry_date LIMIT 5) UNION ALL SELECT * FROM (SELECT entry_date, count(*) AS arrivals, "
            "'smallest' AS side FROM full_days GROUP BY 1 ORDER BY arrivals, entry_date LIMIT 5)",
        ),
        "daily_coverage": (
            CAL,
            "SELECT entry_date, count(*) AS arrivals, min(entry_time) AS first_entry, max(entry_time) AS last_entry, "
            "count(DISTINCT entry_hour) AS active_hours FROM cal GROUP BY 1",
        ),
        "single_day_hours": (
            CAL,
            "SELECT entry_hour, count(*) AS n FROM cal WHERE entry_date = DATE '2024-01-13' GROUP BY 1",
        ),
        "hourly_counts_filled": (
            CAL,
            "SELECT d.entry_date, CAST(h AS INTEGER) AS entry_hour, count(c.entry_time) AS n FROM "
            "(SELECT DISTINCT entry_date FROM cal) d CROSS JOIN (SELECT unnest(range(24)) AS h) "
            "LEFT JOIN cal c ON c.entry_date = d.entry_date AND c.entry_hour = h GROUP BY 1, 2",
        ),
        "complete_day_summary": (
            CAL,
            f"SELECT count(*) AS complete_days, {r('avg(n)')} AS mean_arrivals, min(n) AS min_arrivals, max(n) AS max_arrivals "
            "FROM (SELECT count(*) AS n FROM full_days GROUP BY entry_date)",
        ),
        "daily_arrival_stats": (
            CAL + ", days AS (SELECT count(*) AS arrivals FROM cal GROUP BY entry_date)",
            _describe("days", "arrivals", {"p25": 0.25, "p50": 0.5, "p75": 0.75}),
        ),
        "hourly_avg_arrivals": (
            CAL,
            f"SELECT entry_hour, {r('v')} AS avg_arrivals, row_number() OVER (ORDER BY v DESC, entry_hour) = 1 AS is_busiest, "
            "row_number() OVER (ORDER BY v, entry_hour) = 1 AS is_quietest FROM (SELECT entry_hour, "
            "count(*)::DOUBLE / (SELECT count(DISTINCT entry_date) FROM full_days) AS v FROM full_days GROUP BY 1)",
        ),
        "weekday_arrivals": (
            CAL,
            "SELECT day_of_week, entry_day, count(*) AS total_arrivals, count(DISTINCT entry_date) AS observed_days, "
            f"{r('count(*)::DOUBLE / count(DISTINCT entry_date)')} AS average_arrivals FROM full_days GROUP BY 1, 2",
        ),
        "hourly_occupancy": (
            GRID,
            f"SELECT hour, {r('m')} AS average_occupancy, x AS maximum_occupancy, "
            "row_number() OVER (ORDER BY m DESC, hour) = 1 AS is_mean_peak, row_number() OVER (ORDER BY x DESC, hour) = 1 AS is_max_peak "
            "FROM (SELECT CAST(hour(timestamp) AS INTEGER) AS hour, avg(active_vehicles) AS m, max(active_vehicles) AS x FROM occ "
            f"WHERE {complete('CAST(timestamp AS DATE)')} GROUP BY 1)",
        ),
        "hourly_net_flow": (
            OBSERVED,
            f"SELECT hr AS hour, {r('avg(a)')} AS avg_arrivals, {r('avg(x)')} AS avg_exits, {r('avg(f)')} AS avg_net_flow, "
            "CAST(sign(avg(f)) AS INTEGER) AS flow_sign FROM (SELECT date, hr, sum(arrivals) AS a, sum(exits) AS x, sum(net_flow) AS f "
            "FROM observed GROUP BY 1, 2) GROUP BY hr",
        ),
        "daily_occupancy": (
            OBSERVED,
            f"SELECT date, arrivals, exits, net_flow, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, peak_hour FROM days",
        ),
        "peak_hour_counts": (OBSERVED, "SELECT peak_hour, count(*) AS days FROM days GROUP BY 1"),
        "top_occupancy_days": (
            OBSERVED,
            f"SELECT date, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, peak_hour FROM days "
            "ORDER BY maximum_occupancy DESC, date LIMIT 10",
        ),
        "weekday_occupancy": (
            OBSERVED,
            f"SELECT CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, dayname(timestamp) AS day, {r('avg(active_vehicles)')} AS average_occupancy, "
            "max(active_vehicles) AS maximum_occupancy FROM observed GROUP BY 1, 2",
        ),
        "weekday_comparison": (
            OBSERVED,
            f"SELECT day_of_week, {r('average_arrivals')} AS average_arrivals, day, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, "
            "CAST(rank() OVER (ORDER BY average_arrivals DESC) AS INTEGER) AS arrival_rank, "
            "CAST(rank() OVER (ORDER BY average_occupancy DESC) AS INTEGER) AS occupancy_rank FROM "
            "(SELECT CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, dayname(timestamp) AS day, "
            "sum(arrivals)::DOUBLE / count(DISTINCT date) AS average_arrivals, avg(active_vehicles) AS average_occupancy, "
            "max(active_vehicles) AS maximum_occupancy FROM observed GROUP BY 1, 2)",
        ),
        "hourly_net_flow_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, hr AS hour, {r('avg(a)')} AS avg_arrivals, {r('avg(x)')} AS avg_exits, {r('avg(f)')} AS avg_net_flow, "
            "CAST(sign(avg(f)) AS INTEGER) AS flow_sign FROM (SELECT risk_category, date, hr, sum(arrivals) AS a, sum(exits) AS x, "
            "sum(net_flow) AS f FROM observed GROUP BY ALL) AS q GROUP BY q.risk_category, hr",
        ),
        "mismatch_days_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, date, arrivals, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, kind "
            "FROM mismatch WHERE kind IS NOT NULL",
        ),
        "daily_detail_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, date, d.arrivals, exits, net_flow, {r('d.average_occupancy')} AS average_occupancy, "
            f"d.maximum_occupancy, {r('dwell')} AS average_dwell FROM days d JOIN (SELECT risk_category, date FROM mismatch "
            "WHERE kind IS NOT NULL) USING (risk_category, date) LEFT JOIN (SELECT risk_category, CAST(entry_time AS DATE) AS date, "
            "avg(duration_min) AS dwell FROM visits GROUP BY ALL) USING (risk_category, date)",
        ),
        "top_occupancy_days_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, date, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, peak_hour FROM days AS q "
            "QUALIFY row_number() OVER (PARTITION BY q.risk_category ORDER BY maximum_occupancy DESC, date) <= 10",
        ),
        "hourly_occupancy_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, hour, {r('m')} AS average_occupancy, x AS maximum_occupancy, "
            "row_number() OVER (PARTITION BY q.risk_category ORDER BY m DESC, hour) = 1 AS is_mean_peak, "
            "row_number() OVER (PARTITION BY q.risk_category ORDER BY x DESC, hour) = 1 AS is_max_peak FROM "
            "(SELECT risk_category, CAST(hour(timestamp) AS INTEGER) AS hour, avg(active_vehicles) AS m, "
            f"max(active_vehicles) AS x FROM occ WHERE {complete('CAST(timestamp AS DATE)')} GROUP BY ALL) AS q",
        ),
        "weekday_comparison_keyed": (
            BY_CATEGORY,
            f"SELECT {CATEGORY}, day_of_week, {r('average_arrivals')} AS average_arrivals, day, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, "
            "CAST(rank() OVER (PARTITION BY q.risk_category ORDER BY average_arrivals DESC) AS INTEGER) AS arrival_rank, "
            "CAST(rank() OVER (PARTITION BY q.risk_category ORDER BY average_occupancy DESC) AS INTEGER) AS occupancy_rank FROM "
            "(SELECT risk_category, CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, dayname(timestamp) AS day, "
            "sum(arrivals)::DOUBLE / count(DISTINCT date) AS average_arrivals, avg(active_vehicles) AS average_occupancy, "
            "max(active_vehicles) AS maximum_occupancy FROM observed GROUP BY ALL) AS q",
        ),
        "mismatch_days": (
            OBSERVED,
            f"SELECT date, arrivals, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, kind FROM mismatch WHERE kind IS NOT NULL",
        ),
        "daily_detail": (
            OBSERVED,
            f"SELECT d.date, arrivals, exits, net_flow, {r('average_occupancy')} AS average_occupancy, maximum_occupancy, "
            f"{r('dwell')} AS average_dwell FROM days d LEFT JOIN (SELECT CAST(entry_time AS DATE) AS date, avg(duration_min) AS dwell "
            "FROM visits GROUP BY 1) v ON v.date = d.date WHERE d.date IN (SELECT date FROM mismatch WHERE kind IS NOT NULL)",
        ),
        "daily_state": (
            OBSERVED,
            "SELECT date, (SELECT coalesce(CAST(sum(a - x) AS BIGINT), 0) FROM moves WHERE ts < CAST(date AS TIMESTAMP)) AS starting_occupancy, "
            "(SELECT coalesce(CAST(sum(a - x) AS BIGINT), 0) FROM moves WHERE ts < CAST(date AS TIMESTAMP) + INTERVAL 1 DAY) AS ending_occupancy FROM days",
        ),
        "weekday_dwell": (
            CAL,
            f"SELECT day_of_week, entry_day, count(*) AS n, {_q(0.5)} AS median_dwell, {_q(0.9)} AS p90_dwell FROM full_days GROUP BY 1, 2",
        ),
        "acf_at_horizons": (SERIES, _acf_rows()),
        "acf_full": (
            SERIES + ", placed AS (SELECT x, row_number() OVER (ORDER BY timestamp) AS i FROM series)",
            f"SELECT CAST(k AS INTEGER) AS lag_steps, CAST(k * 15 AS INTEGER) AS lag_minutes, {r('corr(a.x, b.x)')} AS autocorrelation "
            f"FROM placed a, (SELECT unnest(range(1, {ACF_LAGS + 1})) AS k), placed b WHERE b.i = a.i - k GROUP BY k",
        ),
        "acf_standard": (
            SERIES
            + ", placed AS (SELECT x, row_number() OVER (ORDER BY timestamp) AS i FROM series WHERE x IS NOT NULL), "
            + _cov("placed"),
            f"SELECT CAST(k AS INTEGER) AS lag_steps, CAST(k * 15 AS INTEGER) AS lag_minutes, "
            f"{r('c / (SELECT c FROM cov WHERE k = 0)')} AS autocorrelation FROM cov",
        ),
        "pacf": (
            PACF,
            f"SELECT CAST(k AS INTEGER) AS lag_steps, CAST(k * 15 AS INTEGER) AS lag_minutes, {r('v')} AS partial_autocorrelation, "
            f"{r(f'CASE WHEN k = 0 THEN v ELSE v - {H} / sqrt(n) END')} AS lower_ci, "
            f"{r(f'CASE WHEN k = 0 THEN v ELSE v + {H} / sqrt(n) END')} AS upper_ci FROM parts, rho",
        ),
        "baseline_persistence": (
            LONG,
            f"SELECT horizon_minutes, {METRICS}, count(*) AS n FROM (SELECT *, active_vehicles AS p FROM split WHERE split = 'test') GROUP BY 1",
        ),
        "baseline_hourly_mean": (
            LONG,
            f"SELECT horizon_minutes, {METRICS}, count(*) AS n FROM (SELECT s.*, p FROM split s LEFT JOIN "
            "(SELECT hour(at_time) AS h, avg(target) AS p FROM split WHERE split = 'train' GROUP BY 1) ON hour(s.at_time) = h "
            "WHERE s.split = 'test') GROUP BY 1",
        ),
        "baseline_previous_day": (
            LONG,
            f"SELECT horizon_minutes, {METRICS}, count(p) AS n, count(*) FILTER (p IS NULL) AS missing FROM (SELECT s.*, p FROM split s LEFT JOIN "
            "(SELECT DISTINCT timestamp AS t0, active_vehicles AS p FROM long) ON t0 = s.at_time - INTERVAL 24 HOUR "
            "WHERE s.split = 'test') GROUP BY 1",
        ),
        "metric_summary": (
            LONG,
            f"SELECT {r('avg(a)')} AS mean_mae, {r('avg(b)')} AS mean_mse, {r('avg(c)')} AS mean_rmse FROM "
            "(SELECT avg(abs(target - p)) AS a, avg((target - p) * (target - p)) AS b, sqrt(avg((target - p) * (target - p))) AS c "
            "FROM (SELECT *, active_vehicles AS p FROM split WHERE split = 'test') GROUP BY horizon_minutes)",
        ),
        "quantile_metrics": (
            LONG,
            f"SELECT horizon_minutes, {r('avg(greatest(0.9::DOUBLE * e, -0.1::DOUBLE * e))')} AS pinball_loss, {r('avg(CAST(e <= 0 AS INTEGER))')} AS coverage, "
            f"{r('avg(abs(e))')} AS mae, count(*) AS n FROM (SELECT horizon_minutes, target - (greatest(active_vehicles, lag_15m) + 3) AS e FROM long) GROUP BY 1",
        ),
        "quantile_summary": (
            LONG,
            f"SELECT {r('avg(a)')} AS mean_pinball_loss, {r('avg(b)')} AS mean_coverage, {r('avg(c)')} AS mean_mae FROM "
            "(SELECT avg(greatest(0.5::DOUBLE * e, -0.5::DOUBLE * e)) AS a, avg(CAST(e <= 0 AS INTEGER)) AS b, avg(abs(e)) AS c FROM "
            "(SELECT horizon_minutes, target - lag_15m AS e FROM long) GROUP BY horizon_minutes)",
        ),
        "quantile_crossing": (
            LONG,
            "SELECT count(*) FILTER (active_vehicles < lag_15m) AS crossed, count(*) AS total FROM long",
        ),
        "promotion_decision": (
            LONG
            + """,
scored AS (
  SELECT 'v001' AS version, horizon_minutes, target, active_vehicles AS p FROM split WHERE split = 'test'
  UNION ALL
  SELECT 'v002', s.horizon_minutes, s.target, p FROM split s LEFT JOIN
    (SELECT hour(at_time) AS h, avg(target) AS p FROM split WHERE split = 'train' GROUP BY 1) ON hour(s.at_time) = h
  WHERE s.split = 'test'),
summary AS (
  SELECT version, avg(a) AS mae, avg(b) AS mse FROM
    (SELECT version, avg(abs(target - p)) AS a, avg((target - p) * (target - p)) AS b FROM scored GROUP BY version, horizon_minutes)
  GROUP BY version)""",
            f"SELECT c.version AS candidate_version, {r('c.mae')} AS candidate_mae, {r('c.mse')} AS candidate_mse, "
            f"a.version AS previous_version, {r('a.mae')} AS previous_mae, {r('a.mse')} AS previous_mse, "
            "CASE WHEN c.mae < a.mae AND c.mse < a.mse THEN 'promoted' ELSE 'candidate_rejected' END AS decision, "
            "CASE WHEN c.mae < a.mae AND c.mse < a.mse THEN 'lower MAE and lower MSE' ELSE 'not lower in both MAE and MSE' END AS reason, "
            "CASE WHEN c.mae < a.mae AND c.mse < a.mse THEN c.version ELSE a.version END AS active_version "
            "FROM summary c, summary a WHERE c.version = 'v002' AND a.version = 'v001'",
        ),
        "peak_of_fixed": (
            LONG,
            "SELECT prediction_time, h AS horizon_minutes, p AS point_prediction, prediction_time + to_minutes(h) AS forecast_timestamp FROM "
            "(SELECT timestamp AS prediction_time, target AS p, horizon_minutes AS h, "
            "row_number() OVER (PARTITION BY timestamp ORDER BY target DESC, horizon_minutes) AS i FROM long) WHERE i = 1",
        ),
        "parse_events": (
            RAW,
            "SELECT CASE WHEN event_type = 'view' THEN entry_time END AS event_time, entry_time, exit_time, risk_category, duration_min "
            "FROM visits WHERE event_type <> 'click'",
        ),
    }
    # The same periods from a table give the same rows.
    out["wide_frame_periods"] = out["wide_frame_keyed"]
    out["prediction_eligibility_periods"] = out["prediction_eligibility_keyed"]
    out["exact_features_periods"] = out["exact_features_batch_keyed"]
    return {
        name: f"WITH {'RECURSIVE ' if name == 'pacf' else ''}{ctes}\n{select}" for name, (ctes, select) in out.items()
    }
