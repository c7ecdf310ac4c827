"""Autocorrelation of the occupancy series.

A few labelled lags are read through a trailing frame inside a time chunk. For all lags up to a bound, a chunk
and the rows just before it become one array, and the sums of products of its slices against
themselves, one row per lag, are all that leaves a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.functions.running import CHUNK, HOME, drop_halo, halo, in_chunk, running_total
from dwellgrid.functions.timecols import floor_index
from dwellgrid.operators.reliability import longest_segment
from dwellgrid.settings import Settings

# The labelled lags of the horizon study, in minutes.
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
MAX_LAG = 672
NORMAL_95 = 1.959963984540054


def _masked_series(flagged: DataFrame, s: Settings) -> DataFrame:
    return flagged.selectExpr(
        *s.keys, "timestamp", "CASE WHEN is_reliable THEN cast(active_vehicles AS double) END AS x"
    )


def _near(flagged: DataFrame, steps: int, s: Settings) -> DataFrame:
    """The masked series in chunks of at least four lookbacks, so a fifth of it at most is copies."""
    back = steps * s.bucket_seconds
    return halo(_masked_series(flagged, s), "timestamp", max(s.chunk_seconds, 4 * back), back)


def acf_at(flagged: DataFrame, lags: Sequence[tuple[str, int]] = STUDY_LAGS, s: Settings = Settings()) -> DataFrame:
    """Pearson correlation with each labelled lag over the pairs where both ends are reliable."""
    lags = [(label, s.steps(minutes)) for label, minutes in lags]
    near = _near(flagged, max(k for _, k in lags), s)
    w = in_chunk(s.keys, "timestamp")
    rows = drop_halo(near.selectExpr("*", *[f"lag(x, {k}) {w} AS x_{k}" for _, k in lags]))
    stats = rows.groupBy(*s.keys).agg(
        *[F.expr(f"corr(x, x_{k})").alias(f"r_{k}") for _, k in lags],
        *[F.expr(f"count(x + x_{k})").alias(f"n_{k}") for _, k in lags],
    )
    cells = ", ".join(f"'{label}', {k}, r_{k}, n_{k}" for label, k in lags)
    return stats.selectExpr(
        *s.keys,
        f"stack({len(lags)}, {cells}) AS (horizon, lag_steps, autocorrelation, valid_pairs)",
    )


SUMS = ("pairs", "sx", "sy", "sxy", "sxx", "syy")


def _lag_sums(near: DataFrame, max_lag: int, order: str, keys: Sequence[str]) -> DataFrame:
    """Per lag from 0: pairs of a value and the one ``lag`` places before it, and their sums.

    ``near`` has every place of the series, in chunks of ``halo``; a pair with a null doesn't count.
    """

    # Local, so that it travels with the plan and workers need not import this package.
    @F.pandas_udf("array<double>")
    def products(values: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for v, mine in zip(values, own):
            x = np.asarray(v, dtype=float)
            there = ~np.isnan(x)
            m, z = there.astype(float), np.where(there, x, 0.0)
            q, n = z * z, len(x)
            first = n - int(np.sum(mine))  # rows of the chunk before come first
            sums = np.zeros((max_lag + 1, 6))
            for k in range(min(max_lag + 1, n)):
                a, b = slice(max(first, k), n), slice(max(first, k) - k, n - k)
                sums[k] = m[a] @ m[b], z[a] @ m[b], m[a] @ z[b], z[a] @ z[b], q[a] @ m[b], m[a] @ q[b]
            out.append(sums.ravel())
        return pd.Series(out, dtype=object)

    row = F.struct(F.col(order), "x", (F.col(HOME) == F.col(CHUNK)).cast("int").alias("own"))
    # The rows of one chunk and its halo, which the chunk length bounds.
    chunks = near.groupBy(*keys, CHUNK).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    named = ", ".join(f"__s[6 * k + {i}] AS {c}" for i, c in enumerate(SUMS))
    lags = chunks.select(
        *keys, products(F.col("__rows.x"), F.col("__rows.own")).alias("__s")
    ).selectExpr(*keys, f"inline(transform(sequence(0, {max_lag}), k -> struct(k AS lag_steps, {named})))")
    return (
        lags.groupBy(*keys, "lag_steps")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
        .filter("pairs > 0")
    )


def acf_pairwise(flagged: DataFrame, max_lag: int = MAX_LAG, s: Settings = Settings()) -> DataFrame:
    """Pearson autocorrelation at every lag from 1 to ``max_lag``."""
    sums = _lag_sums(_near(flagged, max_lag, s), max_lag, "timestamp", s.keys)
    spread = "sqrt(greatest(pairs * sxx - sx * sx, 0) * greatest(pairs * syy - sy * sy, 0))"
    return sums.filter("lag_steps > 0").selectExpr(
        *s.keys,
        "lag_steps",
        f"(pairs * sxy - sx * sy) / nullif({spread}, 0) AS autocorrelation",
        f"lag_steps * {s.bucket_minutes} AS lag_minutes",
    )


def _numbered(series: DataFrame, s: Settings) -> DataFrame:
    """Replace the time by the position (from 0) among the rows of the series."""
    part = floor_index("timestamp", s.chunk_seconds)
    rows = series.selectExpr(*s.keys, "timestamp", "x", "1L AS __one", f"{part} AS __part")
    return running_total(
        rows, ["timestamp"], {"__place": "__one"}, s.keys, ["__part"]
    ).selectExpr(*s.keys, "__place - 1 AS pos", "x")


def _autocovariance(placed: DataFrame, max_lag: int, s: Settings) -> DataFrame:
    """Of rows (pos, x) without gaps in ``pos``: per lag the covariance sum around the overall mean,
    divided by n, and n.

    With the sums of x, y and xy over the pairs of a lag and the overall mean from lag 0,
    sum (x - m)(y - m) = sum xy - m (sum x + sum y) + pairs * m * m.
    """
    length = 4 * max_lag
    near = placed.selectExpr(
        "*",
        f"pos div {length} AS {HOME}",
        f"explode(sequence(pos div {length}, (pos + {max_lag}) div {length})) AS {CHUNK}",
    )
    sums = _lag_sums(near, max_lag, "pos", s.keys)
    # max_lag + 1 rows per series.
    over = f"OVER ({'PARTITION BY ' + ', '.join(s.keys) if s.keys else ''})"
    first = f"max(CASE WHEN lag_steps = 0 THEN {{}} END) {over}"
    return sums.selectExpr(
        "*", f"cast({first.format('pairs')} AS bigint) AS n", f"{first.format('sx / pairs')} AS m"
    ).selectExpr(
        *s.keys, "lag_steps", "(sxy - m * (sx + sy) + pairs * m * m) / n AS autocovariance", "n"
    )


def acf_standard(flagged: DataFrame, max_lag: int = MAX_LAG, s: Settings = Settings()) -> DataFrame:
    """Autocorrelation of the series with the unreliable rows cut out, one mean, n in the divisor."""
    cut = _masked_series(flagged, s).filter("x IS NOT NULL")
    cov = _autocovariance(_numbered(cut, s), max_lag, s)
    over = f"OVER ({'PARTITION BY ' + ', '.join(s.keys) if s.keys else ''})"
    zero = f"max(CASE WHEN lag_steps = 0 THEN autocovariance END) {over}"
    return cov.selectExpr(
        *s.keys,
        "lag_steps",
        f"lag_steps * {s.bucket_minutes} AS lag_minutes",
        f"autocovariance / {zero} AS autocorrelation",
    )


def pacf(flagged: DataFrame, max_lag: int = MAX_LAG, s: Settings = Settings()) -> DataFrame:
    """Partial autocorrelation of the longest reliable segment with a 95 % band.

    The sums over the series run in Spark; the recursion gets the ``max_lag + 1``
    autocovariances of a series and nothing else.
    """

    # Local, so that it travels with the plan and workers need not import this package.
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        """The Yule-Walker equations of growing order (Durbin-Levinson) for one series."""
        pdf = pdf.sort_values("lag_steps").reset_index(drop=True)
        r = (pdf["autocovariance"] / pdf["autocovariance"].iloc[0]).to_numpy()
        values, phi, rest = [1.0], r[1:1], 1.0
        for k in range(1, len(r)):
            past = r[1:k]
            last = (r[k] - phi @ past[::-1]) / rest
            phi = np.append(phi - last * phi[::-1], last)
            rest *= 1.0 - last * last
            values.append(float(last))
        return pdf.assign(partial_autocorrelation=values)

    # A segment has every bucket, so the bucket number is the position.
    place = floor_index("timestamp", s.bucket_seconds)
    series = longest_segment(flagged, s).selectExpr(
        *s.keys, f"{place} AS pos", "cast(active_vehicles AS double) AS x"
    )
    cov = _autocovariance(series, max_lag, s).selectExpr("*", "0 AS __one")
    schema = ", ".join(f"{name} {kind}" for name, kind in cov.dtypes)
    solved = cov.groupBy(*s.keys, "__one").applyInPandas(
        solve, f"{schema}, partial_autocorrelation double"
    )
    half = f"CASE WHEN lag_steps = 0 THEN 0.0D ELSE {NORMAL_95}D / sqrt(n) END"
    return solved.selectExpr(
        *s.keys,
        "lag_steps",
        f"lag_steps * {s.bucket_minutes} AS lag_minutes",
        "partial_autocorrelation",
        f"partial_autocorrelation - {half} AS lower_ci",
        f"partial_autocorrelation + {half} AS upper_ci",
    )
