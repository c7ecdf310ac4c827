"""The long supervised set, its chronological split and its audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.running import running_total
from dwellgrid.functions.timecols import floor_index, shift, ts_lit
from dwellgrid.settings import Settings


def _complete(s: Settings) -> str:
    # One condition per column: a single expression over all of them, as dropna makes it,
    # sends the optimizer's constraint propagation through every combination of aliases.
    return " AND ".join(["is_reliable", *[f"{c} IS NOT NULL" for c in s.base_features]])


def _as_double(names: list[str]) -> list[str]:
    return [f"cast({c} AS double) AS {c}" for c in names]


def one_horizon(wide: DataFrame, minutes: int, s: Settings = Settings()) -> DataFrame:
    """Reliable rows with every feature and the target of one horizon."""
    target = f"target_{minutes}m"
    return wide.filter(f"{_complete(s)} AND {target} IS NOT NULL").selectExpr(
        *s.keys, "timestamp", *_as_double(s.base_features), f"cast({target} AS double) AS target"
    )


def long_set(wide: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per (timestamp, horizon), from a single pass over the wide frame."""
    pairs = ", ".join(f"{m}, cast(target_{m}m AS double)" for m in s.horizons)
    stack = f"stack({len(s.horizons)}, {pairs}) AS (horizon_minutes, target)"
    return (
        wide.filter(_complete(s))
        .selectExpr(*s.keys, "timestamp", *_as_double(s.base_features), stack)
        .filter("target IS NOT NULL")
    )


def rows_by_horizon(long: DataFrame) -> DataFrame:
    return long.groupBy("horizon_minutes").agg(F.count(F.lit(1)).alias("n"))


def split_label(s: Settings = Settings()) -> str:
    return (
        f"CASE WHEN timestamp < {ts_lit(s.train_end)} THEN 'train' "
        f"WHEN timestamp < {ts_lit(s.validation_end)} THEN 'validation' ELSE 'test' END"
    )


def split(long: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows by time; never shuffled."""
    first, second = ts_lit(s.train_end), ts_lit(s.validation_end)
    return (
        long.filter(f"timestamp < {first}"),
        long.filter(f"timestamp >= {first} AND timestamp < {second}"),
        long.filter(f"timestamp >= {second}"),
    )


def split_counts(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    return long.groupBy(F.expr(split_label(s)).alias("split"), "horizon_minutes").agg(
        F.count(F.lit(1)).alias("n")
    )


def split_ranges(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    return long.groupBy(F.expr(split_label(s)).alias("split")).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count(F.lit(1)).alias("n"),
    )


def check_split(long: DataFrame, s: Settings = Settings()) -> None:
    """Raise unless train, validation and test all have rows."""
    present = {r["split"] for r in split_ranges(long, s).select("split").collect()}
    empty = [name for name in ("train", "validation", "test") if name not in present]
    if empty:
        raise ValueError(f"empty split: {', '.join(empty)}")


def split_bounds(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Timestamps at 70 % and 85 % of the ordered rows of a one-horizon set."""
    part = floor_index("timestamp", s.chunk_seconds)
    numbered = running_total(
        rows.selectExpr(*s.keys, "timestamp", "1L AS __one", f"{part} AS __part"),
        ["timestamp"],
        {"__row": "__one"},
        s.keys,
        ["__part"],
    )
    total = rows.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("__n"))
    if s.keys:
        numbered = left_join(numbered, total, s.keys)
    else:
        numbered = numbered.withColumn("__n", total.select("__n").scalar())
    bounds = {"train_end": 0.70, "validation_end": 0.85}
    here = {name: f"__row = floor(__n * {share}D) + 1" for name, share in bounds.items()}
    # Two rows of a series at most.
    return (
        numbered.filter(" OR ".join(here.values()))
        .groupBy(*s.keys)
        .agg(*[F.expr(f"max(CASE WHEN {x} THEN timestamp END)").alias(name) for name, x in here.items()])
    )


def target_audit(wide: DataFrame, long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Compare every stored target with the occupancy found at ``timestamp + horizon``."""
    future = wide.selectExpr(*s.keys, "timestamp AS __at", "active_vehicles AS __actual")
    stored = long.selectExpr(
        *s.keys, "horizon_minutes", "target", f"{shift('timestamp', 'horizon_minutes')} AS __at"
    )
    wrong = F.expr("__actual IS NULL OR __actual != target")
    return (
        left_join(stored, future, s.keys, ["__at"])
        .groupBy("horizon_minutes")
        .agg(F.count(F.lit(1)).alias("checked"), F.count_if(wrong).alias("mismatches"))
    )


def leaked_targets(features: list[str], s: Settings = Settings()) -> list[str]:
    """Target columns that were listed as features."""
    return sorted(set(features) & {*s.target_names, "target"})


def null_audit(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Null count of every feature and of the target, one row per column."""
    return null_counts(long, [*s.model_features, "target"])


def null_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Null count of every named column, one row per column."""
    counts = df.agg(*[F.expr(f"count_if({c} IS NULL)").alias(c) for c in names])
    pairs = ", ".join(f"'{c}', {c}" for c in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, missing)")


def check_feature_order(df: DataFrame, stored: list[str], s: Settings = Settings()) -> None:
    """Raise unless the stored feature list is the model's, in order, and ``df`` has it so."""
    if list(stored) != s.model_features:
        raise ValueError("stored feature list differs from the model features")
    present = [c for c in df.columns if c in set(stored)]
    if present != list(stored):
        raise ValueError("feature columns are missing or in another order")
