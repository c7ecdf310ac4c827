"""Forecast metrics, baseline forecasts and the promotion rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.timecols import shift
from dwellgrid.operators.supervised import split
from dwellgrid.settings import Settings

GROUP = ("horizon_minutes",)


def point_metrics(
    scored: DataFrame, prediction: str = "prediction", group: Sequence[str] = GROUP
) -> DataFrame:
    """MAE, MSE, RMSE and row count of ``prediction`` against ``target``."""
    e = F.col("target") - F.col(prediction)
    return scored.groupBy(*group).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
    )


def metric_summary(by_horizon: DataFrame) -> DataFrame:
    """Unweighted means over the horizons."""
    return by_horizon.agg(*[F.avg(c).alias(f"mean_{c}") for c in ("mae", "mse", "rmse")])


def quantile_metrics(
    scored: DataFrame, prediction: str, alpha: float, group: Sequence[str] = GROUP
) -> DataFrame:
    """Pinball loss, coverage, MAE and row count of a quantile forecast."""
    e = F.col("target") - F.col(prediction)
    return scored.groupBy(*group).agg(
        F.avg(F.greatest(alpha * e, (alpha - 1.0) * e)).alias("pinball_loss"),
        F.avg((F.col("target") <= F.col(prediction)).cast("int")).alias("coverage"),
        F.avg(F.abs(e)).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def quantile_summary(by_horizon: DataFrame) -> DataFrame:
    return by_horizon.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in ("pinball_loss", "coverage", "mae")]
    )


def quantile_crossing(scored: DataFrame, low: str = "p50", high: str = "p90") -> DataFrame:
    return scored.agg(
        F.count_if(F.col(high) < F.col(low)).alias("crossed"), F.count(F.lit(1)).alias("total")
    )


def persistence(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Test rows with the current occupancy as forecast."""
    return split(long, s)[2].withColumn("prediction", F.col("active_vehicles"))


def _target_time():
    return F.expr(shift("timestamp", "horizon_minutes"))


def hourly_mean(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Test rows with the training mean of the hour the forecast is for."""
    train, _, test = split(long, s)
    hour = F.hour(_target_time()).alias("target_hour")
    means = train.groupBy(*s.keys, hour).agg(F.avg("target").alias("prediction"))
    return left_join(
        test.withColumn("target_hour", F.hour(_target_time())), means, s.keys, ["target_hour"]
    )


def previous_day(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Test rows with the occupancy 24 hours before the target time; null where unknown."""
    lookup = long.groupBy(*s.keys, F.col("timestamp").alias("__at")).agg(
        F.first("active_vehicles").alias("prediction")
    )
    test = split(long, s)[2].withColumn("__at", _target_time() - F.expr("INTERVAL '24' HOUR"))
    return left_join(test, lookup, s.keys, ["__at"]).drop("__at")


def previous_day_metrics(long: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Metrics of the rows that have a previous-day value, and how many have none."""
    scored = previous_day(long, s)
    e = F.col("target") - F.col("prediction")
    return scored.groupBy("horizon_minutes").agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.count("prediction").alias("n"),
        F.count_if(F.col("prediction").isNull()).alias("missing"),
    )


def promotion(candidate: DataFrame, active: DataFrame) -> DataFrame:
    """Decide between one candidate and at most one active row of summary metrics.

    Both have ``version, mean_mae, mean_mse``. The candidate wins only if both metrics are
    lower, or if there is no active model.
    """
    c = candidate.select(
        F.col("version").alias("candidate_version"),
        F.col("mean_mae").alias("candidate_mae"),
        F.col("mean_mse").alias("candidate_mse"),
        F.lit(1).alias("__one"),
    )
    a = active.select(
        F.col("version").alias("previous_version"),
        F.col("mean_mae").alias("previous_mae"),
        F.col("mean_mse").alias("previous_mse"),
        F.lit(1).alias("__one"),
    )
    first = F.col("previous_version").isNull()
    better = (F.col("candidate_mae") < F.col("previous_mae")) & (
        F.col("candidate_mse") < F.col("previous_mse")
    )
    wins = first | F.coalesce(better, F.lit(False))
    reason = (
        F.when(first, "first model")
        .when(wins, "lower MAE and lower MSE")
        .otherwise("not lower in both MAE and MSE")
    )
    return (
        c.join(a, "__one", "left")
        .drop("__one")
        .select(
            "*",
            F.when(wins, "promoted").otherwise("candidate_rejected").alias("decision"),
            reason.alias("reason"),
            F.when(wins, F.col("candidate_version"))
            .otherwise(F.col("previous_version"))
            .alias("active_version"),
        )
    )
