"""Forecast models: fitting, scoring, search, importance and versions.

The boosted trees are those of ``boosting``: point, median and P90 forecasts are three losses grown in
step over one binned table. A forest from ``pyspark.ml`` is kept as another family. Training rows
never leave the executors.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyspark
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from dwellgrid.functions.joins import left_join
from dwellgrid.functions.timecols import shift
from dwellgrid.operators import asof, boosting, evaluate, features, supervised
from dwellgrid.operators.boosting import Model, TreeParams
from dwellgrid.settings import Settings
from dwellgrid.sources.storage import written

CHUNK_ROWS = 2048

# The reduced feature list.
REDUCED_FEATURES = [
    "active_vehicles",
    "hour",
    "horizon_minutes",
    "day_of_week",
    "occupancy_change_15m",
    "lag_6h",
    "lag_15m",
    "lag_2h",
    "exits_1h",
    "arrivals_1h",
    "occupancy_change_2h",
    "lag_1h",
    "arrivals_30m",
    "exits_30m",
    "net_flow_15m",
    "net_flow_1h",
]


# The second booster as tuned in the study; leaves instead of levels, no least gain.
LEAFWISE = TreeParams(
    leaves=39,
    max_depth=9,
    learning_rate=0.092546,
    min_rows=10,
    row_share=0.768381,
    column_share=0.828132,
    min_gain=0.0,
    l1=0.409007,
    l2=4.373288,
)

# The models of one horizon.
SINGLE_HORIZON = TreeParams(
    rounds=1000, learning_rate=0.05, min_rows=1, row_share=0.8, column_share=0.8, min_gain=0.0, l1=0.0, l2=1.0
)


@dataclass(frozen=True)
class Bundle:
    """The three forecasts that belong together, and their inputs in order."""

    point: Model
    p50: Model
    p90: Model
    features: list[str] = field(default_factory=list)
    version: str = "v001"


def fit_boosted(
    train: DataFrame, validation: DataFrame, features: Sequence[str], params: TreeParams = TreeParams()
) -> Model:
    """One boosted model, ended by patience on the validation rows and cut at its best round."""
    return boosting.fit(boosting.binned(train, validation, features, params.max_bins), [params])[0]


def fit_forest(
    train: DataFrame,
    features: Sequence[str],
    trees: int = 100,
    params: TreeParams = TreeParams(),
) -> RandomForestRegressionModel:
    """Another model family, for comparison."""
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="target",
        numTrees=trees,
        maxDepth=params.max_depth,
        minInstancesPerNode=params.min_rows,
        subsamplingRate=params.row_share,
        featureSubsetStrategy="onethird",
        maxBins=params.max_bins,
        seed=params.seed,
    )
    return forest.fit(_assembled(train, features).select("features", "target"))


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def score_forest(model: RandomForestRegressionModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    return model.transform(_assembled(rows, features)).drop("features")


def score(model: Model, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """``rows`` with the model's prediction."""
    return rows.withColumn(name, boosting.predicted({"p": model})["p"])


def fit_bundle(
    train: DataFrame,
    validation: DataFrame,
    params: TreeParams = TreeParams(),
    s: Settings = Settings(),
    version: str = "v001",
) -> Bundle:
    """Point, median and P90 model, grown in step over one binned table."""
    table = boosting.binned(train, validation, s.model_features, params.max_bins)
    configs = [params, replace(params, alpha=0.5), replace(params, alpha=0.9)]
    return Bundle(*boosting.fit(table, configs), s.model_features, version)


def score_bundle(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """Add ``point``, ``p50`` and ``p90``; P90 is never below P50."""
    found = boosting.predicted({"point": bundle.point, "p50": bundle.p50, "p90": bundle.p90})
    return rows.withColumn("__found", found).select(
        *rows.columns,
        "__found.point",
        "__found.p50",
        F.greatest("__found.p50", "__found.p90").alias("p90"),
    )


def bundle_metrics(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """Point metrics and both sets of quantile metrics by horizon, in one pass over the rows."""
    scored = score_bundle(bundle, rows)
    point, p50, p90 = (F.col("target") - F.col(c) for c in ("point", "p50", "p90"))
    return scored.groupBy("horizon_minutes").agg(
        F.avg(F.abs(point)).alias("mae"),
        F.avg(point * point).alias("mse"),
        F.sqrt(F.avg(point * point)).alias("rmse"),
        F.avg(F.greatest(0.5 * p50, -0.5 * p50)).alias("p50_pinball"),
        F.avg(F.abs(p50)).alias("p50_mae"),
        F.avg((p50 <= 0).cast("int")).alias("p50_coverage"),
        F.avg(F.greatest(0.9 * p90, -0.1 * p90)).alias("p90_pinball"),
        F.avg((p90 <= 0).cast("int")).alias("p90_coverage"),
        F.count(F.lit(1)).alias("n"),
    )


# ---- forecasts at instants -------------------------------------------------------------


def forecasts(
    bundle: Bundle,
    visits: DataFrame,
    instants: DataFrame,
    s: Settings = Settings(),
    totals: DataFrame | None = None,
) -> DataFrame:
    """One record per eligible instant with the forecast of every horizon and its peak.

    The peak is the horizon with the highest point forecast, the earliest one on ties. ``totals`` is that of
    ``asof.counts_at``.
    """
    rows = score_bundle(bundle, asof.features_at(visits, instants, s, totals=totals))
    one = F.struct(
        "horizon_minutes",
        F.col("point").alias("point_prediction"),
        F.col("p50").alias("p50_prediction"),
        F.col("p90").alias("p90_prediction"),
    )
    # Six rows per instant.
    records = rows.groupBy(*s.keys, "prediction_time").agg(
        F.first("active_vehicles").alias("current_active_vehicles"),
        F.sort_array(F.collect_list(one)).alias("forecast"),
        peak_of(one).alias("peak_forecast"),
    )
    return with_peak_time(records).select(
        F.lit(bundle.version).alias("model_version"),
        *s.keys,
        "prediction_time",
        "current_active_vehicles",
        "forecast",
        "peak_forecast",
    )


def forecasts_or_reasons(
    bundle: Bundle, visits: DataFrame, instants: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """One record per distinct instant: the forecast, or why there is none."""
    asked = asof.eligibility(visits, instants, s)
    return left_join(asked, forecasts(bundle, visits, instants, s), [*s.keys, "prediction_time"])


def peak_of(one):
    """The record with the highest point forecast within a group, earliest horizon on ties."""
    return F.max_by(one, F.struct(one["point_prediction"], -one["horizon_minutes"]))


def with_peak_time(records: DataFrame) -> DataFrame:
    at = F.expr(shift("prediction_time", "peak_forecast.horizon_minutes"))
    return records.withColumn(
        "peak_forecast", F.col("peak_forecast").withField("forecast_timestamp", at)
    )


# ---- search ----------------------------------------------------------------------------


def sample_params(n: int = 30, base: TreeParams = TreeParams(), seed: int = 42) -> list[TreeParams]:
    """Random configurations by level. The ranges of the search space."""
    draw = random.Random(seed)
    return [
        replace(
            base,
            max_depth=draw.randint(3, 8),
            min_rows=draw.randint(1, 10),
            learning_rate=round(draw.uniform(0.02, 0.10), 6),
            row_share=round(draw.uniform(0.7, 1.0), 6),
            column_share=round(draw.uniform(0.7, 1.0), 6),
            min_gain=round(draw.uniform(0.0, 0.2), 6),
            l1=round(draw.uniform(0.0, 0.5), 6),
            l2=round(draw.uniform(0.5, 5.0), 6),
        )
        for _ in range(n)
    ]


def sample_leafwise(n: int = 30, base: TreeParams = LEAFWISE, seed: int = 42) -> list[TreeParams]:
    """Random configurations by leaf. The ranges of the search space."""
    draw = random.Random(seed)
    return [
        replace(
            base,
            leaves=draw.randint(15, 63),
            max_depth=draw.randint(3, 9),
            learning_rate=round(draw.uniform(0.02, 0.10), 6),
            min_rows=draw.randint(10, 79),
            row_share=round(draw.uniform(0.7, 1.0), 6),
            column_share=round(draw.uniform(0.7, 1.0), 6),
            l1=round(draw.uniform(0.0, 0.5), 6),
            l2=round(draw.uniform(0.5, 5.0), 6),
        )
        for _ in range(n)
    ]


def search(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    configs: Sequence[TreeParams],
    together: int = 30,
) -> DataFrame:
    """Fit every configuration and rank them by validation MAE.

    The rows are binned once; ``together`` configurations grow in step, which bounds the margins kept of a row.
    All models are scored in one pass over the validation rows.
    """
    table = boosting.binned(train, validation, features, configs[0].max_bins)
    found: list[Model] = []
    for i in range(0, len(configs), together):
        found += boosting.fit(table, configs[i : i + together])
    names = {f"m{i}": m for i, m in enumerate(found, start=1)}
    scored = validation.select("target", boosting.predicted(names).alias("p"))
    mae = scored.agg(*[F.avg(F.abs(F.col("target") - F.col(f"p.{n}"))).alias(n) for n in names]).first()
    rows = [
        (i, float(mae[f"m{i}"]), len(m.trees), *asdict(c).values())
        for i, (m, c) in enumerate(zip(found, configs), start=1)
    ]
    types = {int: "int", float: "double"}
    columns = ", ".join(f"{k} {types[type(v)]}" for k, v in asdict(TreeParams()).items())
    return train.sparkSession.createDataFrame(
        rows, f"iteration int, validation_mae double, trees int, {columns}"
    ).orderBy("validation_mae", "iteration")


# ---- importance ------------------------------------------------------------------------


def feature_importance(spark: SparkSession, model: Model) -> DataFrame:
    """Mean gain of each feature's splits, as a share."""
    pairs = [(f, float(v)) for f, v in model.importance().items()]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def permutation_importance(
    model: Model, rows: DataFrame, repeats: int = 10, seed: int = 42, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rise of the MAE when one feature's values are dealt out again at random.

    Rows are dealt to chunks by a hash of their number in the stored table, so each chunk is a random part of all
    rows and equal rows are spread. Values are exchanged inside a chunk, and all that leaves
    a task is one sum per feature and repeat.
    """
    names = model.features
    numbered = written(
        rows.select(
            *[F.col(f).cast("double") for f in names],
            F.col("target").cast("double"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "permuted",
    )
    n = numbered.count()
    parts = max(1, -(-n // chunk_rows))

    def exchange(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row = b["__row"].to_numpy()
            order = np.argsort(row)
            target = b["target"].to_numpy()[order]
            x = b[names].to_numpy(dtype=float).T[:, order].copy()
            out = [(-1, 0, float(np.abs(target - model.predict(x)).sum()))]
            for f in range(len(names)):
                own = x[f].copy()
                for r in range(repeats):
                    rng = np.random.default_rng([seed, f, r, int(row.min())])
                    x[f] = own[rng.permutation(len(own))]
                    out.append((f, r, float(np.abs(target - model.predict(x)).sum())))
                x[f] = own
            yield pd.DataFrame(out, columns=["feature_no", "repeat", "error"])

    dealt = numbered.repartition(parts, F.xxhash64(F.lit(seed), "__row"))
    sums = dealt.mapInPandas(exchange, "feature_no int, repeat int, error double")
    mae = sums.groupBy("feature_no", "repeat").agg((F.sum("error") / F.lit(max(n, 1))).alias("mae"))
    plain = mae.filter("feature_no = -1").select(F.col("mae").alias("plain"))
    rises = mae.filter("feature_no >= 0").join(F.broadcast(plain)).withColumn(
        "rise", F.col("mae") - F.col("plain")
    )
    name = F.element_at(F.array(*[F.lit(f) for f in names]), F.col("feature_no") + 1)
    return (
        rises.groupBy("feature_no")
        .agg(F.avg("rise").alias("importance_mean"), F.stddev_pop("rise").alias("importance_std"))
        .select(name.alias("feature"), "importance_mean", "importance_std")
        .orderBy(F.desc("importance_mean"), "feature")
    )


# ---- versions --------------------------------------------------------------------------

REGISTRY_SCHEMA = (
    "active_version string, updated_at timestamp, decision string, reason string, "
    "candidate_version string, candidate_mae double, candidate_mse double, "
    "previous_version string, previous_mae double, previous_mse double"
)


def _registry(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def next_version(spark: SparkSession, registry: str) -> str:
    number = F.substring("candidate_version", 2, 10).cast("int")
    top = _registry(spark, registry).agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).first()["n"]
    return f"v{top + 1:03d}"


def active_version(spark: SparkSession, registry: str) -> str:
    row = _registry(spark, registry).orderBy(F.desc("updated_at")).select("active_version").first()
    if row is None or row[0] is None:
        raise LookupError("no active model version is registered")
    return row[0]


def register(candidate: DataFrame, registry: str) -> DataFrame:
    """Decide on a candidate (``version, mean_mae, mean_mse``) and append the registry row."""
    spark = candidate.sparkSession
    past = _registry(spark, registry)
    winner = F.col("candidate_version") == F.col("active_version")
    active = (
        past.filter(winner)
        .orderBy(F.desc("updated_at"))
        .limit(1)
        .select(
            F.col("candidate_version").alias("version"),
            F.col("candidate_mae").alias("mean_mae"),
            F.col("candidate_mse").alias("mean_mse"),
        )
    )
    decided = evaluate.promotion(candidate, active).withColumn("updated_at", F.current_timestamp())
    names = [f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]
    row = spark.createDataFrame(decided.select(*names).collect(), REGISTRY_SCHEMA)
    row.write.mode("append").parquet(registry)
    return row


METRICS = (
    "version string, model string, split string, horizon_minutes int, mae double, mse double, "
    "rmse double, pinball_loss double, coverage double, n bigint"
)


def version_metrics(bundle: Bundle, sets: dict[str, DataFrame]) -> DataFrame:
    """Metrics of the three models per split and horizon, one row each."""
    parts = []
    for split, rows in sets.items():
        scored = score_bundle(bundle, rows)
        point = evaluate.point_metrics(scored, "point").withColumn("model", F.lit("point"))
        quantiles = [
            evaluate.quantile_metrics(scored, name, alpha).withColumn("model", F.lit(name))
            for name, alpha in (("p50", 0.5), ("p90", 0.9))
        ]
        for q in (point, *quantiles):
            parts.append(q.withColumn("split", F.lit(split)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    names = [f.split()[0] for f in METRICS.split(", ")]
    return every.withColumn("version", F.lit(bundle.version)).select(*names)


def save(bundle: Bundle, folder: str, params: TreeParams, split_rows: dict[str, int]) -> None:
    """Write the models, the ordered feature list and one row of training metadata."""
    spark = SparkSession.active()
    base = f"{folder}/{bundle.version}"
    named = {"point": bundle.point, "p50": bundle.p50, "p90": bundle.p90}
    boosting.to_nodes(spark, named).write.parquet(f"{base}/trees")
    about = {
        "version": bundle.version,
        "feature_names": bundle.features,
        "feature_count": len(bundle.features),
        "trees": {k: len(m.trees) for k, m in named.items()},
        "rows": split_rows,
        "parameters": {k: float(v) for k, v in asdict(params).items()},
        "python": sys.version.split()[0],
        "pyspark": pyspark.__version__,
    }
    schema = (
        "version string, feature_names array<string>, feature_count int, trees map<string, int>, "
        "rows map<string, bigint>, parameters map<string, double>, python string, pyspark string"
    )
    spark.createDataFrame([about], schema).withColumn("created_at", F.current_timestamp()).coalesce(
        1
    ).write.parquet(f"{base}/metadata")


def load(spark: SparkSession, folder: str, version: str, s: Settings = Settings()) -> Bundle:
    """Read a saved version; its feature list has to match the model features in order."""
    base = f"{folder}/{version}"
    names = list(spark.read.parquet(f"{base}/metadata").first()["feature_names"])
    if names != s.model_features:
        raise ValueError("stored feature list differs from the model features")
    found = boosting.from_nodes(spark.read.parquet(f"{base}/trees"), names)
    return Bundle(found["point"], found["p50"], found["p90"], names, version)


# ---- workflows -------------------------------------------------------------------------


def train(visits: DataFrame, folder: str, params: TreeParams = TreeParams(), s: Settings = Settings()) -> DataFrame:
    """From visits to a registered version: rows, split, fits, metrics, files, decision.

    Returns the registry row. The candidate becomes active only if both mean validation errors are lower.
    """
    spark = visits.sparkSession
    long = written(supervised.long_set(features.wide_frame(visits, s), s), "long")
    supervised.check_split(long, s)
    fitted_on, validation, test = supervised.split(long, s)
    version = next_version(spark, f"{folder}/registry")
    bundle = fit_bundle(fitted_on, validation, params, s, version)
    rows = {
        "train": fitted_on.count(),
        "validation": validation.count(),
        "test": test.count(),
    }
    save(bundle, folder, params, rows)
    metrics = version_metrics(bundle, {"validation": validation, "test": test})
    metrics.coalesce(1).write.parquet(f"{folder}/{version}/metrics")
    stored = spark.read.schema(METRICS).parquet(f"{folder}/{version}/metrics")
    candidate = evaluate.metric_summary(stored.filter("model = 'point' AND split = 'validation'"))
    return register(
        candidate.select(F.lit(version).alias("version"), "mean_mae", "mean_mse"), f"{folder}/registry"
    )


def forecast_active(
    visits: DataFrame, instants: DataFrame, folder: str, s: Settings = Settings()
) -> DataFrame:
    """Forecasts of the registered active version at each instant; refused instants keep a row with the reason."""
    spark = visits.sparkSession
    bundle = load(spark, folder, active_version(spark, f"{folder}/registry"), s)
    return forecasts_or_reasons(bundle, visits, instants, s)
