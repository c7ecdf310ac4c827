import contextlib
import io
import json

import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from dwellgrid.operators import asof, clean, features, grid, models, supervised
from dwellgrid.plans import catalog
from dwellgrid.plans.catalog import S
from dwellgrid.sources import storage, visits
from dwellgrid.streaming import ingest, totals

TINY = models.TreeParams(rounds=4, learning_rate=0.3, max_depth=3, max_bins=16)


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """Three files of JSON lines, with a malformed line in each."""
    folder = tmp_path_factory.mktemp("messages")
    v = catalog.raw_visits(spark, DATA).withColumn(
        "event_time", F.when(F.col("duration_min") > 250, F.col("entry_time"))
    )
    values = visits.as_json_values(v, "event_time").union(
        spark.createDataFrame([("{broken",), ('{"entry_time": "x"}',)], "value string")
    )
    values.repartition(3).write.mode("overwrite").text(f"{folder}/in")
    return f"{folder}/in"


def run(spark, messages, tmp_path, name="a", **options):
    parsed = ingest.parse_events(ingest.text_messages(spark, messages, 1))
    store = ingest.batch_writer(f"{tmp_path}/visits", name, s=S, **options)
    ingest.start(parsed, store, f"{tmp_path}/checkpoint-{name}", drain=True).awaitTermination(120)


def test_stream_equals_batch_and_restart_adds_nothing(spark, messages, tmp_path):
    seen = []
    run(spark, messages, tmp_path, on_summary=lambda i, n, rows: seen.append((i, n, len(rows))))
    landed = clean.strict(visits.load(spark, f"{tmp_path}/visits"))
    assert rows_of(landed) == rows_of(catalog.visits(spark, DATA))
    assert [i for i, _, _ in seen] == [0, 1, 2] and sum(n for _, n, _ in seen) == landed.count()
    assert all(k == ingest.NEWEST_BUCKETS for _, _, k in seen)
    assert rows_of(grid.occupancy_grid(landed, S)) == rows_of(catalog.grid_of(spark, DATA))

    run(spark, messages, tmp_path)
    assert visits.load(spark, f"{tmp_path}/visits").count() == landed.count()


def test_replayed_batch_is_stored_once_and_empty_one_not_at_all(spark, messages, tmp_path):
    batch = ingest.parse_events(spark.read.text(messages))
    store = ingest.batch_writer(f"{tmp_path}/visits", "r")
    store(batch, 0)
    store(batch, 0)
    store(batch.limit(0), 1)
    assert visits.load(spark, f"{tmp_path}/visits").count() == batch.count()
    assert len(list((tmp_path / "visits" / "stream_run=r").glob("batch_id=*"))) == 1


def test_run_comes_from_the_checkpoint(spark, messages, tmp_path):
    """Without a name the run is the query's own: the same after a restart, another with a new checkpoint."""
    parsed = ingest.parse_events(ingest.text_messages(spark, messages, 1))
    store = ingest.batch_writer(f"{tmp_path}/visits", s=S)
    for checkpoint in ("one", "one", "two"):
        ingest.start(parsed, store, f"{tmp_path}/{checkpoint}", drain=True).awaitTermination(120)
    runs = sorted(p.name for p in (tmp_path / "visits").glob("stream_run=*"))
    ids = sorted(json.loads((tmp_path / c / "metadata").read_text())["id"] for c in ("one", "two"))
    assert runs == [f"stream_run={i}" for i in ids]
    with pytest.raises(RuntimeError, match="outside"):
        store(ingest.parse_events(spark.read.text(messages)), 0)


def test_kept_totals_give_the_same_features(spark, messages, tmp_path):
    run(spark, messages, tmp_path, "t", totals_out=f"{tmp_path}/totals")
    batch = visits.load(spark, f"{tmp_path}/visits").filter("batch_id = 1")
    # A replay of a batch replaces its totals.
    ingest.batch_writer(f"{tmp_path}/visits", "t", totals_out=f"{tmp_path}/totals")(
        storage.written(clean.typed(batch.drop("stream_run", "batch_id")), "batch"), 1
    )
    landed = clean.strict(visits.load(spark, f"{tmp_path}/visits"))
    kept = totals.load(spark, f"{tmp_path}/totals", S)
    assert kept.agg(F.sum("arrivals"), F.sum("exits")).first() == (landed.count(),) * 2
    instants = landed.filter("entry_time >= timestamp_ntz'2024-01-25 00:00:00'").selectExpr(
        "entry_time AS prediction_time"
    )
    plain = asof.features_at(landed, instants, S)
    quick = asof.features_at(landed, instants, S, totals=kept)
    assert rows_of(quick) == rows_of(plain) and plain.count() > 0
    assert "GreaterThanOrEqual(exit_time,2024-01-2" in plan_of(quick)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def fitted(spark):
    long = storage.written(catalog.long_of(spark, DATA), "long")
    train, validation, test = supervised.split(long, S)
    return models.fit_bundle(train, validation, TINY, S), train, validation, test


def test_every_clock_of_a_batch_is_forecast(spark, messages, tmp_path, fitted):
    everything = catalog.visits(spark, DATA)
    run(
        spark,
        messages,
        tmp_path,
        "f",
        forecast=lambda clocks: models.forecasts(fitted[0], everything, clocks, S),
        forecasts_out=f"{tmp_path}/forecasts",
    )
    clocks = ingest.event_clocks(ingest.parse_events(spark.read.text(messages)))
    wanted = asof.eligibility(everything, clocks, S).filter("is_eligible").count()
    records = spark.read.json(f"{tmp_path}/forecasts")
    assert 0 < wanted == records.count() < clocks.count() + 1
    row = records.first()
    assert len(row.forecast) == 6 and row.peak_forecast.forecast_timestamp


def test_forecasts_are_ordered_and_peak_is_first_maximum(spark, fitted):
    bundle, _, _, test = fitted
    scored = models.score_bundle(bundle, test)
    assert scored.filter("p90 < p50").count() == 0 and scored.count() == test.count()
    assert len(bundle.point.trees) > 1
    one = F.struct("horizon_minutes", "point_prediction")
    ties = spark.createDataFrame(
        [("a", 15, 1.0), ("a", 30, 5.0), ("a", 60, 5.0), ("b", 15, 2.0), ("b", 30, 1.0)],
        "k string, horizon_minutes int, point_prediction double",
    )
    peaks = ties.groupBy("k").agg(models.peak_of(one).alias("p"))
    assert {r.k: r.p.horizon_minutes for r in peaks.collect()} == {"a": 30, "b": 15}


def test_save_load_and_registry(spark, fitted, tmp_path):
    bundle, _, validation, test = fitted
    models.save(bundle, str(tmp_path), TINY, {"test": test.count()})
    again = models.load(spark, str(tmp_path), bundle.version, S)
    columns = ["timestamp", "horizon_minutes", "point", "p50", "p90"]
    assert rows_of(models.score_bundle(again, test).select(columns)) == rows_of(
        models.score_bundle(bundle, test).select(columns)
    )
    registry = f"{tmp_path}/registry"
    with pytest.raises(LookupError):
        models.active_version(spark, registry)
    for expected, active, mae in (("v001", "v001", 2.0), ("v002", "v002", 1.0), ("v003", "v002", 1.5)):
        version = models.next_version(spark, registry)
        assert version == expected
        row = spark.createDataFrame([(version, mae, mae)], "version string, mean_mae double, mean_mse double")
        models.register(row, registry)
        assert models.active_version(spark, registry) == active


def test_permuting_a_useless_feature_changes_nothing(spark, fitted):
    bundle, _, validation, _ = fitted
    rows = {
        r.feature: r
        for r in models.permutation_importance(bundle.point, validation, repeats=2).collect()
    }
    assert len(rows) == 29
    used = bundle.point.importance()
    for name, r in rows.items():
        if used[name] == 0.0:
            assert r.importance_mean == pytest.approx(0.0, abs=1e-12)
    assert rows["active_vehicles"].importance_mean > 0


class Recorder:
    """Stands in for a stream reader or writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def call(*args, **named):
            key = args[0] if name == "option" else name
            self.told[key] = args[1] if name == "option" else (args or named)
            return self

        return call


def test_kafka_options_are_set():
    reader = Recorder()
    session = type("Session", (), {"readStream": reader})()
    ingest.kafka_messages(session, "host:9092", "visits", "latest")
    assert reader.told == {
        "format": ("kafka",),
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "visits",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "load": {},
    }


def test_start_offsets_by_partition_are_checked():
    reader = Recorder()
    session = type("Session", (), {"readStream": reader})()
    ingest.kafka_messages(session, "host:9092", "visits", {0: 17, 1: "earliest", 2: "latest"})
    assert reader.told["startingOffsets"] == '{"visits": {"0": 17, "1": -2, "2": -1}}'
    for wrong in ("yesterday", {}, {0: "soon"}, {-1: 5}, {0: -7}):
        with pytest.raises(ValueError, match="start"):
            ingest.kafka_messages(session, "host:9092", "visits", wrong)


@pytest.mark.parametrize("drain, trigger", [(False, {"processingTime": "7 seconds"}), (True, {"availableNow": True})])
def test_triggers_and_checkpoint(drain, trigger):
    writer = Recorder()
    rows = type("Rows", (), {"writeStream": writer})()
    ingest.start(rows, print, "/some/where", 7, drain)
    assert writer.told == {"foreachBatch": (print,), "checkpointLocation": "/some/where", "trigger": trigger, "start": {}}


def test_wide_frame_scans_the_visits_for_two_columns(spark):
    plan = features.wide_frame(catalog.visits(spark, DATA), S)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    assert "SinglePartition" not in plan.split("Window")[0]
