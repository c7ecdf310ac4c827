"""Boosted trees against plain versions on one machine, and the train and predict workflows."""

import pickle
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from dwellgrid.operators import asof, boosting, evaluate, models, supervised
from dwellgrid.operators.boosting import TreeParams
from dwellgrid.plans import catalog
from dwellgrid.plans.catalog import S
from dwellgrid.sources import storage

WHOLE = TreeParams(row_share=1.0, column_share=1.0)


@pytest.fixture(scope="module")
def made(spark):
    """9,000 rows whose target has a step, a slope and an interaction; the last third is for validation."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9000, 4)).round(2)
    x[rng.random(9000) < 0.05, 3] = np.nan
    y = 4 * (x[:, 0] > 0.3) + x[:, 1] + 2 * (x[:, 0] > 0) * (x[:, 2] < 0) + rng.normal(0, 1, 9000)
    rows = [
        tuple(None if np.isnan(v) else float(v) for v in r) + (float(t), i) for i, (r, t) in enumerate(zip(x, y))
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, target double, i int").cache()
    train, validation = df.filter("i < 6000"), df.filter("i >= 6000")
    return x, y, boosting.binned(train, validation, ["a", "b", "c", "d"], 16), validation


def codes_of(x, table):
    out = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(table.cuts)])
    out[np.isnan(x.T)] = boosting.NULL_CODE
    return out


def tree_by_hand(codes, y, p, base):
    """One tree, a node at a time; ``leaves`` best first, else every node that gains."""
    g = base - y

    def shrunk(v):
        return np.sign(v) * max(abs(v) - p.l1, 0.0)

    def score(rows):
        return shrunk(g[rows].sum()) ** 2 / (len(rows) + p.l2)

    def best(rows, depth):
        found = None
        if p.max_depth and depth >= p.max_depth:
            return None
        for f in range(len(codes)):
            for c in range(17):
                left, right = rows[codes[f, rows] <= c], rows[codes[f, rows] > c]
                if min(len(left), len(right)) < p.min_rows:
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > p.min_gain + 1e-9 and (found is None or gain > found[0] + 1e-7):
                    found = gain, left, right
        return found

    open_ = [(np.arange(len(y)), 0)]
    open_ = [(r, d, best(r, d)) for r, d in open_]
    done = 1
    while any(s for _, _, s in open_) and (not p.leaves or done < p.leaves):
        k = max(range(len(open_)), key=lambda i: open_[i][2][0] if open_[i][2] else -1)
        _, depth, split = open_.pop(k)
        open_ += [(r, depth + 1, best(r, depth + 1)) for r in split[1:]]
        done += 1
    value = np.empty(len(y))
    for rows, _, _ in open_:
        value[rows] = -p.learning_rate * shrunk(g[rows].sum()) / (len(rows) + p.l2)
    return value, len(open_)


@pytest.mark.parametrize(
    "p", [replace(WHOLE, rounds=1, max_depth=4, learning_rate=0.5), replace(WHOLE, rounds=1, leaves=9, max_depth=0, l1=3.0)]
)
def test_a_tree_equals_the_plain_search(made, p):
    x, y, table, _ = made
    model = boosting.fit(table, [p])[0]
    codes = codes_of(x[:6000], table)
    want, leaves = tree_by_hand(codes, y[:6000], p, y[:6000].mean())
    assert len(model.trees) == 1 and (model.trees[0].feature < 0).sum() == leaves
    assert np.allclose(model.predict(x[:6000].T), y[:6000].mean() + want)


def test_patience_cuts_at_the_best_round(made):
    x, y, table, validation = made
    p = replace(WHOLE, learning_rate=0.5, patience=7, rounds=500)
    model = boosting.fit(table, [p])[0]
    best = int(np.argmin(model.losses))
    assert 1 < len(model.trees) == best and len(model.losses) == best + 7 + 1 > boosting.STORED_ROUNDS / 3
    e = y[6000:] - model.predict(x[6000:].T)
    assert abs((e * e).mean() - model.losses[best]) < 1e-9
    assert (e * e).mean() < 0.6 * ((y[6000:] - y[:6000].mean()) ** 2).mean()
    scored = models.score(model, validation).toPandas()
    assert np.allclose(scored["prediction"], model.predict(x[scored["i"]].T))


def test_margins_are_stored_and_taken_up(made, monkeypatch):
    """Rows of the margins written every few rounds give the model that is grown without them."""
    _, _, table, _ = made
    configs = [replace(TreeParams(), rounds=9, alpha=a) for a in (0.0, 0.9)]
    plain = boosting.fit(table, configs)
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2)
    for a, b in zip(plain, boosting.fit(table, configs)):
        assert np.allclose(a.losses, b.losses) and len(a.trees) == len(b.trees)


def test_configurations_in_step_equal_each_alone(made):
    _, _, table, _ = made
    configs = [replace(TreeParams(), rounds=4), replace(TreeParams(), rounds=2, leaves=7), replace(TreeParams(), rounds=3, alpha=0.5)]
    together = boosting.fit(table, configs)
    for c, m in zip(configs, together):
        assert np.allclose(boosting.fit(table, [c])[0].losses, m.losses)


def test_passes_send_the_driver_a_few_numbers_per_node(made, monkeypatch):
    """With all blocks in one task and with blocks dealt out; the sums of one pass alone are over 100 KB."""
    x, _, table, _ = made
    configs = [replace(TreeParams(), rounds=2), replace(TreeParams(), rounds=2, alpha=0.9)]
    sent, collect = [], boosting.RDD.collect

    def weighed(rdd):
        out = collect(rdd)
        sent.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr(boosting.RDD, "collect", weighed)
    found = []
    for rows in (boosting.ROWS_ALONE, 0):
        monkeypatch.setattr(boosting, "ROWS_ALONE", rows)
        found.append([m.predict(x.T) for m in boosting.fit(table, configs)])
    assert sent and max(sent) < 16_000
    assert np.allclose(found[0], found[1])


def test_what_the_driver_gets_does_not_grow_with_rows(made, monkeypatch):
    """The three losses of a bundle on the training rows once and four times, alone in a task and dealt out."""
    _, _, table, validation = made
    four = table.train
    for _ in range(3):
        four = four.unionByName(table.train)
    more = boosting.binned(four, validation, table.features, 16)
    configs = [replace(WHOLE, rounds=3, max_depth=3, alpha=a) for a in (0.0, 0.5, 0.9)]
    sent, collect = [0], boosting.RDD.collect

    def weighed(rdd):
        out = collect(rdd)
        sent[-1] += len(pickle.dumps(out))
        return out

    monkeypatch.setattr(boosting.RDD, "collect", weighed)
    for rows in (boosting.ROWS_ALONE, 0):
        monkeypatch.setattr(boosting, "ROWS_ALONE", rows)
        for t in (table, more):
            boosting.fit(t, configs)
            sent.append(0)
        *_, once, fourfold, _ = sent
        assert 0 < once < 30_000 and fourfold < 1.2 * once


def test_quantile_leaves_hold_the_residual_quantile(made):
    x, y, table, _ = made
    p = replace(WHOLE, rounds=1, alpha=0.9, learning_rate=1.0, max_depth=3, min_gain=0.0)
    model = boosting.fit(table, [p])[0]
    leaf = model.trees[0].leaf_of(x[:6000].T)
    rest = y[:6000] - model.base
    for k in np.unique(leaf):
        own = np.sort(rest[leaf == k])
        want = own[int(np.ceil(0.9 * len(own))) - 1]
        assert abs(model.trees[0].value[k] - want) < 1e-4


def test_stored_nodes_give_the_model_back(spark, made):
    x, _, table, _ = made
    named = dict(zip("uv", boosting.fit(table, [replace(TreeParams(), rounds=3), replace(TreeParams(), rounds=2, alpha=0.5)])))
    again = boosting.from_nodes(boosting.to_nodes(spark, named), table.features)
    for k, m in named.items():
        assert np.array_equal(again[k].predict(x.T), m.predict(x.T))
        assert again[k].importance() == m.importance() and abs(sum(m.importance().values()) - 1) < 1e-9


def test_empty_training_set_is_an_error(made):
    _, _, table, validation = made
    with pytest.raises(ValueError, match="no training rows"):
        boosting.binned(table.train.limit(0), validation, ["a"], 16)


# ---- forecasts --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sets(spark):
    return supervised.split(storage.written(catalog.long_of(spark, DATA), "long"), S)


@pytest.fixture(scope="module")
def bundle(sets):
    return models.fit_bundle(sets[0], sets[1], replace(TreeParams(), patience=10), S)


def test_forecasts_beat_persistence_and_p90_covers(bundle, sets):
    train, validation, _ = sets
    scored = models.score_bundle(bundle, validation)
    error = F.avg(F.abs(F.col("target") - F.col("point")))
    ours, naive = scored.agg(error, F.avg(F.abs(F.col("target") - F.col("active_vehicles")))).first()
    assert len(bundle.point.trees) > 1 and ours < naive
    by_horizon = evaluate.quantile_metrics(scored, "p90", 0.9)
    p90 = evaluate.quantile_summary(by_horizon).first()
    assert abs(p90["mean_coverage"] - 0.9) <= 0.02
    # The median moved up by the quantile of its training residuals is the simpler P90.
    residual = F.col("target") - F.col("p50")
    offsets = models.score_bundle(bundle, train).groupBy("horizon_minutes").agg(
        F.percentile(residual, 0.9).alias("offset")
    )
    moved = scored.join(F.broadcast(offsets), "horizon_minutes").withColumn("moved", F.col("p50") + F.col("offset"))
    simple = evaluate.quantile_summary(evaluate.quantile_metrics(moved, "moved", 0.9)).first()
    assert p90["mean_pinball_loss"] <= simple["mean_pinball_loss"] * 1.02


def test_metrics_equal_sql_over_stored_predictions(spark, bundle, sets, tmp_path):
    models.score_bundle(bundle, sets[2]).write.parquet(f"{tmp_path}/scored")
    pinball = "avg(greatest({a} * (target - {p}), ({a} - 1) * (target - {p})))"
    sql = f"""
        SELECT horizon_minutes, avg(abs(target - point)) AS mae, avg((target - point) ** 2) AS mse,
          sqrt(avg((target - point) ** 2)) AS rmse, {pinball.format(a=0.5, p="p50")} AS p50_pinball,
          avg(abs(target - p50)) AS p50_mae, avg((target <= p50)::INT) AS p50_coverage,
          {pinball.format(a=0.9, p="p90")} AS p90_pinball, avg((target <= p90)::INT) AS p90_coverage, count(*) AS n
        FROM '{tmp_path}/scored/*.parquet' GROUP BY 1"""
    found = duckdb.sql(sql)
    names = [d[0] for d in found.description]
    want = {r[0]: r[1:] for r in found.fetchall()}
    rows = models.bundle_metrics(bundle, sets[2]).collect()
    assert len(rows) == 6 and {r["horizon_minutes"] for r in rows} == set(want)
    for r in rows:
        assert np.allclose([r[c] for c in names[1:]], want[r["horizon_minutes"]], rtol=1e-12)
    by_model = {(r["model"], r["horizon_minutes"]): r for r in models.version_metrics(bundle, {"test": sets[2]}).collect()}
    for h, values in want.items():
        row = dict(zip(names[1:], values))
        assert abs(by_model["point", h]["mae"] - row["mae"]) < 1e-9
        assert abs(by_model["p90", h]["pinball_loss"] - row["p90_pinball"]) < 1e-9
        assert abs(by_model["p50", h]["coverage"] - row["p50_coverage"]) < 1e-12


def test_search_bins_once_and_ranks(spark, sets, monkeypatch):
    seen = []
    binned = boosting.binned
    monkeypatch.setattr(boosting, "binned", lambda *a: seen.append(a) or binned(*a))
    configs = models.sample_params(3, replace(TreeParams(), rounds=3)) + models.sample_leafwise(2, replace(models.LEAFWISE, rounds=3))
    rows = models.search(sets[0], sets[1], S.model_features, configs, together=2).collect()
    assert len(seen) == 1 and sorted(r["iteration"] for r in rows) == [1, 2, 3, 4, 5]
    assert [r["validation_mae"] for r in rows] == sorted(r["validation_mae"] for r in rows)
    one = models.fit_boosted(sets[0], sets[1], S.model_features, configs[4])
    mae = models.score(one, sets[1]).agg(F.avg(F.abs(F.col("target") - F.col("prediction")))).first()[0]
    assert abs(mae - next(r["validation_mae"] for r in rows if r["iteration"] == 5)) < 1e-9


def test_from_visits_to_the_registry_to_forecasts(spark, tmp_path):
    visits = catalog.visits(spark, DATA)
    folder, tiny = str(tmp_path), replace(TreeParams(), rounds=3, max_depth=3)
    first = models.train(visits, folder, tiny, S).first()
    assert (first["decision"], first["active_version"]) == ("promoted", "v001")
    second = models.train(visits, folder, replace(tiny, rounds=1), S).first()
    assert (second["decision"], second["active_version"]) == ("candidate_rejected", "v001")
    stored = spark.read.parquet(f"{folder}/v001/metrics")
    assert stored.count() == 2 * 3 * 6 and stored.filter("model = 'p90' AND coverage IS NULL").count() == 0
    mean = stored.filter("model = 'point' AND split = 'validation'").agg(F.avg("mae")).first()[0]
    assert abs(mean - first["candidate_mae"]) < 1e-12

    instants = spark.sql(
        "SELECT explode(array(timestamp_ntz'2024-01-20 10:07:00', timestamp_ntz'2000-01-01 00:00:00', "
        "timestamp_ntz'2024-01-13 12:00:00')) AS prediction_time"
    )
    rows = {str(r["prediction_time"]): r for r in models.forecast_active(visits, instants, folder, S).collect()}
    good = rows["2024-01-20 10:07:00"]
    assert good["is_eligible"] and len(good["forecast"]) == 6 and good["model_version"] == "v001"
    asked = asof.eligibility(visits, instants, S).filter("NOT is_eligible").collect()
    assert len(asked) == 2
    for r in asked:
        row = rows[str(r["prediction_time"])]
        assert row["reason"] == r["reason"] and row["forecast"] is None


def test_permuted_chunks_agree_with_the_whole(bundle, sets):
    whole = models.permutation_importance(bundle.point, sets[1], repeats=3, chunk_rows=10**6)
    parts = models.permutation_importance(bundle.point, sets[1], repeats=3, chunk_rows=64)
    a, b = ({r["feature"]: r["importance_mean"] for r in x.collect()} for x in (whole, parts))
    assert max(a, key=a.get) == max(b, key=b.get) == "active_vehicles"
    assert abs(a["active_vehicles"] - b["active_vehicles"]) < 0.2 * a["active_vehicles"]
    unused = [f for f, v in bundle.point.importance().items() if v == 0]
    assert all(a[f] == b[f] == 0 for f in unused)


def test_emptied_tables_hold_no_rows(spark):
    table = storage.written(spark.range(100), "t")
    storage.emptied(table)
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    assert rows_of(spark.read.schema(table.schema).parquet(folder)) == []
