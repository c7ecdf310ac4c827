import numpy as np
import pytest
from conftest import DATA, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellgrid.functions import quantiles
from dwellgrid.functions.quantiles import percentiles
from dwellgrid.operators import asof, evaluate, features, lagstats
from dwellgrid.plans import catalog
from dwellgrid.plans.catalog import S

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.floats(-50, 50).map(lambda v: round(v, 1)), min_size=1, max_size=60),
    small=st.sampled_from([1, 10, 1000]),
)
def test_percentiles_equal_numpy(spark, values, small):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = percentiles(df, "v", PROBS, small=small, splits=4).first()
    assert row.n == len(values)
    expected = np.quantile(values, list(PROBS.values()))
    assert np.allclose([row[k] for k in PROBS], expected, atol=1e-9)


def test_percentiles_with_a_hot_value_a_null_group_and_nulls(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'x' WHEN id % 3 = 1 THEN null ELSE 'z' END AS k",
        "CASE WHEN id % 3 = 0 THEN 7.0D WHEN id % 50 = 0 THEN null ELSE cast(id % 997 AS double) END AS v",
    )
    rows = {r.k: r for r in percentiles(df, "v", PROBS, ["k"]).collect()}
    plain = {
        r.k: r for r in df.groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", 0.9).alias("d")).collect()
    }
    assert set(rows) == {"x", None, "z"} == set(plain)
    for k, r in plain.items():
        assert rows[k].n == r.n and rows[k].d == pytest.approx(r.d)


def test_percentiles_of_large_groups_split_until_cells_are_small(spark, monkeypatch):
    """100,000 distinct values over 30 orders of magnitude, a hot value, two groups and far outliers."""
    df = spark.range(150_000).selectExpr(
        "id % 2 = 0 AS k",
        "CASE WHEN id % 3 = 0 THEN 5.5D WHEN id < 4 THEN pow(-10, 280 + id) "
        "ELSE pow(10, (id * 7919 % 100003) / 100003 * 30 - 15) * (1 - 2 * (id % 5 div 4)) END AS v",
    )
    seen = []
    written = quantiles.written
    monkeypatch.setattr(quantiles, "written", lambda cells, label: seen.append(written(cells, label)) or seen[-1])
    probs = {"a": 0.001, "b": 0.3, "c": 0.5, "d": 0.999}
    rows = {r.k: r for r in percentiles(df, "v", probs, ["k"], small=200, splits=64).collect()}
    assert seen and seen[-1].filter("__rows > 200 AND __lo < __hi").count() == 0
    assert seen[-1].count() <= 2 * 2 * len(probs)
    for k, part in df.toPandas().groupby("k"):
        assert rows[k].n == len(part)
        assert np.allclose([rows[k][p] for p in probs], np.quantile(part["v"], list(probs.values())), rtol=1e-12)
    whole = percentiles(df, "v", probs, small=200, splits=64).first()
    assert np.allclose([whole[p] for p in probs], np.quantile(df.toPandas()["v"], list(probs.values())), rtol=1e-12)


def test_percentiles_of_no_rows(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert percentiles(none, "v", PROBS, ["k"]).count() == 0
    assert percentiles(none, "v", PROBS).first()["c"] is None


@pytest.fixture(scope="module")
def series(spark):
    flagged = features.flagged_grid(catalog.visits(spark, DATA), S)
    pdf = flagged.orderBy("timestamp").toPandas()
    x = pdf["active_vehicles"].astype(float).where(pdf["is_reliable"])
    return flagged, x


def test_autocorrelations_equal_pandas(series):
    flagged, x = series
    ours = {r.lag_steps: r.autocorrelation for r in lagstats.acf_pairwise(flagged, 8, S).collect()}
    assert sorted(ours) == list(range(1, 9))
    for k, v in ours.items():
        assert v == pytest.approx(x.autocorr(k), abs=1e-9)
    study = {r.lag_steps: r for r in lagstats.acf_at(flagged, s=S).collect()}
    for k, r in study.items():
        assert r.autocorrelation == pytest.approx(x.autocorr(k), abs=1e-9)
        assert r.valid_pairs == int((x.notna() & x.shift(k).notna()).sum())


def test_standard_acf_and_pacf(series):
    flagged, x = series
    y = x.dropna().to_numpy()
    d = y - y.mean()
    ours = {r.lag_steps: r.autocorrelation for r in lagstats.acf_standard(flagged, 6, S).collect()}
    for k in range(7):
        assert ours[k] == pytest.approx((d[k:] * d[: len(d) - k]).sum() / (d * d).sum(), abs=1e-9)
    # Solve each Yule-Walker system directly.
    runs = x.notna().astype(int).diff().ne(0).cumsum()[x.notna()]
    seg = x[runs[runs == runs.value_counts().idxmax()].index].to_numpy()
    e = seg - seg.mean()
    r = np.array([(e[k:] * e[: len(e) - k]).sum() for k in range(7)]) / (e * e).sum()
    ours = {p.lag_steps: p for p in lagstats.pacf(flagged, 6, S).collect()}
    assert ours[0].partial_autocorrelation == 1.0
    for k in range(1, 7):
        system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        last = np.linalg.solve(system, r[1 : k + 1])[-1]
        assert ours[k].partial_autocorrelation == pytest.approx(last, abs=1e-9)
        half = lagstats.NORMAL_95 / np.sqrt(len(seg))
        assert ours[k].upper_ci - ours[k].lower_ci == pytest.approx(2 * half)


INSTANTS = ["2024-01-12 10:17:00", "2024-01-20 03:41:12", "2024-01-25 10:17:00", "2024-01-01 00:30:00"]
REFUSED = {
    "2024-01-13 09:00:00": "instant unreliable",
    "2024-01-16 06:00:00": "lag_24h unreliable",
    "2024-01-15 12:00:00": "lag_15m unreliable",
    "2023-12-31 00:00:00": "before first entry",
}


def _instants(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.selectExpr("cast(t AS timestamp_ntz) AS prediction_time")


def test_batch_features_equal_single_features(spark):
    v = catalog.visits(spark, DATA)
    batch = asof.features_at(v, _instants(spark, INSTANTS + list(REFUSED)), S)
    singles = asof.features_at_one(v, INSTANTS[0], S)
    for t in INSTANTS[1:]:
        singles = singles.union(asof.features_at_one(v, t, S))
    assert batch.columns == ["prediction_time", *S.model_features]
    assert rows_of(batch) == rows_of(singles) and batch.count() == 24


def test_periods_from_a_table_hold_for_their_series_only(spark):
    """Half the series have the listed periods, the rest have none; a null key is a series."""
    s, late = S.keyed("site"), INSTANTS[:3]
    v = catalog.visits(spark, DATA).withColumn("site", F.expr("nullif(minute(entry_time) % 3, 2)"))
    listed = ", ".join(f"struct(timestamp_ntz'{a}' AS start, timestamp_ntz'{b}' AS end)" for a, b in S.bad_periods())
    periods = spark.sql(f"SELECT site, x.* FROM (SELECT explode(array(1, null)) AS site), (SELECT explode(array({listed})) AS x)")
    instants = _instants(spark, late + list(REFUSED)).selectExpr("explode(array(0, 1, null)) AS site", "*")
    found = {(r.site, str(r.prediction_time)): r.reason for r in asof.eligibility(v, instants, s, periods).collect()}
    assert len(found) == 21
    for t, why in {**dict.fromkeys(late), **REFUSED}.items():
        assert found[1, t] == found[None, t] == why
        assert found[0, t] == (why if why == "before first entry" else None)
    rows = asof.features_at(v, instants, s, periods).groupBy("site").count().collect()
    assert {r.site: r["count"] for r in rows} == {0: 6 * 6, 1: 6 * 3, None: 6 * 3}
    wide = features.wide_frame(v, s, periods)
    bad = wide.groupBy("site").agg(F.count_if(~F.col("is_reliable")).alias("n")).collect()
    assert {r.site: r.n > 0 for r in bad} == {0: False, 1: True, None: True}


def test_counts_include_an_event_at_the_very_instant(spark, make_visits):
    v = make_visits([("2024-01-01 10:15:00", "2024-01-01 10:30:00")])
    got = {}
    for t in ("2024-01-01 10:14:59", "2024-01-01 10:15:00", "2024-01-01 10:30:00"):
        got[t[-8:]] = v.agg(asof.active_at(t)).first()[0]
    assert got == {"10:14:59": 0, "10:15:00": 1, "10:30:00": 0}
    probes = _instants(spark, ["2024-01-01 10:14:59", "2024-01-01 10:15:00", "2024-01-01 10:30:00"])
    counted = asof.counts_at(v, probes.withColumnRenamed("prediction_time", "probe_ts"), S)
    assert sorted((r.probe_ts.isoformat()[-8:], r.entered, r.left) for r in counted.collect()) == [
        ("10:14:59", 0, 0),
        ("10:15:00", 1, 0),
        ("10:30:00", 1, 1),
    ]


def test_refusals_name_the_first_broken_rule(spark):
    v = catalog.visits(spark, DATA)
    rows = asof.eligibility(v, _instants(spark, INSTANTS + list(REFUSED)), S).collect()
    reasons = {r.prediction_time.isoformat(" "): r.reason for r in rows}
    assert reasons == {**dict.fromkeys(INSTANTS), **REFUSED}
    for t, why in REFUSED.items():
        with pytest.raises(asof.HistoryError, match=why):
            asof.require_history(v, t, S)
    asof.require_history(v, INSTANTS[0] + "+00:00", S)


def test_promotion_rule(spark):
    schema = "version string, mean_mae double, mean_mse double"

    def decide(candidate, active):
        c = spark.createDataFrame([("v002", *candidate)], schema)
        a = spark.createDataFrame([("v001", *active)] if active else [], schema)
        r = evaluate.promotion(c, a).first()
        return r.decision, r.active_version

    assert decide((1.0, 1.0), None) == ("promoted", "v002")
    assert decide((1.0, 1.0), (2.0, 2.0)) == ("promoted", "v002")
    assert decide((1.0, 2.0), (2.0, 2.0)) == ("candidate_rejected", "v001")
    assert decide((3.0, 3.0), (2.0, 2.0)) == ("candidate_rejected", "v001")
