from datetime import datetime

import pytest
from conftest import rows_of

from dwellgrid.operators import clean, supervised
from dwellgrid.plans.catalog import S
from dwellgrid.sources import storage, visits

GOOD = ("2024-01-01 10:07:00", "2024-01-01 10:52:00", None, "45.0")


def raw(spark, rows, columns=None):
    return visits.text_rows(spark, rows, columns or list(clean.RAW_NAMES))


def test_typed_renames_casts_and_fills(spark):
    row = clean.typed(raw(spark, [GOOD])).first()
    assert row.entry_time == datetime(2024, 1, 1, 10, 7)
    assert row.risk_category == "UNKNOWN"
    assert row.duration_min == 45.0


def test_zero_length_visit_is_valid(spark):
    same = ("2024-01-01 10:00:00", "2024-01-01 10:00:00", "RED", "0")
    assert clean.strict(raw(spark, [same])).count() == 1
    assert clean.lenient(raw(spark, [same])).count() == 1


@pytest.mark.parametrize(
    "row, text",
    [
        (("abc", GOOD[1], None, "1"), "entry"),
        ((GOOD[0], None, None, "1"), "exit"),
        ((GOOD[1], GOOD[0], None, "1"), "end before"),
        ((GOOD[0], GOOD[1], None, "x"), "duration"),
    ],
)
def test_batch_raises_and_stream_drops(spark, row, text):
    df = raw(spark, [GOOD, row])
    with pytest.raises(clean.VisitDataError, match=text):
        clean.strict(df)
    assert clean.lenient(df).count() == 1


def test_missing_column_and_empty_input(spark):
    with pytest.raises(clean.VisitDataError, match="exit_time"):
        clean.typed(raw(spark, [("a", "b", "c")], ["Entry Time", "Risk Category", "Duration in Min"]))
    with pytest.raises(clean.VisitDataError, match="no visits"):
        clean.strict(raw(spark, []))


def test_load_by_suffix_and_errors(spark, tmp_path):
    df = raw(spark, [GOOD])
    visits.write_csv(df, f"{tmp_path}/v.csv")
    assert rows_of(visits.load(spark, f"{tmp_path}/v.csv")) == [GOOD]
    snake = clean.typed(df)
    visits.write_parquet(snake, f"{tmp_path}/folder")
    assert rows_of(visits.load(spark, f"{tmp_path}/folder")) == rows_of(snake)
    with pytest.raises(FileNotFoundError):
        visits.load(spark, f"{tmp_path}/nothing")
    (tmp_path / "v.txt").write_text("x")
    with pytest.raises(clean.VisitDataError, match="expected"):
        visits.load(spark, f"{tmp_path}/v.txt")
    (tmp_path / "hollow").mkdir()
    with pytest.raises(clean.VisitDataError, match="cannot read"):
        visits.load(spark, f"{tmp_path}/hollow")


def test_json_lines_are_appended(spark, tmp_path):
    df = spark.range(2)
    visits.append_json(df, f"{tmp_path}/j")
    visits.append_json(df, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 4


def test_written_reads_back_and_uses_the_session_folder(spark):
    df = spark.range(3)
    assert rows_of(storage.written(df, "t")) == rows_of(df)
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_reused_result(spark):
    df = visits.reused(spark.range(5))
    assert df.count() == 5 and df.storageLevel.useMemory
    df.unpersist()
    assert not df.storageLevel.useMemory


def test_feature_lists():
    assert len(S.base_features) == 28 and len(S.model_features) == 29
    assert S.model_features[0] == "active_vehicles" and S.model_features[-1] == "horizon_minutes"
    assert supervised.leaked_targets(S.model_features, S) == []
    assert supervised.leaked_targets(["hour", "target_15m"], S) == ["target_15m"]


def test_feature_order_is_checked(spark):
    row = spark.createDataFrame([tuple(range(29))], S.model_features)
    supervised.check_feature_order(row, S.model_features, S)
    with pytest.raises(ValueError):
        supervised.check_feature_order(row, S.model_features[::-1], S)
    with pytest.raises(ValueError):
        supervised.check_feature_order(row.select(*S.model_features[::-1]), S.model_features, S)
