import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators import enrichment, features, metrics, sampling
from transitloom.plans import testdata

SF = "/root/testdata/sf0.001"


def test_weekend_days_are_a_choice(spark):
    days = spark.createDataFrame([(f"2025-01-{d:02d} 10:00:00",) for d in range(3, 7)], "t string")
    timed = features.time_features(days, "t")
    assert [(r.day_of_week, r.is_weekend, r.hour) for r in timed.collect()] == [
        (6, 0, 10), (7, 1, 10), (1, 1, 10), (2, 0, 10)]
    other = features.time_features(days, "t", weekend_days=(6, 7))
    assert [r.is_weekend for r in other.collect()] == [1, 1, 0, 0]
    assert features.time_features(days, "absent") is days


def test_label_filter_and_fill(spark):
    frame = spark.createDataFrame(
        [(1.0, None), (None, 2.0), (math.nan, 3.0), (-1.0, math.nan)], "delay double, speed double")
    kept = features.fill_zero(features.valid_label(frame), ["speed", "absent"])
    assert rows(kept) == [(-1.0, 0.0), (1.0, 0.0)]
    whole = spark.createDataFrame([(1,), (None,)], "delay int")
    assert rows(features.valid_label(whole)) == [(1.0,)]


def test_alignment_adds_zeros_in_order(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    aligned = features.align_schema(frame, ["b", "c", "a"])
    assert aligned.columns == ["b", "c", "a"] and rows(aligned) == [(2, 0, 1)]


def test_unseen_category_gets_the_extra_index(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "line string")
    models = features.categorical_indexers(train, ["line"])
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "line string")
    encoded = features.encode_categoricals(test, ["line"], models)
    assert encoded.columns == ["line_index"]
    assert [row[0] for row in encoded.collect()] == [1.0, 0.0, 2.0, 3.0, 3.0]


def test_categories_of_different_size_have_their_own_extra_index(spark, tmp_path):
    train = spark.createDataFrame(
        [("GPS", str(i), None) for i in range(9)] + [("ODO", "0", None)],
        "location_source string, line string, direction string")
    models = features.categorical_indexers(train, ["location_source", "line", "direction"])
    assert [list(model.labels) for model in models] == [
        ["GPS", "ODO"], [str(i) for i in range(9)], []]
    test = spark.createDataFrame([("DR", "99", "1"), (None, None, None), ("ODO", "1", "2")], train.schema)
    encoded = features.encode_categoricals(test, model_columns(models), models)
    encoded.write.parquet(str(tmp_path / "encoded"))
    stored = spark.read.parquet(str(tmp_path / "encoded"))
    assert rows(stored) == [(1.0, 1.0, 0.0), (2.0, 9.0, 0.0), (2.0, 9.0, 0.0)]
    assert features.categorical_indexers(train, ["absent"]) == []


def model_columns(models):
    return [model.getInputCol() for model in models]


def test_encoding_without_a_model_ranks_every_value(spark):
    train = spark.createDataFrame([("b", 1), ("b", 2), ("a", 2), ("c", 3), (None, 3)], "line string, operator int")
    encoded = features.encode_categoricals(train, ["line", "operator", "absent"])
    assert rows(encoded) == [(0.0, 0.0), (0.0, 2.0), (1.0, 0.0), (2.0, 1.0), (3.0, 1.0)]


def test_hours_belong_to_the_zone_asked_for(spark):
    moment = spark.createDataFrame([("2024-01-05T23:30:00Z",)], "at string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            utc = features.time_features(moment, "at").first()
            local = features.time_features(moment, "at", zone="Europe/Helsinki").first()
            assert (utc.hour, utc.is_weekend) == (23, 0)
            assert (local.hour, local.is_weekend) == (1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_metrics_of_known_errors(spark):
    perfect = spark.createDataFrame([(1.0, 1.0), (-3.0, -3.0)], "delay double, prediction double")
    assert tuple(metrics.regression_metrics(perfect).first()) == (2, 0.0, 0.0, 1.0, 0.0)
    frame = spark.createDataFrame([(2.0, 1.0), (-2.0, 0.0), (0.0, 3.0)], "delay double, prediction double")
    found = metrics.regression_metrics(frame).first()
    assert found.rows == 3 and found.mae == 2.0
    assert found.rmse == pytest.approx(math.sqrt(14 / 3))
    assert found.r2 == pytest.approx(1 - 14 / 8)
    assert found.mape == pytest.approx((0.5 + 1 + 3) / 3 * 100)
    signed = metrics.regression_metrics(frame, signed=True).first()
    assert signed.mape == pytest.approx((0.5 - 1 + 3) / 3 * 100)
    empty = metrics.regression_metrics(frame.limit(0)).first()
    assert tuple(empty) == (0, None, None, None, None)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 4.0, 4.0], [7.0, 7.0], list(np.linspace(-3, 9, 500))])
def test_histogram_against_numpy(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double")
    counts, edges = np.histogram(values, bins=30)
    found = metrics.histogram(frame, "x").orderBy("bin").collect()
    assert [row.row_count for row in found] == counts.tolist()
    assert [row.bin_start for row in found] == pytest.approx(edges[:-1].tolist())
    assert found[-1].bin_end == pytest.approx(edges[-1])


def test_histogram_of_nothing(spark):
    assert metrics.histogram(spark.createDataFrame([], "x double"), "x").isEmpty()


def test_split_is_disjoint_complete_and_stable(spark):
    events = testdata.table(spark, SF, "events").select("event_id")
    train, test = sampling.split_rows(events, ["event_id"])
    assert train.count() + test.count() == events.count()
    assert train.intersect(test).isEmpty()
    assert 0.7 < train.count() / events.count() < 0.9
    again, _ = sampling.split_rows(events.repartition(13), ["event_id"])
    assert rows(again) == rows(train)


def test_sample_size_and_stability(spark):
    events = testdata.table(spark, SF, "events").select("event_id")
    sample = sampling.sample_rows(events, ["event_id"], 50)
    assert sample.count() == 50 and sample.distinct().count() == 50
    assert rows(sampling.sample_rows(events.repartition(7), ["event_id"], 50)) == rows(sample)
    assert rows(sampling.sample_rows(events, ["event_id"], 50, seed=1)) != rows(sample)
    assert sampling.sample_rows(events, ["event_id"], 10**6).count() == events.count()


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_weather_against_brute_force(spark, hot_rows):
    day = 24 * 60
    reports = [(m, float(i), i) for i, m in enumerate([10, 10, 40, day - 1, 4 * day, 4 * day + 5])]
    asked = [0, 9, 10, 11, 39, 40, 41, day - 2, day - 1, day, 3 * day, 4 * day - 1, 4 * day, 9 * day]
    asked += [41] * 30
    positions = spark.createDataFrame([(i, m) for i, m in enumerate(asked)] + [(-1, None)], "id int, minute long")
    weather = spark.createDataFrame(reports, "minute long, temperature double, report int")
    found = enrichment.weather_enrich(
        positions, weather, tie_break=["report"], hot_rows=hot_rows, hot_share=1 / 100)
    expected = [(-1, None, None, None)]
    for i, m in enumerate(asked):
        last = max(((t, r) for t, _, r in reports if t <= m), default=None)
        expected.append((i, m, float(last[1]) if last else None, last[1] if last else None))
    assert rows(found) == sorted(expected, key=repr)


def test_weather_by_place(spark):
    positions = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5)], "id int, place string, minute int")
    weather = spark.createDataFrame([("a", 1, 1.0), ("b", 6, 2.0), ("b", 2, 3.0)],
                                    "place string, minute int, temperature double")
    found = enrichment.weather_enrich(positions, weather, by=["place"])
    assert rows(found, "id", "temperature") == [(1, 1.0), (2, 3.0), (3, None)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_sync_issues(spark, hot_rows):
    trips = spark.createDataFrame(
        [("t", [("a", 100, 110), ("b", 90, 95), ("c", 1000, 1010)]), ("u", [])],
        "trip_id string, stop_time_updates array<struct<stop_id:string,arrival_time:long,departure_time:long>>")
    vehicles = spark.createDataFrame([("t", "a", 100), ("t", "c", 2000), ("t", "c", 1500), ("x", "a", 1)],
                                     "trip_id string, stop string, timestamp_seconds long")
    assert rows(enrichment.trip_sync_issues(trips, vehicles, 300, hot_rows, 1 / 100)) == [
        ("t", 1, "b", "out_of_order", -10), ("t", 2, "c", "out_of_sync", 500)]


def test_windowed_delay(spark):
    frame = spark.createDataFrame(
        [("2025-01-01 10:00:00", "r", 10), ("2025-01-01 10:59:59", "r", None), ("2025-01-01 11:00:00", "r", 4)],
        "t string, route string, delay int").withColumn("t", F.col("t").cast("timestamp"))
    found = enrichment.windowed_delay(frame, "t").select("route", "positions", "mean_delay")
    assert rows(found) == [("r", 1, 4.0), ("r", 2, 10.0)]
