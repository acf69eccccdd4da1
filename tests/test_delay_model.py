import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators.features import feature_frame
from transitloom.plans import delay_model, testdata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    """Facts whose delay can be learnt: it follows the line and the speed."""
    learnable = F.when(F.col("delay").isNotNull(), F.col("line") * 3.0 + F.coalesce("speed", F.lit(0)))
    return testdata.facts(spark, SF).withColumn("delay", learnable)


@pytest.fixture(scope="module")
def trained(facts):
    return delay_model.train_and_evaluate(facts, ["journey_id"], trees=20)


def test_model_beats_the_mean(trained):
    _, scored = trained
    found = delay_model.evaluate(scored).first()
    assert found.rows > 100 and found.r2 > 0.5


def test_reloaded_model_scores_the_same(spark, facts, trained, tmp_path):
    model, _ = trained
    delay_model.save_model(model, str(tmp_path / "model"))
    delay_model.save_model(model, str(tmp_path / "model"))
    again = delay_model.load_model(str(tmp_path / "model"))
    frame = feature_frame(facts)
    assert rows(delay_model.score(again, frame)) == rows(delay_model.score(model, frame))
    assert delay_model.score(model, frame).columns[-1] == "predicted_delay"


def test_importances_name_every_feature_once(spark, trained):
    model, _ = trained
    found = delay_model.feature_importance(model, spark).collect()
    assert sorted(row.feature for row in found) == sorted(delay_model.feature_names(model))
    weights = [row.importance for row in found]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1)
    assert found[0].feature in ("line_index", "vehicle_latitude")


def test_unseen_categories_are_scored(facts, trained):
    model, _ = trained
    strange = feature_frame(facts).withColumn("vehicle_type", F.lit("balloon"))
    assert delay_model.score(model, strange).count() == strange.count()


def test_features_of_the_frame_are_checked(facts, trained):
    model, _ = trained
    frame = feature_frame(facts).drop("odometer", "line")
    with pytest.raises(ValueError, match="odometer, line_index"):
        delay_model.score(model, frame)
    filled = delay_model.score(model, feature_frame(facts).drop("odometer"), fill=["odometer"])
    assert filled.where("odometer = 0 AND predicted_delay IS NOT NULL").count() == filled.count()


@pytest.mark.parametrize("stop", ["CASE WHEN line % 2 = 0 THEN stop END", "concat('A', stop)"])
def test_every_row_is_scored(facts, trained, stop):
    model, _ = trained
    frame = feature_frame(facts).withColumn("stop", F.expr(stop))
    scored = delay_model.score(model, frame, keep=["line"])
    assert scored.count() == frame.count()
    gap = scored.where("stop IS NULL")
    assert gap.count() > 0 and gap.where("predicted_delay IS NOT NULL").count() == 0
    assert scored.where("stop IS NOT NULL AND predicted_delay IS NULL").count() == 0


def test_more_categories_than_bins(facts):
    model = delay_model.train_delay_model(feature_frame(facts), max_bins=16, trees=2)
    labels = {stage.getInputCol(): stage.labels for stage in model.stages[:-2]}
    assert len(labels["line"]) == 14 and len(labels["location_source"]) == 2
    assert all(label is not None for found in labels.values() for label in found)
    scored = delay_model.score(model, feature_frame(facts))
    assert scored.where("line_index > 14").count() == 0


def test_model_does_not_depend_on_how_rows_lie(facts):
    frame = feature_frame(facts)
    ids = ["journey_id"]
    found = [
        rows(delay_model.score(delay_model.train_delay_model(frame.repartition(n), trees=3), frame, ids))
        for n in (1, 7)
    ]
    assert found[0] == found[1]


def test_batches_keep_their_test_rows(facts):
    found = delay_model.train_score_batches(
        facts, ["timestamp", "journey_id"], ["journey_id"], size=200, trees=3)
    assert set(delay_model.SCORER_FEATURES) < set(found.columns)
    counts = {row["batch_id"]: row["count"] for row in found.groupBy("batch_id").count().collect()}
    assert set(counts) == set(range(5)) and all(10 < n < 80 for n in counts.values())
