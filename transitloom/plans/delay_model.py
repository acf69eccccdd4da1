"""Training, scoring and evaluating the delay model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.functions.values import present_columns
from transitloom.operators.features import (
    CATEGORICAL,
    LABEL,
    MOMENTS,
    align_schema,
    categorical_indexers,
    feature_frame,
)
from transitloom.operators.metrics import regression_metrics
from transitloom.operators.ordering import batch_id
from transitloom.operators.sampling import split_rows
from transitloom.storage import materialize

# The size of the forest and its bins.
TREES, MAX_BINS, MAX_DEPTH, SEED = 100, 256, 5, 42
# Bagging is seeded per partition, so their number belongs to the model, not to the cluster.
TRAINING_PARTITIONS = 16

# The names of the model's features.
NUMERIC_FEATURES = (
    "total_stops", "vehicle_id", "journey_id", "speed", "occupancy", "vehicle_latitude",
    "vehicle_longitude", "timestamp_seconds", "stop", "odometer", "hour", "day_of_week",
    "is_weekend", "timestamp_numeric", "start_time_numeric", "start_date_numeric",
)
# The numeric features that describe a position rather than identify it.
SCORER_FEATURES = (
    "speed", "occupancy", "vehicle_latitude", "vehicle_longitude", "odometer",
    "timestamp_numeric", "start_time_numeric", "start_date_numeric", "hour", "day_of_week",
    "is_weekend",
)


def _prepared(facts: DataFrame, numeric: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Numeric features as doubles (missing columns as 0) next to the categories and the label."""
    categories = present_columns(facts, CATEGORICAL)
    return align_schema(facts, numeric, keep=[*keep, *categories]).withColumns(
        {name: F.col(name).try_cast("double") for name in numeric}
    )


def _training_table(prepared: DataFrame, partitions: int) -> DataFrame:
    """The prepared rows stored, since indexer and forest read them several times.

    Rows are placed by a hash of their content and sorted by it, so the same rows and seed
    give the same forest on any cluster.
    """
    stored = materialize(prepared, "training")
    content = F.xxhash64(*stored.columns)
    return stored.repartition(partitions, content).sortWithinPartitions(content, *stored.columns)


def train_delay_model(
    facts: DataFrame,
    label: str = LABEL,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    trees: int = TREES,
    max_bins: int = MAX_BINS,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
    partitions: int = TRAINING_PARTITIONS,
) -> PipelineModel:
    """Fit encoding, assembling and forest as one model on prepared facts.

    ``facts`` is the training side of a split, as ``feature_frame`` leaves it. What is
    learnt here, the category indexes included, is what scoring uses. Categories with more
    values than bins keep the most frequent ones apart. ``partitions`` should grow with the
    training table; another number gives another, equally good forest.
    """
    prepared = _training_table(_prepared(facts, numeric, [label]), partitions)
    # Each value takes a bin, and all others one more.
    indexers = categorical_indexers(prepared, most=max_bins - 2)
    inputs = [*numeric, *[indexer.getOutputCol() for indexer in indexers]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=trees, maxBins=max_bins,
        maxDepth=max_depth, seed=seed, maxMemoryInMB=1024,
    )
    return Pipeline(stages=[*indexers, assembler, forest]).fit(prepared)


def _assembler(model: PipelineModel) -> VectorAssembler:
    return next(stage for stage in model.stages if isinstance(stage, VectorAssembler))


def feature_names(model: PipelineModel) -> list[str]:
    return _assembler(model).getInputCols()


def _indexed(model: PipelineModel) -> dict[str, str]:
    """The category column behind every index feature."""
    return {
        stage.getOutputCol(): stage.getInputCol()
        for stage in model.stages
        if isinstance(stage, StringIndexerModel)
    }


def check_features(
    model: PipelineModel, columns: Sequence[str], fill: Sequence[str] = ()
) -> None:
    """Fail unless ``columns`` of a frame hold all the features the forest was trained on.

    A numeric feature named in ``fill`` may be missing.
    """
    names, indexed = feature_names(model), _indexed(model)
    if len(names) != model.stages[-1].numFeatures:
        raise ValueError(f"{len(names)} features for a forest of {model.stages[-1].numFeatures}")
    missing = [
        name for name in names
        if indexed.get(name, name) not in columns and name not in fill
    ]
    if missing:
        raise ValueError(f"the frame lacks the features {', '.join(missing)}")


def score(
    model: PipelineModel,
    facts: DataFrame,
    keep: Sequence[str] = (),
    label: str | None = None,
    fill: Sequence[str] = (),
) -> DataFrame:
    """``keep`` columns, the model's features and ``predicted_delay`` of every row.

    ``facts`` are prepared facts; a missing feature is an error unless named in ``fill``,
    which takes it as 0. A row with a feature that is NULL or no number has no prediction.
    """
    check_features(model, facts.columns, fill)
    names, indexed = feature_names(model), _indexed(model)
    numeric = [name for name in names if name not in indexed]
    kept = [*keep, *([label] if label else [])]
    aside = {f"_keep_{name}": name for name in kept}
    carried = facts.withColumns({alias: F.col(name) for alias, name in aside.items()})
    prepared = _prepared(carried, numeric, list(aside))
    # The assembler leaves rows with gaps out: they go in filled, and are told apart by this.
    gaps = F.array(*[F.col(name) for name in numeric])
    complete = ~F.exists(gaps, lambda value: value.isNull() | F.isnan(value))
    whole = prepared.withColumns({"_given": gaps, "_complete": complete}).na.fill(0.0, subset=numeric)
    scored = model.transform(whole)
    given = {name: F.get("_given", F.lit(at)).alias(name) for at, name in enumerate(numeric)}
    return scored.select(
        *[F.col(alias).alias(name) for alias, name in aside.items() if name not in names],
        *[given.get(name, F.col(name)) for name in names],
        F.when(F.col("_complete"), F.col("prediction")).alias("predicted_delay"),
    )


def evaluate(scored: DataFrame, label: str = LABEL, signed: bool = False) -> DataFrame:
    """RMSE, MAE, R² and MAPE of scored rows that kept their label."""
    return regression_metrics(scored, label, "predicted_delay", signed)


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Features by falling importance."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(feature_names(model), weights)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_and_evaluate(
    facts: DataFrame, keys: Sequence[str], label: str = LABEL, **options
) -> tuple[PipelineModel, DataFrame]:
    """Split stored facts 80/20 by ``keys``, fit on one side, score the other."""
    frame = feature_frame(facts, label)
    train, test = split_rows(frame, keys)
    model = train_delay_model(train, label, **options)
    return model, score(model, test, keep=keys, label=label)


def train_score_batches(
    facts: DataFrame,
    order: Sequence[str],
    keys: Sequence[str],
    size: int = 1000,
    label: str = LABEL,
    numeric: Sequence[str] = SCORER_FEATURES,
    **options,
) -> DataFrame:
    """Predictions for the test rows of every ``size``-row batch in the given order.

    One model is fitted on the train rows of all batches and scores them together:
    a fit per batch would be one driver round trip per thousand rows.
    """
    # Numbering the batches stores its rows, so only what is used later goes in.
    used = [*order, *keys, label, *numeric, *CATEGORICAL, *MOMENTS]
    narrow = facts.select(*[name for name in facts.columns if name in used])
    frame = feature_frame(batch_id(narrow, order, size), label)
    train, test = split_rows(frame, keys)
    model = train_delay_model(train, label, numeric, **options)
    return score(model, test, keep=["batch_id", *keys])
