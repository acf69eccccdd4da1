"""The feature frame of the delay model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.functions.times import clock_to_seconds, date_to_epoch, moment_to_epoch
from transitloom.functions.values import is_number, present_columns
from transitloom.operators.ordering import with_rank
from transitloom.operators.skew import BROADCAST_ROWS, skew_join
from transitloom.storage import materialize

LABEL = "delay"
CATEGORICAL = ("vehicle_type", "route_id", "location_source", "operator", "direction", "line")
ZERO_FILLED = (
    "speed", "occupancy", "vehicle_latitude", "vehicle_longitude", "hour", "day_of_week",
    "is_weekend", "odometer",
)
NOT_FEATURES = ("trip_id", "status", "processed_time")
MOMENTS = ("timestamp", "start_time", "start_date")
# Fixed values above: the names of the columns of stored facts and of the model's features.
# dayofweek counts from Sunday = 1 to Saturday = 7.
SATURDAY_SUNDAY = (1, 7)


def time_features(
    df: DataFrame,
    moment: str = "timestamp",
    weekend_days: Sequence[int] = SATURDAY_SUNDAY,
    zone: str = "UTC",
) -> DataFrame:
    """Add hour, day_of_week and is_weekend; nothing if ``moment`` is not a column.

    Instants (timestamps, and texts that name their offset) are read in ``zone``, whatever
    the session's; a timestamp without a zone is taken as it stands.
    """
    if moment not in df.columns:
        return df
    when = F.col(moment)
    kind = dict(df.dtypes)[moment]
    if kind == "string":
        when = F.try_to_timestamp(when)
    if kind != "timestamp_ntz":
        local = when.cast("timestamp").cast("timestamp_ntz")
        when = F.convert_timezone(F.current_timezone(), F.lit(zone), local)
    day = F.dayofweek(when)
    return df.withColumns(
        {
            "hour": F.hour(when),
            "day_of_week": day,
            "is_weekend": F.when(day.isin(*weekend_days), 1).otherwise(0),
        }
    )


def valid_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows whose label is neither NULL nor NaN, with the label as a double."""
    return df.where(is_number(df, label)).withColumn(label, F.col(label).cast("double"))


def fill_zero(df: DataFrame, columns: Sequence[str] = ZERO_FILLED) -> DataFrame:
    """NULL (and NaN) to 0 in those of ``columns`` that exist."""
    found = present_columns(df, columns)
    return df.na.fill(0, subset=found) if found else df


def to_epoch(df: DataFrame, drop: bool = True) -> DataFrame:
    """``timestamp``, ``start_time`` and ``start_date`` to ``*_numeric`` seconds.

    The clock time counts from the service day's midnight.
    """
    rules = {
        "timestamp": lambda: moment_to_epoch(df, "timestamp"),
        "start_time": lambda: clock_to_seconds("start_time"),
        "start_date": lambda: date_to_epoch("start_date"),
    }
    found = present_columns(df, MOMENTS)
    numeric = df.withColumns({f"{name}_numeric": rules[name]() for name in found})
    return numeric.drop(*found) if drop else numeric


def drop_columns(df: DataFrame, columns: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Drop those of ``columns`` that exist."""
    return df.drop(*columns)


def feature_frame(
    df: DataFrame, label: str = LABEL, weekend_days: Sequence[int] = SATURDAY_SUNDAY
) -> DataFrame:
    """Stored facts to model input before encoding, for whichever columns exist."""
    timed = time_features(df, "timestamp", weekend_days)
    return to_epoch(drop_columns(fill_zero(valid_label(timed, label))))


def align_schema(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the ``expected`` columns in that order, missing ones as 0, after ``keep``."""
    columns = [F.col(name) if name in df.columns else F.lit(0).alias(name) for name in expected]
    return df.select(*keep, *columns)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name, value, count`` of the category columns, one pass; NULL is no value."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value"))
            for name in columns
        ]
    )
    counted = df.select(F.explode(pairs).alias("pair")).select("pair.name", "pair.value")
    return counted.where("value IS NOT NULL").groupBy("name", "value").count()


def categorical_indexers(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL, most: int = 254
) -> list[StringIndexerModel]:
    """A model per category with an index for each of its ``most`` most frequent values.

    Most frequent first, ties by name. NULL, unseen and all rarer values of a category share
    the index after its last label, so that ``most + 1`` bins hold any category and the
    driver a bounded list. One model each: the labels of several in one model would have to
    be padded to the longest list, and the padding would count as labels.
    """
    found = present_columns(df, columns)
    if not found:
        return []
    counts = materialize(_value_counts(df, found), "category-counts")
    models = []
    for name in found:
        top = counts.where(F.col("name") == name).orderBy(F.desc("count"), "value").limit(most)
        labels = [row["value"] for row in top.collect()]
        models.append(StringIndexerModel.from_labels(labels, name, f"{name}_index", "keep"))
    return models


def encode_categoricals(
    df: DataFrame,
    columns: Sequence[str] = CATEGORICAL,
    models: Sequence[StringIndexerModel] = (),
) -> DataFrame:
    """Replace category columns by ``*_index``: those of ``models``, or else a rank by frequency.

    Without models every value has its own index, however many there are: values are ranked
    as a table (ties by name) and joined back. NULL gets the number of values.
    """
    if models:
        indexed = PipelineModel(list(models)).transform(df)
        return indexed.drop(*[model.getInputCol() for model in models])
    found = present_columns(df, columns)
    if not found:
        return df
    counts = _value_counts(df, found).withColumn("rarity", -F.col("count"))
    ranked = materialize(with_rank(counts, ["name", "rarity", "value"]), "category-ranks")
    sizes = {
        row["name"]: row
        for row in ranked.groupBy("name").agg(F.min("rank").alias("first"), F.count("*").alias("n")).collect()
    }
    encoded = df
    for name in found:
        first, n = (sizes[name]["first"], sizes[name]["n"]) if name in sizes else (0, 0)
        own = ranked.where(F.col("name") == name).select(
            F.col("value").alias("_value"), (F.col("rank") - first).cast("double").alias("_index")
        )
        keyed = encoded.withColumn("_value", F.col(name).cast("string"))
        # The number of values is known: a short list is broadcast, so that no frequent value
        # and no NULL meets in one task; beyond that frequent values are salted.
        if n <= BROADCAST_ROWS:
            joined = keyed.join(F.broadcast(own), "_value", "left")
        else:
            joined = skew_join(keyed, own, ["_value"], "left", unique_right=True)
        encoded = joined.withColumn(f"{name}_index", F.coalesce("_index", F.lit(float(n))))
        encoded = encoded.drop("_value", "_index", name)
    return encoded


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vectors; rows with a NULL or NaN feature are left out."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")
    return assembler.transform(df)
