"""Counts, regression metrics and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.functions.values import absolute_percentage_error, is_number


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row: the frame's name, its number of rows and whether it is empty."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty")
    )


def regression_metrics(
    df: DataFrame, label: str = "delay", prediction: str = "prediction", signed: bool = False
) -> DataFrame:
    """RMSE, MAE, R² and MAPE (in percent) in one pass over the scored rows."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    sums = df.agg(
        F.count("*").alias("rows"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("variance"),
        F.avg(absolute_percentage_error(label, prediction, signed)).alias("ape"),
    )
    return sums.select(
        "rows",
        F.sqrt(F.col("sse") / F.nullif("rows", F.lit(0))).alias("rmse"),
        "mae",
        (1 - F.col("sse") / F.nullif(F.col("variance") * F.col("rows"), F.lit(0.0))).alias("r2"),
        (F.col("ape") * 100).alias("mape"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; NULL and NaN are not counted.

    A constant column gets a range of 1 around its value. All ``bins`` rows come out,
    none of them if there is no value at all.
    """
    values = df.where(is_number(df, column)).select(F.col(column).cast("double").alias("value"))
    low, high = values.agg(F.min("value"), F.max("value")).first()
    if low is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, row_count long"
        )
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.floor((F.col("value") - F.lit(low)) / F.lit(high - low) * bins)
    counts = values.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("row_count")
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_start"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
    )


def category_ranking(df: DataFrame, column: str) -> DataFrame:
    """Categories with their frequency, most frequent first, ties by name."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category"))
    return counts.agg(F.count("*").alias("frequency")).orderBy(F.desc("frequency"), "category")
