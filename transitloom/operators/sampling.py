"""Samples and splits that depend on row content only, not on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(keys: Sequence[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_rows(df: DataFrame, keys: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """A uniform sample of at most ``size`` rows, the same one for the same ``seed``.

    ``keys`` should identify a row. Every task keeps a bounded heap of rows.
    """
    order = _digest(keys, seed)
    return df.withColumn("_order", order).orderBy("_order", *keys).limit(size).drop("_order")


def split_column(keys: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 100) per key, stable under repartitioning and retries."""
    return F.pmod(F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def split_rows(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows; rows of the same key stay together."""
    in_train = split_column(keys, seed) < round(train_share * 100)
    return df.where(in_train), df.where(~in_train)
