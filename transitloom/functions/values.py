"""Small value rules shared by the normalisers and the feature frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def clamp_non_negative(column) -> Column:
    """Negative to 0, missing to 0."""
    value = F.col(column) if isinstance(column, str) else column
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def topic_segment(topic, index: int = 6, default: str = "unknown") -> Column:
    """The ``index``-th (0-based) ``/`` part of a topic path."""
    path = F.col(topic) if isinstance(topic, str) else topic
    return F.coalesce(F.get(F.split(path, "/"), F.lit(index)), F.lit(default))


def absolute_percentage_error(label, prediction, signed: bool = False) -> Column:
    """``|label - prediction| / |label|``, with 1 as denominator for a zero label.

    ``signed`` divides by the label itself, so negative labels give negative errors.
    """
    label, prediction = F.col(label), F.col(prediction)
    denominator = F.when(label != 0, label if signed else F.abs(label)).otherwise(F.lit(1.0))
    return F.abs(label - prediction) / denominator


def is_number(df: DataFrame, column: str) -> Column:
    """Neither NULL nor NaN."""
    present = F.col(column).isNotNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        present = present & ~F.isnan(column)
    return present


def present_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that ``df`` has, in the given order."""
    return [name for name in columns if name in df.columns]


def once(column: Column) -> Column:
    """``column`` computed once per row, to be selected under an alias.

    The optimizer copies a projected expression into every filter above it that uses
    it, which would parse the same text again for each use. It does not look through a
    generator, so the value passes through one of a single element.
    """
    return F.explode(F.array(column))
