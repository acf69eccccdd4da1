"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, carry: list[str] | None = None, **extra: Column) -> DataFrame:
    """The columns of ``df``, or those in ``carry``, as one struct ``row``, next to ``extra``.

    Result columns added later cannot clash with the columns inside ``row``.
    """
    names = df.columns if carry is None else carry
    whole = F.struct(*[column(name) for name in names]).alias("row")
    return df.select(whole, *[value.alias(name) for name, value in extra.items()])


def packed_text(
    df: DataFrame, text_col: str, carry: list[str] | None, **extra: Column
) -> DataFrame:
    """:func:`packed` with the text as well, once: in ``row`` if that carries it, else beside."""
    if carry is not None and text_col not in carry:
        extra["text"] = column(text_col)
    return packed(df, carry, **extra)


def batch_texts(batch: pa.RecordBatch, text_col: str) -> list[bytes | None]:
    """The texts of a batch of :func:`packed_text` in UTF-8."""
    beside = "text" in batch.schema.names
    texts = batch.column("text") if beside else batch.column("row").field(text_col)
    return texts.cast(pa.binary()).to_pylist()


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``row``."""
    return df.select(*[column("row")[name].alias(name) for name in like.columns])


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def content_key(*values: Column) -> list[Column]:
    """128 bits of the values, as two columns ``key_a`` and ``key_b``."""
    return [
        F.xxhash64(*values).alias("key_a"),
        F.xxhash64(F.lit("second half"), *values).alias("key_b"),
    ]
