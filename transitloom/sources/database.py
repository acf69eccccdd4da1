"""Tables of an external database over JDBC. Addresses and credentials are always arguments."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition: tuple[str, Any, Any, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or a query.

    ``partition`` is ``(column, lower, upper, partitions)``: without it one task reads
    everything. The bounds only shape the partitions; rows outside them are read too.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = dict(properties or {}) | {"url": url, "fetchsize": str(fetch_size)}
    if partition:
        column, lower, upper, partitions = partition
        # A query cannot be partitioned by the reader, a derived table can.
        options["dbtable"] = table if table else f"({query}) AS source_rows"
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    elif table:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, **options) -> DataFrame:
    """A table, or with ``query=`` the result of SQL text, as a frame."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    column_types: str | None = None,
    batch_size: int = 10_000,
) -> dict[str, str]:
    """Writer options; ``column_types`` fixes the column types of a table created on write."""
    options = dict(properties or {}) | {
        "url": url, "dbtable": table, "batchsize": str(batch_size),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", connections: int | None = None, **options
) -> None:
    """Append (or write with ``mode``) a frame to a table, created if it is not there.

    Every partition writes over a connection of its own. ``connections`` deals the rows to
    that many tasks first, which leaves the work before it as wide as it is.
    """
    if connections:
        df = df.repartition(connections)
    df.write.format("jdbc").options(**write_options(url, table, **options)).mode(mode).save()


def foreach_batch_jdbc(
    url: str, table: str, epoch_column: str | None = "epoch_id", **options
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends every micro-batch to a table.

    A replayed micro-batch is appended again; ``epoch_column`` records its number so
    that readers can tell. None leaves the column out.
    """

    def append(batch: DataFrame, epoch_id: int) -> None:
        if epoch_column:
            batch = batch.withColumn(epoch_column, F.lit(epoch_id).cast("bigint"))
        write_jdbc(batch, url, table, **options)

    return append
