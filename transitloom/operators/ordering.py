"""Global order without a single-task sort: ranks, batches, neighbours, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitloom.operators.skew import NO_KEYS, HotKeys
from transitloom.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_rank(df: DataFrame, order: Sequence[str], rank: str = "rank") -> DataFrame:
    """Add the 0-based position of each row in the total order of ``order``.

    Rows are range-partitioned and sorted within partitions; the position inside a
    partition is written down with the rows, and the per-partition row counts (one
    number per partition) become offsets. Rows of equal ``order`` follow each other by a
    hash of their content and input partition, so that a frequent value can be cut into
    several ranges; which of them comes first is settled once, when the rows are stored.
    All columns of ``df`` are stored on the way, so it should have no others than needed.
    """
    tied = df.withColumn("_tie", F.xxhash64(*df.columns, F.spark_partition_id()))
    sorted_rows = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    staged = materialize(
        sorted_rows.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright(F.col("_place"), _ROW_BITS)
    sizes = staged.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for size in sizes:
        starts.append((size["part"], total))
        total += size["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    within = F.col("_place") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_start") + within)
        .drop("_part", "_start", "_place")
    )


def batch_id(df: DataFrame, order: Sequence[str], size: int = 1000) -> DataFrame:
    """Number disjoint consecutive batches of ``size`` rows in the order of ``order``."""
    ranked = with_rank(df, order, "_rank")
    return ranked.withColumn("batch_id", F.floor(F.col("_rank") / size)).drop("_rank")


def first_rows(df: DataFrame, order: Sequence[str], size: int = 1000) -> DataFrame:
    """The first ``size`` rows of the order (kept as a bounded heap per task)."""
    return df.orderBy(*order).limit(size)


def next_in_group(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    value: str,
    alias: str,
    hot: HotKeys = NO_KEYS,
    tasks: int | None = None,
) -> DataFrame:
    """Add ``value`` of the following row of the same ``group``; NULL for the last row.

    Ordinary groups use a window, dealt to ``tasks`` if given. A group in ``hot`` would be one
    task there, so its rows are ranked globally and each is joined with the one ranked right
    after it.
    """
    window = Window.partitionBy(group).orderBy(*order)

    def followed(rows):
        dealt = rows.repartition(tasks, group) if tasks else rows
        return dealt.withColumn(alias, F.lead(value).over(window))

    if not hot:
        return followed(df)

    listed = hot.joinable(hot.table.select(group))
    ordinary = followed(df.join(listed, group, "left_anti"))
    ranked = with_rank(df.join(listed, group, "left_semi"), [group, *order], "_rank")
    following = ranked.select(
        F.col(group), (F.col("_rank") - 1).alias("_rank"), F.col(value).alias(alias)
    )
    return ordinary.unionByName(ranked.join(following, [group, "_rank"], "left").drop("_rank"))
