"""Finding hot keys and joining around them.

A key may hold a large share of all rows. Hash partitioning would put all of it
in one task, so its rows are split over several salts on one side and matched
with replicas on the other. Which keys get salted only changes where rows are
processed, never which rows come out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.storage import materialize

# A key is hot when it holds this many rows, however many there are in all: about what one
# task of a shuffle should get. A caller may ask for a share of all rows besides.
HOT_ROWS = 1_000_000
HOT_SHARE = 0.0
# What a task gets of a shuffle whose number of tasks follows from counted rows.
TASK_ROWS = 250_000
# What a task makes of a join whose pairs were counted: a few rows may make very many.
TASK_PAIRS = 1_000_000
_BUCKETS = 4096
# A bitmap has this many bits for an id, but no more than 64 MB in all, and lies in rows of 4 KB.
_ID_BITS, _MOST_BITS, _PIECE_BITS = 16, 1 << 29, 1 << 15
# A table of narrow rows that is known to have no more than this many is broadcast. Of hot keys
# there is one per million rows at most.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of a frame as a stored table ``(*keys, count)``; false if there are none.
    ``rows`` are all rows of the frame that have a key, where they were counted."""

    table: DataFrame | None = None
    size: int = 0
    rows: int = field(default=0, compare=False)

    def __bool__(self) -> bool:
        return self.size > 0

    def joinable(self, table: DataFrame) -> DataFrame:
        """``table``, one row per hot key, marked for broadcast if there are few enough."""
        return F.broadcast(table) if self.size <= BROADCAST_ROWS else table


NO_KEYS = HotKeys()


def tasks_for(rows: int) -> int:
    """How many tasks a shuffle of so many rows should have, so that none holds more as they grow."""
    return max(1, -(-rows // TASK_ROWS))


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> HotKeys:
    """The keys with ``hot_rows`` rows or more (and at least ``hot_share`` of all).

    The first pass counts hash buckets (a fixed number of groups, combined before
    the shuffle). Only buckets heavy enough to hide a hot key are looked at again.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    present = df.select(*keys).dropna()
    sizes = present.groupBy(bucket.alias("bucket")).count().collect()
    rows = sum(row["count"] for row in sizes)
    threshold = max(hot_rows, hot_share * rows)
    heavy = [row["bucket"] for row in sizes if row["count"] >= threshold]
    if not heavy:
        return HotKeys(rows=rows)
    counted = present.where(bucket.isin(heavy)).groupBy(*keys).count()
    table = materialize(counted.where(F.col("count") >= threshold), "hot-keys")
    return HotKeys(table, table.count(), rows)


def count_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> int:
    """How many rows an inner join on ``keys`` has, from the rows of each key on either side."""
    counts = [
        side.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").cast("double").alias(name))
        for side, name in ((left, "_left"), (right, "_right"))
    ]
    pairs = counts[0].join(counts[1], list(keys)).agg(F.sum(F.col("_left") * F.col("_right")))
    return int(pairs.first()[0] or 0)


def spread(columns: Sequence[str], salts) -> F.Column:
    """A salt in ``[0, salts)`` from the row's content and its input partition.

    Copies of one row differ by partition, and a retried task gives the same salts.
    """
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), salts).cast("int")


def maybe_in(df: DataFrame, ids: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the ``size`` rows of ``ids``: all that are, and of
    the others about one in ``_ID_BITS``, more beyond ``_MOST_BITS`` in all.

    The hashes of ``ids`` are set in a bitmap, which is broadcast in pieces, so that most rows
    that a join by ``key`` would drop are not shuffled for it.
    """
    pieces = -(-min(_MOST_BITS, _ID_BITS * max(1, size)) // _PIECE_BITS)
    place = F.pmod(F.xxhash64(key), F.lit(pieces * _PIECE_BITS))
    # Bits of bytes in the order of bitmap_construct_agg.
    at = place % _PIECE_BITS
    set_bits = (
        ids.select(F.floor(place / _PIECE_BITS).alias("_piece"), at.alias("_at"))
        .groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    )
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1
    marked = df.withColumns({"_piece": F.floor(place / _PIECE_BITS), "_at": at})
    return marked.join(F.broadcast(set_bits), "_piece").where(is_set).select(*df.columns)


def _same(left: str, right: str, keys: Sequence[str]) -> F.Column:
    return reduce(
        lambda a, b: a & b, (F.col(f"{left}.{key}") == F.col(f"{right}.{key}") for key in keys)
    )


def _attach_salts(df, keys, hot, split_by, copy_by):
    """Add ``_split`` (own salt) and ``_copy`` (one replica per salt of the other side)."""
    names = df.columns
    marked = df.alias("data").join(hot.alias("hot"), _same("data", "hot", keys), "left")
    own = F.coalesce(F.col(f"hot.{split_by}"), F.lit(1))
    other = F.coalesce(F.col(f"hot.{copy_by}"), F.lit(1))
    return marked.select(
        *[F.col(f"data.`{name}`") for name in names],
        own.alias("_own"),
        F.explode(F.sequence(F.lit(0), other - 1)).alias("_copy"),
    ).select(
        *[F.col(f"`{name}`") for name in names],
        spread([f"`{name}`" for name in names], F.col("_own")).alias("_split"),
        "_copy",
    )


def _join(left, right, keys, how, tasks):
    if tasks:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.join(right, keys, how)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    unique_right: bool = False,
    left_hot: HotKeys | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Equi-join on ``keys`` (same names on both sides) with hot keys salted.

    An inner join may split both sides of a hot key. ``left``, ``left_semi`` and
    ``left_anti`` split the left side only, and need ``unique_right``: a right
    side with at most one row per key, which is then replicated for hot keys.

    Hot keys are looked for in frames as they are: a frame that is costly to compute
    should be stored first, or its hot keys passed as ``left_hot`` if known already.

    ``tasks``, if given, is the number of tasks that join: where a row has many partners, what
    goes in says little about the work.
    """
    if how != "inner" and not unique_right:
        raise ValueError(f"{how} join needs a right side with one row per key")
    if left_hot is None:
        left_hot = hot_keys(left, keys, hot_rows, hot_share)
    right_hot = NO_KEYS if unique_right else hot_keys(right, keys, hot_rows, hot_share)
    if not left_hot and not right_hot:
        return _join(left, right, list(keys), how, tasks)

    share = max(1, hot_rows // 4)

    def salts(hot: HotKeys, name: str) -> DataFrame:
        source = hot.table if hot else (left_hot or right_hot).table.limit(0)
        return source.select(*keys, F.ceil(F.col("count") / share).cast("int").alias(name))

    both = salts(left_hot, "left_salts").join(salts(right_hot, "right_salts"), [*keys], "full")
    listed = materialize(both.na.fill(1, subset=["left_salts", "right_salts"]), "salts")
    hot = HotKeys(listed, left_hot.size + right_hot.size).joinable(listed)
    salted_left = _attach_salts(left, keys, hot, "left_salts", "right_salts")
    salted_right = _attach_salts(right, keys, hot, "right_salts", "left_salts")
    # A pair of rows meets in the one cell (salt of left, salt of right).
    salted_left = salted_left.withColumnsRenamed({"_split": "_left_salt", "_copy": "_right_salt"})
    salted_right = salted_right.withColumnsRenamed({"_split": "_right_salt", "_copy": "_left_salt"})
    joined = _join(salted_left, salted_right, [*keys, "_left_salt", "_right_salt"], how, tasks)
    return joined.drop("_left_salt", "_right_salt")
