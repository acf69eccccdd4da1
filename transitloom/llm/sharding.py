"""Sharding by extendible hashing: only buckets above the byte limit split on another bit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm.frames import column, packed
from transitloom.operators.ordering import with_rank
from transitloom.storage import materialize

HASH_BITS = 60
_BITS_AT_ONCE = 4


def hash_bits(*values: Column) -> Column:
    """60 bits of the MD5 of the values, as a number; null counts as a text of its own."""
    parts = [F.coalesce(value.cast("string"), F.lit("\u0000null")) for value in values]
    digest = F.md5(F.concat_ws("\u0000", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def start_depth(total: int, limit: int) -> int:
    """Bits of the first directory: as many doublings of the limit as the total holds."""
    depth = 0
    while depth < HASH_BITS and limit << (depth + 1) <= total:
        depth += 1
    return depth


def _cell(depth: int) -> Column:
    return F.shiftright("bits", HASH_BITS - depth).alias("cell")


def shard_directory(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The directory: per step its number of bits and a stored table ``cell, depth, full``.

    ``sizes`` has ``bits`` and ``size`` per row. A cell is a prefix of the step's number of
    bits; ``depth`` is the length of the shortest prefix whose bucket fits the limit, null
    while the bucket has to split further. A bucket of one single hash cannot split: it is a
    leaf, ``full`` if above the limit. A step adds up only the rows of buckets still open.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    base = start_depth(total, limit)
    steps: list[tuple[int, DataFrame]] = []
    rest = sizes.select("bits", "size")
    while True:
        fine = min(HASH_BITS, base + _BITS_AT_ONCE)
        cells = rest.groupBy(_cell(fine)).agg(
            F.sum("size").alias("size"), F.min("bits").alias("low"), F.max("bits").alias("high")
        )
        prefixes = materialize(cells, "cells").select(
            "*", F.explode(F.sequence(F.lit(base), F.lit(fine))).alias("depth")
        ).withColumn("prefix", F.expr(f"shiftright(cell, {fine} - depth)"))
        buckets = prefixes.groupBy("depth", "prefix").agg(
            F.sum("size").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
        )
        leaves = buckets.where((F.col("bytes") <= limit) | (F.col("low") == F.col("high"))).select(
            "depth", "prefix", (F.col("bytes") > limit).alias("full")
        )
        found = F.when(F.col("full").isNotNull(), F.col("depth"))
        directory = materialize(
            prefixes.select("cell", "depth", "prefix")
            .join(leaves, ["depth", "prefix"], "left")
            .groupBy("cell")
            .agg(F.min(found).alias("depth"), F.min_by("full", found).alias("full")),
            "directory",
        )
        steps.append((fine, directory))
        still = directory.where("depth is null").select("cell")
        if fine == HASH_BITS or still.isEmpty():
            return steps
        rest = rest.withColumn("cell", _cell(fine)).join(still, "cell").drop("cell")
        base = fine + 1


def _leaves_by_cell(steps: list[tuple[int, DataFrame]]) -> DataFrame:
    """``cell, leaves``: per cell of the first step its leaves ``depth, prefix, full``.

    A cell that fits lies in one leaf. One that split further has a leaf per bucket of at
    least half a limit or of its sibling, few as hashes spread evenly; rows of one hash are
    one leaf however many they are.
    """
    first = steps[0][0]
    found = [
        directory.where("depth is not null").select(
            F.shiftright("cell", fine - first).alias("cell"),
            "depth",
            F.expr(f"shiftright(cell, {fine} - depth)").alias("prefix"),
            "full",
        )
        for fine, directory in steps
    ]
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("cell")
        .agg(F.collect_set(F.struct("depth", "prefix", "full")).alias("leaves"))
    )


def shard(
    documents: DataFrame,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_bytes: int = 32,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the document's columns, or those in ``carry``), ``shard``, ``size``.

    A row counts its text's bytes and ``row_bytes`` for the rest. ``shard`` is ``b`` and the
    prefix of the hash of id and text that names the bucket. Rows of one single hash above
    the limit (the same row, repeated) cannot be told apart by bits: they are numbered over
    all tasks and cut into overflow shards ``-0``, ``-1``, ... of as many rows as fit. Only a
    single row above the limit makes a shard that does not fit.

    * A null text has no bytes; null ids and texts are hashed as such.
    * Repeated rows share a bucket, or its overflow shards.
    * An empty table gives no rows; other columns ride along untouched.
    """
    size = F.coalesce(F.octet_length(column(text_col)), F.lit(0)) + row_bytes
    rows = packed(
        documents,
        carry,
        bits=hash_bits(column(id_col), column(text_col)),
        size=size.cast("bigint"),
    )
    steps = shard_directory(materialize(rows.select("bits", "size"), "sizes"), limit)
    leaves = materialize(_leaves_by_cell(steps), "leaves")
    # One join, whatever the number of steps: the texts are moved by it once at most.
    leaf = F.filter(
        "leaves",
        lambda one: F.call_function("shiftright", F.col("bits"), HASH_BITS - one["depth"])
        == one["prefix"],
    )
    named = (
        rows.select("row", "size", "bits", _cell(steps[0][0]))
        .join(leaves, "cell", "left")
        .select("row", "size", F.explode(leaf).alias("leaf"))
        .select("row", "size", "leaf.*")
    )
    label = F.concat(F.lit("b"), F.expr("lpad(bin(prefix), depth, '0')"))
    named = named.withColumn("shard", label)
    plain = named.where(~F.col("full")).select("row", "shard", "size")
    if leaves.where(F.exists("leaves", lambda one: one["full"])).isEmpty():
        return plain
    return plain.unionByName(_overflow(named.where("full").select("row", "shard", "size"), limit))


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    ranked = materialize(with_rank(rows, ["shard"], "rank"), "overflow")
    first = ranked.groupBy("shard").agg(
        F.min("rank").alias("first"), F.max("size").alias("largest")
    )
    first = materialize(first, "overflow-starts")
    fitting = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("largest")))
    piece = F.floor((F.col("rank") - F.col("first")) / fitting).cast("string")
    return ranked.join(first, "shard").select(
        "row", F.concat("shard", F.lit("-"), piece).alias("shard"), "size"
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of files per shard, from rows brought together by shard.

    Takes what ``shard`` returns: every row has a shard, so nulls, repeated rows and equal texts
    lie where that put them. The rows' columns become those of the files; one that is itself
    named ``shard`` is written as ``row_shard``. An empty table makes a folder without shards.
    """
    names = sharded.schema["row"].dataType.names
    columns = [column("row")[name].alias("row_shard" if name == "shard" else name) for name in names]
    sharded.select("shard", *columns).repartition("shard").write.partitionBy("shard").parquet(path)
