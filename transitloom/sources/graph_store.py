"""A stored graph that takes batches: nodes and edges in hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from transitloom.operators.skew import tasks_for
from transitloom.storage import discard, materialize, path_exists
from transitloom.streaming.sinks import BatchWriter

BUCKETS = 256
_BATCH = StructField("batch", LongType())


class StoredNodes:
    """Nodes of one kind in a folder, one row a ``key``, clustered by a hash of it.

    ``apply`` merges a numbered batch. Only buckets that the batch has keys for are read and
    written anew; files of the others stay as they are. A node keeps the number of the batch its
    properties come from, and only an equal or later one may set them: applying a batch again,
    or an earlier one after it, changes nothing, so a writer that fails half-way is simply run
    again. One writer at a time.
    """

    def __init__(self, path: str, schema: StructType, key: str, buckets: int = BUCKETS):
        self.path, self.key, self.buckets = path, key, buckets
        self.schema = StructType([field for field in schema if field.name != "batch"])

    def read(self, spark: SparkSession, bucket_numbers: Sequence[int] | None = None) -> DataFrame:
        """The nodes with the number of their ``batch``; of some buckets only, if given."""
        whole = StructType([*self.schema.fields, _BATCH])
        stored = StructType([*whole.fields, StructField("bucket", LongType())])
        if not path_exists(spark, f"{self.path}/bucket=*"):
            return spark.createDataFrame([], whole)
        rows = spark.read.schema(stored).parquet(self.path)
        if bucket_numbers is not None:
            rows = rows.where(F.col("bucket").isin(list(bucket_numbers)))
        return rows.select(*whole.names)

    def apply(self, incoming: DataFrame, batch: int, order: Sequence[str] = ()) -> int:
        """Merge a batch; returns how many buckets were rewritten.

        Of several rows for a key the last by ``order`` counts, which should single it out, and
        sets all properties. Rows without key are left out.
        """
        spark = incoming.sparkSession
        names = [field.name for field in self.schema if field.name != self.key]
        recency = F.struct(*[F.col(name).alias(f"o{at}") for at, name in enumerate([*order, *names])])
        newest = (
            incoming.where(F.col(self.key).isNotNull())
            .groupBy(self.key)
            .agg(F.max_by(F.struct(*names), recency).alias("state"))
            .select(
                *[(F.col(self.key) if f.name == self.key else F.col(f"state.{f.name}")).cast(f.dataType).alias(f.name)
                  for f in self.schema],
                F.lit(batch).cast("bigint").alias("batch"),
            )
        )
        return _rewrite(self, spark, newest, [self.key], F.max_by)


class StoredEdges:
    """Edges ``src, dst, relation`` in a folder, each once, clustered by a hash of all three, so
    that a node with very many edges fills no bucket. ``apply`` as for ``StoredNodes``; ``batch``
    is the first one that brought the edge."""

    _FIELDS = ("src", "dst", "relation")

    def __init__(self, path: str, schema: StructType, buckets: int = BUCKETS):
        self.path, self.buckets = path, buckets
        self.schema = StructType([schema[name] for name in self._FIELDS])

    read = StoredNodes.read

    def apply(self, incoming: DataFrame, batch: int) -> int:
        fresh = incoming.select(*self._FIELDS).dropna().distinct()
        fresh = fresh.withColumn("batch", F.lit(batch).cast("bigint"))
        return _rewrite(self, incoming.sparkSession, fresh, list(self._FIELDS), F.min_by)


def _rewrite(store, spark: SparkSession, fresh: DataFrame, keys: list[str], choose) -> int:
    """Merge ``fresh`` into the buckets it touches, the row of the ``choose``-n batch per key."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(store.buckets)).alias("bucket")
    fresh = materialize(fresh, "incoming")
    touched = sorted(row["bucket"] for row in fresh.select(bucket).distinct().collect())
    if not touched:
        discard(fresh)
        return 0
    held = store.read(spark, touched).unionByName(fresh)
    names = held.columns
    whole = F.struct(*[name for name in names if name not in keys])
    # A large bucket is several tasks' work, and several files.
    pieces = -(-tasks_for(held.count()) // len(touched))
    piece = F.pmod(F.xxhash64(F.lit("piece"), *keys), F.lit(pieces)).alias("piece")
    dealt = held.select("*", bucket, piece).repartition(len(touched) * pieces, "bucket", "piece")
    merged = dealt.groupBy("bucket", "piece", *keys).agg(choose(whole, "batch").alias("state"))
    # Spark writes apart and puts the buckets in place when all are written: a failure before
    # that leaves them alone, and doing it again gives the same buckets.
    (
        merged.select("bucket", *keys, "state.*").select(*names, "bucket")
        .sortWithinPartitions("bucket", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(store.path)
    )
    discard(fresh)
    return len(touched)


def node_writer(store: StoredNodes, order: Sequence[str] = ()) -> BatchWriter:
    """Merge each micro-batch of a stream by its number, so that a replayed one changes nothing.

    The store belongs to one checkpoint: with another one the numbers start over.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        store.apply(batch, epoch_id, order)

    return write


def edge_writer(store: StoredEdges) -> BatchWriter:
    """The same for edges."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        store.apply(batch, epoch_id)

    return write
