"""The shared folder for intermediate tables, stream checkpoints and outputs."""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where neither is set, a local session gets a temporary folder, with a warning, which goes
    when the process ends; on a cluster a machine-local folder would be lost with its
    machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_CONF} to a folder every executor can reach")
        own = tempfile.mkdtemp(prefix="transitloom-")
        logging.getLogger(__name__).warning("%s is not set; using %s", _CHECKPOINT_CONF, own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, fixes values that depend on partitioning, and survives the
    loss of executors.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a table made by ``materialize`` that no frame still to be computed reads."""
    spark, path = stored.sparkSession, stored._stored_at
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize_buckets(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Write ``df``, which lies in ``buckets`` partitions by ``column``, as a table of as many
    buckets in the shared folder: joins and groups by ``column`` read it where it is."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(table)
    stored = spark.table(table)
    stored._stored_at, stored._table = path, table
    return stored


def drop_buckets(stored: DataFrame) -> None:
    """Delete a table made by ``materialize_buckets`` that no frame still to be computed reads."""
    stored.sparkSession.sql(f"DROP TABLE {stored._table}")
    discard(stored)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or a glob) names something, on any Hadoop file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0
