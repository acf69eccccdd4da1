"""Session defaults for transport jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job of this library is tuned for. Shuffle parallelism, memory
# and the checkpoint folder belong to the cluster and are not set here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` wins over them.

    In names without a dot ``_`` stands for one; a name with dots is taken as it is.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    named = {key if "." in key else key.replace("_", "."): value for key, value in conf.items()}
    settings = DEFAULTS | named
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
