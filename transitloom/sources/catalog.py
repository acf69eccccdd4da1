"""Views and tables known to the session by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from transitloom.schemas import PREDICTIONS

PROCESSED_VIEW = "processed_transport_data"


def register_view(df: DataFrame, name: str = PROCESSED_VIEW) -> None:
    """Make a frame readable by name in its session."""
    df.createOrReplaceTempView(name)


def read_view(spark: SparkSession, name: str = PROCESSED_VIEW) -> DataFrame:
    """Everything a view or table holds."""
    return spark.sql(f"SELECT * FROM {name}")


def ensure_table(
    spark: SparkSession, name: str, schema: StructType = PREDICTIONS, location: str | None = None
) -> None:
    """Create a table with fixed columns unless it is there already."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to a table by column name."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)
