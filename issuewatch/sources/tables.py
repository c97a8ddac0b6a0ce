"""Reading stored tables (driver parquet tables, warehouse tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one parquet table `<root>/<name>.parquet` (column pruning and filter
    pushdown happen in the scan)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
