"""Parquet scans of the raw tables (one path -> one DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Scan one Parquet path; the schema comes from the file footer.

    Nothing is read here: Catalyst prunes columns and pushes filters into the
    scan once the final plan is known.
    """
    return spark.read.parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan ``{root}/{name}.parquet``."""
    return read_parquet(spark, f"{root.rstrip('/')}/{name}.parquet")
