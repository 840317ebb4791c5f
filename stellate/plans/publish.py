"""Publishing the mart: overwrite writes, read-back, SQL views over the written paths."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Published table names -> SQL view names.
MART_VIEWS = {
    "dim_payments": "vw_dim_payments",
    "dim_customer1": "vw_dim_customer1",
    "dim_calendar": "vw_dim_calendar",
    "fact": "vw_fact",
}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> str:
    """Write ``df`` to ``path`` (overwrite by default) and return the path.

    ``fmt`` is any data source Spark knows (``parquet``; ``delta`` when its
    package is on the classpath). Each write is one job over its own lineage.

    With ``partition_by`` the rows are first rebalanced on the partition
    columns (Spark's ``rebalance`` hint): each output directory is written by
    few tasks instead of every task writing a small file into every directory,
    and AQE splits a value holding a large share of the rows over several
    tasks rather than one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a written table (cuts the lineage: later plans start at the files)."""
    return spark.read.format(fmt).load(path)


def create_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet", temp: bool = True) -> None:
    """``CREATE OR REPLACE [TEMP] VIEW name AS SELECT * FROM fmt.`path```."""
    kind = "TEMP VIEW" if temp else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT * FROM {fmt}.`{path}`")


def sample_view(spark: SparkSession, view: str, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """``select * from view order by ... limit n`` (ordered so the sample is fixed)."""
    cols = ", ".join(order_by)
    return spark.sql(f"SELECT * FROM {view} ORDER BY {cols} LIMIT {int(n)}")


@dataclass(frozen=True)
class Published:
    """Paths and views of a published mart."""

    paths: dict[str, str]
    views: dict[str, str]


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    fmt: str = "parquet",
    temp_views: bool = True,
    partition_by: dict[str, Sequence[str]] | None = None,
) -> Published:
    """Write each table under ``root/<name>`` and put a view over each path.

    One path per table feeds both the write and its view, so a view can never
    point at a stale or misspelt location.
    """
    partition_by = partition_by or {}
    paths: dict[str, str] = {}
    views: dict[str, str] = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, fmt, partition_by=partition_by.get(name))
        paths[name] = path
        view = MART_VIEWS.get(name, f"vw_{name}")
        create_view(spark, view, path, fmt, temp=temp_views)
        views[name] = view
    return Published(paths, views)
