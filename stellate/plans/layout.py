"""Layouts of the published fact that let its readers skip files and row groups.

* By month: the fact carries ``purchase_month`` (yyyymm of the purchase) as its
  partition column. A query that joins it to a window of the calendar on the month
  and the date reads the folders of the window's months alone: Spark takes the
  months from the filtered calendar while the query runs (dynamic pruning).
* By key: rows are range-partitioned and sorted by a key, so a row group's minimum
  and maximum bound a narrow range, and other lookup keys get a Parquet bloom
  filter. An equality on either is pushed to the reader, which skips row groups
  that cannot hold the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators.broadcast import DEFAULT_MAX_ROWS
from stellate.plans.mart import calendar_between
from stellate.plans.publish import read_back, write_table

MONTH = "purchase_month"


def with_month(fact: DataFrame, ts_col: str = "order_purchase_timestamp") -> DataFrame:
    """The fact with the month of ``ts_col`` as yyyymm, to be partitioned by."""
    ts = F.col(ts_col)
    return fact.withColumn(MONTH, (F.year(ts) * 100 + F.month(ts)).cast("int"))


def write_by_month(fact: DataFrame, path: str, ts_col: str = "order_purchase_timestamp", fmt: str = "parquet") -> str:
    """Write the fact in one folder a month; a month with a large share of the rows is split over files."""
    return write_table(with_month(fact, ts_col), path, fmt, partition_by=[MONTH])


def in_calendar_window(
    fact: DataFrame, calendar: DataFrame, lo: int, hi: int, columns: Sequence[str] = ("date_key",),
    ts_col: str = "order_purchase_timestamp",
) -> DataFrame:
    """Rows of a fact stored by month in the calendar days ``lo`` to ``hi`` (date keys), with ``columns`` of the day.

    The window has at most one row a day between its keys, which bounds what is
    broadcast; beyond that bound the join is Spark's choice. ``calendar`` should
    be a stored table: its filter is what the months are pruned by.
    """
    days = calendar_between(calendar, lo, hi).select(
        F.col("date").alias("_date"), (F.col("year") * 100 + F.col("month")).cast("int").alias("_month"), *columns
    )
    if (hi // 10000 - lo // 10000 + 1) * 366 <= DEFAULT_MAX_ROWS:
        days = F.broadcast(days)
    same_day = (F.col(MONTH) == F.col("_month")) & (F.to_date(ts_col) == F.col("_date"))
    return fact.join(days, same_day).drop("_date", "_month", MONTH)


def write_clustered(
    df: DataFrame, path: str, key: str, bloom: Sequence[str] = (), distinct: int = 1_000_000,
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet clustered by ``key``, with bloom filters on ``bloom``; the scan of it.

    Ranges are cut on the key and then all other columns of plain types, so a
    key with many rows is spread over several files. ``distinct`` is the number
    of values a row group's filter is sized for.
    """
    plain = [f.name for f in df.schema.fields if f.name != key and f.dataType.typeName() not in ("map", "variant")]
    clustered = df.repartitionByRange(key, *plain).sortWithinPartitions(key)
    writer = clustered.write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
        # a dictionary would answer for small columns; large row groups fall back from it and need the filter
        writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return read_back(df.sparkSession, path)


def stored_calendar(spark: SparkSession, calendar: DataFrame, path: str) -> DataFrame:
    """The calendar written to ``path`` and scanned from there."""
    return read_back(spark, write_table(calendar, path))
