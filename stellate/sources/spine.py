"""Date spine generator: one row per day between two bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import default_parallelism


def day_sequence(start: Column, end: Column) -> Column:
    """``sequence(start, end, interval 1 day)``; an empty array when end < start.

    Spark's ``sequence`` raises on a reversed range; a calendar whose end lies
    before its start simply has no rows.
    """
    return F.when(
        end >= start, F.sequence(start, end, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


SPINE_TASKS = 64


def month_sequence(start: Column, end: Column) -> Column:
    """First days of every month touching [start, end]; empty when end < start."""
    return F.when(
        end >= start,
        F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")),
    ).otherwise(F.array().cast("array<date>"))


def spine_from_bounds(
    bounds: DataFrame, start: str, end: str, name: str = "calendarDate", keep: list[str] | None = None,
    max_tasks: int = SPINE_TASKS,
) -> DataFrame:
    """Explode a frame of (start, end) bounds into one row per day, inclusive.

    ``bounds`` normally holds one row (an aggregate over the data); ``keep``
    lists other columns of that row to carry along (for instance an as-of
    date). The spine's length is the number of days in the range, not a
    function of the data volume.

    Generation is spread out: the range is first cut into one row per month,
    the months are dealt round-robin over up to ``max_tasks`` tasks
    (the cluster's default parallelism when smaller), and each task expands
    its own months into days. No task builds the whole range.
    """
    keep = keep or []
    s, e = F.col(start), F.col(end)
    months = bounds.select(F.explode(month_sequence(s, e)).alias("_month"), start, end, *keep)
    # a calendar has at most a few hundred months: spread them, but never over
    # thousands of mostly empty tasks on a large cluster
    months = months.repartition(max(1, min(max_tasks, default_parallelism(bounds.sparkSession))))
    first = F.greatest(F.col("_month"), s)
    last = F.least(F.last_day(F.col("_month")), e)
    return months.select(F.explode(day_sequence(first, last)).alias(name), *keep)


def date_spine(spark: SparkSession, start: str, end: str, name: str = "calendarDate") -> DataFrame:
    """Fixed-date spine, both ends inclusive (``to_date`` of ISO strings)."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(start)).alias("_start"), F.to_date(F.lit(end)).alias("_end")
    )
    return spine_from_bounds(bounds, "_start", "_end", name)


def date_range_of(df: DataFrame, col: str, start: str = "_start", end: str = "_end") -> DataFrame:
    """One-row frame with the first and last date of a timestamp/date column.

    A partial + final aggregate: every task reduces its split to two values,
    so it scales with the scan, not with the number of groups.
    """
    d = F.to_date(F.col(col))
    return df.agg(F.min(d).alias(start), F.max(d).alias(end))


def data_spine(df: DataFrame, col: str, name: str = "calendarDate") -> DataFrame:
    """Spine covering every day from the first to the last date in ``col``."""
    return spine_from_bounds(date_range_of(df, col), "_start", "_end", name)
