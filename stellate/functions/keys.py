"""Stable surrogate keys.

``monotonically_increasing_id()`` depends on the partition layout, is not
dense, and is recomputed on every evaluation of a lazy plan, so a dimension
written once and a fact joined later can disagree on it. ``dense_key`` numbers
the distinct rows 1..N in the order of chosen columns: the same data always
gets the same keys, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from stellate.session import ensure_checkpoint_dir


def _sort_cols(cols: list[str]) -> list[Column]:
    # Ascending with NULLs first, as ORDER BY does by default in Spark SQL.
    return [F.col(c).asc_nulls_first() for c in cols]


def _tie_breakers(df: DataFrame, order_by: list[str]) -> list[str]:
    """The other orderable columns, appended to the order so ties are split."""
    return [
        f.name for f in df.schema.fields
        if f.name not in order_by and not isinstance(f.dataType, MapType)
    ]


def dense_key(df: DataFrame, order_by: list[str], name: str = "id") -> DataFrame:
    """Add ``name`` = 1..N following ``order_by``, ties broken by the other columns.

    Works like ``row_number() over (order by ...)`` but without pulling every
    row into one task:

    1. range-partition on the order columns and sort inside each partition
       (one shuffle, spread over all executors; AQE may merge small ranges,
       which keeps the order);
    2. count rows per partition -- one row per partition, so the running
       offsets form a table whose size is bounded by the partition count,
       which is what gets broadcast;
    3. key = offset of the partition + position inside it, read off
       ``monotonically_increasing_id`` (consecutive within a partition).

    The counts and the keyed rows must see the same partitions, so the ranged
    and numbered frame is checkpointed once (to the shared checkpoint folder)
    and both read it: whatever plan the result becomes part of, neither
    adaptive merging nor a second sampling of range bounds can tell them
    apart, and columns that have no order (maps) are carried along. Ordering
    on the remaining columns after ``order_by`` makes ties deterministic and
    lets the range partitioner split a key shared by many rows over several
    tasks. Meant for distinct rows (dimensions); exact copies of one row stay
    together in one range partition.
    """
    mid = "_stellate_mid"
    pid = "_stellate_pid"
    order = _sort_cols(list(order_by) + _tie_breakers(df, list(order_by)))
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(mid, F.monotonically_increasing_id())
        .withColumn(pid, F.shiftright(F.col(mid), 33))
    )
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        pid, (F.sum("_n").over(before) - F.col("_n")).alias("_offset")
    )
    local = F.col(mid) - F.shiftleft(F.col(pid), 33)
    keyed = ranged.join(F.broadcast(offsets), pid).withColumn(name, (F.col("_offset") + local + 1).cast("bigint"))
    # columns of its own: a fact built from the keyed frame may be joined to it again
    return keyed.drop(mid, pid, "_offset").toDF(*df.columns, name)


def hash_key(*cols: str) -> Column:
    """A stable, order-free 64-bit key from natural key columns (xxhash64).

    For very large dimensions where a dense numbering is not needed; the same
    natural key always maps to the same value without any shuffle.
    """
    return F.xxhash64(*[F.col(c) for c in cols])
