"""Global sorts that split a hot sort key over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def ordered(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """``df.orderBy(*cols)`` with a hash of the whole row as the last key.

    A global sort range-partitions on its keys, and rows equal in every key
    can only go to one partition. If one key value is a large share of the
    data, one task would sort all of those rows. The row hash lets the range
    partitioner split them by their other columns. Rows equal in ``cols`` have
    no defined order anyway, so the result is still ordered by ``cols``.

    The extra key is deterministic (``xxhash64`` of the columns), so a
    re-run task after a lost executor routes every row as before. Exact copies
    of one row hash alike and stay in one partition.
    """
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    if not hashable:
        return df.orderBy(*cols)
    return df.orderBy(*cols, F.xxhash64(*hashable))
