"""Surrogate keys that stay when more data are loaded.

``dense_key`` numbers what it is given; a value that arrives later would move all
behind it. A ``KeyMap`` is a stored table of natural keys and their numbers, to
which a load only adds: values that it lacks are found by a null-safe anti-join
and numbered after the largest stored number, in the order of their columns. So
old numbers never change, and all numbers together are 1..N.

A load writes its new keys as a part of their own and then commits it (see
``sources.commits``); a part without a commit, left by a run that died, is not
read, and the next load numbers its values again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stellate.functions.keys import dense_key
from stellate.operators.broadcast import broadcast_if_small
from stellate.sources import commits

TABLE = "keys"


class KeyMap:
    """The keys of one dimension, stored below ``root`` (shared storage; one load at a time)."""

    def __init__(self, spark: SparkSession, root: str, cols: Sequence[str], name: str = "id"):
        self.spark, self.root, self.cols, self.name = spark, root.rstrip("/"), list(cols), name

    def read(self) -> DataFrame | None:
        """All committed keys; None before the first load."""
        parts = commits.entries(self.spark, self.root).select("version").distinct().collect()  # one row for each load
        paths = sorted(commits.table_path(self.root, TABLE, r["version"]) for r in parts)
        return self.spark.read.parquet(*paths) if paths else None

    def extend(self, values: DataFrame) -> DataFrame:
        """Give every value of ``values`` that has none a key; returns the whole map as stored."""
        known = self.read()
        fresh = values.select(*self.cols).distinct()
        largest = 0
        if known is not None:
            largest = known.agg(F.max(self.name)).first()[0] or 0
            held = broadcast_if_small(known.select(*[F.col(c).alias(f"_{c}") for c in self.cols]))
            same = reduce(lambda a, b: a & b, [fresh[c].eqNullSafe(held[f"_{c}"]) for c in self.cols])
            fresh = fresh.join(held, same, "left_anti")
        numbered = dense_key(fresh, self.cols, self.name).withColumn(self.name, F.col(self.name) + F.lit(largest))
        numbered = numbered.select(*self.cols, F.col(self.name).cast("long").alias(self.name))
        version = "v" + uuid.uuid4().hex
        numbered.write.parquet(commits.table_path(self.root, TABLE, version))
        schema = StructType([*[f for f in fresh.schema.fields], StructField(self.name, LongType())])
        commits.commit(self.spark, self.root, version, {TABLE: self.spark.createDataFrame([], schema)})
        return self.read()
