"""Broadcast a join side only behind a measured size bound.

Catalyst's static broadcast decision uses plan statistics, which for a derived
dimension (a ``distinct`` over a fact-sized scan) are the size of the scan, so
it plans a shuffle join. AQE converts that to a broadcast join only after both
sides have been shuffled -- by then the big side has been written through a
shuffle keyed on the (often low-cardinality) dimension key, which at scale is
both wasted I/O and a skew hazard.

``broadcast_if_small`` settles the question before the join is planned: the
candidate side is materialised once (a reliable checkpoint in the cluster's
checkpoint folder, so the lineage is cut and a lost executor does not redo
it), its rows and bytes are measured, and it is broadcast only when both are
within the bounds. Otherwise the checkpointed frame is returned as is and the
join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from stellate.session import ensure_checkpoint_dir

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

# In-memory width in bytes of fixed-size Spark types; anything
# else not listed (decimal, interval, nested) is counted as 16.
FIXED_WIDTH = {
    "boolean": 1,
    "byte": 1,
    "short": 2,
    "integer": 4,
    "long": 8,
    "float": 4,
    "double": 8,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one aggregate job.

    Bytes are the fixed-width sizes from the schema plus the real length of
    every string / binary value.
    """
    fixed = 0
    var = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)).cast("long"))
        else:
            fixed += FIXED_WIDTH.get(field.dataType.typeName(), 16)
    var_total = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    rows, var_bytes = df.agg(F.count(F.lit(1)), var_total).first()
    return int(rows), int(rows) * fixed + int(var_bytes or 0)


def measure_side(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_ROWS,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> tuple[DataFrame, bool]:
    """Checkpoint ``df`` and say whether it fits the broadcast bounds."""
    ensure_checkpoint_dir(df.sparkSession)
    frozen = df.checkpoint(eager=True)
    rows, size = measured_size(frozen)
    return frozen, rows <= max_rows and size <= max_bytes


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_ROWS,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Checkpoint ``df``; return it with a broadcast hint if it is within bounds.

    Rows that are part of the plan itself (a literal mapping) have a known
    size: they are neither written nor measured.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.nodeName() == "LocalRelation" and int(str(plan.stats().sizeInBytes())) <= max_bytes:
        return F.broadcast(df)
    frozen, fits = measure_side(df, max_rows, max_bytes)
    return F.broadcast(frozen) if fits else frozen
