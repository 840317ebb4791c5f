"""Joining rows to a set of keys when some keys are hot.

The audits match full rows back to the keys an aggregate found (repeated
ids). If one key holds a large share of the rows -- a third, say -- a plain
shuffle join hands all of them to one task. Adaptive execution can split such
a partition only when both join inputs arrive through their own shuffle. Here
the key side comes straight out of an aggregate that is already partitioned
on the key, so that split never applies.

``join_to_keys`` removes the hazard:

1. The keys and their counts are materialised once and measured. Within the
   broadcast bound the keys are broadcast: the large side is not shuffled.
2. Otherwise hot keys are salted. A key is hot above ``hot_rows`` rows, or
   above the ``1 / max_hot_keys``-th part of all matched rows where that is
   more; so there are never more than ``max_hot_keys`` of them, without any
   being left out, and a hot key's share of a task stays in proportion to the
   input. A hot key of ``n`` rows gets ``ceil(n / threshold)`` salts. Each
   large-side row of a hot key takes the salt ``hash(row) mod salts``; the key
   side carries every salt of its key, so every row finds its match and the
   result is exact. Cold keys keep salt 0. The join on (key, salt) spreads a
   hot key over many tasks, and both inputs are ordinary shuffles, so AQE can
   split further.

The salt is a hash of the row, not a random draw, so a task re-run after a
lost executor routes each row exactly as the first attempt did. Exact copies
of one row therefore share a salt. That only matters in step 2, when the key
set is too big to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from stellate.operators.broadcast import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, measure_side

DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_MAX_HOT_KEYS = 10_000
SALT = "_stellate_salt"
SALTS = "_stellate_salts"


def join_to_keys(
    df: DataFrame,
    key_counts: DataFrame,
    keys: Sequence[str],
    how: str = "left_semi",
    count_col: str = "_n",
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
    spread_by: Sequence[str] | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Rows of ``df`` whose ``keys`` appear in ``key_counts`` (one row per key).

    ``key_counts`` holds the keys and, in ``count_col``, how many rows of
    ``df`` carry each key. ``how`` is ``left_semi`` or ``inner``; the key set
    has one row per key, so both give the same rows, and the output has
    exactly ``df``'s columns. NULL keys never match (join equality).
    ``spread_by`` names the columns the salt is a hash of (default: all, which
    makes the scan read all): a few that tell rows of one key apart.
    """
    keys = list(keys)
    if how not in ("left_semi", "inner"):
        raise ValueError(f"how must be 'left_semi' or 'inner', not {how!r}")
    frozen, fits = measure_side(key_counts.select(*keys, count_col), max_rows, max_bytes)
    key_set = frozen.select(*keys)
    if fits:
        return df.join(F.broadcast(key_set), keys, how).select(*df.columns)

    total = frozen.agg(F.sum(count_col)).first()[0] or 0
    threshold = max(hot_rows, -(-int(total) // max_hot_keys))
    hot = frozen.where(F.col(count_col) > threshold).select(
        *keys, F.ceil(F.col(count_col) / F.lit(threshold)).cast("int").alias(SALTS)
    )
    # fewer than max_hot_keys rows, by the threshold; broadcast if their bytes fit as well
    hot, narrow = measure_side(hot, max_hot_keys, max_bytes)
    hot = F.broadcast(hot) if narrow else hot

    # the salt must be a function of the row: a re-run task (lost executor)
    # has to send every row to the same reducer as the first attempt did
    hashed = spread_by or [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    row_hash = F.xxhash64(*[F.col(c) for c in hashed])
    salted_rows = df.join(hot, keys, "left").withColumn(
        SALT,
        F.when(F.col(SALTS).isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col(SALTS)).cast("int")),
    )
    salted_keys = key_set.join(hot, keys, "left").select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)).alias(SALT),
    )
    return salted_rows.join(salted_keys, keys + [SALT], how).select(*df.columns)
