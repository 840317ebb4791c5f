"""Dimension helpers: distinct dimensions with surrogate keys, translation joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stellate.functions.keys import dense_key
from stellate.operators.broadcast import broadcast_if_small


def distinct_dim(
    df: DataFrame,
    cols: Sequence[str],
    surrogate: str | None = None,
) -> DataFrame:
    """``select distinct cols``; with ``surrogate``, add a stable key 1..N in column order.

    The distinct is a partial + final hash aggregate; the surrogate key is
    ``dense_key`` (range partitioned, no single-task window), so the same
    input always yields the same keys.
    """
    dim = df.select(*cols).distinct()
    if surrogate:
        dim = dense_key(dim, list(cols), surrogate)
    return dim


def translate(
    df: DataFrame,
    mapping: DataFrame,
    on: str,
    out: str,
    keep: Sequence[str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Replace ``df[on]`` by ``mapping[out]`` via a left join (unmatched -> NULL).

    The original column is not kept. Output columns: ``key`` (if given),
    ``out``, then ``keep``. The mapping is a lookup table: it is measured and,
    within the bound, broadcast, so the translated table is never shuffled on
    its (low-cardinality) category column; a mapping beyond the bound stays a
    shuffle join.
    """
    keep = list(keep or [c for c in df.columns if c not in (on, key)])
    m = broadcast_if_small(mapping.select(on, out))
    joined = df.join(m, on, "left")
    head = [key] if key else []
    return joined.select(*head, out, *keep)
