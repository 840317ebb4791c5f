"""Audits and dimension operators (DataFrame -> DataFrame)."""

from stellate.operators.dims import distinct_dim, translate
from stellate.operators.quality import (
    date_profile,
    distinct_count,
    distinct_per_group,
    duplicate_key_values,
    duplicate_keys,
    duplicate_rows,
    full_row_duplicates,
    lookup,
    min_max_profile,
    row_count,
)

__all__ = [
    "date_profile",
    "distinct_count",
    "distinct_dim",
    "distinct_per_group",
    "duplicate_key_values",
    "duplicate_keys",
    "duplicate_rows",
    "full_row_duplicates",
    "lookup",
    "min_max_profile",
    "row_count",
    "translate",
]

from stellate.operators.broadcast import broadcast_if_small, measured_size  # noqa: E402

__all__ += ["broadcast_if_small", "measured_size"]

from stellate.operators.order import ordered  # noqa: E402
from stellate.operators.skew import join_to_keys  # noqa: E402

__all__ += ["join_to_keys", "ordered"]
