"""Data-quality audits: counts, duplicate keys and rows, uniqueness, profiles, lookups.

All of them are aggregations or joins Catalyst plans with partial (map-side)
aggregation, so a hot key costs one pre-aggregated row per task before the
shuffle, never a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.order import ordered
from stellate.operators.skew import join_to_keys


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """``count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, cols: str | Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Number of distinct values of ``cols``, with NULL counted as one value.

    This is ``select distinct ... `` then ``count()``: unlike
    ``count(distinct x)``, a NULL key is a value of its own. Planned as two
    aggregations (distinct per key, then count) so no single task holds the
    set of values.
    """
    return row_count(df.select(*_cols(cols)).distinct(), name)


def duplicate_keys(
    df: DataFrame,
    keys: str | Sequence[str],
    count_col: str = "count",
    min_count: int = 2,
) -> DataFrame:
    """Key values occurring at least ``min_count`` times, with their count.

    ``group by keys having count(*) >= min_count``. NULL keys are grouped
    together as one key.
    """
    return (
        df.groupBy(*_cols(keys))
        .agg(F.count(F.lit(1)).alias(count_col))
        .where(F.col(count_col) >= min_count)
    )


def duplicate_key_values(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Only the repeated key values (the derived-table form, no count column)."""
    keys = _cols(keys)
    return duplicate_keys(df, keys).select(*keys)


def duplicate_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    how: str = "semi",
    order_by: Sequence[str] | None = None,
    **skew_options,
) -> DataFrame:
    """Every full row whose key value occurs more than once.

    The repeated keys and their counts come from a partially aggregated
    ``group by``; the rows are matched back with ``join_to_keys``.
    ``how='semi'`` is the ``where key in (subquery)`` form (left semi join),
    ``how='join'`` the inner join to the derived table; both drop NULL keys
    because equality never holds for NULL. The key set is broadcast when it
    fits; otherwise hot keys are salted over several tasks (see
    ``stellate.operators.skew``), so no task receives a whole hot key.
    ``skew_options`` pass through to ``join_to_keys``.

    ``order_by`` sorts the result (a global range sort, see
    ``operators.order.ordered``: rows equal in every sort key are still spread
    over several range partitions).
    """
    keys = _cols(keys)
    if how not in ("semi", "join"):
        raise ValueError(f"how must be 'semi' or 'join', not {how!r}")
    counts = duplicate_keys(df, keys, count_col="_n")
    out = join_to_keys(df, counts, keys, "left_semi" if how == "semi" else "inner", **skew_options)
    if order_by:
        out = ordered(out, order_by)
    return out


def full_row_duplicates(df: DataFrame, count_col: str = "c", min_count: int = 2) -> DataFrame:
    """Whole rows that occur at least ``min_count`` times, each once with its count.

    ``select *, count(*) c ... group by <every column> having c > 1``.
    """
    return duplicate_keys(df, df.columns, count_col=count_col, min_count=min_count)


def distinct_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    value: str,
    count_col: str = "c",
    min_count: int = 2,
) -> DataFrame:
    """Groups with at least ``min_count`` distinct non-NULL values of ``value``.

    ``count(distinct value) ... having c > 1``. Planned by Catalyst as a
    distinct on (group, value) followed by a count per group, both partial
    aggregations.
    """
    return (
        df.groupBy(*_cols(group))
        .agg(F.countDistinct(value).alias(count_col))
        .where(F.col(count_col) >= min_count)
    )


def wide_row_duplicates(df: DataFrame, count_col: str = "c", min_count: int = 2, **skew_options) -> DataFrame:
    """``full_row_duplicates`` for wide rows of which few repeat: only candidates are shuffled whole.

    A 128-bit fingerprint of each row is counted first, which moves 24 bytes a
    row. Rows whose fingerprint is seen ``min_count`` times are matched back
    (``join_to_keys``: by broadcast within the bound, else with hot fingerprints
    salted) and grouped by all their columns, so a collision of fingerprints
    costs a needless candidate and never a wrong group.
    """
    marks = ["_f1", "_f2"]
    cols = [F.col(c) for c in df.columns]
    marked = df.select(*cols, F.xxhash64(*cols).alias("_f1"), F.xxhash64(F.lit(40503), *reversed(cols)).alias("_f2"))
    seen = duplicate_keys(marked.select(*marks), marks, count_col="_n", min_count=min_count)
    candidates = join_to_keys(marked, seen, marks, "left_semi", **skew_options).select(*df.columns)
    return full_row_duplicates(candidates, count_col, min_count)


def key_audit(df: DataFrame, checks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Uniqueness of several key lists in one scan and one shuffle.

    One row per check: ``rows``, ``keys`` (distinct key values), ``repeated``
    (those that occur more than once) and ``largest`` (most rows of one key).
    All lists are grouping sets of one aggregation: a row is counted once for
    each list before the shuffle, and the counts are then summed up by list. A
    NULL key is a value like any other. Over an empty frame all counts are 0.
    """
    cols = list(dict.fromkeys(c for keys in checks.values() for c in keys))
    # a set's grouping id has a bit for each column that is not in it, the first column's the highest
    names: dict[int, list[str]] = {}
    for name, keys in checks.items():
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
        names.setdefault(bits, []).append(name)
    sets = [[c for i, c in enumerate(cols) if not bits >> (len(cols) - 1 - i) & 1] for bits in names]
    counted = df.select(*cols).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
    )
    summed = counted.groupBy("_set").agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_n") > 1).alias("repeated"),
        F.max("_n").alias("largest"),
    )
    # one row for each check, whatever the data
    listed = df.sparkSession.createDataFrame([(n, b) for b, ns in names.items() for n in ns], "check string, _set bigint")
    found = listed.join(F.broadcast(summed), "_set", "left")
    return found.select("check", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "keys", "repeated", "largest")])


def min_max_profile(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """One-row profile: ``{alias: aggregate expression}``, e.g. min/max of dates."""
    return df.agg(*[expr.alias(alias) for alias, expr in spec.items()])


def date_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min and max of each column, named ``min_<col>`` / ``max_<col>``."""
    spec: dict[str, Column] = {}
    for c in cols:
        spec[f"min_{c}"] = F.min(c)
        spec[f"max_{c}"] = F.max(c)
    return min_max_profile(df, spec)


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Rows where every named column equals the given value.

    Equality predicates on scan columns reach the Parquet reader as pushed
    filters, so row groups whose min/max exclude the value are skipped.
    """
    cond = F.lit(True)
    for col, value in equals.items():
        cond = cond & (F.col(col) == F.lit(value))
    return df.where(cond)
