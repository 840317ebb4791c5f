"""End-to-end mart build: dimensions, calendar and fact, written and published."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from stellate.operators.keymap import KeyMap
from stellate.plans import mart
from stellate.plans.publish import MART_VIEWS, Published, create_view, read_back, write_table
from stellate.sources import commits
from stellate.sources.marketplace import Marketplace

# File formats whose partition folders Spark reads.
LOGGED_FORMATS = ("parquet", "orc")


@dataclass(frozen=True)
class CalendarWindow:
    """The calendar a mart publishes: its days from ``first_key`` to ``last_key`` (yyyyMMdd, inclusive).

    The calendar starts at ``start`` and its rolling flags are relative to
    ``as_of`` (default: the run date); ``load_ts`` (default: now) is its load date.
    """

    start: str = "2016-01-01"
    first_key: int = 20160101
    last_key: int = 20191231
    as_of: str | None = None
    load_ts: str | None = None


def build_mart(
    spark: SparkSession,
    mp: Marketplace,
    root: str,
    fmt: str = "parquet",
    months_ahead: int = 60,
    temp_views: bool = True,
    version: str | None = None,
    view_names: dict[str, str] | None = None,
    partition_by: dict[str, list[str]] | None = None,
    calendar: CalendarWindow | None = None,
    key_root: str | None = None,
) -> Published:
    """Build and publish the four mart tables under ``root``.

    Order matters for correctness at scale: ``dim_payments`` is written first
    and the fact joins the *written* table, so ``type_id`` in the fact is the
    key that was published (no second evaluation of the key assignment).

    The tables go to ``root/<table>/_v=<version>`` (default: a new run id). When
    all four are written, one entry in the commit log (``sources.commits``) makes
    them the current ones; the views read through the log's last entry, so they
    change together, a failed or half-finished run never replaces what their
    readers see, and re-running the same version is idempotent. Formats that
    Spark reads without partition folders (delta) get views on the version's
    paths. An empty version overwrites the tables in place at ``root/<table>``.

    ``key_root`` names a folder where the payment types' keys are kept over runs
    (``operators.keymap``): a type that appears later then gets the next number
    and no other changes. Without it the keys are numbered anew in each run.

    ``calendar`` fixes the calendar's bounds; without it the calendar covers
    the whole years of the orders, as of the last order.

    ``view_names`` renames the views ({table: view}); missing tables keep the
    default names of ``MART_VIEWS``. With ``temp_views=False`` they are
    persistent views in the current database (``USE <db>`` first).

    ``partition_by`` ({table: [columns]}) writes a table partitioned on some
    of its columns (e.g. the fact on ``order_status``), rebalanced first.
    """
    names = {**MART_VIEWS, **(view_names or {})}
    parts = partition_by or {}
    root = root.rstrip("/")
    version = commits.folder_name(uuid.uuid4().hex if version is None else version)
    suffix = f"/_v={version}" if version else ""
    paths = {name: f"{root}/{name}{suffix}" for name in MART_VIEWS}

    if key_root:
        types = KeyMap(spark, key_root, ["payment_type"], "type_id").extend(mp.order_payments)
    else:
        types = mart.dim_payments(mp.order_payments)
    write_table(types, paths["dim_payments"], fmt, partition_by=parts.get("dim_payments"))
    payment_types = read_back(spark, paths["dim_payments"], fmt)

    # slim dimension from the per-order customer records (the raw customers
    # table itself for real extracts), so a person with several zips shows up
    write_table(mart.dim_customer_slim(mp.customer_orders), paths["dim_customer1"], fmt,
                partition_by=parts.get("dim_customer1"))

    ts = "order_purchase_timestamp"
    if calendar is None:
        days = mart.calendar_years_for(mp.orders, ts, months_ahead)
    else:
        days = mart.calendar_dim(spark, calendar.start, calendar.as_of, months_ahead, calendar.load_ts)
        days = mart.calendar_between(days, calendar.first_key, calendar.last_key)
    write_table(days, paths["dim_calendar"], fmt, partition_by=parts.get("dim_calendar"))

    oc = mart.order_customer(mp.orders, mart.dim_customer(mp.customers), mp.order_columns or mart.ORDER_COLUMNS)
    write_table(mart.build_fact(mp.order_payments, payment_types, oc), paths["fact"], fmt,
                partition_by=parts.get("fact"))

    logged = bool(version) and fmt in LOGGED_FORMATS
    if logged:
        tables = {name: read_back(spark, path, fmt) for name, path in paths.items()}
        commits.commit(spark, root, version, tables)
    views = {}
    for name, view in names.items():
        if logged:
            commits.create_switched_view(spark, view, root, name, tables[name].columns, fmt, temp_views)
        else:
            create_view(spark, view, paths[name], fmt, temp=temp_views)
        views[name] = view
    return Published(paths, views)
