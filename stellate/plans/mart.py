"""The mart: dimensions, order_customer, the payment-grain fact, the calendar.

Each function takes DataFrames in marketplace names and returns a DataFrame;
composing them yields one plan Catalyst optimises end to end. The plans are
lazy, but for what is measured or numbered while they are built: small join
sides and surrogate keys are checkpointed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.calendar import calendar_columns, calendar_end
from stellate.functions.keys import dense_key
from stellate.operators.broadcast import broadcast_if_small
from stellate.operators.dims import distinct_dim, translate
from stellate.operators.order import ordered
from stellate.operators.quality import duplicate_rows
from stellate.sources.spine import spine_from_bounds

# Column names of the marketplace tables the mart reads.
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
)
SLIM_CUSTOMER_COLUMNS = ("customer_unique_id", "customer_zip_code_prefix")
GEOLOCATION_COLUMNS = ("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")
ORDER_COLUMNS = (
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
PAYMENT_MEASURES = ("payment_sequential", "payment_installments", "payment_value")


def _required(df: DataFrame, cols: Sequence[str], table: str) -> list[str]:
    """``cols``, all of which ``df`` must have: a mart is not built without some of its columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    return list(cols)


# --------------------------------------------------------------------------- dims


def product_translation(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name in place of the original (left join)."""
    keep = [c for c in products.columns if c not in ("product_id", "product_category_name")]
    return translate(
        products,
        translation,
        on="product_category_name",
        out="product_category_name_english",
        keep=keep,
        key="product_id",
    )


def product_translation_sql(spark: SparkSession, products: DataFrame, translation: DataFrame) -> DataFrame:
    """The same join written as SQL text with DataFrame arguments (``{prod}``)."""
    keep = [c for c in products.columns if c not in ("product_id", "product_category_name")]
    columns = ", ".join(["product_id", "product_category_name_english", *keep])
    return spark.sql(
        f"SELECT {columns} FROM {{items}} LEFT JOIN {{names}} USING (product_category_name)",
        items=products,
        names=broadcast_if_small(translation.select("product_category_name", "product_category_name_english")),
    )


def dim_payments(payments: DataFrame) -> DataFrame:
    """Distinct payment types with a stable ``type_id`` 1..N in payment_type order."""
    return distinct_dim(payments, ["payment_type"], surrogate="type_id")


def dim_customer(customers: DataFrame, columns: Sequence[str] = CUSTOMER_COLUMNS) -> DataFrame:
    """Distinct customers with location (five columns)."""
    return distinct_dim(customers, _required(customers, columns, "customers"))


def dim_customer_slim(customers: DataFrame) -> DataFrame:
    """Distinct (customer_unique_id, customer_zip_code_prefix)."""
    return distinct_dim(customers, list(SLIM_CUSTOMER_COLUMNS))


def dim_customer_slim_sql(spark: SparkSession, customers: DataFrame) -> DataFrame:
    """The slim customer dimension written as SQL with a DataFrame argument."""
    columns = ", ".join(SLIM_CUSTOMER_COLUMNS)
    return spark.sql(f"SELECT {columns} FROM {{people}} GROUP BY {columns}", people=customers)


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """Distinct (zip prefix, city, state); a zip with two cities keeps both rows."""
    return distinct_dim(geolocation, list(GEOLOCATION_COLUMNS))


def geolocation_per_zip(geolocation: DataFrame) -> DataFrame:
    """Exactly one row per zip prefix, safe to join on zip: the zip's first whole row.

    The raw geolocation has many rows per zip (one per coordinate), and even
    its distinct form can hold two cities for one zip; joining either fans the
    orders out. First is by city, state, latitude, longitude (the coordinates
    where the input has them), taken together, so the place is one of the
    input's. Grouping by zip is a partial aggregation, so a hot zip costs one
    row per task before the shuffle.
    """
    place = ["geolocation_city", "geolocation_state"]
    place += [c for c in ("geolocation_lat", "geolocation_lng") if c in geolocation.columns]
    first = geolocation.groupBy("geolocation_zip_code_prefix").agg(F.min(F.struct(*place)).alias("_place"))
    return first.select("geolocation_zip_code_prefix", "_place.*")


# --------------------------------------------------------------------------- fact


def order_customer(
    orders: DataFrame,
    customers: DataFrame,
    order_columns: Sequence[str] = ORDER_COLUMNS,
    customer_columns: Sequence[str] = CUSTOMER_COLUMNS,
) -> DataFrame:
    """Orders with their customer's attributes (inner join on customer_id).

    ``order_columns`` and ``customer_columns`` are kept; all must be there.

    Orders without a customer drop out. Both sides are large at scale, so this
    is a shuffle join on customer_id; AQE splits a customer that owns a large
    share of the orders.
    """
    order_cols = _required(orders, order_columns, "orders")
    cust_cols = _required(customers, customer_columns, "customers")
    o = orders.select(*order_cols, "customer_id")
    c = customers.select(*cust_cols)
    joined = o.join(c, "customer_id", "inner")
    return joined.select(*order_cols, *cust_cols)


def build_fact(
    payments: DataFrame,
    payment_types: DataFrame,
    order_cust: DataFrame,
    measures: Sequence[str] = PAYMENT_MEASURES,
) -> DataFrame:
    """Payment-grain fact: one row per payment of an order that has a customer.

    ``payments`` join ``payment_types`` on the natural payment_type (brings
    ``type_id``; NULL types drop), then ``order_cust`` on order_id (payments
    without order and orders without payment drop).

    The payment-type dimension is materialised once (so its keys are fixed)
    and measured; within the bound it is broadcast, so the payments are never
    shuffled on the low-cardinality payment_type and the only shuffle of the
    fact-sized side is the one on order_id.
    """
    measures = _required(payments, measures, "order_payments")
    p = payments.select("order_id", "payment_type", *measures)
    pt = broadcast_if_small(payment_types.select("payment_type", "type_id"))
    typed = p.join(pt, "payment_type", "inner")
    fact = typed.join(order_cust, "order_id", "inner")
    first = [c for c in measures if c == "payment_sequential"]
    rest = [c for c in measures if c not in first]
    return fact.select(*order_cust.columns, *first, "type_id", *rest)


def payments_with_cause(
    payments: DataFrame, payment_types: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Every payment with ``cause``: why the fact does not have it, null where it does.

    The fact's inner joins drop rows silently. Here the same lookups are outer
    joins in one pass, and the first that fails names the cause: no payment
    type, no order, no customer. One row per payment, whatever repeats in the
    orders or customers, so the rows without cause are the payments that the
    fact holds and all rows together are the payments.
    """
    types = broadcast_if_small(payment_types.select("payment_type", F.lit(True).alias("_type")))
    people = customers.select("customer_id").distinct().withColumn("_person", F.lit(True))
    # grouped by order_id, as the payments are joined: no shuffle of its own for that join
    known = orders.join(people, "customer_id", "left").groupBy("order_id").agg(
        F.max(F.coalesce("_person", F.lit(False))).alias("_person")
    )
    joined = payments.join(types, "payment_type", "left").join(known, "order_id", "left")
    cause = (
        F.when(F.col("_type").isNull(), "no payment type")
        .when(F.col("_person").isNull(), "no order")
        .when(~F.col("_person"), "no customer")
    )
    return joined.select(*payments.columns, cause.alias("cause"))


def fact_rejects(
    payments: DataFrame, payment_types: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Payments by cause (``loaded`` for those in the fact): rows, orders and the largest value."""
    judged = payments_with_cause(payments, payment_types, orders, customers)
    return judged.groupBy(F.coalesce("cause", F.lit("loaded")).alias("cause")).agg(
        F.count(F.lit(1)).alias("payments"),
        F.countDistinct("order_id").alias("orders"),
        F.max("payment_value").alias("largest"),
    )


def reviews_with_order_customer(reviews: DataFrame, order_cust: DataFrame) -> DataFrame:
    """Every review row with its order's customer attributes (inner join on order_id)."""
    return reviews.join(order_cust, "order_id", "inner")


def duplicate_review_customers(
    reviews: DataFrame, orders: DataFrame, customers: DataFrame, key: str = "review_id"
) -> DataFrame:
    """Reviews whose id repeats, traced to their order's customer and person.

    Columns: ``key``, order_id, customer_id, customer_unique_id, ordered by
    them. Repeated ids come from a partially aggregated count matched back by
    join (see ``duplicate_rows``); the two lookups are inner joins on the
    order and customer keys, so reviews of unknown orders or customers drop.
    """
    dups = duplicate_rows(reviews, key, how="join").select(key, "order_id")
    with_customer = dups.join(orders.select("order_id", "customer_id"), "order_id", "inner")
    people = customers.select("customer_id", "customer_unique_id")
    traced = with_customer.join(people, "customer_id", "inner")
    cols = [key, "order_id", "customer_id", "customer_unique_id"]
    return ordered(traced.select(*cols), cols)


def orders_with_geolocation(orders: DataFrame, customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Orders, their customer and the customer's zip location, one row per order.

    Customers go through the distinct customer dimension and geolocation is
    first reduced to one row per zip, so neither join can multiply orders.
    """
    # one row per zip prefix: bounded by the prefix domain, measured before broadcasting
    geo = broadcast_if_small(geolocation_per_zip(geolocation))
    oc = orders.join(dim_customer(customers), "customer_id", "inner")
    return oc.join(
        geo, oc["customer_zip_code_prefix"] == geo["geolocation_zip_code_prefix"], "inner"
    ).drop("geolocation_zip_code_prefix")


# --------------------------------------------------------------------------- calendar


def _calendar_from_bounds(bounds: DataFrame, months_ahead: int, keys: bool = False) -> DataFrame:
    """bounds has columns _start (date), _as_of (date), _load (timestamp) and,
    with ``keys``, _lo / _hi date keys the rows are filtered to."""
    bounds = bounds.withColumn("_end", F.date_sub(calendar_end(F.col("_as_of"), months_ahead), 1))
    carry = ["_as_of", "_load"] + (["_lo", "_hi"] if keys else [])
    spine = spine_from_bounds(bounds, "_start", "_end", "_d", keep=carry)
    cal = spine.select(*calendar_columns(F.col("_d"), F.col("_as_of"), F.col("_load")), *carry[2:])
    if keys:
        cal = calendar_between(cal, F.col("_lo"), F.col("_hi")).drop("_lo", "_hi")
    return cal


def calendar_dim(
    spark: SparkSession,
    start: str = "2016-01-01",
    as_of: str | None = None,
    months_ahead: int = 60,
    load_ts: str | None = None,
) -> DataFrame:
    """Calendar from ``start`` up to, not including, the last day of the month
    ``months_ahead`` months after ``as_of`` (default: today).

    ``load_ts`` (default ``current_timestamp()``) fills ``load_date``.
    """
    as_of_col = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    load_col = F.current_timestamp() if load_ts is None else F.to_timestamp(F.lit(load_ts))
    bounds = spark.range(1).select(
        F.to_date(F.lit(start)).alias("_start"), as_of_col.alias("_as_of"), load_col.alias("_load")
    )
    return _calendar_from_bounds(bounds, months_ahead)


def calendar_for(df: DataFrame, ts_col: str, months_ahead: int = 60) -> DataFrame:
    """Calendar sized by the data: from January 1st of the first year in
    ``ts_col`` to ``months_ahead`` months past its last date.

    The last date is the as-of date of the rolling month flags and the last
    timestamp fills ``load_date``, so the table is reproducible from the data
    alone. The bounds come from one partial aggregate over the scan.
    """
    d = F.to_date(F.col(ts_col))
    bounds = df.agg(
        F.trunc(F.min(d), "YEAR").alias("_start"),
        F.max(d).alias("_as_of"),
        F.max(F.col(ts_col)).alias("_load"),
    )
    return _calendar_from_bounds(bounds, months_ahead)


def calendar_years_for(df: DataFrame, ts_col: str, months_ahead: int = 60) -> DataFrame:
    """``calendar_for`` kept to the whole years the data covers, in one pass.

    Same rows as ``calendar_years_of(calendar_for(df, ...), df, ...)``, but
    the year bounds come out of the same one-row aggregate as the calendar
    bounds, so ``df`` is scanned once.
    """
    d = F.to_date(F.col(ts_col))
    bounds = df.agg(
        F.trunc(F.min(d), "YEAR").alias("_start"),
        F.max(d).alias("_as_of"),
        F.max(F.col(ts_col)).alias("_load"),
        (F.year(F.min(d)) * 10000 + 101).cast("int").alias("_lo"),
        (F.year(F.max(d)) * 10000 + 1231).cast("int").alias("_hi"),
    )
    return _calendar_from_bounds(bounds, months_ahead, keys=True)


def calendar_between(calendar: DataFrame, lo: int | Column, hi: int | Column) -> DataFrame:
    """Rows with ``lo <= date_key <= hi`` (int keys yyyyMMdd, both ends inclusive)."""
    return calendar.where(F.col("date_key").between(lo, hi))


def calendar_years_of(calendar: DataFrame, df: DataFrame, ts_col: str) -> DataFrame:
    """Keep the whole years the data covers: Jan 1st of the first year to Dec 31st of the last.

    The two bounds are scalar subqueries over ``df`` (each one aggregate row),
    not a join.
    """
    d = F.to_date(F.col(ts_col))
    lo = df.select((F.year(F.min(d)) * 10000 + 101).cast("int")).scalar()
    hi = df.select((F.year(F.max(d)) * 10000 + 1231).cast("int")).scalar()
    return calendar_between(calendar, lo, hi)


def spine_of(df: DataFrame, ts_col: str, name: str = "calendarDate") -> DataFrame:
    """Every day from the first to the last date in ``ts_col`` (both inclusive)."""
    d = F.to_date(F.col(ts_col))
    bounds = df.agg(F.min(d).alias("_start"), F.max(d).alias("_end"))
    return spine_from_bounds(bounds, "_start", "_end", name)


__all__ = [
    "build_fact",
    "calendar_between",
    "calendar_dim",
    "calendar_for",
    "calendar_years_for",
    "calendar_years_of",
    "dense_key",
    "dim_customer",
    "dim_customer_slim",
    "dim_customer_slim_sql",
    "dim_geolocation",
    "dim_payments",
    "duplicate_review_customers",
    "geolocation_per_zip",
    "order_customer",
    "orders_with_geolocation",
    "product_translation",
    "product_translation_sql",
    "reviews_with_order_customer",
    "spine_of",
]
