"""The raw marketplace tables, as DataFrames with the marketplace column names.

Two ways to get them:

* ``read_raw(spark, paths)`` scans real marketplace Parquet extracts, one path
  per table (customers, geolocation, order_items, order_reviews, orders,
  order_payments, products, sellers, product_category_name_translation).
* ``Marketplace.from_driver(spark, root)`` maps the TPC-H style tables under
  ``root`` onto the same names with renaming projections (no data is copied;
  Catalyst folds the renames into the scans).

Mapping of the driver tables (see SURVEY section 7.2):

================  ==========================================================
marketplace       driver source
================  ==========================================================
customers         customer + nation (city) + region (state):
                  customer_id = c_custkey, customer_unique_id = c_name,
                  customer_zip_code_prefix = c_nationkey
customer_orders   orders as per-order customer records (repeats per person):
                  customer_unique_id = o_custkey,
                  customer_zip_code_prefix = o_orderpriority
orders            order_id = o_orderkey, customer_id = o_custkey,
                  order_status = o_orderstatus,
                  order_purchase_timestamp = o_orderdate
order_payments    lineitem: order_id = l_orderkey,
                  payment_sequential = l_linenumber,
                  payment_type = l_returnflag,
                  payment_installments = l_quantity,
                  payment_value = l_extendedprice
products          part: product_id = p_partkey,
                  product_category_name = p_type, ...
order_reviews     lineitem: review_id = l_partkey, order_id = l_orderkey,
                  review_score = l_linenumber,
                  review_creation_date = l_shipdate
category map      fixed lookup below (one type left out so NULLs occur)
geolocation       supplier + nation + region (several rows per zip prefix)
order_items       lineitem as read
sellers           supplier as read
================  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.sources.tables import read_parquet, read_table

RAW_TABLES = (
    "customers",
    "geolocation",
    "order_items",
    "order_reviews",
    "orders",
    "order_payments",
    "products",
    "sellers",
    "product_category_name_translation",
)

# Category translation used for the driver's part types.
# product_category_name -> product_category_name_english. STANDARD is left out
# on purpose so the left join yields NULL for it.
CATEGORY_TRANSLATION = [
    ("ECONOMY", "economy_en"),
    ("LARGE", "large_en"),
    ("MEDIUM", "medium_en"),
    ("PROMO", "promo_en"),
    ("SMALL", "small_en"),
]


def read_raw(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Scan the raw marketplace Parquet files, one DataFrame per table name."""
    unknown = set(paths) - set(RAW_TABLES)
    if unknown:
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    return {name: read_parquet(spark, path) for name, path in paths.items()}


def category_translation(spark: SparkSession) -> DataFrame:
    """The fixed category map as a (tiny, constant-size) DataFrame."""
    return spark.createDataFrame(
        CATEGORY_TRANSLATION,
        "product_category_name string, product_category_name_english string",
    )


def translation_from_products(products: DataFrame, untranslated: tuple[str, ...] = ("STANDARD",)) -> DataFrame:
    """A translation derived from the products' categories: one row each, but for those left ``untranslated``."""
    name = F.col("product_category_name")
    known = products.select(name).where(name.isNotNull() & ~name.isin(*untranslated)).distinct()
    return known.withColumn("product_category_name_english", F.concat(F.lower(name), F.lit("_en")))


def _place(customer_like: DataFrame, nation: DataFrame, region: DataFrame, key: str) -> DataFrame:
    """Attach city (nation name) and state (region name) to rows keyed by a nation key.

    nation and region have a fixed size at every scale factor (25 and 5 rows
    by the benchmark's definition), so they are broadcast: the customer-sized
    side is never shuffled on the 25-value nation key.
    """
    n = F.broadcast(nation.select(
        F.col("n_nationkey").alias("_nk"), "n_name", F.col("n_regionkey").alias("_rk")
    ))
    r = F.broadcast(region.select(F.col("r_regionkey").alias("_rk"), "r_name"))
    return (
        customer_like.join(n, customer_like[key] == n["_nk"], "left")
        .join(r, "_rk", "left")
        .drop("_nk", "_rk")
    )


FIELDS = (
    "customers",
    "customer_orders",
    "orders",
    "order_payments",
    "products",
    "category_translation",
    "geolocation",
    "order_items",
    "sellers",
)
OPTIONAL = ("order_reviews",)


class Marketplace:
    """The raw tables a mart build reads, already in marketplace names.

    Each table is given as a DataFrame or as a zero-argument function making
    one; functions run on first use, so a query only opens the files it reads.
    """

    def __init__(self, order_columns: tuple[str, ...] | None = None, **tables):
        """``order_columns``: the orders' columns a mart keeps, where the source has not all of them."""
        self.order_columns = order_columns
        missing = set(FIELDS) - set(tables)
        extra = set(tables) - set(FIELDS) - set(OPTIONAL)
        if missing or extra:
            raise TypeError(f"missing {sorted(missing)}, unknown {sorted(extra)}")
        self._sources = dict(tables)
        self._frames: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._frames:
            src = self._sources[name]
            self._frames[name] = src if isinstance(src, DataFrame) else src()
        return self._frames[name]

    def replaced(self, **tables) -> "Marketplace":
        """The same marketplace with some tables replaced."""
        return Marketplace(self.order_columns, **(self._sources | tables))

    customers = property(lambda self: self._get("customers"))
    customer_orders = property(lambda self: self._get("customer_orders"))
    orders = property(lambda self: self._get("orders"))
    order_payments = property(lambda self: self._get("order_payments"))
    products = property(lambda self: self._get("products"))
    category_translation = property(lambda self: self._get("category_translation"))
    geolocation = property(lambda self: self._get("geolocation"))
    order_items = property(lambda self: self._get("order_items"))
    sellers = property(lambda self: self._get("sellers"))

    @property
    def order_reviews(self) -> DataFrame | None:
        """The review extract when one was given."""
        return self._get("order_reviews") if "order_reviews" in self._sources else None

    @classmethod
    def from_driver(cls, spark: SparkSession, root: str) -> "Marketplace":
        cache: dict[str, DataFrame] = {}

        def t(name: str) -> DataFrame:
            if name not in cache:
                cache[name] = read_table(spark, root, name)
            return cache[name]

        def customers():
            return _place(t("customer"), t("nation"), t("region"), "c_nationkey").select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                F.col("c_nationkey").alias("customer_zip_code_prefix"),
                F.col("n_name").alias("customer_city"),
                F.col("r_name").alias("customer_state"),
            )

        def customer_orders():
            return t("orders").select(
                F.col("o_orderkey").alias("customer_id"),
                F.col("o_custkey").alias("customer_unique_id"),
                F.col("o_orderpriority").alias("customer_zip_code_prefix"),
            )

        def orders():
            return t("orders").select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_orderdate").alias("order_purchase_timestamp"),
            )

        def order_payments():
            return t("lineitem").select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("payment_sequential"),
                F.col("l_returnflag").alias("payment_type"),
                F.col("l_quantity").alias("payment_installments"),
                F.col("l_extendedprice").alias("payment_value"),
            )

        def order_reviews():
            return t("lineitem").select(
                F.col("l_partkey").alias("review_id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("review_score"),
                F.col("l_shipdate").alias("review_creation_date"),
            )

        def products():
            return t("part").select(
                F.col("p_partkey").alias("product_id"),
                F.col("p_type").alias("product_category_name"),
                F.length("p_name").alias("product_name_lenght"),
                F.col("p_brand").alias("product_brand"),
                F.col("p_size").alias("product_size"),
                F.col("p_retailprice").alias("product_retail_price"),
            )

        def geolocation():
            return _place(t("supplier"), t("nation"), t("region"), "s_nationkey").select(
                F.col("s_nationkey").alias("geolocation_zip_code_prefix"),
                F.col("n_name").alias("geolocation_city"),
                F.col("r_name").alias("geolocation_state"),
            )

        return cls(
            customers=customers,
            customer_orders=customer_orders,
            orders=orders,
            order_payments=order_payments,
            products=products,
            category_translation=lambda: category_translation(spark),
            geolocation=geolocation,
            order_items=lambda: t("lineitem"),
            sellers=lambda: t("supplier"),
            order_reviews=order_reviews,
            order_columns=("order_id", "order_status", "order_purchase_timestamp"),
        )

    def register_views(
        self, spark: SparkSession, reviews: DataFrame | None = None, prefix: str = ""
    ) -> dict[str, str]:
        """Register the tables as session views, for SQL written against them.

        View names: customers, geolocation, orders, payments (also
        order_payments), products, product_category_name_translation,
        order_items, sellers and order_reviews (given here or held by the
        marketplace), each after ``prefix``, which keeps views of other names a
        session may hold. Returns {view name: table}. Views are names for the lazy plans; nothing is
        materialised.
        """
        views = {
            "customers": self.customers,
            "geolocation": self.geolocation,
            "orders": self.orders,
            "payments": self.order_payments,
            "order_payments": self.order_payments,
            "products": self.products,
            "product_category_name_translation": self.category_translation,
            "order_items": self.order_items,
            "sellers": self.sellers,
        }
        reviews = reviews if reviews is not None else self.order_reviews
        if reviews is not None:
            views["order_reviews"] = reviews
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return {prefix + name: name for name in views}

    @classmethod
    def from_raw(cls, spark: SparkSession, paths: dict[str, str]) -> "Marketplace":
        """Real marketplace extracts: the names already match; files open on first use."""
        unknown = set(paths) - set(RAW_TABLES)
        if unknown:
            raise ValueError(f"unknown raw tables: {sorted(unknown)}")

        def scan(name: str):
            return lambda: read_parquet(spark, paths[name])

        return cls(
            customers=scan("customers"),
            customer_orders=scan("customers"),
            orders=scan("orders"),
            order_payments=scan("order_payments"),
            products=scan("products"),
            category_translation=scan("product_category_name_translation"),
            geolocation=scan("geolocation"),
            order_items=scan("order_items"),
            sellers=scan("sellers"),
            **({"order_reviews": scan("order_reviews")} if "order_reviews" in paths else {}),
        )
