"""The fact from bucketed tables: joins whose sides lie ready, without a shuffle.

Orders and customers are stored in the same number of buckets by customer_id,
payments and the joined order_customer by order_id, each bucket sorted by its
key. A join on the bucket key then reads bucket i of both sides in one task: no
exchange and no sort. The shuffle is paid once, when a table is written, and
every later run that joins on the key is free of it.

A bucket cannot be split when it is read, so a key with a large share of the rows
must not be in one: adaptive execution has no shuffle to split there. Keys with
more rows than a bucket's fair share (``hot_share`` times rows / buckets) are
found first by a partial aggregate; their rows are stored beside the buckets, in
a plain table, and joined to the few rows of their keys by a measured broadcast.
At most ``buckets / hot_share`` keys can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators.broadcast import broadcast_if_small
from stellate.plans import mart
from stellate.session import default_parallelism, plan_bytes

BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(spark: SparkSession, inputs: Sequence[DataFrame], target_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``target_bytes`` of input, at least one for each core."""
    return max(default_parallelism(spark), -(-sum(plan_bytes(df) for df in inputs) // target_bytes))


def hot_keys(df: DataFrame, key: str, buckets: int, hot_share: float = 0.5) -> DataFrame:
    """The keys with more than ``hot_share`` of a bucket's fair share of the rows: at most buckets / hot_share."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).first()[0]
    # a key that repeats only a little is never worth a path of its own
    return counts.where(F.col("_n") > max(hot_share * total / buckets, 1000)).select(key)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` as ``table``, in ``buckets`` buckets sorted by ``key``; the scan of it."""
    # dealt like the buckets, so each is written by one task as one file
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


@dataclass(frozen=True)
class Stored:
    """A table in two parts: ``even`` in buckets of ``key``, ``hot`` the rows of its hot keys."""

    even: DataFrame
    hot: DataFrame
    key: str

    def join(self, other: DataFrame) -> DataFrame:
        """Inner join to a bucketed table on the key; the few rows of hot keys' partners are broadcast."""
        partners = broadcast_if_small(other.join(broadcast_if_small(self.hot.select(self.key).distinct()), self.key, "left_semi"))
        return self.even.join(other, self.key).unionByName(self.hot.join(partners, self.key))


def store(df: DataFrame, name: str, folder: str, key: str, buckets: int, hot_share: float = 0.5) -> Stored:
    """Write ``df`` below ``folder`` as a bucketed table and a plain one for its hot keys."""
    hot = broadcast_if_small(hot_keys(df, key, buckets, hot_share))
    even = write_bucketed(df.join(hot, key, "left_anti"), f"{name}_even", f"{folder}/{name}_even", key, buckets)
    df.join(hot, key, "left_semi").write.mode("overwrite").parquet(f"{folder}/{name}_hot")
    return Stored(even, df.sparkSession.read.parquet(f"{folder}/{name}_hot"), key)


def fact_from_buckets(
    payments: DataFrame, payment_types: DataFrame, orders: DataFrame, customers: DataFrame, folder: str, prefix: str,
    order_columns: Sequence[str] = mart.ORDER_COLUMNS, buckets: int | None = None, hot_share: float = 0.5,
) -> DataFrame:
    """The payment-grain fact, its inputs stored in buckets under ``folder`` as tables named ``prefix``_*.

    ``customers`` has one row for each customer_id, so only the orders can make
    a customer hot; only the payments can make an order hot.
    """
    spark = payments.sparkSession
    n = buckets or bucket_count(spark, [payments, orders, customers])
    people = customers.select(*mart.CUSTOMER_COLUMNS)
    stored_people = write_bucketed(people, f"{prefix}_customers", f"{folder}/customers", "customer_id", n)
    placed = store(orders.select(*order_columns, "customer_id"), f"{prefix}_orders", folder, "customer_id", n, hot_share)
    joined = placed.join(stored_people).select(*order_columns, *mart.CUSTOMER_COLUMNS)
    order_cust = write_bucketed(joined, f"{prefix}_order_customer", f"{folder}/order_customer", "order_id", n)
    typed = payments.select("order_id", "payment_type", *mart.PAYMENT_MEASURES)
    paid = store(typed, f"{prefix}_payments", folder, "order_id", n, hot_share)
    fact = paid.join(order_cust).join(broadcast_if_small(payment_types.select("payment_type", "type_id")), "payment_type")
    first, *rest = mart.PAYMENT_MEASURES
    return fact.select(*order_columns, *mart.CUSTOMER_COLUMNS, first, "type_id", *rest)
