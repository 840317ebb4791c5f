"""Dimensions, surrogate keys, translation, order_customer and the fact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import marketplace
from stellate.functions import dense_key, hash_key
from stellate.plans import mart


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dense_key_matches_row_number(spark):
    vals = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    vals = vals.union(spark.createDataFrame([(None,)], "k string")).repartition(13)
    got = dense_key(vals, ["k"], "sk")
    expect = vals.select("k", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())).alias("sk"))
    assert got.count() == 5001
    assert _rows(got.select("k", "sk")) == _rows(expect)
    assert dict(got.dtypes)["sk"] == "bigint"


def test_dense_key_stable_across_layouts(spark):
    base = spark.range(2000).select(F.format_string("%05d", "id").alias("k"))
    a = _rows(dense_key(base.repartition(3), ["k"], "sk"))
    b = _rows(dense_key(base.repartition(17), ["k"], "sk"))
    assert a == b


def test_dense_key_in_a_union_of_two_keyed_frames(spark):
    # adaptive merging of partitions must not differ between counts and rows
    n = 400_000
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        one = dense_key(spark.range(n).select(F.format_string("a%07d", (F.col("id") * 7) % n).alias("k")), ["k"], "sk")
        two = dense_key(spark.range(n).select(F.format_string("b%07d", (F.col("id") * 11) % n).alias("k")), ["k"], "sk")
        both = one.unionByName(two).groupBy(F.substring("k", 1, 1).alias("side")).agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("sk").alias("d"), F.min("sk").alias("lo"), F.max("sk").alias("hi"),
            F.sum((F.substring("k", 2, 7).cast("long") + 1 != F.col("sk")).cast("long")).alias("wrong"))
        rows = both.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert [tuple(r)[1:] for r in rows] == [(n, n, 1, n, 0)] * 2


def test_dense_key_keeps_rows_with_a_map_column(spark):
    n = 50_000
    df = spark.range(n).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"))
    got = dense_key(df.repartition(9), ["id"], "sk")
    assert got.where("m['k'] = id and sk = id + 1").count() == n


def test_dense_key_without_exchange_reuse(spark):
    base = spark.range(3000).select(F.format_string("%05d", (F.col("id") * 17) % 3000).alias("k"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = dense_key(base.repartition(7), ["k"], "sk")
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted(r["sk"] for r in rows) == list(range(1, 3001))
    assert all(int(r["k"]) + 1 == r["sk"] for r in rows)


def test_hash_key_is_stable(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    one = _rows(df.select("k", hash_key("k").alias("h")))
    two = _rows(df.repartition(5).select("k", hash_key("k").alias("h")))
    assert one == two


def test_dim_payments(spark):
    mp = marketplace(spark)
    dim = mart.dim_payments(mp.order_payments)
    assert dim.columns == ["payment_type", "type_id"]
    # distinct keeps NULL as a type; keys follow payment_type order, NULL first
    assert _rows(dim) == _rows(spark.createDataFrame(
        [(None, 1), ("boleto", 2), ("credit_card", 3), ("debit_card", 4), ("voucher", 5)],
        "payment_type string, type_id bigint"))


def test_customer_dims(spark):
    mp = marketplace(spark)
    assert mart.dim_customer(mp.customers).count() == 5  # duplicate row collapsed
    slim = mart.dim_customer_slim(mp.customers)
    assert slim.columns == ["customer_unique_id", "customer_zip_code_prefix"]
    assert slim.count() == 5
    assert _rows(slim) == _rows(mart.dim_customer_slim_sql(spark, mp.customers))
    # u3 keeps two zips
    assert slim.where("customer_unique_id = 'u3'").count() == 2


def test_geolocation(spark):
    mp = marketplace(spark)
    dim = mart.dim_geolocation(mp.geolocation)
    assert dim.columns == ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]
    assert dim.where("geolocation_zip_code_prefix = '20000'").count() == 2  # both cities kept
    mixed = spark.createDataFrame(
        [("01", 2.0, 1.0, "Zeta", "AA"), ("01", 1.0, 9.0, "Alfa", "ZZ"), ("01", 0.5, 9.5, "Alfa", "ZZ"), ("02", 1.0, 1.0, None, "B")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string")
    assert _rows(mart.geolocation_per_zip(mixed)) == [("01", "Alfa", "ZZ", 0.5, 9.5), ("02", None, "B", 1.0, 1.0)]
    per_zip = mart.geolocation_per_zip(mp.geolocation)
    assert per_zip.count() == 3
    og = mart.orders_with_geolocation(mp.orders, mp.customers, mp.geolocation)
    # one row per order with a located customer: o1 (01001), o2 (20000, two cities), o3 (30000);
    # o4's customer c5 is listed twice and has no location, o5 has no customer
    got = sorted(r["order_id"] for r in og.collect())
    assert got == ["o1", "o2", "o3"]


def test_translation(spark):
    mp = marketplace(spark)
    tr = mart.product_translation(mp.products, mp.category_translation)
    assert tr.count() == mp.products.count()  # invariant: left join keeps every product
    assert "product_category_name" not in tr.columns
    assert tr.columns[:2] == ["product_id", "product_category_name_english"]
    names = {r["product_id"]: r["product_category_name_english"] for r in tr.collect()}
    assert names == {"p1": "perfumery", "p2": "art", "p3": None, "p4": None}
    sql = mart.product_translation_sql(spark, mp.products, mp.category_translation)
    assert sql.columns == tr.columns and _rows(sql) == _rows(tr)
    assert tr.where(F.col("product_category_name_english") == "perfumery").count() == 1


def test_order_customer_drops_orphans(spark):
    mp = marketplace(spark)
    oc = mart.order_customer(mp.orders, mart.dim_customer(mp.customers))
    assert sorted(r["order_id"] for r in oc.collect()) == ["o1", "o2", "o3", "o4", "o6"]
    assert oc.columns == [
        "order_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "customer_id", "customer_unique_id",
        "customer_zip_code_prefix", "customer_city", "customer_state",
    ]


def test_fact(spark):
    mp = marketplace(spark)
    dim = mart.dim_payments(mp.order_payments)
    oc = mart.order_customer(mp.orders, mart.dim_customer(mp.customers))
    fact = mart.build_fact(mp.order_payments, dim, oc)
    assert len(fact.columns) == 16
    assert fact.columns[-4:] == ["payment_sequential", "type_id", "payment_installments", "payment_value"]
    rows = fact.collect()
    # o2 has two payments; o4's NULL type, o6 (no payment), o5 (no customer), o9 (no order) drop
    assert sorted((r["order_id"], r["payment_sequential"]) for r in rows) == [
        ("o1", 1), ("o2", 1), ("o2", 2), ("o3", 1)]
    # every fact type_id joins back to the dimension
    assert fact.join(dim, "type_id", "left_anti").count() == 0
    types = {r["payment_type"]: r["type_id"] for r in dim.collect()}
    assert {(r["order_id"], r["payment_sequential"]): r["type_id"] for r in rows}[("o2", 1)] == types["voucher"]


def test_reviews_with_order_customer(spark):
    from fixtures import reviews

    mp = marketplace(spark)
    oc = mart.order_customer(mp.orders, mart.dim_customer(mp.customers))
    got = mart.reviews_with_order_customer(reviews(spark), oc)
    # reviews of o1, o2, o3 (x2), o4, o6; o5 has no customer
    assert got.count() == 6
    assert got.columns.count("order_id") == 1


def test_fact_with_a_hot_order_is_complete(spark):
    """One order holds a third of all payments: every payment row is kept."""

    n = 30000
    pay = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("o%d", "id")).alias("order_id"),
        F.col("id").cast("int").alias("payment_sequential"),
        F.when(F.col("id") % 2 == 0, F.lit("credit_card")).otherwise(F.lit("boleto")).alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        (F.col("id") * 1.0).alias("payment_value"),
    )
    orders = pay.select("order_id").distinct().select(
        "order_id", F.lit("c1").alias("customer_id"), F.lit("delivered").alias("order_status"),
        F.lit(None).cast("timestamp").alias("order_purchase_timestamp"))
    cust = spark.createDataFrame([("c1", "u1", "01001", "sp", "SP")],
                                 "customer_id string, customer_unique_id string, "
                                 "customer_zip_code_prefix string, customer_city string, customer_state string")
    kept = ["order_id", "order_status", "order_purchase_timestamp"]
    fact = mart.build_fact(pay, mart.dim_payments(pay), mart.order_customer(orders, mart.dim_customer(cust), kept))
    assert fact.count() == n
    assert fact.where("order_id = 'hot'").count() == n // 3
    assert fact.agg(F.sum("payment_value")).first()[0] == sum(range(n))


def test_duplicate_review_customers(spark):
    from fixtures import reviews

    mp = marketplace(spark)
    got = [tuple(r) for r in mart.duplicate_review_customers(
        reviews(spark), mp.orders, mart.dim_customer(mp.customers)).collect()]
    # r1 sits on o1 (c1/u1) and o2 (c2/u2); r2's two identical rows both trace to o3 (c3/u3);
    # the NULL review ids never match the join
    assert got == [("r1", "o1", "c1", "u1"), ("r1", "o2", "c2", "u2"),
                   ("r2", "o3", "c3", "u3"), ("r2", "o3", "c3", "u3")]


def test_hot_customer_join_is_split_by_adaptive_execution(spark):
    """One customer owns a third of the orders: the join's hot partition is split
    (thresholds lowered to test scale), and no order is lost."""
    n = 600_000
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(n).select(
            F.col("id").alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20000).alias("customer_id"),
            F.lit("delivered").alias("order_status"),
        )
        cust = spark.range(20000).select(
            F.col("id").alias("customer_id"), F.format_string("u%d", "id").alias("customer_unique_id"))
        oc = mart.order_customer(orders, mart.dim_customer(cust, cust.columns), ["order_id", "order_status"], cust.columns)
        qe = oc._jdf.queryExecution()  # run through the frame's own execution to read its final plan
        assert qe.toRdd().count() == n
        plan = qe.executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
