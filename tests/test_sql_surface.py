"""The SQL surface: statements of the shapes the mart's users write, over session views."""

from fixtures import marketplace, reviews
from stellate.operators import duplicate_keys, duplicate_rows, full_row_duplicates
from stellate.plans import mart


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_register_views(spark):
    mp = marketplace(spark)
    names = mp.register_views(spark, reviews=reviews(spark))
    assert {"customers", "orders", "payments", "order_reviews", "geolocation"} <= set(names)
    assert spark.sql("select * from payments where order_id = 'o2'").count() == 2
    assert spark.sql("select * from customers where customer_unique_id = 'u3'").count() == 2


def test_a_filtered_derived_table_equals_having(spark):
    rv = reviews(spark)
    rv.createOrReplaceTempView("order_reviews")
    inner = "SELECT review_id AS id, count(1) AS times FROM order_reviews GROUP BY 1"
    derived = spark.sql(f"SELECT id FROM ({inner}) t WHERE t.times >= 2")
    having = spark.sql(f"{inner} HAVING times >= 2")
    assert _rows(derived) == _rows(having.select("id"))
    assert _rows(having) == _rows(duplicate_keys(rv, "review_id"))


def test_membership_forms_agree(spark):
    rv = reviews(spark)
    rv.createOrReplaceTempView("order_reviews")
    again = "WITH again AS (SELECT review_id FROM order_reviews GROUP BY ALL HAVING count(1) >= 2) "
    member = spark.sql(again + "SELECT * FROM order_reviews WHERE review_id IN (TABLE again)")
    joined = spark.sql(again + "SELECT order_reviews.* FROM again INNER JOIN order_reviews USING (review_id)")
    exists = spark.sql(again + "FROM order_reviews o SELECT * WHERE EXISTS (FROM again a SELECT 1 WHERE a.review_id = o.review_id)")
    assert _rows(member) == _rows(joined) == _rows(exists) == _rows(duplicate_rows(rv, "review_id"))


def test_whole_rows_counted(spark):
    rv = reviews(spark)
    counted = spark.sql("SELECT *, count(1) AS copies FROM {frame} GROUP BY ALL HAVING copies >= 2", frame=rv)
    assert _rows(counted) == _rows(full_row_duplicates(rv))


def test_sql_with_dataframe_arguments(spark):
    mp = marketplace(spark)
    people = mart.dim_customer(mp.customers)
    sql = spark.sql("SELECT * FROM {people} GROUP BY ALL", people=mp.customers)
    assert _rows(sql) == _rows(people)
    types, oc = mart.dim_payments(mp.order_payments), mart.order_customer(mp.orders, people)
    fact = mart.build_fact(mp.order_payments, types, oc)
    columns = ", ".join(fact.columns)
    fact_sql = spark.sql(
        f"SELECT {columns} FROM {{paid}} JOIN {{kinds}} USING (payment_type) JOIN {{bought}} USING (order_id)",
        paid=mp.order_payments, kinds=types, bought=oc)
    assert fact_sql.columns == fact.columns
    assert _rows(fact_sql) == _rows(fact)


def test_profile_of_three_dates(spark):
    from stellate.operators import date_profile

    orders = marketplace(spark).orders
    cols = ["order_purchase_timestamp", "order_delivered_carrier_date", "order_estimated_delivery_date"]
    row = date_profile(orders, cols).first()
    ends = ", ".join(f"min({c}), max({c})" for c in cols)
    assert tuple(row) == tuple(spark.sql(f"SELECT {ends} FROM {{orders}}", orders=orders).first())
    assert str(row["min_order_purchase_timestamp"].date()) == "2017-01-01"


def test_from_raw_paths(spark, out_dir):
    from stellate.sources import Marketplace

    mp = marketplace(spark)
    paths = {}
    for name, df in {
        "customers": mp.customers, "geolocation": mp.geolocation, "order_items": mp.order_items,
        "orders": mp.orders, "order_payments": mp.order_payments, "products": mp.products,
        "sellers": mp.sellers, "product_category_name_translation": mp.category_translation,
    }.items():
        paths[name] = f"{out_dir}/{name}.parquet"
        df.write.parquet(paths[name])
    reviews(spark).write.parquet(f"{out_dir}/order_reviews.parquet")
    paths["order_reviews"] = f"{out_dir}/order_reviews.parquet"
    raw = Marketplace.from_raw(spark, paths)
    assert raw.order_reviews.count() == 7
    raw.register_views(spark)
    assert duplicate_keys(spark.table("order_reviews"), "review_id").count() == 3
    assert Marketplace.from_driver(spark, "/root/testdata/sf0.001").order_reviews.columns[0] == "review_id"
    fact = mart.build_fact(raw.order_payments, mart.dim_payments(raw.order_payments),
                           mart.order_customer(raw.orders, mart.dim_customer(raw.customers)))
    assert fact.count() == 4


def test_view_over_the_generated_spine(spark):
    from stellate.sources import date_spine

    date_spine(spark, "2016-01-01", "2023-12-31").createOrReplaceTempView("dates")
    assert spark.sql("SELECT * FROM dates").count() == 2922
    first = spark.sql("SELECT * FROM dates ORDER BY calendarDate LIMIT 20").collect()
    assert len(first) == 20 and str(first[0][0]) == "2016-01-01"
