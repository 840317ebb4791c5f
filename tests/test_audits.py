"""Audits in one pass: key checks, causes of dropped payments, wide duplicates, guarded translation, holidays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from data_dirs import SMALL, SMOKE
from fixtures import PAYMENTS, marketplace, reviews
from stellate.functions.holidays import easter, holidays_of, mark_holidays
from stellate.operators import quality as q
from stellate.plans import mart
from stellate.plans.guard import RepeatedKey, publish_translation
from stellate.sources import Marketplace, commits, read_table

CHECKS = {"review": ["review_id"], "pair": ["review_id", "order_id"], "again": ["order_id", "review_id"], "score": ["review_score"]}


def audit(df, checks=CHECKS):
    return {r["check"]: tuple(r)[1:] for r in q.key_audit(df, checks).collect()}


def separately(df, keys):
    counts = df.groupBy(*keys).count().collect()
    ns = [r["count"] for r in counts]
    return sum(ns), len(ns), sum(n > 1 for n in ns), max(ns, default=0)


def test_key_audit_equals_the_separate_checks(spark):
    rv = reviews(spark)
    assert audit(rv) == {name: separately(rv, keys) for name, keys in CHECKS.items()}
    assert audit(rv)["review"] == (7, 4, 3, 2)  # the NULL id twice is one repeated key
    assert audit(rv.limit(0)) == dict.fromkeys(CHECKS, (0, 0, 0, 0))
    big = Marketplace.from_driver(spark, SMALL).order_reviews
    assert audit(big) == {name: separately(big, keys) for name, keys in CHECKS.items()}


def test_key_audit_scans_once_and_counts_before_its_one_shuffle_of_keys(spark):
    plan = q.key_audit(Marketplace.from_driver(spark, SMOKE).order_reviews, CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan and "partial_count" in plan
    assert sum("hashpartitioning(review_id" in line for line in plan.splitlines() if "Exchange" in line) == 1


def test_every_payment_is_loaded_or_has_a_cause(spark):
    mp = marketplace(spark)
    pay = mp.order_payments.unionByName(spark.createDataFrame([("o5", 1, "boleto", 1, 7.0), (None, 1, "boleto", 1, 8.0)], mp.order_payments.schema))
    # repeated orders and customers do not repeat payments here
    orders = mp.orders.unionByName(mp.orders)
    types = mart.dim_payments(pay)
    got = {(r["order_id"], r["payment_sequential"]): r["cause"] for r in mart.payments_with_cause(pay, types, orders, mp.customers).collect()}
    assert got == {("o1", 1): None, ("o2", 1): None, ("o2", 2): None, ("o3", 1): None, ("o4", 1): "no payment type",
                   ("o9", 1): "no order", ("o5", 1): "no customer", (None, 1): "no order"}
    counts = {r["cause"]: r["payments"] for r in mart.fact_rejects(pay, types, mp.orders, mp.customers).collect()}
    assert sum(counts.values()) == len(PAYMENTS) + 2
    fact = mart.build_fact(pay, types, mart.order_customer(mp.orders, mart.dim_customer(mp.customers)))
    assert counts["loaded"] == fact.count()
    # a type that the dimension lacks, and none at all
    few = types.where("payment_type = 'boleto'")
    causes = mart.payments_with_cause(pay, few, mp.orders, mp.customers).groupBy("cause").count().collect()
    assert {r["cause"]: r["count"] for r in causes}["no payment type"] == 5


def test_wide_duplicates_equal_the_plain_ones(spark):
    rv = reviews(spark)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    for df in (rv, rv.unionByName(rv).unionByName(rv.where("review_id = 'r2'")), rv.limit(0)):
        assert rows(q.wide_row_duplicates(df)) == rows(q.full_row_duplicates(df))
        assert rows(q.wide_row_duplicates(df, "n", 3, max_rows=0, hot_rows=1)) == rows(q.full_row_duplicates(df, "n", 3))


def test_only_candidates_are_grouped_whole(spark):
    wide = read_table(spark, SMALL, "lineitem").join(read_table(spark, SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    some = wide.where("l_orderkey < 50")
    found = q.wide_row_duplicates(wide.unionByName(some))
    assert found.count() == some.count()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # no exchange carries all wide rows: the candidates alone are hashed on every column
    assert "BroadcastHashJoin" in plan


def test_guard_publishes_counts_and_refuses_a_repeating_key(spark, out_dir):
    mp = marketplace(spark)
    stored, counts = publish_translation(mp.products, mp.category_translation, out_dir)
    assert counts == {"rows_in": 4, "rows_out": 4, "untranslated": 2} and stored.count() == 4
    at = commits.last(spark, out_dir)
    again = mp.category_translation.unionByName(mp.category_translation.where("product_category_name = 'artes'"))
    with pytest.raises(RepeatedKey, match="artes"):
        publish_translation(mp.products, again, out_dir)
    assert commits.last(spark, out_dir) == at
    # a repeated key that no product has multiplies nothing
    unused = mp.category_translation.unionByName(spark.createDataFrame([("x", "1"), ("x", "2")], mp.category_translation.schema))
    assert publish_translation(mp.products, unused, out_dir)[1]["rows_out"] == 4


def easter_by_hand(y):
    """Another algorithm than the library's (the anonymous one of 1876)."""
    a, b, c = y % 19, y // 100, y % 100
    d, e, f = b // 4, b % 4, (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = (a + 11 * h + 22 * m) // 451
    month, day = divmod(h + m - 7 * n + 114, 31)
    return dt.date(y, month, day + 1)


def test_easter(spark):
    got = {r["y"]: r["e"] for r in spark.range(1800, 2300).select(F.col("id").cast("int").alias("y")).withColumn("e", easter(F.col("y"))).collect()}
    assert got == {y: easter_by_hand(y) for y in range(1800, 2300)}
    assert got[2024] == dt.date(2024, 3, 31) and got[2038] == dt.date(2038, 4, 25)


def test_holidays(spark):
    years = spark.createDataFrame([(2000,), (2016,), (2000,), (None,)], "year int")
    found = {r["date"]: r["holiday_name"] for r in holidays_of(years).collect()}
    assert len(found) == 13 + 12  # two of the year 2000 fall on one day
    assert found[dt.date(2000, 4, 21)] == "Good Friday, Tiradentes" and found[dt.date(2016, 2, 9)] == "Carnival Tuesday"
    calendar = mart.calendar_dim(spark, "2016-01-01", "2016-06-15", 6, "2016-06-15 00:00:00")
    marked = mark_holidays(calendar)
    assert marked.count() == calendar.count()
    assert marked.where("is_holiday = 1").count() == sum(d.year == 2016 and d <= dt.date(2016, 12, 30) for d in found)
