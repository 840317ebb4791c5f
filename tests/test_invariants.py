"""The invariants of SURVEY section 5, checked on the driver's smoke tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from data_dirs import SMOKE
from stellate.plans import mart
from stellate.sources import Marketplace, read_table

Q = entry.queries()


@pytest.fixture(scope="module")
def mp(spark):
    return Marketplace.from_driver(spark, SMOKE)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_1_translation_keeps_every_product(spark, mp):
    assert Q["product_translation"](spark, SMOKE).count() == read_table(spark, SMOKE, "part").count()


def test_2_every_order_has_its_customer(spark, mp):
    assert Q["order_customer"](spark, SMOKE).count() == read_table(spark, SMOKE, "orders").count()


def test_3_fact_has_one_row_per_payment(spark, mp):
    assert Q["fact_order_payments"](spark, SMOKE).count() == read_table(spark, SMOKE, "lineitem").count()


def test_4_customer_id_is_unique(spark):
    assert Q["customer_id_unique_check"](spark, SMOKE).count() == 0


def test_5_calendar_filter_keeps_whole_years(spark, mp):
    cal = Q["calendar_years"](spark, SMOKE)
    first, last, n = cal.agg(F.min("date"), F.max("date"), F.count(F.lit(1))).first()
    assert (first.month, first.day, last.month, last.day) == (1, 1, 12, 31)
    assert n == (last - first).days + 1


def test_6_equivalent_forms_agree(spark):
    ids_derived = _rows(Q["duplicate_ids_subquery"](spark, SMOKE))
    ids_having = _rows(Q["duplicate_ids_having"](spark, SMOKE).select("l_orderkey"))
    assert ids_derived == ids_having
    assert _rows(Q["duplicate_rows_semi"](spark, SMOKE)) == _rows(Q["duplicate_rows_join"](spark, SMOKE))


def test_7_fact_type_ids_join_back_to_the_dimension(spark, mp):
    dim = mart.dim_payments(mp.order_payments)
    oc = mart.order_customer(mp.orders, mart.dim_customer(mp.customers), mp.order_columns)
    fact = mart.build_fact(mp.order_payments, dim, oc)
    assert fact.join(dim, "type_id", "left_anti").count() == 0
    assert fact.join(dim, "type_id").count() == fact.count()


def test_8_published_tables_read_back_equal(spark, mp, out_dir):
    from stellate.plans import build_mart, read_back

    pub = build_mart(spark, mp, f"{out_dir}/mart")
    assert _rows(read_back(spark, pub.paths["dim_customer1"])) == _rows(mart.dim_customer_slim(mp.customer_orders))
    assert read_back(spark, pub.paths["fact"]).count() == Q["fact_order_payments"](spark, SMOKE).count()
    assert _rows(read_back(spark, pub.paths["dim_payments"])) == _rows(Q["dim_payments"](spark, SMOKE))
