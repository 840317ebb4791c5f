"""Every registered query vs its DuckDB oracle on the smoke tables, plus plan checks."""

import contextlib
import datetime as dt
import io
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stellate.plans import catalog
from data_dirs import SMOKE
from stellate.sources.tables import DRIVER_TABLES

QUERIES = catalog.QUERIES  # the training-text queries have tests of their own
ORACLE = catalog.ORACLE


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_id" and "type_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    assert df.columns == cols
    assert Counter(got) == Counter(want)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


PLAN_SKIP = {n for n in QUERIES if n.startswith("published_")}  # these write when called


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PLAN_SKIP))
def test_plans_stay_jvm_side_without_cross_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SMOKE))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name} uses {bad}"


def test_lookup_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["payment_lookup"](spark, SMOKE))
    assert "PushedFilters: [IsNotNull(l_orderkey), EqualTo(l_orderkey,5979)]" in plan
    plan = _plan(QUERIES["customer_lookup_by_unique"](spark, SMOKE))
    assert "EqualTo(c_name,Customer#000000001)" in plan


def test_fact_scans_only_needed_columns(spark):
    plan = _plan(QUERIES["fact_order_payments"](spark, SMOKE))
    assert ("ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,"
            "l_extendedprice:double,l_returnflag:string>") in plan
    # the payment-type dimension is materialised once, measured and broadcast:
    # the payments are never shuffled on the low-cardinality payment_type
    assert "Scan ExistingRDD" in plan and "BroadcastExchange" in plan
    assert "hashpartitioning(payment_type" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_duplicate_audit_uses_partial_aggregation(spark):
    plan = _plan(QUERIES["duplicate_ids_having"](spark, SMOKE))
    assert "partial_count" in plan


def test_fact_plan_without_static_broadcasts(spark):
    """As at scale, where no raw table is under the static threshold: the payments
    are shuffled once (on order_id), customers never on the nation key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["fact_order_payments"](spark, SMOKE)
        df.collect()
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(payment_type" not in plan
    assert "hashpartitioning(c_nationkey" not in plan and "hashpartitioning(_nk" not in plan
    assert "hashpartitioning(order_id" in plan


def test_published_samples_survive_later_publishes(spark):
    """Build every published sample first, publish again, then collect them all."""
    held = {n: QUERIES[n](spark, SMOKE) for n in sorted(QUERIES) if n.startswith("published_")}
    QUERIES["published_fact_sample"](spark, SMOKE)  # overwrites dim_payments and fact
    for name, df in held.items():
        assert 0 < df.count() <= 5, name


def test_delivery_days_are_expanded_in_many_tasks(spark, out_dir):
    """Some orders of few bytes and many days: adaptive execution must not leave them in one task."""
    day = dt.datetime(2000, 1, 1)
    spark.createDataFrame(
        [(k, 1, "O", day) for k in range(400)] + [(400, 1, "O", None), (None, 1, "O", day), (7, 2, "F", day)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp",
    ).coalesce(1).write.parquet(f"{out_dir}/orders.parquet")
    spark.createDataFrame(
        [(k, 1, 1, day + dt.timedelta(k - 1)) for k in range(401)] + [(None, 1, 1, day)],
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp",
    ).coalesce(1).write.parquet(f"{out_dir}/lineitem.parquet")
    days = QUERIES["delivery_days"](spark, out_dir)
    rows = Counter(r["order_id"] for r in days.collect())
    # an end before the start gives none, and a repeated order its days again
    assert rows == {k: k * (2 if k == 7 else 1) for k in range(1, 400)}
    used = days.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 4
