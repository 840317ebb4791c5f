"""Layouts of the published fact: months pruned by the calendar, row groups skipped by key."""

import pytest
from pyspark.sql import functions as F

from data_dirs import SMALL, SMOKE
from stellate.operators import quality as q
from stellate.plans import catalog, layout, mart
from stellate.plans.catalog import QUERIES


def leaf_metrics(df):
    """{table format scan: metric values} of the final plan, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan


def scans(plan):
    """Metrics of every file scan below ``plan``, query stages included."""
    out, stack = [], [plan]
    while stack:
        p = stack.pop()
        name = p.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            m, got = p.metrics(), {}
            for key in ("numFiles", "numOutputRows", "numPartitions"):
                if m.contains(key):
                    got[key] = m.apply(key).value()
            out.append((p.relation().location().rootPaths().head().toString(), got))
        if name.endswith("QueryStageExec"):
            stack.append(p.plan())
        kids = p.children().iterator()
        while kids.hasNext():
            stack.append(kids.next())
    return out


def test_a_calendar_window_reads_the_months_it_needs(spark, out_dir):
    fact = catalog.fact_frame(spark, SMOKE)
    layout.write_by_month(fact, f"{out_dir}/fact")
    stored = spark.read.parquet(f"{out_dir}/fact")
    days = mart.calendar_for(fact, "order_purchase_timestamp", 1)
    calendar = layout.stored_calendar(spark, days, f"{out_dir}/calendar")
    got = layout.in_calendar_window(stored, calendar, 19950310, 19950520, ("date_key", "month_name"))
    plan = leaf_metrics(got)
    assert "dynamicpruning" in plan.toString().lower()
    read = next(m for path, m in scans(plan) if path.endswith("/fact"))
    assert read["numPartitions"] == 3  # March, April and May
    total = stored.select(layout.MONTH).distinct().count()
    assert total > 20
    want = fact.where(F.to_date("order_purchase_timestamp").between("1995-03-10", "1995-05-20"))
    assert got.count() == want.count() > 0
    assert got.select(*fact.columns).exceptAll(want).count() == 0


def test_window_edges_and_null_dates(spark, out_dir):
    rows = [(1, "1999-12-31 23:59:59"), (2, "2000-01-01 00:00:00"), (3, "2000-02-29 12:00:00"), (4, None), (5, "2000-03-01 00:00:00")]
    fact = spark.createDataFrame(rows, "k int, t string").select("k", F.to_timestamp("t").alias("order_purchase_timestamp"))
    layout.write_by_month(fact, f"{out_dir}/f")
    stored = spark.read.parquet(f"{out_dir}/f")
    assert stored.count() == 5
    calendar = layout.stored_calendar(spark, mart.calendar_for(fact, "order_purchase_timestamp", 1), f"{out_dir}/c")
    got = layout.in_calendar_window(stored, calendar, 20000101, 20000229)
    assert sorted((r["k"], r["date_key"]) for r in got.collect()) == [(2, 20000101), (3, 20000229)]
    assert layout.in_calendar_window(stored, calendar, 20010101, 20001231).count() == 0


# a customer's orders lie all over the order ids, so most row groups of this small table hold some
@pytest.mark.parametrize("column,value,part", [("order_id", 5979, 0.5), ("customer_id", 899, 0.75)])
def test_lookups_skip_row_groups(spark, out_dir, column, value, part):
    fact = catalog.fact_frame(spark, SMALL).repartition(4)
    small = 256 * 1024
    fact.write.option("parquet.block.size", small).parquet(f"{out_dir}/plain")
    clustered = layout.write_clustered(fact, f"{out_dir}/clustered", "order_id", ["customer_id"], 20_000, small)
    plain = spark.read.parquet(f"{out_dir}/plain")
    counts = {}
    for name, table in (("plain", plain), ("clustered", clustered)):
        found = q.lookup(table, **{column: value})
        counts[name] = sum(m["numOutputRows"] for _, m in scans(leaf_metrics(found)))
        assert found.count() == fact.where(F.col(column) == value).count() > 0
    assert counts["clustered"] < counts["plain"] * part, counts
    absent = q.lookup(clustered, customer_id=-5)
    assert sum(m["numOutputRows"] for _, m in scans(leaf_metrics(absent))) == 0


def test_a_value_inside_the_range_but_absent_is_skipped_by_the_filter(spark, out_dir):
    # even keys only: minimum and maximum cannot tell that an odd one is missing, the bloom filter can
    df = spark.range(0, 200_000, 2).select(F.col("id").alias("k"), F.xxhash64("id").alias("x"), (F.col("id") * 7919 % 200_000).alias("s"))
    table = layout.write_clustered(df, f"{out_dir}/t", "x", ["k"], 100_000, 512 * 1024)
    # a handful of false positives in a hundred probes is what the filter allows
    read = [sum(m["numOutputRows"] for _, m in scans(leaf_metrics(q.lookup(table, k=k)))) for k in range(1001, 1021, 2)]
    assert sum(r == 0 for r in read) >= 8, read


def test_registered_window_and_lookups(spark):
    got = QUERIES["fact_in_calendar_window"](spark, SMOKE)
    assert "dynamicpruning" in leaf_metrics(got).toString().lower() and got.count() > 0
    assert QUERIES["stored_order_lookup"](spark, SMALL).count() == 7
