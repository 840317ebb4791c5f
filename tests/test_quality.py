"""Audits: duplicate keys / rows, whole-row duplicates, counts, profiles, lookups."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from fixtures import reviews
from stellate.operators import (
    date_profile,
    distinct_count,
    distinct_per_group,
    duplicate_key_values,
    duplicate_keys,
    duplicate_rows,
    full_row_duplicates,
    lookup,
    min_max_profile,
    row_count,
)


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_counts(spark):
    rv = reviews(spark)
    assert row_count(rv).first()["row_count"] == 7
    # distinct then count: NULL is one value of its own (r1, r2, r3, NULL)
    assert distinct_count(rv, "review_id").first()["distinct_count"] == 4
    assert rv.select(F.countDistinct("review_id")).first()[0] == 3


def test_duplicate_keys_groups_null_once(spark):
    rv = reviews(spark)
    got = {r["review_id"]: r["count"] for r in duplicate_keys(rv, "review_id").collect()}
    assert got == {"r1": 2, "r2": 2, None: 2}
    assert {r[0] for r in duplicate_key_values(rv, "review_id").collect()} == {"r1", "r2", None}


def test_duplicate_pairs(spark):
    rv = reviews(spark)
    got = _rows(duplicate_key_values(rv, ["review_id", "order_id"]))
    assert [g for g in got if g[0] is not None] == [("r2", "o3")]


def test_semi_and_join_agree_and_drop_null_keys(spark):
    rv = reviews(spark)
    semi = duplicate_rows(rv, "review_id", how="semi")
    join = duplicate_rows(rv, "review_id", how="join", order_by=rv.columns)
    assert semi.columns == rv.columns == join.columns
    assert _rows(semi) == _rows(join)
    ids = [r["review_id"] for r in join.collect()]
    assert ids == ["r1", "r1", "r2", "r2"]  # ordered, NULL ids lost in the join


def test_skewed_key_stays_whole(spark):
    # one key holds a third of the rows: results are complete, nothing capped
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id")
    )
    dup = duplicate_keys(hot, "k")
    assert dup.collect()[0]["count"] == 10000
    rows = duplicate_rows(hot, "k", how="join", order_by=["k", "id"])
    assert rows.count() == 10000
    assert rows.agg(F.min("id"), F.max("id")).first() == (0, 29997)


def test_full_row_duplicates(spark):
    rv = reviews(spark)
    got = full_row_duplicates(rv).collect()
    assert len(got) == 1
    assert got[0]["review_id"] == "r2" and got[0]["c"] == 2
    assert full_row_duplicates(rv).columns == rv.columns + ["c"]
    # lookups and key checks over the duplicates (follow-up audits)
    assert lookup(full_row_duplicates(rv), order_id="o3").count() == 1
    assert duplicate_keys(full_row_duplicates(rv), "review_id", count_col="c").count() == 0


def test_distinct_per_group(spark):
    rv = reviews(spark)
    got = {r["review_id"]: r["c"] for r in distinct_per_group(rv, "review_id", "order_id").collect()}
    # r1 -> {o1, o2}; NULL review ids group together too -> {o5, o6}
    assert got == {"r1": 2, None: 2}


def test_profiles(spark):
    rv = reviews(spark)
    prof = min_max_profile(
        rv,
        {
            "min_created": F.min(F.to_date("review_creation_date")),
            "max_answer": F.max("review_answer_timestamp"),
        },
    ).first()
    assert prof["min_created"] == dt.date(2017, 1, 2)
    assert prof["max_answer"] == dt.datetime(2017, 4, 3)
    p2 = date_profile(rv, ["review_creation_date"]).first()
    assert p2["min_review_creation_date"] == dt.datetime(2017, 1, 2)
    assert p2["max_review_creation_date"] == dt.datetime(2017, 4, 1)


def test_lookup(spark):
    rv = reviews(spark)
    assert lookup(rv, review_id="r1").count() == 2
    assert lookup(rv, review_id="r1", order_id="o2").count() == 1
    assert lookup(rv, review_id="nope").count() == 0


def test_hot_key_in_duplicate_rows_is_spread(spark):
    """A key with a third of the rows never lands in one task.

    Within the bound the key set is broadcast (no shuffle of the rows); beyond
    it the hot key is salted over many partitions. Both give every row.
    """
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50000).alias("k"),
        F.col("id").alias("v"),
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("semi", "join"):
            small = duplicate_rows(df, "k", how=how)
            plan = _plan(small)
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
            assert small.count() == n

            salted = duplicate_rows(df, "k", how=how, max_rows=10, hot_rows=10_000)
            plan = _plan(salted)
            assert "hashpartitioning(k#" in plan and "_stellate_salt" in plan
            assert salted.count() == n
            assert salted.agg(F.sum("v")).first()[0] == n * (n - 1) // 2
            # where the hot key's rows sit after the join (coalescing off, so the
            # join's own partitions are seen, not AQE's merge of small ones)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            per_task = (salted.withColumn("p", F.spark_partition_id()).where("k = -1")
                        .groupBy("p").count().agg(F.count(F.lit(1)), F.max("count")).first())
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
            assert per_task[0] >= 4, per_task          # spread over several tasks
            assert per_task[1] < n // 3, per_task     # no task holds the whole hot key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sort_spreads_a_hot_sort_key(spark):
    from stellate.operators import ordered

    n = 200_000
    # a third of the rows share one value of the sort key (their other column differs)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ordered(df, ["k"]).withColumn("p", F.spark_partition_id())
        rows = out.collect()
        assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)  # still ordered by k
        assert len(rows) == n
        hot = Counter(r["p"] for r in rows if r["k"] == -1)
        assert len(hot) >= 2 and max(hot.values()) < n // 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
