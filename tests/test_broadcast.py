"""Size-checked broadcasts: within the bound a hint, beyond it a shuffle join."""

import contextlib
import io

from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.functions import dense_key
from stellate.operators import broadcast_if_small, measured_size, translate


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_measured_size_counts_rows_and_string_bytes(spark):
    df = spark.createDataFrame([("ab", 1), ("cde", 2), (None, 3)], "s string, n int")
    rows, size = measured_size(df)
    assert rows == 3
    assert size == 3 * 4 + len("ab") + len("cde")


def test_small_side_is_broadcast(spark):
    big = spark.range(20000).select((F.col("id") % 7).alias("k"), "id")
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = big.join(broadcast_if_small(small), "k")
        plan = _plan(joined)
        assert "BroadcastHashJoin" in plan
        assert joined.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_side_over_the_bound_stays_a_shuffle_join(spark):
    big = spark.range(20000).select((F.col("id") % 500).alias("k"), "id")
    side = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    old = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"),
           spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        checked = broadcast_if_small(side, max_rows=100)  # 500 rows > bound
        joined = big.join(checked, "k")
        plan = _plan(joined)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 20000
        assert joined.agg(F.sum("v")).first()[0] == big.agg(F.sum(F.col("k") * 10)).first()[0]
        by_bytes = broadcast_if_small(side, max_bytes=100)  # 500 rows x 16 bytes > 100
        assert "BroadcastHashJoin" not in _plan(big.join(by_bytes, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        if old[1] is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])


def test_dense_key_multi_column_with_nulls(spark):
    rows = [(a, b) for a in (None, "x", "y") for b in (None, 1, 2)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(4)
    got = dense_key(df, ["a", "b"], "sk")
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    expect = df.select("a", "b", F.row_number().over(w).cast("bigint").alias("sk"))
    assert sorted(got.collect(), key=repr) == sorted(expect.collect(), key=repr)


def test_translate_fans_out_on_a_repeated_mapping_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, cat string")
    mapping = spark.createDataFrame([("a", "A1"), ("a", "A2"), ("b", "B")], "cat string, cat_en string")
    got = sorted(translate(df, mapping, on="cat", out="cat_en", key="id").collect(), key=repr)
    assert [tuple(r) for r in got] == sorted([(1, "A1"), (1, "A2"), (2, "B"), (3, None)], key=repr)
