import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import blocknn
from stellate.llm.catalog import QUERIES

NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, k=20, step=20):
    rows = [(i, n, v) for n, (i, v) in enumerate(rows) if usable(v)]
    out = []
    for q, own, x in rows:
        if q is None or q % step:
            continue
        found = []
        for c, n, y in rows:
            if n != own and len(x) == len(y):
                total = 0.0
                for a, b in zip(x, y, strict=True):
                    total += float(np.float32(a)) * float(np.float32(b))
                found.append((-total, (1 << 63) - 1 if c is None else c, c, total))
        found.sort(key=lambda f: f[:2])
        out += [(q, r, c, score) for r, (_, _, c, score) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


@pytest.fixture()
def search(spark):
    def run(rows, parts=4, **settings):
        # clashing column names are not read
        full = [(i, v, 0, 1, 2.0) for i, v in rows]
        frame = spark.createDataFrame(full, "vec_id bigint, embedding array<float>, q int, id int, score double")
        s = blocknn.Settings(**settings)
        return rows_of(blocknn.nearest(frame.repartition(parts), F.col("vec_id") % 20 == 0, settings=s))

    return run


def cloud(n, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return [(i, [float(np.float32(x)) for x in centres[i % 4] + rng.normal(scale=0.4, size=dim)]) for i in range(n)]


ODD = [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [1.0, None] + [0.0] * 10), (1020, [NAN] + [1.0] * 11),
       (1040, [INF] + [1.0] * 11), (1060, [1.0, 2.0, 3.0]), (1061, [3.0, 1.0, 0.5]), (-20, [5.0] * 12), (None, [4.0] * 12),
       (1080, [1e-30] * 12), (1100, [1e18] + [1e-18] * 11), (20, [0.5, -0.25] * 6), (20, [0.5, -0.25] * 6), (41, [-0.0] + [2.0] * 11)]


@pytest.mark.parametrize("settings", [
    {}, {"block": 64, "least_block": 16}, {"block": 50, "least_block": 1, "crowd": 1, "chunk": 7}, {"k": 1, "block": 64, "least_block": 16},
])
def test_equals_brute_force(search, settings):
    rows = cloud(400) + ODD
    assert search(rows, **settings) == brute(rows, settings.get("k", 20))


@pytest.mark.parametrize("crowd", [4, 100_000])
def test_a_third_in_copies_and_a_third_in_near_copies(search, crowd):
    rng = np.random.default_rng(9)
    hot = [0.25, -1.0, 0.5, 0.75] * 3
    rows = [(i, hot if i % 3 == 0 else [float(np.float32(x + rng.normal(scale=1e-6))) for x in hot] if i % 3 == 1 else v)
            for i, v in cloud(600)]
    assert search(rows, block=128, least_block=32, crowd=crowd) == brute(rows)


def test_blocks_without_candidates(search):
    """More blocks than vectors: some are empty, and the crowded tiles still meet their own candidates."""
    rows = [(i, [float(np.float32(1 + 2.4e-7 * (i * 7 % 60))), 1.0, 1.0]) for i in range(60)]
    for block in (1, 3):
        assert search(rows, k=2, block=block, least_block=1, crowd=0) == brute(rows, 2)


def test_a_tile_sends_few_rows_of_crowded_queries(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in 1 + rng.normal(scale=1e-6, size=8)]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "id bigint, vector array<double>")
    classes = frame.select("id", F.lit(8).alias("dim"), (F.col("id") % 20 == 0).alias("asked"), "vector")
    s = blocknn.Settings(block=1024, least_block=1024, crowd=64)
    found, _ = blocknn._survivors(classes, s)
    most = found.groupBy("q", "gc").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert found.where("kind = 2").count() > 0 and most <= s.k + 2


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-127, 128, (40, 3000)).astype(np.int8), rng.integers(-127, 128, (30, 3000)).astype(np.int8)
    assert (blocknn._products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


def test_fewer_rows_than_asked_for_and_none(search):
    assert search([]) == []
    assert search([(0, [1.0])]) == []
    rows = [(0, [1.0, 2.0]), (5, [2.0, 1.0]), (7, [-1.0, -1.0])]
    assert search(rows) == brute(rows)
    assert search([(i, [1.0, float(i)]) for i in (1, 2, 3)]) == []


def test_very_long_vectors(search):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=2500)]) for i in range(40)]
    assert search(rows, k=3) == brute(rows, 3)


def test_registered_query(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = rows_of(QUERIES["op11_block_nearest"](spark, "/root/testdata/sf0.001"))
    assert got == brute([(r.vec_id, r.embedding) for r in t.select("vec_id", "embedding").collect()])
