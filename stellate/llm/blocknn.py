"""Exact nearest neighbours by inner product as a block matrix join over 8-bit vectors.

1. Vectors with the same components are one class; of its rows only the first
   ``k + 1`` by id can be among anyone's ``k`` nearest, so those are its members.
2. Each class vector x is rounded to 8-bit integers times a scale; with x' the
   rounded vector, |<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'|. The three
   norms travel with the integers.
3. Query classes and candidate classes are dealt into blocks, and every query
   block meets every candidate block in one task (a cogroup on the pair of block
   numbers): one integer product tile, from which each pair has a lower and an
   upper bound. A pair survives in its tile if its upper bound reaches the
   ``k + 1``-th lower bound there.
4. Over all tiles, pairs survive if they reach the ``k + 1``-th lower bound of
   their query. They are recomputed from the original vectors in double
   precision, summed component by component, and merged by heaps of k + 1.
5. Vectors that lie closer together than the rounding can tell leave many
   survivors. A (query, tile) with more than ``crowd`` of them sends a mark
   instead; marked queries meet the tile's original vectors in one task, where
   they are computed in double precision and only the best ``k + 1`` leave it.
   So a tile sends a bounded number of rows for a query, whatever the data.
6. Classes are replaced by their members, each query drops itself, and ``k`` stay.

The result is exact. Tasks hold one tile's blocks; only block numbers, counts and
bounds meet the driver (two counts). Work is queries times rows by definition;
what is shuffled for it is the rows' 8-bit form, once for each query block.

Null vectors, vectors with a null or non-finite component, all-zero and empty ones
take no part, neither as queries nor as candidates; a vector of another length is
no candidate. Rows that repeat an id are rows of their own: each excludes only
itself. Null ids are candidates (after all others in ties) and never queries.
With fewer candidates than ``k`` all are returned. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze
from stellate.session import default_parallelism

PAIR, BOUND, MARK = 0, 1, 2
FOUND = "dim int, gq int, gc int, q bigint, c bigint, lo double, hi double, kind int"
SCORED = "q bigint, c bigint, score double"
EXACT_DIMS = 1024  # 8-bit products over so many components are exact in single precision


@dataclass(frozen=True)
class Settings:
    k: int = 20
    block: int = 16_384  # vectors of a block at most, about
    least_block: int = 1024
    crowd: int = 256  # survivors of a query in a tile beyond which the tile is computed exactly
    chunk: int = 256  # queries of a tile computed at once


def _quantised():
    @F.arrow_udf("struct<x:binary,scale:double,err:double,norm:double,near:double>")
    def quantise(vectors):
        import pyarrow as pa

        out = []
        for v in vectors:
            x = np.array(v.as_py(), np.float64)
            scale = float(np.abs(x).max()) / 127
            whole = np.rint(x / scale)
            near = whole * scale
            norms = (float(np.linalg.norm(y)) for y in (x - near, x, near))
            out.append((whole.astype(np.int8).tobytes(), scale, *norms))
        kinds = (pa.binary(), *[pa.float64()] * 4)
        arrays = [pa.array(a, t) for a, t in zip(zip(*out, strict=True) if out else [()] * 5, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, ["x", "scale", "err", "norm", "near"])

    return quantise


def _columns(table, *names):
    return [table.column(n).to_numpy() for n in names]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of the rows of two int8 matrices, exactly."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, at : at + EXACT_DIMS].astype(np.float32) @ b[:, at : at + EXACT_DIMS].T.astype(np.float32)
    return out


def _tile(s: Settings):
    """Survivors of one tile: the pairs, or a mark and the best bounds of a crowded query."""

    def tile(key, queries, candidates):
        import pyarrow as pa

        dim, gq, gc = (x.as_py() for x in key)
        crowd = max(s.crowd, s.k + 1)
        rows: list[tuple] = []
        if queries.num_rows and candidates.num_rows:
            q, qs, qe, qn, qh = _columns(queries, "id", "scale", "err", "norm", "near")
            c, cs, ce, cn = _columns(candidates, "id", "scale", "err", "norm")
            sides = [np.frombuffer(b"".join(t.column("x").to_pylist()), np.int8).reshape(-1, dim) for t in (queries, candidates)]
            for at in range(0, len(q), s.chunk):
                part = slice(at, at + s.chunk)
                near = _products(sides[0][part], sides[1]) * qs[part, None] * cs
                # the last term covers the rounding of double precision itself
                off = qe[part, None] * cn + qh[part, None] * ce + 1e-12 * qn[part, None] * cn
                low, high = near - off, near + off
                if len(c) > s.k + 1:
                    least = np.partition(low, len(c) - s.k - 1, axis=1)[:, len(c) - s.k - 1]
                else:
                    least = np.full(len(low), -np.inf)
                alive = high >= least[:, None]
                many = alive.sum(1)
                for i, n in enumerate(many):
                    kind, found = PAIR, np.flatnonzero(alive[i])
                    if n > crowd:
                        rows.append((dim, gq, gc, q[at + i], -1, float(least[i]), float(high[i].max()), MARK))
                        kind, found = BOUND, np.argpartition(low[i], len(c) - s.k - 1)[len(c) - s.k - 1 :]
                    rows += [(dim, gq, gc, q[at + i], c[j], float(low[i, j]), float(high[i, j]), kind) for j in found]
        names = [f.split()[0] for f in FOUND.split(", ")]
        kinds = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.float64()] * 2 + [pa.int32()]
        cols = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.table({n: pa.array(v, t) for n, v, t in zip(names, cols, kinds, strict=True)})

    return tile


def _exact_tile(s: Settings):
    """The best ``k + 1`` candidates of each query of a tile, in double precision."""

    def tile(key, queries, candidates):
        import pyarrow as pa

        q, c, score = [], [], []
        if queries.num_rows and candidates.num_rows:
            ids, first = _columns(candidates, "id", "first")
            vectors = np.array(candidates.column("vector").to_pylist(), np.float64).T
            for i, x in zip(queries.column("id").to_pylist(), queries.column("vector").to_pylist(), strict=True):
                total = np.zeros(len(ids))
                for a, column in zip(x, vectors, strict=True):  # one after another, as the pairs are summed
                    total += a * column
                for j in np.lexsort((ids, first, -total))[: s.k + 1]:
                    q.append(i)
                    c.append(ids[j])
                    score.append(total[j])
        return pa.table({"q": pa.array(q, pa.int64()), "c": pa.array(c, pa.int64()), "score": pa.array(score, pa.float64())})

    return tile


def _heaps(k: int):
    """Of each query's rows in a partition the best ``k``."""

    def merge(batches):
        import pyarrow as pa

        best: dict[int, list[tuple]] = {}
        for b in batches:
            for q, c, first, score in zip(*(x.to_pylist() for x in b.columns), strict=True):
                heap = best.setdefault(q, [])
                entry = (score, -first, -c)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
        rows = [(q, -c, -first, score) for q, heap in best.items() for score, first, c in heap]
        cols = zip(*rows, strict=True) if rows else [()] * 4
        kinds = [pa.int64()] * 3 + [pa.float64()]
        arrays = [pa.array(v, t) for v, t in zip(cols, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["q", "c", "first", "score"])

    return merge


def _usable(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _survivors(classes: DataFrame, s: Settings) -> tuple[DataFrame, Column]:
    """Pairs, bounds and marks of all tiles; and the candidate block of a class, by its id."""
    rounded = classes.select("id", "dim", "asked", _quantised()("vector").alias("r")).select("id", "dim", "asked", "r.*")
    rounded = freeze(rounded, "rounded")
    n, n_asked = rounded.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    # small tables make smaller blocks, so that all cores have tiles; the result is the same
    size = min(s.block, max(s.least_block, n // (2 * default_parallelism(classes.sparkSession))))
    blocks_c, blocks_q = -(-n // size), -(-n_asked // size)
    block = F.xxhash64("id")
    gc = F.pmod(block, F.lit(max(blocks_c, 1))).cast("int")
    gq = F.pmod(block, F.lit(max(blocks_q, 1))).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1)))

    queries = rounded.where("asked").withColumn("gq", gq).withColumn("gc", every(blocks_c))
    candidates = rounded.withColumn("gc", gc).withColumn("gq", every(blocks_q))
    keys = ("dim", "gq", "gc")
    tiles = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(_tile(s), FOUND)
    return freeze(tiles, "tiles"), gc


def _scored(classes: DataFrame, s: Settings) -> DataFrame:
    """q, c, score in double precision for pairs that hold the ``k + 1`` best of every query class."""
    found, gc = _survivors(classes, s)
    order = Window.partitionBy("q").orderBy(F.desc("lo"))
    least = found.where(F.col("kind") != MARK).withColumn("n", F.row_number().over(order)).where(F.col("n") == s.k + 1)
    alive = found.join(least.select("q", F.col("lo").alias("least")), "q", "left")
    alive = alive.where(F.coalesce(F.col("hi") >= F.col("least"), F.lit(True))).drop("least")
    alive = freeze(alive, "alive")

    vectors = classes.select("id", "vector")
    left = vectors.select(F.col("id").alias("q"), F.col("vector").alias("_x"))
    right = vectors.select(F.col("id").alias("c"), F.col("vector").alias("_y"))
    pairs = alive.where(F.col("kind") == PAIR).select("q", "c").join(right, "c").join(left, "q")
    products = F.zip_with("_x", "_y", lambda x, y: x.cast("double") * y.cast("double"))
    single = pairs.select("q", "c", F.aggregate(products, F.lit(0.0), lambda a, b: a + b).alias("score"))

    marks = alive.where(F.col("kind") == MARK).select("dim", "gq", "gc", "q")
    tiles = marks.select("dim", "gq", "gc").distinct().toDF("dim", "gq", "gc")  # columns of its own
    asked = marks.join(left, "q").select("dim", "gq", "gc", F.col("q").alias("id"), F.col("_x").alias("vector"))
    near = classes.select("dim", gc.alias("gc"), "id", "first", "vector").join(tiles, ["dim", "gc"])
    keys = ("dim", "gq", "gc")
    crowded = asked.groupBy(*keys).cogroup(near.groupBy(*keys)).applyInArrow(_exact_tile(s), SCORED)
    return single.unionByName(crowded)


def nearest(
    vectors: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product for each row that ``queries`` marks.

    ``queries`` is a condition on the id column, which it sees as ``vec_id``.
    """
    s = settings
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(_usable("vector"))
    rows = own.withColumn("asked", F.coalesce(queries & F.col("vec_id").isNotNull(), F.lit(False)))
    # numbered as they are written: read again after a lost executor, a scan may be dealt otherwise
    rows = freeze(rows.withColumn("key", content_key("vector")).withColumn("id", F.monotonically_increasing_id()), "vectors")
    # the id that decides ties; null ids come after all others
    rows = rows.withColumn("first", F.coalesce("vec_id", F.lit((1 << 63) - 1)))
    placed = Window.partitionBy("key").orderBy("first", "id")
    members = rows.withColumn("n", F.row_number().over(placed)).where(F.col("n") <= s.k + 1)
    members = freeze(members.select("key", "id", "first", "vec_id", "vector", "n"), "members")
    asked = rows.where("asked").select("key").distinct().withColumn("asked", F.lit(True))
    classes = members.where("n = 1").join(asked, "key", "left").select(
        "id", "first", "vector", F.size("vector").alias("dim"), F.coalesce("asked", F.lit(False)).alias("asked"), "key"
    )
    classes = freeze(classes, "classes")

    heads = classes.select(F.col("id").alias("c"), "first")
    scored = _scored(classes, s).join(heads, "c").select("q", "c", "first", "score")
    best = scored.mapInArrow(_heaps(s.k + 1), "q bigint, c bigint, first bigint, score double")
    by_class = Window.partitionBy("q").orderBy(F.desc("score"), "first", "c")
    best = best.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= s.k + 1).select("q", "c", "score")
    held = members.join(classes.select("key", F.col("id").alias("c")), "key").select("c", "id", "first", "vec_id")
    by_row = Window.partitionBy("q").orderBy(F.desc("score"), "first", "id")
    lists = best.join(held, "c").withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= s.k + 1)
    lists = freeze(lists.select("q", "id", "first", "vec_id", "score"), "lists")

    heads = freeze(classes.where("asked").select("key", F.col("id").alias("q")), "heads")
    asking = rows.where("asked").select("key", F.col("vec_id").alias("query_id"), F.col("id").alias("own"))
    asking = freeze(asking.join(heads, "key").select("q", "query_id", "own"), "asking")
    order = Window.partitionBy("own").orderBy(F.desc("score"), "first", "id")
    ranked = asking.join(lists, "q").where("own <> id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
