"""Ranked lexical search for many items at once, sharing the work that items have in common.

Each item is a bag of terms; a document's score is the sum over the item's
terms of weight * saturated term frequency, all in 64-bit integers, so the order
of adding does not matter and parts of the sum can be shared exactly.

1. Items become queries: equal bags of terms are one query.
2. Shared term sets are mined. An element is (term, times in the query); the
   elements that occur in exactly the same queries form a class, found by two
   groupings (queries of an element, elements of a list of queries).
3. Over the classes a query-sharing DAG is built: the two nodes that most queries
   contain together become a node of their own, again and again, until no two
   nodes are together in two queries.
4. An index pass cuts every whole document into terms once and writes, for each,
   its length and the frequencies of the terms that any query has. Document
   count, total length and document frequencies are aggregates of it.
5. A scoring pass reads the index in batches. The partial accumulator of each
   class is made once for a document and then combined along the DAG: each node
   is one addition, however many queries use it. Every task keeps the best
   ``top`` documents of each query; these are merged by window functions, first
   within buckets of partitions, then over them.

Queries are dealt into blocks of at most about ``block_terms`` elements; what is
sent to tasks is one block's terms, weights and DAG, so its size is bounded
whatever the number of items; more blocks are more passes over the documents.

Documents without text or terms rank nowhere and count in no statistic; an item
without terms, or whose terms no document has, has no rows. Rows that repeat are
documents of their own, items that repeat are ranked each; rank is unique, equal
scores go by ascending document id, null ids first. Texts of any length are read
whole. Empty tables give no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import freeze, whole
from stellate.operators.broadcast import broadcast_if_small

# A-Z in lower case; ASCII other than letters and digits separates; bytes of other characters are letters
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Settings:
    top: int = 10
    block_terms: int = 50_000  # elements of the queries in one block, about
    batch_cells: int = 1_500_000  # accumulators held at once in a task
    mined: int = 200  # nodes of a query whose pairs are mined, those of most queries first; the rest are added singly
    merge_buckets: int = 64


def terms(text: str) -> list[bytes]:
    """The text's terms with repeats, as UTF-8."""
    return text.encode("utf-8", "replace").translate(TABLE).split()


@dataclass(frozen=True)
class Plan:
    """How the queries of a block are summed up.

    Node k is the accumulator of class k; node ``classes + j`` is the sum of
    the two nodes ``sums[j]``; a query is the sum of its ``roots``.
    """

    elements: list[tuple[str, int, int]]  # term, times, class
    classes: int
    sums: list[tuple[int, int]]
    roots: list[list[int]]
    names: list[str]

    def additions(self) -> int:
        """Additions of nodes that a document costs."""
        return len(self.sums) + sum(max(len(r) - 1, 0) for r in self.roots)


def share(queries: list[set[int]], classes: int, mined: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """The DAG over ``queries`` (sets of class numbers): sums of two nodes and each query's roots."""
    queries = [set(q) for q in queries]
    uses = Counter(k for q in queries for k in q)
    together: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i, q in enumerate(queries):
        nodes = sorted(sorted((k for k in q if uses[k] > 1), key=lambda k: (-uses[k], k))[:mined])
        for at, a in enumerate(nodes):
            for b in nodes[at + 1 :]:
                together[a, b].add(i)
    waiting = [(-len(users), pair) for pair, users in together.items() if len(users) > 1]
    heapq.heapify(waiting)
    sums: list[tuple[int, int]] = []
    while waiting:
        count, pair = heapq.heappop(waiting)
        users = together.get(pair, set())
        if len(users) != -count:  # out of date
            if len(users) > 1:
                heapq.heappush(waiting, (-len(users), pair))
            continue
        node = classes + len(sums)
        sums.append(pair)
        grown: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i in list(users):
            q = queries[i]
            q.difference_update(pair)
            for other in q:
                for gone in pair:
                    together[min(gone, other), max(gone, other)].discard(i)
                grown[other, node].add(i)
            q.add(node)
        together.pop(pair)
        for new, who in grown.items():
            together[new] = who
            if len(who) > 1:
                heapq.heappush(waiting, (-len(who), new))
    return sums, [sorted(q) for q in queries]


def _bags_udf():
    @F.arrow_udf("array<struct<term:string,times:int>>")
    def bags(texts):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("term", pa.string()), ("times", pa.int32())]))
        out = []
        for t in texts:
            found = sorted(Counter(terms(t.as_py())).items())
            out.append([{"term": w.decode(), "times": n} for w, n in found])
        return pa.array(out, kind)

    return bags


def queries_of(items: DataFrame, text: str) -> DataFrame:
    """``items`` with ``_bag``, its terms in order with their times, and ``_query``, the same for equal bags."""
    bag = items.withColumn("_bag", _bags_udf()(whole(text))).where(F.size("_bag") > 0)
    return bag.withColumn("_query", F.sha2(F.to_json("_bag"), 256))


def plans(queries: DataFrame, s: Settings) -> list[Plan]:
    """One plan for each block of ``queries`` (_query, _bag)."""
    sized = queries.agg(F.sum(F.size("_bag").cast("long"))).first()[0] or 0
    blocks = -(-int(sized) // s.block_terms)
    block = F.pmod(F.xxhash64("_query"), F.lit(max(blocks, 1)))
    elements = freeze(
        queries.select(block.alias("block"), "_query", F.explode("_bag").alias("e")).select("block", "_query", "e.*"),
        "elements",
    )
    used = elements.groupBy("block", "term", "times").agg(F.sort_array(F.collect_list("_query")).alias("users"))
    classes = used.groupBy("block", "users").agg(F.sort_array(F.collect_list(F.struct("term", "times"))).alias("terms"))
    classes = freeze(classes, "classes")
    out = []
    for n in range(blocks):
        rows = classes.where(F.col("block") == n).orderBy("terms").collect()  # one block: bounded
        names = sorted({u for r in rows for u in r["users"]})
        number = {u: i for i, u in enumerate(names)}
        members: list[set[int]] = [set() for _ in names]
        listed = []
        for k, r in enumerate(rows):
            listed += [(t["term"], t["times"], k) for t in r["terms"]]
            for u in r["users"]:
                members[number[u]].add(k)
        if names:
            sums, roots = share(members, len(rows), s.mined)
            out.append(Plan(listed, len(rows), sums, roots, names))
    return out


def index(docs: DataFrame, vocabulary: list[str], doc_id: str, text: str) -> DataFrame:
    """doc_id, n (terms of the document), terms and tf: the numbers and frequencies of terms in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast({w.encode(): i for i, w in enumerate(vocabulary)})

    @F.arrow_udf("struct<n:bigint,terms:array<int>,tf:array<bigint>>")
    def count(texts):
        import pyarrow as pa

        known = shared.value
        n, offsets, ids, tfs = [], [0], [], []
        for t in texts:
            words = terms(t.as_py())
            n.append(len(words))
            for w, c in Counter(words).items():
                k = known.get(w)
                if k is not None:
                    ids.append(k)
                    tfs.append(c)
            offsets.append(len(ids))
        at = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in ((ids, pa.int32()), (tfs, pa.int64()))]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), *lists], ["n", "terms", "tf"])

    own = docs.select(F.col(doc_id).alias("doc_id"), count(whole(text)).alias("s"))
    return freeze(own.select("doc_id", "s.*").where("n > 0"), "index")


class _Combiner:
    """Scores of a batch of documents under a plan, and the best documents so far."""

    def __init__(self, plan: Plan, numbers: dict[str, int], weights: np.ndarray, docs: int, length: int, s: Settings):
        self.plan, self.weights, self.docs, self.length, self.top = plan, weights, docs, length, s.top
        by_term: list[list[tuple[int, int]]] = [[] for _ in numbers]
        for term, times, k in plan.elements:
            by_term[numbers[term]].append((times, k))
        self.starts = np.cumsum([0, *map(len, by_term)])
        flat = [e for es in by_term for e in es]
        self.times = np.array([t for t, _ in flat], np.int64)
        self.classes = np.array([k for _, k in flat], np.int64)
        self.nodes = plan.classes + len(plan.sums)
        self.batch = max(1, s.batch_cells // max(self.nodes, 1))
        self.floor = np.ones(len(plan.roots), np.int64)  # the least score that may enter
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in plan.roots]

    def add(self, ids: list[int | None], n: np.ndarray, offsets: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        size = len(ids)
        m = 25 + (75 * n * self.docs) // self.length
        row = np.repeat(np.arange(size), np.diff(offsets))
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        # each term once for every element that has it
        first, many = self.starts[term], self.starts[term + 1] - self.starts[term]
        at = np.repeat(first - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        cells = np.zeros((self.nodes, size), np.int64)
        np.add.at(cells, (self.classes[at], np.repeat(row, many)), np.repeat(part, many) * self.times[at])
        for j, (a, b) in enumerate(self.plan.sums, self.plan.classes):
            np.add(cells[a], cells[b], out=cells[j])
        for i, roots in enumerate(self.plan.roots):
            total = cells[roots].sum(0) if len(roots) > 1 else cells[roots[0]]
            for j in np.flatnonzero(total >= self.floor[i]):
                self._offer(i, int(total[j]), ids[j])

    def _offer(self, i: int, score: int, doc: int | None) -> None:
        best = self.best[i]
        entry = (score, int(doc is None), 0 if doc is None else -doc)  # of equal scores null, then the smallest id
        if len(best) < self.top:
            heapq.heappush(best, entry)
        else:
            heapq.heappushpop(best, entry)
        if len(best) == self.top:
            self.floor[i] = best[0][0]

    def rows(self):
        for i, best in enumerate(self.best):
            for score, null, doc in best:
                yield self.plan.names[i], None if null else -doc, score


def _best_of(frame: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, plan: Plan, doc_id: str, text: str, s: Settings) -> DataFrame:
    vocabulary = sorted({t for t, _, _ in plan.elements})
    indexed = index(docs, vocabulary, doc_id, text)
    stats = indexed.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = int(stats["n"]), int(stats["l"] or 0)
    df = np.zeros(len(vocabulary), np.int64)
    for r in indexed.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["t"]] = r["df"]  # one row for each term of the block
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    numbers = {t: i for i, t in enumerate(vocabulary)}
    shared = docs.sparkSession.sparkContext.broadcast((plan, numbers, weights, n_docs, length))

    def score(batches):
        import pyarrow as pa

        plan, numbers, weights, n_docs, length = shared.value
        combiner = _Combiner(plan, numbers, weights, n_docs, length, s)
        for b in batches:
            for at in range(0, b.num_rows, combiner.batch):
                part = b.slice(at, combiner.batch)
                ids, n, term, tf = (part.column(c) for c in range(4))
                offsets = np.asarray(term.offsets)
                flat = [np.asarray(x.flatten()) for x in (term, tf)]
                combiner.add(ids.to_pylist(), np.asarray(n), offsets - offsets[0], *flat)
        found = list(zip(*combiner.rows(), strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "doc_id", "score"])

    hits = indexed.where(F.size("terms") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "n", "terms", "tf")
    best = hits.mapInArrow(score, "query string, doc_id bigint, score bigint")
    dealt = best.withColumn("bucket", F.spark_partition_id() % s.merge_buckets)
    partly = _best_of(dealt, ["query", "bucket"], s.top).drop("bucket", "rank")
    return freeze(_best_of(partly, ["query"], s.top), "ranked")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item."""
    own = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    known = freeze(queries_of(own, "text").drop("text"), "items")
    distinct = known.groupBy("_query").agg(F.first("_bag").alias("_bag"))
    found: DataFrame | None = None
    for plan in plans(distinct, settings):
        part = _search_block(docs, plan, doc_id, text, settings)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query string, doc_id bigint, score bigint, rank int")
    # items of one query share its rows; at most ``top`` rows for each query
    asked = known.select("item_id", F.col("_query").alias("query"))
    return asked.join(broadcast_if_small(found), "query").select("item_id", "rank", "doc_id", "score")
