import math
import re
from collections import Counter

import pytest
from llm_texts import prose

from stellate.llm import lexical
from stellate.llm.catalog import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) by the definition; docs and items are (id, text)."""
    bags = [(i, Counter(cut(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item, text in items:
        found = []
        for i, b, n in bags:
            m = 25 + (75 * n * n_docs) // length
            score = 0
            for w, times in Counter(cut(text)).items():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += times * weight * ((1000000000 * b[w]) // (1000 * b[w] + 8 * m))
            if score > 0:
                found.append((-score, i is not None, i, score))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, score) for r, (_, _, i, score) in enumerate(found[:top], 1)]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture()
def items(spark):
    def make(found):
        full = [(i, t, "x", 1) for i, t in found]
        return spark.createDataFrame(full, "item_id bigint, text string, doc_id string, score int")

    return make


DOCS = [(i, prose(i % 37, 30 + i % 9) + (" Common Ärger tail" if i % 3 else "")) for i in range(150)]
DOCS += [(500 + i, prose(3, 40)) for i in range(40)]  # copies: ties
DOCS += [(None, prose(3, 40)), (None, None), (700, None), (701, ""), (702, " ,.;"), (703, "É É É ñandú 日本 a1b2")]
DOCS += [(704, "common " * 50_000), (3, prose(3, 33)), (3, prose(3, 33))]
ITEMS = [(i, prose(i, 12) + " common TAIL tail") for i in range(25)]
ITEMS += [(100, prose(3, 12) + " common TAIL tail"), (100, prose(3, 12)), (101, None), (102, "..."), (103, "Ärger É 日本"), (None, "a1b2")]
ITEMS += [(104, "nowhere-to-be-found"), (105, "common"), (106, " ".join(prose(i, 300) for i in range(6)))]


@pytest.mark.parametrize("settings", [
    lexical.Settings(), lexical.Settings(block_terms=60, batch_cells=500, merge_buckets=3, mined=5), lexical.Settings(top=3),
])
def test_equals_brute_force(docs, items, settings):
    frame = docs([(i, t, "s") for i, t in DOCS]).repartition(5)
    got = rows(lexical.search(frame, items(ITEMS), settings=settings))
    assert got == sorted(brute(DOCS, ITEMS, settings.top), key=repr)


def test_no_documents_or_no_items(docs, items):
    assert rows(lexical.search(docs([]), items(ITEMS))) == []
    assert rows(lexical.search(docs([(1, None, "s")]), items(ITEMS))) == []
    assert rows(lexical.search(docs([(1, "common", "s")]), items([]))) == []
    assert rows(lexical.search(docs([(1, "common", "s")]), items([(1, None)]))) == []


def test_registered_query(spark, small_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in small_docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert rows(QUERIES["op12_shared_lexical_search"](spark, "/root/testdata/sf0.001")) == sorted(want, key=repr)


def test_shared_sums_cost_less_and_are_exact(spark):
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    known = lexical.queries_of(bench, "text")
    (plan,) = lexical.plans(known.groupBy("_query").agg({"_bag": "first"}).toDF("_query", "_bag"), lexical.Settings())
    bags = {r["_query"]: {(t["term"], t["times"]) for t in r["_bag"]} for r in known.collect()}

    def leaves(node):
        if node < plan.classes:
            return [node]
        return [x for child in plan.sums[node - plan.classes] for x in leaves(child)]

    held = [set() for _ in range(plan.classes)]
    for term, times, k in plan.elements:
        held[k].add((term, times))
    for name, roots in zip(plan.names, plan.roots, strict=True):
        classes = [x for node in roots for x in leaves(node)]
        assert len(classes) == len(set(classes)) and set().union(*(held[k] for k in classes)) == bags[name]
    one_by_one = sum(len(b) - 1 for b in bags.values())
    assert plan.additions() < 0.7 * one_by_one, (plan.additions(), one_by_one)
