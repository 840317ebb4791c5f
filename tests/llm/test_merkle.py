import zlib
from hashlib import sha256

import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from stellate.llm import merkle
from stellate.llm.catalog import QUERIES

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
        i //= 8
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: ((r["doc_id"] is not None, r["doc_id"]), leaf(r)))
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: [r for r in rows if r["lang"] == g] for g in langs}
    trees = {g: tree([leaf(r) for r in rs]) for g, rs in groups.items()}
    upper = tree([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            node = leaf(changed)
            steps = path(trees[g], i) + path(upper, at)
            for a, b in steps:
                node = h(a + node + b)
            proof = h("".join(a + b for a, b in steps))
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], upper[-1][0], proof, node, node == upper[-1][0]))
    return out


def as_tuples(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture()
def run(spark, out_dir):
    def run(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, hash int, path string"
        full = [(*(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")), "x", 1, "y") for r in rows]
        spark.createDataFrame(full, schema).write.mode("overwrite").parquet(f"{out_dir}/documents.parquet")
        return QUERIES["op13_merkle_manifest"](spark, out_dir)

    return run


def row(i, lang, text, source="s"):
    return {"doc_id": i, "lang": lang, "source": source, "n_chars": None if text is None else len(text), "text": text}


def test_many_groups_and_odd_rows(run):
    rows = [row(i, "en", prose(i, 5).title()) for i in range(70)]
    rows += [row(1000 + i, f"l{i}", "Ärger " + prose(i, 3)) for i in range(12)]
    rows += [row(2000 + i, None, None if i % 2 else "") for i in range(9)] + [row(i, "", "Empty Lang") for i in (5, -7)]
    rows += [row(None, "en", "Null Id"), row(None, "en", None), row(None, "de", "Null Id", None)]
    rows += [row(3, "en", "Other Text Of 3")] + [row(4, "en", "Copy")] * 20 + [row(9, "de", "X" * 300_000)]
    assert as_tuples(run(rows)) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65])
def test_sizes_of_one_group(run, n):
    rows = [row(i, "en", f"Text {i}") for i in range(n)]
    assert as_tuples(run(rows)) == sorted(brute(rows), key=repr)


def test_empty_table(run):
    assert run([]).collect() == []


def test_small_table(spark, small_docs):
    rows = [r.asDict() for r in small_docs.select(*COLUMNS).collect()]
    assert as_tuples(QUERIES["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")) == sorted(brute(rows), key=repr)


def test_intervals_and_siblings_cover_the_group(spark, small_docs):
    built = merkle.manifest(small_docs)
    nodes = built.groups.nodes()
    # the nodes of a level cut the group's ranks into intervals without gaps or overlaps
    spans = nodes.groupBy("g", "level").agg(
        F.sum(F.col("hi") - F.col("lo") + 1).alias("covered"), F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    assert spans.where("covered <> n or lo <> 0 or hi <> n - 1").count() == 0
    assert nodes.count() == nodes.select("g", "level", "lo").distinct().count()
    proofs = built.proofs()
    folded = proofs.select(merkle.fold(F.col("hash"), F.col("path")).alias("f"), "root")
    assert folded.where("f <> root").count() == 0 and proofs.count() == small_docs.count()
