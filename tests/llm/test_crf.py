import itertools
import random
import zlib

import numpy as np
from llm_texts import prose
from pyspark.sql import functions as F

from stellate.llm import crf


def good(i):
    rng = random.Random(i)
    lines = [" ".join(prose(i * 50 + j, rng.randint(6, 25)).split()).capitalize() + "." for j in range(rng.randint(1, 8))]
    return "\n".join(lines)


def bad(i):
    base = prose(5000 + i, 40)
    kind = i % 3
    if kind == 0:
        return " ".join(w + "###" for w in base.split())
    if kind == 1:
        return base.upper().replace(" ", "!! ")
    return (base.split()[0] + " ") * 60


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(2)
    lengths = np.array([4, 3, 1])
    score, pair = rng.normal(size=(3, 4)), rng.normal(size=(2, 2))
    marginal, moves, log_z = crf._marginals(score, pair, lengths)
    all_z, want_moves = 0.0, np.zeros((2, 2))
    for k, n in enumerate(lengths):
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            s = sum(score[k, i] for i in range(n) if labels[i])
            s += sum(pair[labels[i], labels[i + 1]] for i in range(n - 1))
            weights[labels] = np.exp(s)
        z = sum(weights.values())
        all_z += np.log(z)
        for i in range(n):
            assert np.isclose(marginal[k, i], sum(w for lab, w in weights.items() if lab[i]) / z)
        for lab, w in weights.items():
            for i in range(n - 1):
                want_moves[lab[i], lab[i + 1]] += w / z
    assert np.isclose(log_z, all_z) and np.allclose(moves, want_moves)


def labelled(spark, docs, n=160):
    rows = [(i, good(i) if i % 2 else bad(i), "s") for i in range(n)]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(n)], "doc_id bigint, quality int, text string")
    return docs(rows), labels


def test_held_out_accuracy(spark, docs):
    frame, labels = labelled(spark, docs)
    held = crf.fold(labels.doc_id, 4) == 2
    model = crf.train(frame, labels.where(~held), settings=crf.Settings(steps=80))
    scored = {r.doc_id: r.score for r in crf.score(frame, model).collect()}
    out = [i for i in scored if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(out) > 20
    assert np.mean([(scored[i] >= 0.7) == bool(i % 2) for i in out]) > 0.9


def test_neighbouring_lines_matter():
    feats = [crf.line_features(t)[0] for t in ("a b c\nd e f", "a b c\nD### E### F###")]
    assert not np.allclose(feats[0][0], feats[1][0])  # the same first line, another neighbour


def test_odd_texts_and_columns(spark, docs):
    frame, labels = labelled(spark, docs, 40)
    model = crf.train(frame, labels, settings=crf.Settings(steps=20))
    odd = docs([(1, None, None), (2, "", "s"), (3, " \n\n ", "s"), (4, "word " * 50000, "s"), (5, "x\n" * 20000, "s"),
                (None, "no id", "s"), (1, None, None), (6, "é日\x00", "s")])
    out = crf.score(odd, model)
    assert set(odd.columns) < set(out.columns)
    rows = out.collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert crf.score(docs([]), model).count() == 0


def test_one_label_or_none(spark, docs):
    frame, labels = labelled(spark, docs, 20)
    only = crf.train(frame, labels.where("quality = 1"))
    assert all(r.score > 0.7 for r in crf.score(frame, only).collect())
    none = crf.train(frame, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in crf.score(frame, none).collect())


def test_the_sample_is_bounded_and_repeatable(spark, docs):
    frame, labels = labelled(spark, docs, 60)
    s = crf.Settings(max_docs=30, steps=10)
    a, b = crf.train(frame, labels, settings=s), crf.train(frame.repartition(5), labels.repartition(3), settings=s)
    assert np.allclose(a.unary, b.unary) and np.allclose(a.calibration, b.calibration)


def test_fold_is_the_crc_of_the_id_as_text(spark):
    rows = spark.range(-3, 50).select("id", crf.fold(F.col("id"), 4).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in rows)



def test_the_fit_needs_little_memory_beside_one_long_document():
    import tracemalloc

    texts = [good(i) if i % 2 else bad(i) for i in range(300)] + ["some words of a line\n" * 50_000]
    feats, sizes = zip(*map(crf.line_features, texts), strict=True)
    labels = [i % 2 for i in range(len(texts))]
    tracemalloc.start()
    model = crf.fit(list(feats), list(sizes), labels, crf.Settings(steps=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(model.unary).all() and peak < 250e6, peak


def test_repeated_ids_and_long_texts_do_not_fill_the_driver(spark, docs):
    frame, labels = labelled(spark, docs, 60)
    many = frame.unionByName(docs([(3, good(3 + k), "s") for k in range(500)] + [(4, "x\n" * 100_000, "s"), (None, "no id", "s")]))
    model = crf.train(many, labels.unionByName(labels), settings=crf.Settings(steps=10, max_lines=200))
    assert np.isfinite(model.unary).all()
    empty = crf.train(docs([]), labels.limit(0), settings=crf.Settings(steps=5))
    assert [r.score for r in crf.score(docs([(1, "a", "s")]), empty).collect()] == [0.5]


def test_registered_query_on_the_whole_small_table(spark, small_docs):
    from stellate.llm.catalog import QUERIES

    rows = QUERIES["op9_crf_quality"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == small_docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
