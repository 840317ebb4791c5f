"""The pipeline on the small table, held against plain Python for what each stage decides."""

import hashlib

import corpus_pipeline
import pytest
from llm_texts import prose
from test_decontam import brute_force as contaminated
from test_minmax import sets_of
from test_rules import counts

from stellate.llm.common import freeze

ROOT = "/root/testdata/sf0.001"


def components(texts):
    sets = sets_of(texts, 5)
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in texts if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if min(len(sets[a]), len(sets[b])) * 100 < 80 * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def test_stages_have_the_contract_shape():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "scan_secrets", "encode"]


def test_run_matches_brute_force(spark):
    from stellate.llm import bpe, rules, secrets
    from stellate.llm.catalog import vocabulary

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    # no line of so small a table is shared by enough documents to be boilerplate
    texts = {i: t for i, t in texts.items() if not counts(t)[-1]}
    part = components(texts)
    texts = {i: t for i, t in texts.items() if part[i] == i}
    texts = {i: t for i, t in texts.items() if not contaminated(t, items)[3]}
    left = docs.where(docs.doc_id.isin(list(texts)))
    clean = {r.doc_id: r.text for r in secrets.redact(left).collect()}
    assert set(clean) == set(texts)
    codec = bpe.Codec(*bpe.ByteBpe(spark, vocabulary()).shared.value["parts"]).open()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, ROOT).collect()}
    assert set(got) == set(texts)
    for i, t in clean.items():
        assert "[SECRET]" in t or t == texts[i]
        assert got[i].input_ids == codec.encode(t) and got[i].n_tokens == len(got[i].input_ids)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert rules.Limits().min_words == 10


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None), (1, None, None), (1, None, None), (2, "", "s"), (3, prose(1, 50), "s"), (3, prose(1, 50), "s"),
     (4, prose(1, 50), None), (None, prose(2, 50), "s"), (5, prose(3, 20000), "s"), (6, prose(4, 30) + " password=abcdefgh", "s")],
])
def test_every_stage_takes_odd_rows(spark, docs, rows):
    cur = docs(rows)
    for name, stage in corpus_pipeline.STAGES:
        before = cur.columns
        out = stage(spark, cur, ROOT)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == before
        cur = freeze(out, "test")
    if rows:
        assert {r.decoded_sha256 for r in cur.collect()} >= {hashlib.sha256(prose(i, n).encode()).hexdigest() for i, n in ((2, 50), (3, 20000))}
    ids = sorted(str(r.doc_id) for r in cur.collect())
    assert ids == (["3", "5", "6", "None"] if rows else [])


def test_two_texts_under_one_id_both_stay(spark, docs):
    cur = docs([(1, prose(41, 60), "s"), (1, prose(42, 60), "s"), (2, prose(42, 60), "s"), (None, prose(43, 60), "s"), (None, prose(43, 60), "t")])
    for _, stage in corpus_pipeline.STAGES:
        cur = freeze(stage(spark, cur, ROOT), "test")
    want = sorted((str(i), hashlib.sha256(prose(n, 60).encode()).hexdigest()) for i, n in ((1, 41), (1, 42), (None, 43)))
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in cur.collect()) == want
