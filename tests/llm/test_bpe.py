import base64
import hashlib

import pytest

from stellate.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")
VOCABULARY = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", "plain words, and numbers 12345", "é日本語 \U0001f600 <|endoftext|> <unk> ▁", "\x00\x01\r\n\t  x",
    " " * 3000, "a" * 20000, "word " * 30000, "'s're''''ll", "same", "same",
]


def test_matches_the_reference_encoder_and_round_trips(spark, docs, encoding):
    frame = docs([(i, t, None) for i, t in enumerate(TEXTS)])
    codec = bpe.ByteBpe(spark, VOCABULARY)
    out = codec.decode(codec.encode(frame))
    assert set(frame.columns) <= set(out.columns)
    rows = {r.doc_id: r for r in out.collect()}
    digest = {r.doc_id: r for r in bpe.digests(out).collect()}
    for i, t in enumerate(TEXTS):
        ids = encoding.encode_ordinary(t or "")
        assert rows[i].input_ids == ids
        assert bytes(rows[i].decoded) == (t or "").encode()
        assert digest[i].n_tokens == len(ids)
        assert digest[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_empty_table_and_null_ids(spark, docs):
    codec = bpe.ByteBpe(spark, VOCABULARY)
    assert codec.decode(codec.encode(docs([]))).count() == 0
    row = codec.decode(spark.sql("select cast(null as array<int>) as input_ids")).first()
    assert bytes(row.decoded) == b""


def test_every_token_is_its_own_encoding():
    ranks = bpe.read_ranks(VOCABULARY)
    codec = bpe.Codec(bpe.model_proto(ranks), P.PATTERN, sorted(ranks.values()), sorted(ranks, key=ranks.get)).open()
    mapped = [t.decode("latin-1").translate(bpe.TO_CHARS) for t in codec.tokens]
    assert codec.processor.encode(mapped, num_threads=1) == [[i] for i in codec.ids]


def test_registered_query_on_the_whole_small_table(spark, small_docs, encoding):
    from stellate.llm.catalog import QUERIES

    want = {}
    for r in small_docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[r.doc_id] = (len(ids), sha, hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op1_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want
