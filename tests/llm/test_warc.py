import base64
import glob
import hashlib

import pytest
from llm_texts import prose

from stellate.llm import warc

SCHEMA = "page_id bigint, url string, html string, record string, file string"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def embedded(payload: str) -> str:
    """A whole record as it would stand in an archive, to be hidden in a payload."""
    n = len(payload.encode())
    return (
        f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {n}\r\n\r\n{payload}\r\n\r\n"
    )


PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y z\r\nWARC-Type: evil", "<p>one</p>"),
    (3, None, None), (4, "http://b.example/", ""), (5, "u", "é日本語\r\n\r\n"), (6, "u", warc.MAGIC), (7, "u", warc.MAGIC * 3 + "x"),
    (8, "u", "before " + embedded("inner") + embedded("inner two") + " after"), (9, "u", "x" * 300_000), (10, "u", prose(1, 50)),
    (0, "u", "<p>one</p>"), (11, "u", embedded("whole")), (12, "u", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"),
    (13, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (14, "u", prose(1, 50)), (None, "u", "no id"), (None, "v", "no id"),
]


def want(pages):
    first: dict[str, int] = {}
    for i, _, t in pages:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, _, t in pages:
        f = first.get(t or "")
        again = f is not None and f != i and i is not None
        out.append((i, len((t or "").encode()), b32(t), "revisit" if again else "response", f if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("split_bytes", ["128m", "2k"])
def test_round_trip(spark, out_dir, split_bytes):
    pages = spark.createDataFrame([(*p, "r", "f") for p in PAGES], SCHEMA).coalesce(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = warc.round_trip(pages, f"{out_dir}/w").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want(PAGES)
    assert all(r.intact for r in got)
    assert {r.url for r in got if r.page_id in (1, 3)} == {"http://a.example/x", None}


def test_archives_are_well_formed(spark, out_dir):
    """A plain sequential reader finds the same records."""
    warc.write_archives(spark.createDataFrame([(*p, "r", "f") for p in PAGES], SCHEMA), f"{out_dir}/w")
    kinds = []
    for path in glob.glob(f"{out_dir}/w/part-*"):
        data = open(path, "rb").read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at) + 4
            lines = data[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:] if x)
            at = end + int(fields["Content-Length"])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            kinds.append(fields["WARC-Type"])
    assert len(kinds) == len(PAGES) and kinds.count("revisit") == 4


def test_repeated_rows_and_empty_table(spark, out_dir):
    rows = [(1, "u", "same", "r", "f"), (1, "u", "same", "r", "f"), (2, "u", "same", "r", "f")]
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA), f"{out_dir}/a").collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(1, "response", None)] * 2 + [(2, "revisit", 1)]
    assert warc.round_trip(spark.createDataFrame([], SCHEMA), f"{out_dir}/b").count() == 0


def test_a_damaged_payload_is_told(spark, out_dir):
    pages = spark.createDataFrame([(1, "u", "abcdef", "r", "f")], SCHEMA).coalesce(1)
    warc.write_archives(pages, f"{out_dir}/w")
    (path,) = [p for p in glob.glob(f"{out_dir}/w/part-*") if len(open(p, "rb").read())]
    data = open(path, "rb").read().replace(b"abcdef", b"abcdeX")
    with open(f"{out_dir}/bad.warc", "wb") as f:
        f.write(data)
    (r,) = warc.read_archives(spark, f"{out_dir}/bad.warc").collect()
    assert not r.intact and r.payload_digest == b32("abcdeX")
