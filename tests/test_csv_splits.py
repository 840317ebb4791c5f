"""Multi-line CSV read by splits: quote parity, records over split borders, agreement with the whole-file reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from data_dirs import SMALL
from stellate.plans.catalog import QUERIES
from stellate.sources import read_csv
from stellate.sources.csv_splits import csv_records, ingest_csv_records, read_csv_records, split_starts, _lines

SCHEMA = "id int, note string, score double, other string"
PIECES = ['"', '""', "\n", "\r\n", ",", "a", "é", "x" * 40, " ", ";", '"\n"', "word", "日本"]


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        note = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
        other = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 4)))
        if i % 29 == 0:
            note = "long \n" * 200 + '"quoted"\n'  # longer than many splits
        out.append((i, note or None, i / 4, other))
    return out


def write(path, found, end="\n", header=True):
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        if header:
            w.writerow(["id", "note", "score", "other"])
        for r in found:
            w.writerow(["" if x is None else x for x in r])


@pytest.fixture()
def splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def of(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield of
    for n, v in before.items():
        spark.conf.set(n, v)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [7, 200, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_size_gives_the_rows(spark, out_dir, splits, size, end):
    if size == 7 and end == "\r\n":
        pytest.skip("one tiny split size is enough")
    n = 20 if size == 7 else 200
    files = [rows(1, n), rows(2, n // 3), []]
    for k, found in enumerate(files):
        write(f"{out_dir}/f{k}.csv", found, end)
    splits(size)
    got = collected(read_csv_records(spark, out_dir, SCHEMA))
    assert got == sorted((r for found in files for r in found), key=repr)


def test_agrees_with_the_whole_file_reader(spark, out_dir, splits):
    write(f"{out_dir}/f.csv", rows(5, 200))
    whole = collected(read_csv(spark, out_dir, SCHEMA))
    splits(100)
    assert collected(read_csv_records(spark, out_dir, SCHEMA)) == whole


def test_without_header_and_with_broken_records(spark, out_dir, splits):
    write(f"{out_dir}/f.csv", rows(6, 20), header=False)
    with open(f"{out_dir}/f.csv", "a", encoding="utf-8") as f:
        f.write("\n   \nnot a number,\"two\nlines\",1.5,o\n99,\"never closed\nto the end")
    splits(50)
    got = read_csv_records(spark, out_dir, SCHEMA, header=False, corrupt="_bad")
    assert collected(got.where("_bad is null").drop("_bad")) == sorted(rows(6, 20), key=repr)
    bad = {r["_bad"] for r in got.where("_bad is not null").collect()}
    assert 'not a number,"two\nlines",1.5,o' in bad


def test_splits_that_begin_inside_a_field_are_known(spark, out_dir, splits):
    body = '1,"' + "line\n" * 100 + '",2,x\n'
    with open(f"{out_dir}/f.csv", "w", encoding="utf-8") as f:
        f.write(body * 3)
    splits(64)
    text = body * 3
    starts = split_starts(_lines(spark, out_dir)).collect()
    assert len(starts) > 10
    for r in starts:
        # the split's first line begins after the first line end at or behind its start
        at = r["block"] if r["block"] == 0 else text.index("\n", r["block"] - 1 if text[r["block"] - 1] == "\n" else r["block"]) + 1
        assert r["inside"] == (text[:at].count('"') % 2 == 1), r


def test_no_task_reads_more_than_a_split_and_only_fragments_are_shuffled(spark, out_dir, splits):
    write(f"{out_dir}/f.csv", rows(8, 800))
    splits(4096)
    records = csv_records(spark, out_dir)
    assert records.rdd.getNumPartitions() > 10
    plan = records._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BatchScan" in plan or "FileScan text" in plan
    # the branch of whole records has no exchange: one for the fragments' window is all there is
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_ordered_join_serves_many_open_splits(spark, out_dir, splits, monkeypatch):
    from stellate.sources import csv_splits as module

    write(f"{out_dir}/f.csv", rows(9, 150))
    monkeypatch.setattr(module, "measure_side", lambda df: (df, False))
    splits(200)
    assert collected(read_csv_records(spark, out_dir, SCHEMA)) == sorted(rows(9, 150), key=repr)


def test_ingest_drops_columns_and_empty_input(spark, out_dir):
    write(f"{out_dir}/f.csv", rows(3, 10))
    out = ingest_csv_records(spark, f"{out_dir}/f.csv", f"{out_dir}/p", SCHEMA, drop=("note", "other"))
    assert collected(out) == sorted((r[0], r[2]) for r in rows(3, 10))
    write(f"{out_dir}/e.csv", [])
    assert ingest_csv_records(spark, f"{out_dir}/e.csv", f"{out_dir}/q", SCHEMA).count() == 0


def test_registered_round_trip(spark):
    back = QUERIES["csv_multiline_round_trip"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*back.columns)
    assert docs.where(F.col("text").contains("\n")).count() > 0 and back.count() == docs.count()
    assert back.exceptAll(docs).count() == 0
