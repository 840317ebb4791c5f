"""CSV extracts with line breaks in quoted fields, read by splits instead of by files.

Spark's reader gives a multi-line CSV file to one task, because a split cannot
tell from its own bytes whether it begins inside a quoted field. Here it can:

1. Every split counts its quote characters (a partial aggregate over the text
   scan). A doubled quote counts two, so the parity says whether the split flips
   between inside and outside; the running sum over a file's earlier splits says
   how the split begins.
2. In a second scan each split cuts its own lines into records: a record ends
   with the line after which the number of quotes is even. Records within one
   split go straight on. What a split holds of a record that began before it, or
   goes on after it, are at most two fragments.
3. The fragments alone are shuffled and put together per record.
4. Whole records go through Spark's own CSV parser (``from_csv``).

No task reads more than the scan's splits and no data but the fragments moves.
The text is scanned three times: for the counts, the records and the fragments.

A quote must only occur as RFC 4180 has it: around a field, or doubled inside
one. Fields are UTF-8 and lines end in LF or CRLF; a CR inside quotes stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stellate.operators.broadcast import measure_side

WHOLE, HEAD, TAIL = 0, 1, 2
RECORDS = "file string, block bigint, kind int, first boolean, text string"


def _lines(spark: SparkSession, src: str | list[str]) -> DataFrame:
    """The lines of the files with the file and the start of the split that holds them, in order within a split."""
    return spark.read.option("lineSep", "\n").text(src).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether the split begins inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes.cast("long")).alias("quotes"))
    # one row per split, not per line
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counts.select("file", "block", odd.alias("inside"))


def _cut(wanted: tuple[int, ...]):
    """Lines (value, file, block, inside) to records and fragments of the ``wanted`` kinds."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out: list[tuple] = []
        at = None  # the split
        pending: list[str] = []  # the lines of the record under way
        odd = head = first = False

        def close(kind: int) -> None:
            nonlocal head, first
            kind = HEAD if head else kind
            if kind in wanted:
                out.append((*at, kind, first, "\n".join(pending)))
            pending.clear()
            head = first = False

        for b in batches:
            values, files, blocks, inside = b.columns
            flips = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
            text = values.to_pylist()
            same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(blocks[1:], blocks[:-1]))
            cuts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), b.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                here = (files[start].as_py(), blocks[start].as_py())
                if here != at:
                    if pending:
                        close(TAIL)
                    at = here
                    odd = head = bool(inside[start].as_py())
                    first = at[1] == 0
                after = (np.cumsum(flips[start:end]) + odd) % 2
                begin = start
                for last in (np.flatnonzero(after == 0) + start).tolist():
                    pending += text[begin : last + 1]
                    close(WHOLE)
                    begin = last + 1
                pending += text[begin:end]
                odd = bool(after[-1])
            yield _batch(pa, out)
            out.clear()
        if pending:
            close(TAIL)
        yield _batch(pa, out)

    return cut


def _batch(pa, rows: list[tuple]):
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    cols = zip(*rows, strict=True) if rows else [()] * len(kinds)
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def csv_records(spark: SparkSession, src: str | list[str], header: bool = True) -> DataFrame:
    """The records of the CSV files at ``src`` as text, one row each (column ``text``); headers and blank lines go."""
    lines = _lines(spark, src)
    # the splits that begin inside a field: one small row each, broadcast while they are few
    opened, few = measure_side(split_starts(lines).where("inside"))
    if few:
        placed = lines.join(F.broadcast(opened), ["file", "block"], "left")
    else:
        kept = lines.withColumn("_at", F.monotonically_increasing_id())
        joined = kept.join(opened, ["file", "block"], "left").repartition("file", "block")
        placed = joined.sortWithinPartitions("file", "block", "_at")
    placed = placed.select("value", "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"))
    whole = placed.mapInArrow(_cut((WHOLE,)), RECORDS)
    parts = placed.mapInArrow(_cut((HEAD, TAIL)), RECORDS)
    # within a split the end of an older record comes before the beginning of a newer one
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("n", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("block", "kind", "text")))
    spanning = numbered.groupBy("file", "n").agg(
        F.max("first").alias("first"), F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text")
    )
    records = whole.select("first", "text").unionByName(spanning.select("first", "text"))
    if header:
        records = records.where(~F.col("first"))
    text = F.regexp_replace("text", "\r\\z", "")
    return records.select(text.alias("text")).where(F.trim("text") != "")


def read_csv_records(
    spark: SparkSession, src: str | list[str], schema: StructType | str, header: bool = True, corrupt: str | None = None
) -> DataFrame:
    """The CSV files at ``src`` under ``schema``; ``corrupt`` names a column for the text of malformed records."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt:
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return csv_records(spark, src, header).select(F.from_csv("text", ddl, options).alias("r")).select("r.*")


OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def small_files_split(spark: SparkSession, cost: int = 64 * 1024) -> Iterator[None]:
    """Let inputs below a few megabytes a core be split as well; larger ones are split as ever."""
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, str(cost))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def ingest_csv_records(
    spark: SparkSession, src: str | list[str], dst: str, schema: StructType | str, drop: tuple[str, ...] = (),
    header: bool = True, corrupt: str | None = None,
) -> DataFrame:
    """Convert CSV files with multi-line fields to Parquet at ``dst`` (overwrite), split by split; the scan of it."""
    with small_files_split(spark):
        read_csv_records(spark, src, schema, header, corrupt).drop(*drop).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)
