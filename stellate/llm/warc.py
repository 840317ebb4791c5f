"""WARC archives: pages written as records, and archives read back by boundary-chain verification.

Writing: payloads are hashed in place; of pages with equal payloads the one
with the smallest id is stored and the others become revisit records that
refer to it. Each task writes one archive of the records it holds (a text
file whose line separator is the blank line after a record), so an archive is
as large as an input partition.

Reading: archives are cut at every occurrence of the magic, by Spark's
splittable text reader with the magic as line separator. Tasks emit a candidate
for each cut: its place and the place of its successor, by the declared
length. Payloads may contain the magic, so not every candidate is a record.
Within a split the task follows the successors to where they leave the split;
between splits these exits are joined by pointer jumping from the start of each
file (rounds: the logarithm of the splits of a file). Candidates that the
chain from the file's start does not reach are parts of payloads and rejected.
A payload that was cut is put together from its pieces before it is hashed.

Null payloads are empty, a null url is left out, null page ids are kept (a
payload that only such pages have makes responses of them). Rows that repeat
in id and payload are all responses or all revisits. An empty table gives no
records. Other columns are not archived.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.llm.common import freeze, shuffles_dropped, whole
from stellate.operators.broadcast import broadcast_if_small
from stellate.session import shared_dir

# The format's marks and the RFC 4648 base32 alphabet.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID = "urn:page:"

CHUNK = (
    "file string, split bigint, nr int, at bigint, size bigint, next bigint, exit bigint, page_id bigint, url string, "
    "kind string, refers_to bigint, declared string, payload_bytes bigint, head int, digest string, entire boolean"
)


def base32(hex_digest: Column) -> Column:
    """Bare upper-case base32 of a 40-digit hex string."""
    out = []
    for five in range(8):
        bits = F.conv(F.substring(hex_digest, 1 + 5 * five, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> DataFrame:
    """One row per page: the record as text, without the blank line that ends it."""
    own = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), whole(html).alias("html")
    ).withColumn("sha", F.sha1("html"))
    ids = own.select("page_id", "sha", F.octet_length("html").alias("n")).where(F.col("n") >= min_bytes)
    first = freeze(ids.groupBy("sha", "n").agg(F.min("page_id").alias("first")), "first")
    # the join that a payload of many copies makes uneven holds ids only
    again = (
        ids.distinct().join(first, ["sha", "n"]).where("page_id <> first")
        .select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "first")
    )
    # few revisits are sent to the pages; many meet them in a shuffle join
    again = broadcast_if_small(again)
    full = own.join(again, (F.col("page_id") == F.col("_id")) & (F.col("sha") == F.col("_sha")), "left")
    revisit = F.col("first").isNotNull()
    length = F.octet_length("html").cast("string")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def page(col: str) -> Column:
        return F.concat(F.lit(f"<{ID}"), F.col(col).cast("string"), F.lit(">"))

    nothing = F.lit("")
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(field("WARC-Record-ID", page("page_id")), nothing),
        F.coalesce(field("WARC-Target-URI", clean_url), nothing),
        field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha")))),
        F.coalesce(field("WARC-Refers-To", page("first")), nothing),
        field("Payload-Length", length),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit("0")).otherwise(length)),
        F.lit("\r\n"),
    )
    return full.select(F.concat(head, F.when(revisit, nothing).otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, path: str, **cols) -> None:
    """Write the pages' records as archives in folder ``path``."""
    with shuffles_dropped(pages.sparkSession):
        records(pages, **cols).write.option("lineSep", END).text(path)


def _header(chunk: bytes) -> dict | None:
    """Fields of the record that starts the chunk (after the magic), or None."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in chunk[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip()
    try:
        length = int(fields["content-length"])
        kind = fields["warc-type"].decode()
    except (KeyError, ValueError):
        return None
    if length < 0:
        return None

    def page(name: str) -> int | None:
        v = fields.get(name, b"").strip(b"<>").decode("latin-1")
        try:
            return int(v.removeprefix(ID)) if v.startswith(ID) else None
        except ValueError:
            return None

    try:
        stored = int(fields.get("payload-length", b"").decode())
    except ValueError:
        stored = length
    url = fields.get("warc-target-uri")
    return {
        "length": length, "head": end + 4, "kind": kind, "page_id": page("warc-record-id"),
        "refers_to": page("warc-refers-to"), "url": url.decode("utf-8", "replace") if url is not None else None,
        "declared": fields.get("warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:"), "stored": stored,
    }


def payload_digest(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _rows(batches) -> Iterator[tuple[str, int, bytes]]:
    import pyarrow as pa

    for b in batches:
        values = b.column(0).cast(pa.binary() if b.column(0).type == pa.string() else pa.large_binary())
        for file, split, value in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), values, strict=True):
            yield file, split, value.as_py()


def _candidates(batches):
    """A row for each chunk: where it starts in its split, where its record ends, where its chain leaves the split."""
    import pyarrow as pa

    names = [c.strip().split()[0] for c in CHUNK.split(",")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(c.strip().split()[0], kinds[c.strip().split()[1]]) for c in CHUNK.split(",")])

    def flush(done: list[dict]):
        exits: dict[int, int] = {}
        for r in reversed(done):
            if r["next"] is not None:
                r["exit"] = exits.get(r["next"], r["next"])
                exits[r["at"]] = r["exit"]
        return pa.RecordBatch.from_pylist([{k: r.get(k) for k in names} for r in done], schema=schema)

    done: list[dict] = []
    here, at, nr = None, 0, 0
    for file, split, chunk in _rows(batches):
        if (file, split) != here:
            if done:
                yield flush(done)
            here, at, nr, done = (file, split), 0, 0, []
        # places count from the split's first text; a record starts at the magic before its chunk
        row = {"file": file, "split": split, "nr": nr, "at": at - len(MAGIC), "size": len(chunk) + len(MAGIC), "next": None}
        h = _header(chunk)
        if h is not None:
            body = h["head"] + h["length"]
            entire = len(chunk) == body + len(END) and chunk.endswith(END.encode())
            digest = payload_digest(chunk[h["head"] : body]) if entire else None
            row |= {k: h[k] for k in ("page_id", "url", "kind", "refers_to", "declared", "head")}
            row |= {"next": at + body + len(END), "payload_bytes": h["stored"], "digest": digest, "entire": entire}
        done.append(row)
        at += len(chunk) + len(MAGIC)
        nr += 1
    if done:
        yield flush(done)


def _chain(key, table):
    """The chunks of a split that the chain from the entry point reaches."""
    rows = table.sort_by("at")
    places = dict(zip(rows.column("at").to_pylist(), range(rows.num_rows), strict=True))
    nexts = rows.column("next").to_pylist()
    i = places.get(rows.column("entry")[0].as_py()) if rows.num_rows else None
    take = []
    while i is not None:
        take.append(i)
        i = places.get(nexts[i])
    return rows.take(take).drop_columns(["entry"])


def _scan(spark: SparkSession, path: str) -> DataFrame:
    chunks = spark.read.option("lineSep", MAGIC).text(path)
    return chunks.select("value", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))


def reachable(chunks: DataFrame) -> DataFrame:
    """The candidates that are records: those on the chain from the start of their file."""
    per_split = chunks.groupBy("file", "split").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = per_split.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    base = freeze(base, "splits")
    placed = chunks.join(base, ["file", "split"])
    for c in ("at", "next", "exit"):
        placed = placed.withColumn(c, F.col(c) + F.col("base"))
    placed = freeze(placed.drop("base").where("next is not null"), "placed")

    points = placed.select("file", F.col("at").alias("place"))
    entries = freeze(placed.where("at = 0").select("file", F.col("at").alias("place")), "entries")
    jump = placed.select("file", F.col("at").alias("place"), F.col("exit").alias("to"))
    jump = freeze(jump.join(points.withColumnRenamed("place", "to"), ["file", "to"], "left_semi"), "jump")
    while not jump.isEmpty():
        more = entries.join(jump, ["file", "place"]).select("file", F.col("to").alias("place"))
        entries = freeze(entries.unionByName(more).distinct(), "entries")
        on = jump.select("file", F.col("place").alias("to"), F.col("to").alias("further"))
        jump = freeze(jump.join(on, ["file", "to"]).select("file", "place", F.col("further").alias("to")), "jump")

    starts = placed.select("file", "split", F.col("at").alias("place")).join(entries, ["file", "place"])
    starts = starts.select("file", "split", F.col("place").alias("entry"))
    grouped = placed.join(starts, ["file", "split"]).groupBy("file", "split")
    return grouped.applyInArrow(_chain, placed.schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes, payload_digest, intact.

    The digest of a response is computed from its payload, that of a revisit
    is the one it declares. ``intact``: a response's payload is whole and its
    digest as declared.
    """
    chunks = freeze(_scan(spark, path).mapInArrow(_candidates, CHUNK), "chunks")
    found = freeze(reachable(chunks), "records")
    entire = found.where("entire").select(
        "page_id", "url", "kind", "refers_to", "payload_bytes", "declared", "digest"
    )
    out = entire
    cut = found.where("not entire")
    if not cut.isEmpty():
        out = entire.unionByName(_put_together(spark, path, chunks, cut))
    shown = F.when(F.col("kind") == "revisit", F.col("declared")).otherwise(F.col("digest"))
    return out.select(
        "page_id",
        "url",
        F.col("kind").alias("record_type"),
        F.when(F.col("kind") == "revisit", F.col("refers_to")).alias("refers_to"),
        "payload_bytes",
        shown.alias("payload_digest"),
        F.coalesce(shown == F.col("declared"), F.lit(False)).alias("intact"),
    )


def _put_together(spark: SparkSession, path: str, chunks: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their pieces, in order, read a second time."""

    def texts(batches):
        import pyarrow as pa

        here, nr = None, 0
        for b in batches:
            values = b.column(0).cast(pa.binary() if b.column(0).type == pa.string() else pa.large_binary())
            numbers = []
            for place in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                nr = nr + 1 if place == here else 0
                here = place
                numbers.append(nr)
            cols = [b.column(1), b.column(2), pa.array(numbers, pa.int32()), values.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["file", "split", "nr", "body"])

    per_split = chunks.groupBy("file", "split").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = per_split.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    places = chunks.select("file", "split", "nr", "at").join(base, ["file", "split"])
    places = places.withColumn("place", F.col("at") + F.col("base")).drop("at", "base")
    wanted = cut.select(
        "file", F.col("at").alias("start"), F.col("next").alias("end"), "head", "page_id", "url", "kind", "refers_to",
        "payload_bytes", "declared",
    )
    # the record that a piece is in is the last one to begin at or before it: within the split, else in an earlier one
    begins = wanted.select("file", F.col("start").alias("place"), F.col("start").alias("begin"))
    marked = freeze(places.join(begins, ["file", "place"], "left"), "marked")
    so_far = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    tops = marked.groupBy("file", "split").agg(F.max("begin").alias("top"))
    carried = tops.select("file", "split", F.max("top").over(before).alias("carried"))
    held = marked.withColumn("begin", F.max("begin").over(so_far)).join(carried, ["file", "split"])
    held = held.select("file", "split", "nr", "place", F.coalesce("begin", "carried").alias("start")).where("start is not null")
    pieces = held.join(wanted, ["file", "start"]).where("place < end")
    bodies = _scan(spark, path).mapInArrow(texts, "file string, split bigint, nr int, body binary")
    keys = ["file", "start", "end", "head", "page_id", "url", "kind", "refers_to", "payload_bytes", "declared"]
    whole_records = (
        freeze(pieces, "pieces").join(bodies, ["file", "split", "nr"])
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "body"))).alias("parts"))
    )

    def digest(heads, lengths, lists):
        import pyarrow as pa

        out = []
        for head, n, parts in zip(heads.to_pylist(), lengths.to_pylist(), lists.to_pylist(), strict=True):
            record = MAGIC.encode().join(p["body"] for p in parts)
            ok = len(record) == head + n + len(END) and record.endswith(END.encode())
            out.append(payload_digest(record[head : head + n]) if ok else None)
        return pa.array(out, pa.string())

    body_bytes = F.col("end") - F.col("start") - len(MAGIC) - F.col("head") - len(END)
    return whole_records.select(
        "page_id", "url", "kind", "refers_to", "payload_bytes", "declared",
        F.arrow_udf(digest, "string")("head", body_bytes, "parts").alias("digest"),
    )


def round_trip(pages: DataFrame, path: str | None = None, **cols) -> DataFrame:
    """Write the pages to archives (by default in the cluster's shared folder) and read them back."""
    spark = pages.sparkSession
    path = path or shared_dir(spark, "llm", f"warc-{uuid.uuid4().hex}")
    write_archives(pages, path, **cols)
    return read_archives(spark, path)
