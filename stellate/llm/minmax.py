"""Near-duplicate documents by min-max hashing.

Documents are sets of word shingles. Under each of ``hashes`` permutations both
the smallest and the largest value are kept, so one evaluation gives two
signature entries; ``bands`` bands of ``rows`` entries each (rows // 2
permutations, both ends) nominate candidates. Every nominated link is then
confirmed on the full sets.

1. Documents with the same set form a class, represented by its smallest id.
2. Classes that share a band key are chained to the smallest class of the key
   (one row per membership, never pairs), and the connected components of
   these chains are the candidate groups.
3. A group is cut into blocks of bounded size; each pair of blocks is one task
   group, in which every pair of sets is compared exactly. Only links that
   join two parts not yet joined inside the block pair are returned. So no
   task holds more than two blocks, and no link between parts is lost.
4. The components of the links are the result.

A pair at a similarity of exactly 0.8 misses all bands with probability
(1 - 0.8^rows)^bands: 3e-6 for the default 24 bands of 4 rows; at 0.85 it is
below 1e-8.

Empty and null texts have an empty set and link with nothing; a text of fewer
words than a shingle is one shingle. Very long texts are sketched in pieces. Rows
are told apart by a key of id and text: an id with two texts is two documents, of
which each goes its own way, and rows equal in both are one class. Rows with a
null id link like any other and come last: a component's id is its smallest
non-null one, null where it has none, and of rows with null ids only the one that
stands for such a component is kept. Empty tables give empty results; other
columns are carried along, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, whole
from stellate.llm.graph import connected_components
from stellate.operators.broadcast import broadcast_if_small

MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    percent: int = 80  # of the union that the intersection must reach
    bands: int = 24
    rows: int = 4  # signature entries per band: two per permutation
    seed: int = 7
    block_docs: int = 256  # documents of a candidate group in one block
    block_shingles: int = 1_000_000  # shingles in one block


def shingles(text: str, size: int) -> np.ndarray:
    """The text's distinct shingles as sorted 64-bit hashes."""
    import xxhash

    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    names = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    hashed = np.fromiter(map(names.__getitem__, words), np.uint64, n)
    size = min(size, n)
    last = n - size + 1
    out = np.full(last, np.uint64(size))
    for j in range(size):
        out = (out ^ (out >> np.uint64(31))) * MIX + hashed[j : j + last]
    return np.unique((out ^ (out >> np.uint64(29))) * STEP)


def band_keys(values: np.ndarray, s: Settings) -> np.ndarray:
    """One 64-bit key per band from the minima and maxima of the permutations."""
    per_band = s.rows // 2
    rng = np.random.default_rng(s.seed)
    factors = rng.integers(1, 1 << 63, s.bands * per_band, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for at in range(0, len(values), 4096):  # bounded memory for very long texts
        part = values[at : at + 4096, None] * factors
        part ^= part >> np.uint64(32)
        part *= MIX
        low = np.minimum(low, part.min(0))
        high = np.maximum(high, part.max(0))
    key = np.arange(1, s.bands + 1, dtype=np.uint64) * STEP
    for j in range(per_band):
        for ends in (low, high):
            key = (key ^ (key >> np.uint64(31))) * MIX + ends.reshape(s.bands, per_band)[:, j]
    return key


def _sketch_udf(s: Settings):
    @F.arrow_udf("struct<n:bigint,h1:bigint,h2:bigint,keys:array<bigint>>")
    def sketch(texts):
        import pyarrow as pa

        n, h1, h2, keys = [], [], [], []
        for t in texts:
            v = shingles(t.as_py(), s.shingle)
            n.append(len(v))
            rows = (v, v * STEP ^ (v >> np.uint64(17)))
            a, b = (int(x.sum().view(np.int64)) if len(v) else 0 for x in rows)
            h1.append(a)
            h2.append(b)
            keys.append(band_keys(v, s).view(np.int64) if len(v) else np.empty(0, np.int64))
        offsets = np.zeros(len(keys) + 1, np.int32)
        np.cumsum([len(k) for k in keys], out=offsets[1:])
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        cols = [pa.array(c, pa.int64()) for c in (n, h1, h2)]
        return pa.StructArray.from_arrays([*cols, lists], ["n", "h1", "h2", "keys"])

    return sketch


def _sets_udf(s: Settings):
    @F.arrow_udf("binary")
    def sets(texts):
        import pyarrow as pa

        return pa.array([shingles(t.as_py(), s.shingle).tobytes() for t in texts], pa.binary())

    return sets


def links_within(ids: list[int], sets: list[np.ndarray], side: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that span the parts of one block pair.

    ``side`` is 0 or 1 by block; with two blocks only pairs across them count.
    Every set is compared with all others through the postings of its
    shingles, unless all are in one part already.
    """
    n = len(ids)
    sizes = np.array([len(x) for x in sets])
    who = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    ranked, posting = values[order], who[order]
    part = np.arange(n)
    two = len(set(side)) > 1
    sides = np.array(side)
    out = []
    for i in range(n):
        if two and sides[i]:
            continue
        if (part == part[0]).all():
            break
        a, b = np.searchsorted(ranked, sets[i]), np.searchsorted(ranked, sets[i], "right")
        lens = b - a
        at = np.repeat(a - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
        common = np.bincount(posting[at], minlength=n)
        near = 100 * common >= percent * (sizes + sizes[i] - common)
        near[i] = False
        if two:
            near &= sides == 1
        for j in np.flatnonzero(near):
            if part[j] != part[i]:
                out.append((ids[i], ids[int(j)]))
                part[part == part[j]] = part[i]
    return out


def _compare(percent: int):
    def compare(table):
        import pyarrow as pa

        ids = table.column("node").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("values").to_pylist()]
        found = links_within(ids, sets, table.column("side").to_pylist(), percent)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def confirmed_links(classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """(a, b): links between classes; the components of these are those of all links."""
    member = freeze(classes.select("node", F.explode("keys").alias("key")), "bands")
    shared = member.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = freeze(shared.drop("c"), "shared")  # both join sides then arrive by a shuffle that can be split
    chains = member.join(shared, "key").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    groups = freeze(connected_components(chains), "groups")
    grouped = groups.join(classes.select("node", "n"), "node")
    weight = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    blocks = F.greatest(F.ceil(F.col("c") / s.block_docs), F.ceil(F.col("w") / s.block_shingles)).cast("int")
    placed = grouped.join(weight.select("component", blocks.alias("blocks")), "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), "blocks").cast("int")
    )
    sets = placed.join(docs.select("node", "text"), "node").withColumn("values", _sets_udf(s)(whole("text"))).drop("text")
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "node",
        "values",
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )
    return dealt.groupBy("component", "i", "j").applyInArrow(_compare(s.percent), "a bigint, b bigint")


def _sketched(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """For each row doc_id, ``key`` (the 128-bit key of its id and text) and the sketch of its set."""
    own = docs.select(
        F.col(doc_id).alias("doc_id"), content_key(doc_id, text).alias("key"), _sketch_udf(s)(whole(text)).alias("s")
    )
    return freeze(own.select("doc_id", "key", "s.*"), "sketch")


def _components(docs: DataFrame, sketched: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """For each class h1, h2 and ``first``: null, doc_id, key of the row that stands for its component."""
    # the first row of a class: non-null ids before null ones; ids may repeat with other texts, keys tell them apart
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "key")
    classes = sketched.where("n > 0").groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    # numbered as they are written: read again after a lost executor, a scan may be dealt otherwise
    classes = freeze(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    wanted = classes.select("node", F.col("first.key").alias("key"))
    keyed = docs.select(content_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    # rows that repeat in id and text are one before the texts move
    texts = keyed.join(wanted, "key").groupBy("node").agg(F.first("text").alias("text"))
    links = freeze(confirmed_links(classes, texts, s), "links")
    parts = connected_components(links)
    placed = classes.join(parts, "node", "left").select("h1", "h2", "first", F.coalesce("component", "node").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("first"))
    return freeze(placed.drop("first").join(smallest, "component").drop("component"), "components")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sketched = _sketched(docs, doc_id, text, settings)
    # frozen, so that this join's both sides arrive by a shuffle that can be split at a hot class
    named = sketched.select("doc_id", "key", "n", "h1", "h2").join(
        _components(docs, sketched, doc_id, text, settings), ["h1", "h2"], "left"
    )
    alone = F.col("n") == 0
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.lit(True))
        .when(F.col("doc_id").isNull(), F.col("key") == F.col("first.key"))
        .otherwise(F.coalesce(F.col("doc_id") == F.col("first.doc_id"), F.lit(False)))
        .alias("kept"),
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The documents that stay: the first row of each component, and all rows without words."""
    sketched = _sketched(docs, doc_id, text, settings)
    first = _components(docs, sketched, doc_id, text, settings).select("first.key").distinct()
    counted = sketched.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("again"))
    stay = freeze(first.join(counted, "key"), "stay")
    key = content_key(doc_id, text)
    keyed = docs.withColumn("_key", key)
    once = stay.where("not again").select(F.col("key").alias("_key"))
    named = keyed.join(once, "_key", "left_semi").drop("_key")
    # rows equal in id and text: the one whose other columns hash first
    again = broadcast_if_small(stay.where("again").select(F.col("key").alias("_key")))
    row = F.struct(*[F.col(c) for c in docs.columns])
    single = keyed.join(again, "_key", "left_semi").groupBy("_key").agg(
        F.min_by(row, F.xxhash64(*docs.columns)).alias("_row")
    )
    wordless = docs.where(~F.regexp_like(whole(text), F.lit(r"[^\x20\x09-\x0D]")))
    return named.unionByName(single.select("_row.*")).unionByName(wordless)
