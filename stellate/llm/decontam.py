"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item's window is ``window`` consecutive words (an item of fewer words is
one window); a document is hit where a window occurs word for word. As a set
join with a containment of one:

1. Windows and documents are sets of positioned shingles (``shingle`` words;
   shorter items use shingles of their own length). The documents' shingles
   that occur in any item are found in one pass over the texts.
2. Shingles are ordered by rarity, their number of occurrences in the
   documents, ties by value. A window that is contained must have its rarest
   shingle in the document, so that one is its prefix: only occurrences of
   prefix shingles nominate (document, start, window), which drops the
   windows whose prefix never occurs and keeps frequent shingles out of the join.
3. Positional and length bounds: the window must start and end inside the
   document.
4. Verification: every shingle of the window stands at its place. Shingles are
   compared as words, so this is exact containment.

The item side is broadcast only within measured bounds (``broadcast_if_small``);
beyond them the joins are shuffle joins. Null texts have no words. Rows that
repeat in id and text are judged alike; ids may be null. Equal windows of
several items are one window with several items.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, lower_ascii, whole
from stellate.operators.broadcast import broadcast_if_small

# Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    window: int = 13
    shingle: int = 4
    min_share: int = 20  # contaminated: hit words are at least one in so many


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(whole(text)), BETWEEN), lambda w: w != "")


def _shingles(df: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """(keep, at, hash, text) of every run of ``size`` words in the array column ``w``."""
    at = F.posexplode(F.slice("w", 1, F.greatest(F.size("w") - (size - 1), F.lit(0)))).alias("at", "_first")
    parts = [F.get("w", F.col("at") + j) for j in range(size)]
    return df.select(*keep, "w", at).select(
        *keep, "at", F.xxhash64(*parts).alias("hash"), F.concat_ws(" ", *parts).alias("shingle")
    )


def item_windows(items: DataFrame, item_id: str, text: str, rule: Rule) -> DataFrame:
    """(item_id, window, len, size, shingles): every window of every item that has words.

    ``window`` is the window's words as text; ``size`` its shingles' length.
    """
    w = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(rule.window))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    one = w.select("item_id", n.alias("len"), F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("w"))
    size = F.least("len", F.lit(rule.shingle))
    runs = F.transform(F.sequence(F.lit(1), F.col("len") - size + 1), lambda i: F.concat_ws(" ", F.slice("w", i, size)))
    return one.select("item_id", F.concat_ws(" ", "w").alias("window"), "len", size.alias("size"), runs.alias("shingles"))


def judge(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rule: Rule = Rule(),
) -> DataFrame:
    """One row per document: doc_id, key, n_words, n_hit, items (sorted strings), contaminated."""
    per_item = freeze(item_windows(items, item_id, item_text, rule), "windows")
    windows = per_item.select("window", "len", "size", "shingles").distinct()
    runs = windows.select("window", "len", "size", F.posexplode("shingles").alias("off", "shingle"))

    own = docs.select(
        F.col(doc_id).alias("doc_id"), content_key(doc_id, text).alias("key"), words(F.col(text)).alias("w")
    )
    # at most `shingle` sizes; one pass over the documents for each that the items have
    found = None
    for size in sorted(r[0] for r in windows.select("size").distinct().collect()):
        wanted = runs.where(F.col("size") == size).select("shingle").distinct()
        parts = F.split("shingle", " ")
        hashed = F.xxhash64(*[F.get(parts, F.lit(j)) for j in range(size)])
        wanted = broadcast_if_small(wanted.select("shingle", hashed.alias("hash")))
        hits = _shingles(own.select("key", F.size("w").alias("n"), "w"), size, ["key", "n"])
        hits = hits.join(wanted, ["hash", "shingle"]).select("key", "n", "at", "shingle", F.lit(size).alias("size"))
        found = hits if found is None else found.unionByName(hits)
    counts = own.select("doc_id", "key", F.size("w").cast("long").alias("n_words"))
    if found is None:  # no item has words
        return counts.select(
            "*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
            F.lit(False).alias("contaminated"),
        )
    found = freeze(found.distinct(), "occurrences")

    rarity = found.groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("times"))
    ranked = runs.join(rarity, ["size", "shingle"], "left").groupBy("window", "len", "size").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "off")).alias("prefix")
    )
    prefixes = freeze(
        ranked.where("prefix.times > 0").select("window", "len", "size", "prefix.shingle", "prefix.off"), "prefixes"
    )
    nominated = (
        found.join(prefixes, ["size", "shingle"])
        .withColumn("start", F.col("at") - F.col("off"))
        .where("start >= 0 and start + len <= n")
        .select("key", "start", "window", "len", "size")
    )
    places = nominated.join(runs, ["window", "len", "size"]).select(
        "key", "start", "window", "len", "size", "shingle", (F.col("start") + F.col("off")).alias("at")
    )
    occurs = (
        places.join(found.select("key", "at", "shingle", "size"), ["key", "at", "shingle", "size"])
        .groupBy("key", "start", "window", "len", "size")
        .agg(F.count(F.lit(1)).alias("present"))
        .where("present = len - size + 1")
    )
    occurs = freeze(occurs.select("key", "start", "len", "window"), "hits")

    hit = (
        occurs.select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("at"))
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = (
        occurs.select("key", "window").distinct()
        .join(per_item.select("window", F.col("item_id").cast("string").alias("item_id")).distinct(), "window")
        .select("key", "item_id").distinct()
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        counts.join(hit.join(named, "key"), "key", "left")
        .withColumn("n_hit", n_hit)
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (rule.min_share * F.col("n_hit") >= F.col("n_words")))
    )


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    bad = judge(docs, items, doc_id, text).where("contaminated").select(F.col("key").alias("_bad")).distinct()
    return docs.join(bad, content_key(doc_id, text) == F.col("_bad"), "left_anti")
