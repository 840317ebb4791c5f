"""Quality rules: per-document counts, and lines that many documents of a host share.

Two verdicts per document:

* the base rule: too few words, or too many words inside repeated 5-word windows;
* cross-document line frequency: lines are normalised (case, digits and white
  space folded) and hashed; a line that more than ``max_docs`` distinct
  documents of its host hold is boilerplate and removed; a document of which
  less than ``min_left_pct`` is left is rejected.

Distinct documents are told apart by content, not by id: a document counts
under a 128-bit key of its whole text, so that a page copied a thousand times is
one document, and pages that share all but a few words are not. How many copies
hold a line does not matter. Copies are the near-duplicate operator's to thin out;
removing all of them here would lose the text altogether.

Hosts and lines may be hot: counts are partial aggregates keyed by (host,
line, document key), then by (host, line); the shared lines are written out, so
that the match back to lines is a shuffle join that adaptive execution can split.

Null text or host: an empty text, the host ``null``. Texts without words fail
the base rule. Texts of any length are read whole. Rows that repeat in all of id,
host and text are judged alike. An empty table gives no rows; other columns are
not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, whole

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
WINDOW = 5
LINES = "array<struct<line:bigint,words:int>>"
STATS = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    f"n_repeat_words:bigint,lines:{LINES}>"
)


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    max_repeat_pct: int = 20  # of the words, in repeated 5-word windows
    max_docs: int = 20  # distinct documents of a host that may share a line
    min_left_pct: int = 20  # of the words, after boilerplate is gone


def text_stats(text: str) -> tuple:
    """The counts of one text and its distinct normalised lines."""
    import re

    import numpy as np
    import xxhash

    h64 = xxhash.xxh3_64_intdigest
    words = text.encode().split()
    n = len(words)
    seen: set[str] = set()
    dup_lines = 0
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        inner = line.strip(WHITE)
        if not inner:
            continue
        if line in seen:
            dup_lines += 1
        seen.add(line)
        folded = b" ".join(re.sub(r"[0-9]+", "0", inner.lower()).encode().split())
        key = h64(folded)
        lines[key] = lines.get(key, 0) + folded.count(b" ") + 1
    repeat = 0
    if n:
        names = {w: h64(w) for w in set(words)}
        hashed = np.fromiter(map(names.__getitem__, words), np.uint64, n)
        if n >= WINDOW:
            last = n - WINDOW + 1
            win = np.zeros(last, np.uint64)
            for j in range(WINDOW):
                win = (win ^ (win >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashed[j : j + last]
            _, at, counts = np.unique(win, return_inverse=True, return_counts=True)
            starts = np.flatnonzero(counts[at] > 1)
            if len(starts):
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WINDOW, -1)
                repeat = int((np.cumsum(edge[:-1]) > 0).sum())
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    return n, chars, symbols, dup_lines, repeat, lines


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _stats(texts):
    import pyarrow as pa

    rows = []
    for t in texts:
        *counts, lines = text_stats(t.as_py())
        rows.append((*counts, [{"line": _signed(k), "words": w} for k, w in lines.items()]))
    kinds = [pa.int64()] * 5 + [pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")
    cols = list(zip(*rows, strict=True)) or [()] * 7
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def boilerplate_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """(host, line) of the lines over the limit; ``lines`` has host, line, who per document."""
    by_doc = lines.select("host", "line", "who").distinct()
    counted = by_doc.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_distinct"))
    return counted.where(F.col("n_distinct") > limits.max_docs).select("host", "line")


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """One row per document: doc_id, its counts, words_left, base_failed, kept, and its key.

    ``key`` is the content key of (doc_id, host, text), to match verdicts back.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("null")).alias("host"),
        content_key(doc_id, host, text).alias("key"),
        content_key(whole(text)).alias("who"),
        F.arrow_udf(_stats, STATS)(whole(text)).alias("s"),
    ).select("doc_id", "host", "key", "who", "s.*")
    base = freeze(base, "rules")
    lines = base.select("key", "host", "who", F.explode("lines").alias("l")).select(
        "key", "host", "who", "l.line", "l.words"
    )
    # written first: a side straight out of an aggregate on the join key could not be split at a hot line
    shared = freeze(boilerplate_lines(lines, limits), "boilerplate")
    gone = (
        lines.join(shared, ["host", "line"])
        .dropDuplicates(["key", "line"])
        .groupBy("key")
        .agg(F.sum("words").alias("removed"))
    )
    words = F.col("n_words")
    left = words - F.coalesce("removed", F.lit(0))
    failed = (words < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_pct * words)
    enough = 100 * left >= limits.min_left_pct * words
    return (
        base.join(gone, "key", "left")
        .withColumn("words_left", left)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & enough)
        .drop("host", "who", "lines", "removed")
    )


def keep_good(docs: DataFrame, **cols) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    doc_id, text, host = (cols.get(k, d) for k, d in (("doc_id", "doc_id"), ("text", "text"), ("host", "source")))
    bad = judge(docs, doc_id, text, host).where(~F.col("kept")).select(F.col("key").alias("_bad")).distinct()
    return docs.join(bad, content_key(doc_id, host, text) == F.col("_bad"), "left_anti")
