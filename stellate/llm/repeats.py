"""Substring dedup by recompression.

A window is ``window`` consecutive words. Every word inside a window whose
word sequence also starts elsewhere, in the same document or another, is
removed.

Texts are word sequences. Rounds of recompression rename maximal runs of one
symbol and then pairs of neighbours (of a symbol from one half of the
alphabet followed by one of the other half; the halves change every round) by
new symbols. A name is a hash of what it replaces, so equal runs and pairs
get one name in every document, and equal substrings get equal symbols in
their interior. For each symbol the span of words that decided its boundaries
is carried along (``low`` to ``high``): any other occurrence of these words
gives the same symbol. Therefore

* a symbol that occurs once in the whole corpus proves that no window around
  its span is repeated;
* windows that no such symbol rules out lie in regions of shared high-level
  symbols. These long repeats are verified by the windows' words themselves
  (96-bit names of the ``window`` words, counted over the corpus).

Nothing depends on the lengths that rounds happen to give: a window without a
complete symbol (inside a long run of one word, say) is simply verified.

Names are counted by partial aggregation and matched back by shuffle joins
that adaptive execution can split, so a phrase that fills a third of the
corpus needs no task of its own. Verification runs in ``passes`` over slices
of the names, which divides the shuffle space it holds at once.

Names are hashes made where the text is read, so a round needs no exchange of
its own to agree on them across documents: equal runs and pairs have equal names
in every task.

Null and empty texts have no words and lose none; texts shorter than a window
are returned as they are; very long ones are worked on whole. Rows that repeat are
occurrences like any other. An empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, let_go, whole

MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = np.uint64(0x9E3779B97F4A7C15)
BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))
CHUNK_WORDS = 60_000  # words a task works on at a time
HASH_BYTES = 16 << 20  # of a hashed join side in one partition, on average


@dataclass(frozen=True)
class Settings:
    window: int = 35
    rounds: int = 4  # each renames runs and then pairs; spans that decide a symbol outgrow the window after more
    symbol_passes: int = 2  # slices in which symbols are counted, and windows below: each holds its part of the shuffle space
    passes: int = 4


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(27))


class _Numbered(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def word_names(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names per word."""
    import xxhash

    index = _Numbered()
    at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    raw = b"".join(xxhash.xxh3_128_digest(w) for w in index)
    names = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    return names[at, 0], names[at, 1]


def recompress(names: np.ndarray, stop: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after all rounds: (name, low, high) with ``low <= high`` word places.

    ``names`` are the words of several documents with a stop before, between
    and after them (``stop`` is true there); stops never merge. [low, high)
    is the span of words that decides the symbol.
    """
    n = len(names)
    name, low, high, halt = names.copy(), np.arange(n), np.arange(1, n + 1), stop.copy()

    def gather(first: np.ndarray, new: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Merge the symbols from each ``first`` to the next."""
        return new[first], np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), halt[first]

    for turn in range(s.rounds):
        same = (name[1:] == name[:-1]) & ~halt[1:] & ~halt[:-1]
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        length = np.diff(np.append(first, len(name))).astype(np.uint64)
        # a run ends where a neighbour differs, so the neighbours decide it too
        l2, h2 = low.copy(), high.copy()
        l2[1:] = np.minimum(low[1:], low[:-1])
        h2[:-1] = np.maximum(high[:-1], high[1:])
        new, low, high, halt = gather(first, name, l2, h2)
        run = length > 1
        new = np.where(run, _scramble(new * STEP + length * MIX + np.uint64(turn + 1)), new)
        name = new
        second = (_scramble(name + np.uint64((turn + 101) * int(STEP) % (1 << 64))) >> np.uint64(63)).astype(bool)
        pair = ~second[:-1] & second[1:] & ~halt[:-1] & ~halt[1:]
        left, right = np.append(pair, False), np.concatenate(([False], pair))
        # a symbol of the first half left alone depends on what follows it, one of the second on what precedes
        l2, h2 = low.copy(), high.copy()
        alone_r = second & ~right
        alone_l = ~second & ~left
        l2[1:] = np.where(alone_r[1:], np.minimum(low[1:], low[:-1]), low[1:])
        h2[:-1] = np.where(alone_l[:-1], np.maximum(high[:-1], high[1:]), high[:-1])
        joined = name.copy()
        joined[:-1] = np.where(
            left[:-1], _scramble(_scramble(name[:-1] + np.uint64(turn + 11)) * STEP + name[1:]), name[:-1]
        )
        name, low, high, halt = gather(np.flatnonzero(~right), joined, l2, h2)
    keep = ~halt
    return name[keep], low[keep], high[keep]


def _utf8(texts):
    """The texts' bytes, one at a time."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return (t.as_py() for t in texts.cast(kind))


def _chunks(texts):
    """Lists of word lists, of about CHUNK_WORDS words each."""
    group, size = [], 0
    for t in _utf8(texts):
        words = t.split()
        group.append(words)
        size += len(words)
        if size >= CHUNK_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _joined(group: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both names of all words with stops around documents, the stops, and each document's first place."""
    sizes = np.array([len(w) for w in group])
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1] + 1
    n = int(sizes.sum()) + len(group) + 1
    stop = np.zeros(n, bool)
    stop[0] = True
    stop[first + sizes] = True
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if sizes.sum():
        one[~stop], two[~stop] = word_names([w for words in group for w in words])
    return one, two, stop, first


def _lists(parts: list[np.ndarray], kind):
    import pyarrow as pa

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _symbols(s: Settings):
    """For each text its number of words and the symbols that can rule out a window, with the spans that decide them.

    A span's begin is given as the words since the one before: small numbers, that are stored and shuffled in few bytes.
    """

    def symbols(texts):
        import pyarrow as pa

        sizes, names, steps, spans = [], [], [], []
        for group in _chunks(texts):
            one, _, stop, first = _joined(group)
            name, low, high = recompress(one, stop, s)
            use = high - low <= s.window
            name, low, high = name[use], low[use], high[use]
            cut = np.append(np.searchsorted(low, first), len(low))
            for k, words in enumerate(group):
                mine = slice(cut[k], cut[k + 1])
                sizes.append(len(words))
                names.append(name[mine].view(np.int64))
                steps.append(np.diff(low[mine], prepend=first[k]).astype(np.int32))
                spans.append((high[mine] - low[mine]).astype(np.int16))
        lists = [_lists(p, k) for p, k in ((names, pa.int64()), (steps, pa.int32()), (spans, pa.int16()))]
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), *lists], ["n", "names", "steps", "spans"])

    return symbols


def _open_places(s: Settings):
    """Where the windows begin that no symbol of a text, occurring once in the corpus, rules out."""

    def places(sizes, names, steps, spans, shared):
        import pyarrow as pa

        out = []
        columns = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (names, steps, spans, shared)]
        for i, size in enumerate(sizes.to_pylist()):
            if size < s.window:
                out.append(np.empty(0, np.int32))
                continue
            name, step, span, known = (values[ends[i] : ends[i + 1]] for ends, values in columns)
            low = np.cumsum(step)
            known = np.sort(known)
            at = np.minimum(np.searchsorted(known, name), max(len(known) - 1, 0))
            single = known[at] != name if len(known) else np.ones(len(name), bool)
            last = size - s.window + 1
            edge = np.zeros(last + 1, np.int64)
            frm = np.maximum(low[single] + span[single] - s.window, 0)
            to = np.minimum(low[single], last - 1)
            ok = frm <= to
            np.add.at(edge, frm[ok], 1)
            np.add.at(edge, to[ok] + 1, -1)
            out.append(np.flatnonzero(np.cumsum(edge[:-1]) == 0).astype(np.int32))
        return _lists(out, pa.int32())

    return places


def _named_windows(s: Settings):
    """The 96-bit names of a text's windows that begin at the given places."""

    def windows(texts, places):
        import pyarrow as pa

        ends = places.offsets.to_numpy()
        flat = places.values.to_numpy(zero_copy_only=False)
        first_names, second_names = [], []
        doc = 0
        for group in _chunks(texts):
            one, two, _, first = _joined(group)
            n = len(one)
            # prefix sums of word names times powers: a window's name is a difference, scaled back
            sums, inverses = [], [_powers(np.uint64(pow(int(base), -1, 1 << 64)), n) for base in BASES]
            for names, base in zip((one, two), BASES, strict=True):
                sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(names * _powers(base, n), dtype=np.uint64))))
            for a in first:
                place = flat[ends[doc] : ends[doc + 1]] + int(a)
                both = []
                for total, inverse in zip(sums, inverses, strict=True):
                    both.append(_scramble((total[place + s.window] - total[place]) * inverse[place]))
                first_names.append(both[0].view(np.int64))
                second_names.append((both[1] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                doc += 1
        return pa.StructArray.from_arrays(
            [_lists(first_names, pa.int64()), _lists(second_names, pa.int32())], ["a", "b"]
        )

    return windows


_power_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    table = _power_tables.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, CHUNK_WORDS), base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if n <= 4 * CHUNK_WORDS:  # a very long text's table is not kept
            _power_tables[int(base)] = table
    return table[:n]


def _kept(window: int):
    def kept(texts, starts):
        import pyarrow as pa

        ends = starts.offsets.to_numpy()
        flat = starts.values.to_numpy(zero_copy_only=False)
        words_out, removed_out, text_out = [], [], []
        for i, t in enumerate(_utf8(texts)):
            words = t.split()
            at = flat[ends[i] : ends[i + 1]]
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
            stay = np.cumsum(gone[:-1]) == 0
            words_out.append(len(words))
            removed_out.append(len(words) - int(np.count_nonzero(stay)))
            if len(at):
                words = [words[k] for k in np.flatnonzero(stay).tolist()]
            text_out.append(b" ".join(words).decode())
        cols = [pa.array(words_out, pa.int64()), pa.array(removed_out, pa.int64()), pa.array(text_out, pa.string())]
        return pa.StructArray.from_arrays(cols, ["n_words", "n_removed", "kept_text"])

    return kept


def _hashed(side: DataFrame, row_bytes: int) -> DataFrame:
    """A written join side, hinted to be hashed if its partitions are measured to fit in memory; else Spark sorts.

    A hashed side does not spill, so the bound is on what one shuffle partition
    of it can hold, several times over for uneven ones.
    """
    spark = side.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return side.hint("shuffle_hash") if side.count() * row_bytes <= parts * HASH_BYTES else side


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (its kept words joined by a space)."""
    s = settings
    own = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    # rows that repeat share a key; each still counts as an occurrence of its windows
    own = own.withColumn("key", content_key("doc_id", "text"))
    symbols = F.arrow_udf(_symbols(s), "struct<n:int,names:array<bigint>,steps:array<int>,spans:array<smallint>>")
    # rows are numbered as they are written, so that what is shuffled by symbol or window carries 8 bytes for its text
    named = own.select("key", symbols("text").alias("s")).select("key", "s.*")
    early = f"symbols-{uuid.uuid4().hex}"  # what finds the open places, let go before windows are named
    named = freeze(named.withColumn("row", F.monotonically_increasing_id()), "symbols", early)
    each = named.select("row", F.explode("names").alias("name"))
    lists = None
    for turn in range(s.symbol_passes):
        mine = each.where(F.pmod(F.col("name"), F.lit(s.symbol_passes)) == turn)
        shared = freeze(mine.groupBy("name").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("name"), "shared", early)
        part = mine.join(_hashed(shared, 64), "name").groupBy("row").agg(F.collect_set("name").alias("shared"))
        part = freeze(part, "shared-by-doc", early)
        lists = part if lists is None else lists.unionByName(part)
    per_doc = lists.groupBy("row").agg(F.flatten(F.collect_list("shared")).alias("shared"))
    nothing = F.array().cast("array<bigint>")
    left_open = F.arrow_udf(_open_places(s), "array<int>")
    places = named.join(per_doc, "row", "left").select(
        "key", left_open("n", "names", "steps", "spans", F.coalesce("shared", nothing)).alias("at")
    )
    # rows that repeat have the same places
    places = freeze(places.where(F.size("at") > 0).dropDuplicates(["key"]), "open")
    let_go(docs.sparkSession, early)
    name = F.arrow_udf(_named_windows(s), "struct<a:array<bigint>,b:array<int>>")
    opened = own.join(places, "key").select("key", "at", name("text", "at").alias("w")).select("key", "at", "w.*")
    opened = freeze(opened.withColumn("row", F.monotonically_increasing_id()), "windows")
    found = None
    for turn in range(s.passes):
        mine = opened.select("row", F.explode(F.arrays_zip("at", "a", "b")).alias("w")).select("row", "w.*")
        mine = mine.where(F.pmod(F.col("a"), F.lit(s.passes)) == turn)
        twice = freeze(
            mine.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a", "b"), "repeated"
        )
        part = mine.join(_hashed(twice, 64), ["a", "b"]).groupBy("row").agg(F.collect_set("at").alias("at"))
        part = freeze(part, "covered")
        found = part if found is None else found.unionByName(part)
    covered = found.groupBy("row").agg(F.flatten(F.collect_list("at")).alias("at"))
    # rows that repeat have the same places
    covered = covered.join(opened.select("row", "key"), "row").drop("row").dropDuplicates(["key"])
    cut = F.arrow_udf(_kept(s.window), "struct<n_words:bigint,n_removed:bigint,kept_text:string>")
    return (
        own.join(covered, "key", "left")
        .select("doc_id", cut("text", F.coalesce("at", F.array().cast("array<int>"))).alias("r"))
        .select("doc_id", "r.*")
    )
