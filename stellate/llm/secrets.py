"""Secret scans by rules and by character Markov models, in DataFrame operations only.

Three fixed kinds (values after a key word, access key ids, long hex runs) are
found by pattern. They also label the training samples for the method: first
order character models of *random strings* (the values the rules found in
the corpus) and of *ordinary identifiers* (long alphabetic tokens, and their
upper-case forms). A token of ``min_len`` or more characters whose
log-likelihood ratio, random over ordinary, reaches ``threshold`` is a further
secret of kind ``markov``, unless it touches a span of the rules.

The counts cover the whole corpus; the two tables have one cell per pair of
ASCII characters, whatever the input size, so they are read by the driver and
become a literal. With no labelled sample a model is uniform and finds nothing.

Null and empty texts have no spans. Positions are code points, end exclusive.
Texts of any length are searched whole: spans are found, kept apart and replaced in
sweeps over blocks of ``BLOCK`` of them, so the time is linear but for sorting.
Rows are judged one by one, so repeated rows come out alike; an empty table gives
no rows, and other columns are kept, whatever their names.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import whole

# The patterns of the rules.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 or more characters with the prefix
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6  # characters of an assigned value

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][a-z]{11,}(?![A-Za-z0-9+/_=-])"
SPAN = "struct<kind:int,s:int,e:int,v:string>"
BLOCK = 256
CHUNK = 4096  # characters
CODES = 128


@dataclass(frozen=True)
class Scan:
    min_len: int = 16
    threshold: float = 12.0  # nats
    prior: float = 0.5  # added to every cell
    join_share: float = 0.02  # of letters in identifiers that a joiner follows, and a digit
    number_weight: float = 1e4  # of each pair of digits among ordinary identifiers


def _locate(df: DataFrame, text: Column, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """Add a column array<SPAN> of all matches, leftmost and non-overlapping, for each (pattern, kind).

    Each step is a projection of its own, so that a text is searched once
    however often its matches are referred to.
    """
    none = F.array().cast(f"array<{SPAN}>")
    m, q, b = (lambda n, k=k: f"_{k}_{n}" for k in "mqb")
    df = df.withColumns({m(n): F.regexp_extract_all(text, F.lit(p), F.lit(0)) for n, (p, _) in patterns.items()})

    def pairs(n: str, pattern: str) -> Column:
        # gaps between matches and the matches themselves alternate, so their lengths give the places
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(m(n)))
        both = F.zip_with(
            gaps, m(n), lambda gap, x: F.struct(F.length(gap).alias("gap"), F.length(x).alias("len"), x.alias("v"))
        )
        return F.when(F.size(m(n)) > 0, both)

    df = df.withColumns({q(n): pairs(n, p) for n, (p, _) in patterns.items()})

    def blocks(n: str) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(q(n)) - 1) / BLOCK).cast("int"))
        return F.when(F.col(q(n)).isNotNull(), F.transform(at, lambda i: F.slice(q(n), i * BLOCK + 1, F.lit(BLOCK))))

    df = df.withColumns({b(n): blocks(n) for n in patterns})

    def spans(n: str, kind: int) -> Column:
        def size(block: Column) -> Column:
            return F.aggregate(block, F.lit(0), lambda a, x: a + x["gap"] + x["len"])

        starts = F.aggregate(
            b(n), F.array(F.lit(0)), lambda a, block: F.concat(a, F.array(F.element_at(a, -1) + size(block)))
        )

        def placed(block: Column, at: Column) -> Column:
            zero = F.struct(at.alias("at"), none.alias("out"))

            def step(acc: Column, x: Column) -> Column:
                s = acc["at"] + x["gap"]
                e = s + x["len"]
                one = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), x["v"].alias("v"))
                return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            return F.aggregate(block, zero, step, lambda acc: acc["out"])

        every = F.flatten(F.zip_with(b(n), F.slice(starts, 1, F.size(b(n))), placed))
        return F.when(F.col(b(n)).isNotNull(), every).otherwise(none)

    df = df.withColumns({n: spans(n, kind) for n, (_, kind) in patterns.items()})
    return df.drop(*(f(n) for n in patterns for f in (m, q, b)))


def _value(match: Column) -> Column:
    """The assigned value: the second group, found again in the match alone."""
    return F.regexp_extract(match, ASSIGN, 2)


def _by_start(spans: Column) -> Column:
    """Spans by start, then kind (the struct's fields in this order from now on)."""
    order = F.transform(
        spans,
        lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"), x["v"].alias("v")),
    )
    return F.array_sort(order)


def with_base(df: DataFrame, text: Column, more: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """Add ``base``, the spans of the rules by start then kind, and the spans of ``more`` patterns."""
    rules = {"_assign": (ASSIGN, 0), "_access": (ACCESS, 1), "_hex": (HEX, 2)}
    found = _locate(df, text, rules | (more or {}))
    assign = F.filter("_assign", lambda x: F.length(_value(x["v"])) >= MIN_VALUE)
    return found.withColumn("base", _by_start(F.concat(assign, F.col("_access"), F.col("_hex")))).drop(*rules)


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c))


def train(docs: DataFrame, text: str = "text", scan: Scan = Scan()) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of ASCII characters.

    Cell ``a * 128 + b`` is for character ``b`` after ``a``; ``a = 0`` stands for
    the token's start.
    """
    t = whole(text)
    found = with_base(docs.select(t.alias("_t")), F.col("_t"))
    values = F.transform(
        "base", lambda x: F.struct(F.lit(1).alias("random"), F.when(x["kind"] == 0, _value(x["v"])).otherwise(x["v"]).alias("v"))
    )
    ordinary = F.transform(
        F.regexp_extract_all("_t", F.lit(ORDINARY), F.lit(0)), lambda v: F.struct(F.lit(0).alias("random"), v.alias("v"))
    )
    samples = found.select(F.explode(F.concat(values, ordinary)).alias("x")).select(
        "x.random", F.concat(F.array(F.lit(0)), _codes(F.col("x.v"))).alias("c")
    )
    pairs = samples.select("random", "c", F.posexplode(F.slice("c", 2, F.size("c"))).alias("i", "b")).select(
        "random", (F.get("c", F.col("i")) * CODES + F.col("b")).alias("cell")
    )
    counts = {0: {}, 1: {}}
    for r in pairs.where(F.col("cell") < CODES * CODES).groupBy("random", "cell").count().collect():
        counts[r["random"]][r["cell"]] = float(r["count"])
    return ratio_table(counts[1], counts[0], scan)


def ratio_table(random: dict[int, float], ordinary: dict[int, float], scan: Scan = Scan()) -> list[float]:
    """Cell-wise log ratio of two smoothed models from their pair counts."""
    both: dict[int, float] = dict(ordinary)

    def upper(code: int) -> int:
        return code - 32 if 97 <= code <= 122 else code

    for cell, n in ordinary.items():  # identifiers in capitals read like those in small letters
        up = upper(cell // CODES) * CODES + upper(cell % CODES)
        if up != cell:
            both[up] = both.get(up, 0.0) + n
    starts = {b: n for cell, n in both.items() if not cell // CODES for b in [cell % CODES]}
    joined: dict[int, float] = {}
    for a in map(ord, ALPHABET):  # identifiers are words joined by - _ /
        total = sum(both.get(a * CODES + ord(b), 0.0) for b in ALPHABET)
        for j in map(ord, "-_/"):
            joined[a * CODES + j] = total * scan.join_share
    for j in map(ord, "-_/"):
        for b, n in starts.items():
            joined[j * CODES + b] = n
    digits = range(ord("0"), ord("9") + 1)
    for a in map(ord, ALPHABET):  # and may hold numbers, whose digits are alike
        total = sum(both.get(a * CODES + ord(b), 0.0) for b in ALPHABET)
        for b in digits:
            joined[a * CODES + b] = total * scan.join_share / 10
    if both:
        for a in [0, *digits]:
            for b in digits:
                joined[a * CODES + b] = scan.number_weight
    for cell, n in joined.items():
        both[cell] = both.get(cell, 0.0) + n

    out = [0.0] * (CODES * CODES)
    for a in [0, *map(ord, ALPHABET)]:
        cells = [a * CODES + ord(b) for b in ALPHABET]
        logs = []
        for counts in (random, both):
            seen = sum(counts.get(c, 0.0) for c in cells)
            total = seen + scan.prior * len(cells)
            logs.append([math.log((counts.get(c, 0.0) + scan.prior) / total) for c in cells])
        for c, r, o in zip(cells, *logs, strict=True):
            out[c] = round(r - o, 5)
    if not random:
        return [min(x, 0.0) for x in out]
    return out


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token under a ``ratio_table``."""
    cells = F.from_json(F.lit(json.dumps(table)), "array<double>")
    zero = F.struct(F.lit(0).alias("a"), F.lit(0.0).cast("double").alias("sum"))
    return F.aggregate(
        _codes(token),
        zero,
        lambda acc, b: F.struct(
            b.alias("a"), (acc["sum"] + F.coalesce(F.get(cells, acc["a"] * CODES + b), F.lit(0.0))).alias("sum")
        ),
        lambda acc: acc["sum"],
    )


ITEM = "struct<s:int,token:int,kind:int,e:int,v:string>"


def _items(spans: str, token: int) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["s"].alias("s"), F.lit(token).alias("token"), x["kind"].alias("kind"), x["e"].alias("e"), x["v"].alias("v")
        ),
    )


def _sweep(df: DataFrame, out: str, items: str, start: int, carry) -> DataFrame:
    """Add ``out``: each of the ``items`` (array<ITEM>) as x with ``before``, what ``carry(value, x)`` made of the earlier ones.

    Blocks are carried over first and then swept by themselves, so that no
    array longer than a block grows step by step.
    """
    none = F.array().cast(f"array<struct<x:{ITEM},before:int>>")
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
    df = df.withColumn("_cut", F.when(F.size(items) > 0, cut).otherwise(F.array().cast(f"array<array<{ITEM}>>")))
    heads = F.aggregate(
        "_cut",
        F.array(F.lit(start)),
        lambda a, block: F.concat(a, F.array(F.aggregate(block, F.element_at(a, -1), carry))),
    )

    def swept(block: Column, at: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            one = F.struct(x.alias("x"), acc["at"].alias("before"))
            return F.struct(carry(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    every = F.flatten(F.zip_with("_cut", F.slice(heads, 1, F.size("_cut")), swept))
    return df.withColumn(out, every).drop("_cut")


def _free_tokens(df: DataFrame) -> DataFrame:
    """Add ``_free``: the items of ``_tokens`` that overlap no span of ``base``, in one pass each way."""
    df = df.withColumn("_all", F.array_sort(F.concat(_items("base", 0), _items("_tokens", 1))))

    def furthest(at: Column, x: Column) -> Column:
        return F.when(x["token"] == 0, F.greatest(at, x["e"])).otherwise(at)

    def nearest(at: Column, x: Column) -> Column:
        return F.when(x["token"] == 0, x["s"]).otherwise(at)

    # from the left: no span that began before reaches into the token
    df = _sweep(df, "_left", "_all", 0, furthest)
    kept = F.filter("_left", lambda y: (y["x"]["token"] == 0) | (y["before"] <= y["x"]["s"]))
    df = df.withColumn("_back", F.reverse(F.transform(kept, lambda y: y["x"])))
    # from the right: the next span begins behind it
    df = _sweep(df, "_right", "_back", (1 << 31) - 1, nearest)
    free = F.filter("_right", lambda y: (y["x"]["token"] == 1) & (y["before"] >= y["x"]["e"]))
    return df.withColumn("_free", F.transform(free, lambda y: y["x"])).drop("_all", "_left", "_back", "_right")


def find(docs: DataFrame, table: list[float], text: str = "text", scan: Scan = Scan()) -> DataFrame:
    """Add ``base`` and ``spans``: the spans of the rules, and those with the models' added."""
    both = with_base(docs.withColumn("_t", whole(text)), F.col("_t"), {"_tokens": (TOKEN % scan.min_len, 3)})
    both = _free_tokens(both)
    extra = F.filter("_free", lambda x: ratio(x["v"], table) >= scan.threshold)
    extra = F.transform(
        extra, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"), x["v"].alias("v"))
    )
    return both.withColumn("spans", F.array_sort(F.concat("base", extra))).drop("_tokens", "_free", "_t")


def as_text(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))
    )
    return F.concat_ws(",", parts)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", scan: Scan = Scan()) -> DataFrame:
    """The documents with every span replaced by ``mark``; columns and rows as they were.

    ``n_chars``, if there, is counted anew for the texts that change.
    """
    cols = docs.columns
    marked = find(docs.withColumnsRenamed({"base": "_base", "spans": "_spans"}), train(docs, text, scan), text, scan)
    marked = _sweep(
        marked.withColumn("_items", _items("spans", 0)), "_swept", "_items", 0, lambda at, x: F.greatest(at, x["e"])
    )
    # a place in a long text is only found by walking to it, so pieces are cut from chunks, not from the text
    marked = marked.withColumn("_chunks", F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))

    def piece(at: Column, end: Column) -> Column:
        first, last = F.floor(at / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")
        parts = F.transform(
            F.sequence(first, last),
            lambda i: F.substring(
                F.get("_chunks", i),
                F.greatest(at - i * CHUNK, F.lit(0)) + 1,
                F.least(end - i * CHUNK, F.lit(CHUNK)) - F.greatest(at - i * CHUNK, F.lit(0)),
            ),
        )
        return F.when(end > at, F.array_join(parts, "")).otherwise(F.lit(""))

    # a span that begins inside an earlier one is under its mark
    heads = F.filter("_swept", lambda y: y["x"]["s"] >= y["before"])
    cleaned = F.transform(heads, lambda y: F.concat(piece(y["before"], y["x"]["s"]), F.lit(mark)))
    end = F.array_max(F.transform("spans", lambda x: x["e"]))
    rebuilt = F.concat(F.array_join(cleaned, ""), piece(end, F.length(text)))
    touched = F.size("spans") > 0
    out = marked.withColumn("_new", F.when(touched, rebuilt).otherwise(F.col(text)))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(touched, F.length("_new").cast("long")).otherwise(F.col("n_chars")))
    out = out.drop(text, "base", "spans", "_items", "_swept", "_chunks").withColumnRenamed("_new", text)
    return out.withColumnsRenamed({"_base": "base", "_spans": "spans"}).select(*cols)
