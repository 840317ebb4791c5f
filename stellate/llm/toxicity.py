"""Toxicity of texts that may hide their words: a noisy-channel decoder, then a scorer.

1. A character language model (letters a-z, trigrams) is counted over the
   words of all documents.
2. A token that is not plain letters becomes a lattice: digits and signs
   stand for the letters they resemble, marks may be fillers or stand for any
   letter, runs of three or more equal letters are one or two letters, two equal
   letters may be one, and a row of single letters set apart by spaces or marks
   is one word or several: between any two letters a word may end, more cheaply
   where the gap is wider than the others. Viterbi decoding under the language
   model restores the words. Other plain tokens have a one-path lattice and are
   their own decoding.
3. The restored text is scored. Features are its words and their beginnings,
   hashed; each is rated by the share of toxic documents among the labelled
   documents that have it (the lower end of a confidence interval, copies of a
   document counted once by a key of the whole text). A text is
   summed up by the ratings of its most telling words and how many there are;
   a logistic regression on these few numbers gives the score. It is fitted on
   at most ``max_docs`` labelled documents, each rated without its own count.

The language model counts all documents. The labelled documents used are
bounded by ``max_rated`` (distinct texts, the first by a hash of their id). What the driver
holds is bounded: the language model has 27 cubed cells, and the feature table
at most ``2 ** hash_bits`` entries, of which only those that ``min_docs``
distinct toxic documents have are kept.

Empty and null texts have no words; their summary is all zeros. Texts and tokens
of any length are decoded by one rule: a run of three or more fillers, or of more
than eight signs that may stand for any letter, is padding. Rows with a null id
are scored like any other and never labelled; where several labelled rows share
an id, the fit takes one of them. Without labelled documents every score is that
of the starting weights; empty tables give empty results. Other columns are kept
as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import content_key, freeze, whole

# The letters that characters are commonly written for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¥": "y",
    "¡": "i", "§": "s", "µ": "u", "×": "x",
}
FILLERS = ".-_'*~^`,:;/\\·•#="
ANY_LETTER = "*#"
MASKED_RUN = 8  # signs in a row that may each stand for a letter; more are padding
# costs, in nats, of the channel's ways to write a letter
COST_LOOKS, COST_FILLER, COST_ANY, COST_DROP, COST_RUN = 0.5, 0.7, 2.0, 15.0, 0.3
COST_DOUBLE = 2.5  # of two equal letters that stand for one
# of a word's end inside a row of single letters, one reading each; of joining over, or ending at, an unlikely gap
COST_END, COST_GAP = (2.0, 0.0, 5.0), 4.0
LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE = 0  # the language model's mark for a word's edge; letters are 1..26
SIZE = 27
STRIP_LEFT = "\"'([{<«„“”‘’¿¡*#_~^`.,:;-–—/\\"
STRIP_RIGHT = "\"')]}>»“”‘’?!*#_~^`.,:;-–—/\\%&"
LATIN = re.compile(r"[a-z]+\Z")
PLAIN = re.compile(r"[^\W\d_]+\Z")
LONG_RUN = re.compile(r"(.)\1\1")
DOUBLE = re.compile(r"([a-z])\1")
# the gap takes every mark it can, so that a row has one reading only and matching stays linear
APART = re.compile(r"(?<!\S)[\w@$!|+€£*#](?:[ .\-_*~/,]++(?:[^\W_]|[@$!|+€£#])){2,}(?: ++\*)?(?!\S)")
ROW_MARK = re.compile(r"([\w@$!|+€£*#])([ .\-_*~/,]*)")
INNER = re.compile(r"[.\-_'*~^`,:;/\\·•#=]+")


@dataclass(frozen=True)
class Settings:
    hash_bits: int = 22
    min_docs: int = 3  # distinct toxic documents that must have a feature
    min_rating: float = 0.02
    false_features: float = 0.01  # features expected to pass for telling by chance
    unsure: float = 0.45  # what the rating of a feature that may be chance is multiplied by
    z: float = 1.64  # of the confidence interval
    telling: int = 5  # words whose ratings go into a text's summary
    max_rated: int = 20_000  # labelled documents that features are rated on at most
    max_docs: int = 4000  # labelled documents that the summary's weights are fitted on at most
    prefixes: tuple[int, ...] = (4, 5, 6, 7)


class Channel:
    """Viterbi decoding of one token at a time under a trigram model (27 x 27 x 27 log-probabilities)."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        # (before, letter, after) where two equal letters are likelier to stand for one
        at = np.arange(SIZE)
        twice = model[:, at, at][:, :, None] + model[at, at, :][None, :, :]
        names = " " + LETTERS
        self.once = {names[a] + 2 * names[b] + names[c] for a, b, c in np.argwhere(model - COST_DOUBLE > twice) if b}

    def arcs(self, token: str, masked: bool = False) -> list[list[tuple[str, float]]]:
        """For each stretch of the token the letters it may stand for, with costs.

        ``masked``: signs that may stand for any letter do, and are no fillers.
        """
        out = []
        at = 0
        while at < len(token):
            c = token[at]
            end = at
            while end < len(token) and token[end] == c:
                end += 1
            n = end - at
            looks = LOOKS_LIKE.get(c, "")
            if c in LETTERS or c.isalpha():
                letter = c if c in LETTERS else ""
                if n >= 3:
                    out.append([(letter, 0.0), (letter * 2, COST_RUN)])
                elif n == 2 and letter:
                    out.append([(letter * 2, 0.0), (letter, COST_DOUBLE)])
                else:
                    out += [[(letter, 0.0)]] * n
            else:
                if c in FILLERS and n > (MASKED_RUN if c in ANY_LETTER else 2):
                    out.append([("", COST_FILLER)])
                elif n >= 3 and looks:
                    ways = [(x, COST_LOOKS) for x in looks] + [(x * 2, COST_LOOKS + COST_RUN) for x in looks]
                    out.append(ways + [("", COST_DROP)])
                else:
                    ways = [(x, COST_LOOKS) for x in looks]
                    if c in FILLERS and not (masked and c in ANY_LETTER):
                        ways.append(("", COST_FILLER))
                    if c in ANY_LETTER:
                        ways += [(x, COST_ANY) for x in LETTERS]
                    if not ways or c not in FILLERS:
                        ways.append(("", COST_DROP))
                    out += [ways] * n
            at = end
        return out

    def decode(self, token: str, masked: bool = False) -> str:
        """The likeliest word for a lower-case token."""
        return self.best(self.arcs(token, masked))

    def undoubled(self, word: str) -> str:
        """``decode`` of a plain a-z word without long runs: what a run's length costs depends on its neighbours only."""
        edged = f" {word} "
        drop = [m.start() for m in DOUBLE.finditer(word) if edged[m.start() : m.start() + 4] in self.once]
        for at in reversed(drop):
            word = word[:at] + word[at + 1 :]
        return word

    def best(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The likeliest path's letters; a space in a way is a word's edge."""
        model = self.model
        # a path's letters hang in (path before, letters) pairs, so that a step does not copy them
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        for ways in lattice:
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in best.items():
                for letters, cost in ways:
                    s, x, y = score - cost, a, b
                    for ch in letters:
                        if ch == " ":
                            s += model[x][y][EDGE]
                            x = y = EDGE
                        else:
                            k = ord(ch) - 96
                            s += model[x][y][k]
                            x, y = y, k
                    found = new.get((x, y))
                    if found is None or s > found[0]:
                        new[x, y] = (s, (path, letters))
            best = new
        path = max(((s + model[a][b][EDGE], a, b), p) for (a, b), (s, p) in best.items() if p or not lattice)[1]
        out = []
        while path:
            path, letters = path
            out.append(letters)
        return "".join(reversed(out))

    def row(self, found: str) -> list[str]:
        """A row of single characters as words set apart by spaces: its readings, the likeliest first."""
        marks = ROW_MARK.findall(found.lower())
        gaps = [len(g) for _, g in marks[:-1]]
        if not gaps:  # the rest are fillers
            return []
        if any(c.isalpha() and c not in LETTERS for c, _ in marks):  # the model does not know these
            return ["".join(c for c, _ in marks)]
        wide = min(gaps) < max(gaps)
        ends = [0.0, *(COST_GAP * (wide and g == min(gaps)) for g in gaps)]
        joins = [0.0, *(COST_GAP * (wide and g > min(gaps)) for g in gaps)]
        out = []
        for end in COST_END:
            lattice = []
            at = 0
            while at < len(marks):
                c = marks[at][0]
                n = 1
                while at + n < len(marks) and marks[at + n][0] == c:
                    n += 1
                first = at
                if n >= 3:  # drawn out, or a word's end lies in it
                    ways = self.arcs(c * 3)[0]
                    ways = ways + [(f"{a} {b}", u + v + end) for a, u in ways for b, v in ways if a and b]
                    at += n
                else:
                    ways = self.arcs(c)[0]
                    at += 1
                if first:
                    ways = [(w, v + joins[first]) for w, v in ways] + [(" " + w, v + end + ends[first]) for w, v in ways if w]
                lattice.append(ways)
            out.append(" ".join(self.best(lattice).split()))
        return [t for t in dict.fromkeys(out) if t]

    def words(self, token: str) -> list[str]:
        """The restored words of one white-space-free token; more than one where it has several readings."""
        t = token.lower()
        if t.isascii() and t.isalpha() and not DOUBLE.search(t):
            return [t]
        core = t.strip(STRIP_LEFT).rstrip(STRIP_RIGHT)
        if PLAIN.match(core) and not LONG_RUN.search(core):
            if not DOUBLE.search(core) or not LATIN.match(core):
                return [core]
            return list(dict.fromkeys([self.undoubled(core), core]))
        if not t:
            return []
        out = [self.decode(core, masked=True)] if any(c in core for c in ANY_LETTER) else []
        out.append(self.decode(core))
        pieces = [p for p in INNER.split(core) if p]
        if len(pieces) > 1:
            out += [p if PLAIN.match(p) and not LONG_RUN.search(p) else self.decode(p) for p in pieces if len(p) > 1]
        full = t.rstrip(".,;:?\"')]")  # signs at the edges may be letters
        if full != core and any(c in LOOKS_LIKE for c in full.replace(core, "", 1)):
            out.append(self.decode(full))
        return [w for w in dict.fromkeys(out) if w]

    def restore(self, text: str) -> str:
        """The text with every hidden word written out (its first reading)."""
        text = APART.sub(lambda m: next(iter(self.row(m[0])), m[0]), text)

        def one(m):
            token = m[0]
            core = token.strip(STRIP_LEFT).rstrip(STRIP_RIGHT)
            if all(len(p) > 1 and PLAIN.match(p) and not LONG_RUN.search(p) for p in INNER.split(core) if p):
                if not LATIN.match(core.lower()):
                    return token
                likeliest = self.words(core)[0]
                # one double letter less may be an ordinary word; scoring reads both
                return token if len(core) - len(likeliest) < 2 else token.replace(core, likeliest, 1)
            words = self.words(token)
            return words[0] if words else token

        return re.sub(r"\S+", one, text)

    def tokens(self, text: str) -> set[str]:
        """The text's distinct tokens, with rows of single letters joined and as the words they hold."""
        out = set(text.split())
        for m in APART.finditer(text):
            out.add("".join(x for x in m[0] if x not in " .-_*~/,"))
            out.add("".join(m[0].split()))
            out.update(w for t in self.row(m[0]) for w in t.split())
        return out


def features(word: str, s: Settings) -> list[int]:
    """Hashed features of a restored word: the word, and its beginnings."""
    digest, shift, size = xxhash.xxh3_64_intdigest, 64 - s.hash_bits, len(word)
    raw = word.encode("utf-8", "replace")
    out = [digest(b"=" + raw) >> shift]
    if len(raw) == size:  # a byte a character: bytes are cut where characters would be
        for n in s.prefixes:
            if size >= n:
                out.append(digest(raw[:n]) >> shift)
    else:
        out += [digest(word[:n].encode("utf-8", "replace")) >> shift for n in s.prefixes if size >= n]
    return out


def word_cells(words: dict[str, int]) -> np.ndarray:
    """How often each letter (or a word's end) follows two letters, over plain a-z words and their counts."""
    plain, times = [], []
    for w, n in words.items():
        w = w.strip(STRIP_LEFT).rstrip(STRIP_RIGHT)
        if not LATIN.match(w):
            continue
        plain.append(w)
        times.append(n)
    # one line of words with two edges before each: every letter or edge that ends a word has its two letters before it
    line = np.frombuffer("".join(["``" + w for w in plain] + ["``"]).encode(), np.uint8).astype(np.int64) - 96
    sizes = np.fromiter(map(len, plain), np.int64, len(plain))
    cell = (line[:-2] * SIZE + line[1:-1]) * SIZE + line[2:]
    # the place after a word's end belongs to no word
    own = np.ones(len(cell), bool)
    own[np.cumsum(sizes + 2) - 1] = False
    cells = np.zeros(SIZE**3, np.int64)
    np.add.at(cells, cell[own], np.repeat(np.array(times, np.int64), sizes + 1))
    return cells


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of a letter after two, over the plain a-z words of all documents."""

    def count(batches):
        import pyarrow as pa

        for b in batches:
            words = Counter()
            for t in b.column(0).to_pylist():
                words.update(t.lower().split())
            cells = word_cells(words)
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(cells[at], pa.int64())], ["cell", "n"])

    counted = docs.select(whole(text).alias("t")).mapInArrow(count, "cell int, n bigint")
    table = np.zeros(SIZE**3)
    for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most 27 cubed rows
        table[r["cell"]] = r["n"]
    table = table.reshape(SIZE, SIZE, SIZE)
    single = table.sum((0, 1)) + 1.0
    single /= single.sum()
    two = table.sum(0) + 5.0 * single
    two /= two.sum(1, keepdims=True)
    three = table + 5.0 * two[None, :, :]
    return np.log(three / three.sum(2, keepdims=True))


def _cached(known: dict, make, limit: int = 300_000):
    def get(token: str):
        found = known.get(token)
        if found is None:
            if len(known) > limit:
                known.clear()
            found = known[token] = make(token)
        return found

    return get


@dataclass
class Scorer:
    """What scoring needs: the language model, rated features and the weights of a text's summary."""

    model: np.ndarray
    ratings: dict[int, float]
    weights: np.ndarray
    settings: Settings


def rating(a: float, b: float, share: float, tries: float, s: Settings) -> float:
    """Of a feature of ``a`` toxic and ``b`` clean documents, where ``share`` of all are toxic."""
    n = a + b
    if a < 1:
        return 0.0
    p = a / n
    z2 = s.z * s.z
    low = (p + z2 / (2 * n) - s.z * math.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)
    # how unlikely the share is by chance (Chernoff), against as many tries as there are features
    away = n * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0))
    sure = p > share and away >= math.log(tries / s.false_features)
    return low if sure else low * s.unsure


def summary(ratings: list[float], s: Settings) -> list[float]:
    """A text as numbers: its highest word ratings, how many are high, and how many words it has."""
    some = sorted([r for r in ratings if r > 0.0], reverse=True)
    top = some[: s.telling]
    top += [0.0] * (s.telling - len(top))
    high = [math.log1p(sum([r >= t for r in some])) for t in (0.3, 0.5, 0.8)]
    return [1.0, *top, *high, math.log1p(len(ratings)) / 5]


OWN = {"all": (0, 0), "y1": (1, 0), "y0": (0, 1)}  # a document's own counts by its label


def rated(counts: list[tuple[int, int, int]], share: float, tries: float, s: Settings, name: str) -> dict[int, float]:
    """The telling features, a labelled document's own count taken off: it must not be told by itself."""
    a, b = OWN[name]
    found = ((f, rating(x - a, max(y - b, 0), share, tries, s)) for f, x, y in counts)
    return {f: r for f, r in found if r >= s.min_rating}


def _opened(shared, s: Settings, name: str):
    """The worker's channel and its cached word ratings under the table ``name``."""
    parts = shared.value
    if "channel" not in parts:
        parts["channel"] = Channel(parts["model"])
    channel = parts["channel"]
    if f"get-{name}" not in parts:
        table = parts[name] if name in parts else rated(parts["counts"], parts["share"], parts["tries"], s, name)

        def rate(tok: str) -> float:
            best = 0.0
            for w in channel.words(tok):
                for f in features(w, s):
                    r = table.get(f, 0.0)
                    if r > best:
                        best = r
            return best

        parts[f"get-{name}"] = _cached({}, rate)
    return channel, parts[f"get-{name}"]


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small ridge."""
    w = np.zeros(x.shape[1])
    w[0] = -2.0
    if len(y) == 0:
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - 0.3 * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.3 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, g), -2, 2)
    return w


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
    settings: Settings = Settings(), model: np.ndarray | None = None,
) -> Scorer:
    """Rate features and fit the score on (at most ``max_rated`` of) the documents in ``labels``."""
    s = settings
    if model is None:
        model = language_model(docs, text)
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("y"))
    known = known.distinct().orderBy(F.xxhash64("_id"), "_id", "y")
    # copies of a document are one document: the one whose id's hash comes first
    keyed = docs.select(F.col(doc_id).alias("_id"), content_key(whole(text)).alias("who")).join(known, "_id")
    firsts = keyed.groupBy("who", "y").agg(F.min(F.struct(F.xxhash64("_id").alias("h"), "_id")).alias("first"))
    firsts = firsts.select("first._id", "who", "y").orderBy("first.h", "_id", "y", "who")
    # at most max_rated rows: a broadcast of proven size
    rated_on = F.broadcast(freeze(firsts.limit(s.max_rated), "rated"))
    same = (F.col(doc_id) == F.col("_id")) & (content_key(whole(text)) == F.col("who"))
    labelled = docs.join(rated_on, same).select("who", "y", whole(text).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})

    def describe(texts):
        import pyarrow as pa

        parts = shared.value
        if "get" not in parts:
            channel = parts["channel"] = Channel(parts["model"])
            parts["get"] = _cached({}, lambda tok: [f for w in channel.words(tok) for f in features(w, s)])
        rows = []
        for t in texts:
            t = t.as_py()
            found: set[int] = set()
            for tok in parts["channel"].tokens(t):
                found.update(parts["get"](tok))
            rows.append(list(found))
        return pa.array(rows, pa.list_(pa.int32()))

    described = labelled.select("who", "y", F.arrow_udf(describe, "array<int>")("t").alias("f"))
    # rows that repeat in id and text have the same features
    described = freeze(described.dropDuplicates(["who", "y"]), "described")
    totals = {r["y"]: r["n"] for r in described.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = described.select("y", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")
    )
    counts = freeze(counts.where(F.col("a") > 0), "features")
    tried = counts.count()
    # the table holds what a text can be told by; at most 2 ** hash_bits rows
    enough = (F.col("a") >= s.min_docs) & (F.col("a") >= s.min_rating * (F.col("a") + F.col("b")))
    table = counts.where(enough).collect()
    share = min(max(totals.get(1, 0) / max(sum(totals.values()), 1), 1e-6), 1 - 1e-6)
    tries = max(tried, 1)
    # a labelled document must not be told by itself: its own count is taken off for the fit
    parts = {"model": model, "counts": [(r["f"], r["a"], r["b"]) for r in table], "share": share, "tries": tries}
    told = docs.sparkSession.sparkContext.broadcast(parts)

    def describe_fit(texts, labels):
        import pyarrow as pa

        rows = []
        for t, y in zip(texts, labels, strict=True):
            channel, get = _opened(told, s, f"y{y.as_py()}")
            rows.append(summary([get(tok) for tok in channel.tokens(t.as_py())], s))
        return pa.array(rows, pa.list_(pa.float64()))

    fit_on = known.limit(s.max_docs)
    sample = docs.join(F.broadcast(fit_on), F.col(doc_id) == F.col("_id")).select("_id", "y", whole(text).alias("t"))
    sample = sample.select("_id", "y", F.arrow_udf(describe_fit, "array<double>")("t", "y").alias("x"))
    # one row for an id and label, however often the id repeats: at most max_docs come to the driver
    sample = sample.groupBy("_id", "y").agg(F.min("x").alias("x"))
    fitted = sample.toArrow().sort_by([("_id", "ascending"), ("y", "ascending")])
    x = np.array(fitted.column("x").to_pylist(), np.float64).reshape(-1, len(summary([], s)))
    ratings = rated(parts["counts"], share, tries, s, "all")
    return Scorer(model, ratings, _fit(x, np.array(fitted.column("y").to_pylist(), np.float64)), s)


def score(docs: DataFrame, scorer: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the toxicity of the whole restored text, 0 to 1."""
    s, weights = scorer.settings, scorer.weights
    shared = docs.sparkSession.sparkContext.broadcast({"model": scorer.model, "all": scorer.ratings})

    def rate(texts):
        import pyarrow as pa

        channel, get = _opened(shared, s, "all")
        x = np.array([summary([get(tok) for tok in channel.tokens(t.as_py())], s) for t in texts], np.float64)
        p = 1 / (1 + np.exp(-np.clip(x.reshape(-1, len(weights)) @ weights, -30, 30)))
        return pa.array(p, pa.float64())

    return docs.withColumn(out, F.arrow_udf(rate, "double")(whole(text)))


def restore(docs: DataFrame, model: np.ndarray, text: str = "text", out: str = "restored") -> DataFrame:
    """Add ``out``: the whole text with hidden words written out."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})

    def rewrite(texts):
        import pyarrow as pa

        parts = shared.value
        if "channel" not in parts:
            parts["channel"] = Channel(parts["model"])
        return pa.array([parts["channel"].restore(t.as_py()) for t in texts], pa.string())

    return docs.withColumn(out, F.arrow_udf(rewrite, "string")(whole(text)))
