"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. A line is described by counts of its
own (length, symbols, capitals, digits, repetition) and by those of the lines
before and after it; the chain's transition weights tie neighbouring labels.
Forward-backward gives each line's marginal probability of being good, and
their mean, weighted by the lines' words, is calibrated to the document's
score.

Labels are known for documents only, so in training every line takes its
document's label. The fit runs on the driver on a bounded sample
(``max_docs`` labelled documents, the first by a hash of their id, of at most
``max_lines`` lines together and ``longest`` each); scoring covers every text whole.

Empty and null texts are one empty line; very long ones are laid out in tables of
bounded size. The score uses nothing but the text. Null ids have no labels; of
rows that repeat a labelled id, the fit takes one. Without labels, or with one
label only, every document gets the labels' mean (0.5 without any). Empty tables
give empty results; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import freeze, whole

UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
SYMBOL = b"#*$%&|<>!@^~=+\\/{}[]_"
WHITE = b" \t\r\v\f"
OWN = 11
NEAR = (1, 2, 3, 5, 7, 8)  # of the own features, those also taken from the neighbours
WIDTH = OWN + 2 * len(NEAR) + 4  # and first, last, the text's length, a constant
CELLS = 400_000  # of a table of documents by lines that is worked on at a time


@dataclass(frozen=True)
class Settings:
    max_docs: int = 3000  # labelled documents that the fit uses at most
    max_lines: int = 300_000  # lines of these together; documents beyond it are left out of the fit
    longest: int = 3000  # lines of one document; longer ones are left out of the fit
    steps: int = 120
    rate: float = 0.2
    ridge: float = 1e-3
    seed: int = 11


@dataclass
class Model:
    unary: np.ndarray  # (WIDTH,), log-odds of good over bad
    pair: np.ndarray  # (2, 2)
    centre: np.ndarray
    scale: np.ndarray
    calibration: tuple[float, float] = (1.0, 0.0)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the text's lines that have a word; one empty line if none has."""
    rows, sizes = [], []
    seen: set[bytes] = set()
    pairs: set = set()
    for line in text.encode().split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line.translate(None, WHITE))
        upper = chars - len(line.translate(None, WHITE + UPPER))
        digits = chars - len(line.translate(None, WHITE + DIGIT))
        symbols = chars - len(line.translate(None, WHITE + SYMBOL))
        two = set(zip(words, words[1:]))
        fresh = len(two - pairs) if n > 1 else 1
        rows.append((
            np.log1p(n),
            symbols / chars,
            upper / chars,
            digits / chars,
            min(chars / n, 30.0) / 10,
            len(set(words)) / n,
            sum(len(w) < 4 for w in words) / n,
            fresh / max(n - 1, 1),
            float(line in seen),
            float(line.rstrip()[-1:] in b".!?\"" and line.rstrip()[-2:] != b"!!"),
            float(line.lstrip()[:1].isupper() or line[:1] > b"\x7f"),
        ))
        sizes.append(n)
        seen.add(line)
        pairs |= two
    if not rows:
        rows, sizes = [(0.0,) * OWN], [1]
    own = np.array(rows, np.float64)
    near = own[:, NEAR]
    flat = np.zeros((1, len(NEAR)))
    k = len(own)
    first, last = np.zeros((k, 1)), np.zeros((k, 1))
    first[0], last[-1] = 1, 1
    whole_text = np.full((k, 1), np.log1p(sum(sizes)))
    parts = [own, np.vstack((flat, near[:-1])), np.vstack((near[1:], flat)), first, last, whole_text, np.ones((k, 1))]
    return np.hstack(parts), np.array(sizes, np.float64)


def _marginals(score: np.ndarray, pair: np.ndarray, lengths: np.ndarray):
    """Forward-backward for sequences laid out as (sequence, place), longest first.

    ``score`` is the log-odds of good. Returns the marginals of good, the
    expected transitions (summed) and the log partition function (summed).
    """
    n, t = score.shape
    e = np.zeros((n, t, 2))
    e[:, :, 1] = score
    alpha, beta = np.full((n, t, 2), -np.inf), np.zeros((n, t, 2))
    alpha[:, 0] = e[:, 0]
    live = [int(np.searchsorted(-lengths, -i, "left")) for i in range(t + 1)]  # sequences longer than i
    for i in range(1, t):
        k = live[i]
        alpha[:k, i] = np.logaddexp(*(alpha[:k, i - 1, a, None] + pair[a] for a in (0, 1))) + e[:k, i]
    for i in range(t - 2, -1, -1):
        k = live[i + 1]
        after = beta[:k, i + 1] + e[:k, i + 1]
        beta[:k, i] = np.logaddexp(*(after[:, b, None] + pair[:, b] for b in (0, 1)))
    ends = alpha[np.arange(n), lengths - 1]
    log_z = np.logaddexp(ends[:, 0], ends[:, 1])
    inside = np.arange(t) < lengths[:, None]
    with np.errstate(invalid="ignore"):
        good = np.where(inside, np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None], 0.0)), 0.0)
    moves = np.zeros((2, 2))
    for i in range(1, t):
        k = live[i]
        for a in (0, 1):
            for b in (0, 1):
                moves[a, b] += np.exp(
                    alpha[:k, i - 1, a] + pair[a, b] + e[:k, i, b] + beta[:k, i, b] - log_z[:k]
                ).sum()
    return good, moves, log_z.sum()


def line_marginals(model: Model, features: list[np.ndarray]) -> list[np.ndarray]:
    """P(good) of every line, by document; documents of like length are laid out together."""
    out: list[np.ndarray] = [np.empty(0)] * len(features)
    by_length = sorted(range(len(features)), key=lambda i: -len(features[i]))
    at = 0
    while at < len(by_length):
        group = by_length[at : at + max(1, CELLS // len(features[by_length[at]]))]
        at += len(group)
        lengths = np.array([len(features[i]) for i in group])
        rows = np.repeat(np.arange(len(group)), lengths)
        cols = np.concatenate([np.arange(n) for n in lengths])
        grid = np.zeros((len(group), int(lengths[0])))
        x = np.vstack([features[i] for i in group])
        grid[rows, cols] = (x - model.centre) / model.scale @ model.unary
        good, _, _ = _marginals(grid, model.pair, lengths)
        for i, row, n in zip(group, good, lengths, strict=True):
            out[i] = row[:n]
    return out


def document_quality(model: Model, features: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """Word-weighted mean of the line marginals per document."""
    good = line_marginals(model, features)
    return np.array([(g * w).sum() / w.sum() for g, w in zip(good, sizes, strict=True)])


def fit(features: list[np.ndarray], sizes: list[np.ndarray], labels: list[int], s: Settings = Settings()) -> Model:
    """Fit the chain by gradient ascent (Adam) on the lines' conditional log-likelihood."""
    if not features or len(set(labels)) < 2:  # nothing to tell apart: every document gets the labels' value
        value = float(np.mean(labels)) if labels else 0.5
        odds = np.log((value + 0.01) / (1.01 - value))
        return Model(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH), (0.0, float(odds)))
    longest_first = sorted(range(len(features)), key=lambda i: -len(features[i]))
    features, sizes, labels = ([each[i] for i in longest_first] for each in (features, sizes, labels))
    lengths = np.array([len(f) for f in features])
    ends = np.cumsum(lengths)
    # documents of like length are laid out together, in tables of about CELLS places
    groups = []
    at = 0
    while at < len(lengths):
        group = slice(at, at + max(1, CELLS // int(lengths[at])))
        own = lengths[group]
        rows = np.repeat(np.arange(len(own)), own)
        cols = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        groups.append((own, rows, cols, slice(int(ends[at] - lengths[at]), int(ends[at + len(own) - 1]))))
        at = group.stop
    x = np.vstack(features)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    centre[-1], scale[-1] = 0, 1  # the constant
    x = (x - centre) / scale
    y = np.repeat(np.array(labels), lengths)
    # every document weighs the same, and both labels together
    share = np.array([np.mean(labels), 1 - np.mean(labels)])
    weight = np.where(np.array(labels) == 1, 0.5 / share[0], 0.5 / share[1])
    same = np.zeros((2, 2))
    np.add.at(same, (labels, labels), lengths - 1)
    theta = np.zeros(x.shape[1] + 4)
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    per_line = np.repeat(weight / lengths, lengths)
    for step in range(1, s.steps + 1):
        w, pair = theta[: x.shape[1]], theta[x.shape[1] :].reshape(2, 2)
        odds, good, moves = x @ w, np.empty(len(x)), np.zeros((2, 2))
        for own, rows, cols, lines in groups:
            grid = np.zeros((len(own), int(own[0])))
            grid[rows, cols] = odds[lines]
            inside, turned, _ = _marginals(grid, pair, own)
            good[lines] = inside[rows, cols]
            moves += turned
        gradient = np.concatenate((
            x.T @ (per_line * (y - good)) / len(lengths),
            ((same - moves) / max(lengths.sum(), 1)).ravel(),
        ))
        gradient -= s.ridge * theta
        mean = 0.9 * mean + 0.1 * gradient
        var = 0.999 * var + 0.001 * gradient**2
        theta += s.rate * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.999**step)) + 1e-9)
    model = Model(theta[: x.shape[1]], theta[x.shape[1] :].reshape(2, 2), centre, scale)
    model.calibration = _calibrate(document_quality(model, features, sizes), np.array(labels))
    return model


def _calibrate(quality: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from the quality's log-odds to the labels."""
    q = np.clip(quality, 1e-4, 1 - 1e-4)
    x = np.log(q / (1 - q))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, d = labels - p, p * (1 - p) + 1e-6
        g = np.array([(r * x).sum() - 0.1 * (a - 1), r.sum()])
        h = np.array([[(d * x * x).sum() + 0.1, (d * x).sum()], [(d * x).sum(), d.sum()]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + move[0], b + move[1]
    return float(max(a, 0.05)), float(b)


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Score between 0 and 1 of each text."""
    out = np.empty(len(texts))
    at = 0
    while at < len(texts):
        feats, sizes, size = [], [], 0
        start = at
        while at < len(texts) and size < 200_000:  # words laid out at a time
            f, w = line_features(texts[at])
            feats.append(f)
            sizes.append(w)
            size += int(w.sum())
            at += 1
        q = np.clip(document_quality(model, feats, sizes), 1e-4, 1 - 1e-4)
        a, b = model.calibration
        out[start:at] = 1 / (1 + np.exp(-np.clip(a * np.log(q / (1 - q)) + b, -30, 30)))
    return out


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    settings: Settings = Settings(),
) -> Model:
    """Fit on at most ``settings.max_docs`` of the labelled documents given, of ``settings.max_lines`` lines."""
    known = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("y"))
    order = F.xxhash64("_id", F.lit(settings.seed))
    known = known.distinct().orderBy(order, "_id", "y").limit(settings.max_docs)

    def measure(texts):
        import pyarrow as pa

        rows = []
        for t in texts:
            f, w = line_features(t.as_py())
            rows.append({"f": f.ravel().tolist(), "w": w.tolist()})
        return pa.array(rows, pa.struct([("f", pa.list_(pa.float64())), ("w", pa.list_(pa.float64()))]))

    described = F.arrow_udf(measure, "struct<f:array<double>,w:array<double>>")
    # at most max_docs ids: a broadcast of proven size
    sample = docs.join(F.broadcast(known), F.col(doc_id) == F.col("_id")).select("_id", "y", described(whole(text)).alias("x"))
    # one text for an id and label, however often the id repeats
    sample = freeze(sample.groupBy("_id", "y").agg(F.min("x").alias("x")), "labelled")
    # ids and numbers of lines of at most max_docs documents
    listed = sample.select("_id", "y", F.size("x.w").alias("n"), order.alias("h")).toArrow().to_pylist()
    chosen, lines = [], 0
    for r in sorted(listed, key=lambda r: (r["h"], r["_id"], r["y"])):
        if r["n"] <= settings.longest and lines + r["n"] <= settings.max_lines:
            lines += r["n"]
            chosen.append((r["_id"], r["y"]))
    used = F.broadcast(docs.sparkSession.createDataFrame(chosen, sample.select("_id", "y").schema))
    table = sample.join(used, ["_id", "y"], "left_semi").select("_id", "y", "x.*").toArrow()
    table = table.sort_by([("_id", "ascending"), ("y", "ascending")])
    feats = [np.array(f.as_py()).reshape(-1, WIDTH) for f in table.column("f")]
    sizes = [np.array(w.as_py()) for w in table.column("w")]
    return fit(feats, sizes, table.column("y").to_pylist(), settings)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the quality of the whole text, 0 to 1."""
    parts = (model.unary, model.pair, model.centre, model.scale, model.calibration)

    def rate(texts):
        import pyarrow as pa

        return pa.array(scores(Model(*parts), [t.as_py() for t in texts]), pa.float64())

    return docs.withColumn(out, F.arrow_udf(rate, "double")(whole(text)))


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
