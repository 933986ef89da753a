"""op5: text quality by a generalised additive model with pairwise interactions.

Features are counts over the whole text. The model is a lookup table for each feature's bins and for the bins of
some pairs of features. Tables are learned by cyclic boosting: in each round every feature in turn gets a shallow
tree (one or two cuts of its bins) fitted to what the model still leaves, at a low rate; then the pairs that leave
most are found and boosted alike with trees that cut one feature and, on each side, the other. A document's
score is the logistic of the sum of its bins' entries.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, tidy

#: Labelled rows that the fit sees at most, and its other settings.
SAMPLE, BINS, PAIRS, ROUNDS, RATE, LEAST = 20_000, 32, 6, 150, 0.15, 8
THRESHOLD = 0.7
FEATURES = ("chars", "words", "word_length", "upper", "digits", "stops", "exclamations", "symbols", "bars", "white", "beyond_ascii", "distinct", "adjacent", "repeated_lines", "line_words", "top_word")

_UPPER, _LOWER = range(65, 91), range(97, 123)
_SYMBOLS = list(b"#$%&*@^~=+<>{}[]\\/_`")


def features(text: str) -> tuple[float, ...]:
    raw = text.encode()
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, words = max(1, len(raw)), text.split()
    upper, lower = int(n[_UPPER].sum()), int(n[_LOWER].sum())
    count = max(1, len(words))
    common = Counter(words)
    lines = text.split("\n")
    return (
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / count, upper / max(1, upper + lower), n[48:58].sum() / size, (n[46] + n[44] + n[63]) / count,
        n[33] / count, n[_SYMBOLS].sum() / size, n[124] / count, (n[32] + n[9] + n[10] + n[13]) / size, n[128:].sum() / size, np.log1p(len(common)) / np.log1p(count),
        sum(a == b for a, b in zip(words, words[1:])) / count, 1 - len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)), max(common.values(), default=0) / count,
    )


@dataclass
class GamModel:
    """Lookup tables; ``score`` only looks up bins and adds."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for i, t in enumerate(self.tables):
            out += t[b[:, i]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(x)))) if self.edges else np.full(len(x), 1 / (1 + np.exp(-self.base)))


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut of a row of bins, and the bin after it."""
    gl, hl, nl = (np.cumsum(v)[:-1] for v in (g, h, n))
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = np.where((nl >= LEAST) & (nr >= LEAST), gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1), -1.0)
    at = int(gain.argmax()) if len(gain) else 0
    return (float(gain[at]), at + 1) if len(gain) else (-1.0, 0)


def _step(g: np.ndarray, h: np.ndarray) -> float:
    return RATE * float(g.sum() / (h.sum() + 1))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Steps by bin of a tree with up to three leaves."""
    out = np.zeros(len(g))
    gain, cut = _best_cut(g, h, n)
    if gain <= 0:
        return out
    parts = [slice(0, cut), slice(cut, len(g))]
    again = [_best_cut(g[p], h[p], n[p]) for p in parts]
    k = int(again[1][0] > again[0][0])
    if again[k][0] > 0:
        p = parts.pop(k)
        parts += [slice(p.start, p.start + again[k][1]), slice(p.start + again[k][1], p.stop)]
    for p in parts:
        out[p] = _step(g[p], h[p])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the steps by cell of a tree that cuts the rows, then on each side the columns."""
    out, gain = np.zeros(g.shape), 0.0
    first, cut = _best_cut(g.sum(1), h.sum(1), n.sum(1))
    rows = [slice(0, cut), slice(cut, len(g))] if first > 0 else [slice(0, len(g))]
    gain += max(first, 0)
    for r in rows:
        own, at = _best_cut(g[r].sum(0), h[r].sum(0), n[r].sum(0))
        gain += max(own, 0)
        for c in [slice(0, at), slice(at, g.shape[1])] if own > 0 else [slice(0, g.shape[1])]:
            out[r, c] = _step(g[r, c], h[r, c])
    return gain, out


def fit(x: np.ndarray, y: np.ndarray) -> GamModel:
    """x: rows by features; y: 0 or 1. With one class the score is the smoothed share of ones; with no rows 0.75, which rejects nothing."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.75
    model = GamModel(base=float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    b = model.bins(x)
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in size]
    margin = model.margin(b)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    counts = [np.bincount(b[:, i], minlength=s) for i, s in enumerate(size)]
    for _ in range(ROUNDS):
        for i, s in enumerate(size):
            g, h = gradient()
            step = _tree(np.bincount(b[:, i], g, s), np.bincount(b[:, i], h, s), counts[i])
            model.tables[i] += step
            margin += step[b[:, i]]
    g, h = gradient()

    def grid(i: int, j: int, w: np.ndarray | None) -> np.ndarray:
        return np.bincount(b[:, i] * size[j] + b[:, j], w, size[i] * size[j]).reshape(size[i], size[j])

    gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), grid(i, j, None))[0], i, j) for i in range(len(size)) for j in range(i + 1, len(size))), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((size[i], size[j])) for i, j in model.pairs]
    cells = [grid(i, j, None) for i, j in model.pairs]
    for _ in range(ROUNDS // 3):
        for k, (i, j) in enumerate(model.pairs):
            g, h = gradient()
            step = _pair_tree(grid(i, j, g), grid(i, j, h), cells[k])[1]
            model.pair_tables[k] += step
            margin += step[b[:, i], b[:, j]]
    return model


def held_out(doc_id: Column | str = "doc_id", parts: int = 4) -> Column:
    """Whether crc32 of the id as text leaves 2; an id that is null is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 2, F.lit(False))


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> GamModel:
    """Fits on at most ``sample`` labelled rows that aren't held out, taken by the hash of their id.

    labels: doc_id, quality; of an id with several labels the lowest counts, null labels and ids don't. Of an id with several
    texts the one with the smallest hash counts.
    """
    docs = documents(docs)
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")).where(~held_out())
    taken = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("_hash"), batch.column("doc_id"), batch.column("quality"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["hash", "doc_id", "quality", "x"])

    texts = docs.join(F.broadcast(taken), "doc_id").withColumn("_hash", F.xxhash64("text"))  # taken: as many rows as the sample has
    rows = texts.select("_hash", "doc_id", "text", "quality").mapInArrow(tidy(run), "hash long, doc_id long, quality double, x array<double>")
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("quality", "x"), "hash").alias("row")).select("doc_id", "row.*").orderBy("doc_id").limit(sample).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    return fit(x, rows.column("quality").to_numpy())


def classify(docs: DataFrame, model: GamModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs; null and empty texts are scored by their (zero) counts, and rows that repeat an id one by one."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = held.value.score(_matrix(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents(docs).mapInArrow(tidy(run), "doc_id long, score double, predicted int").select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: GamModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose predicted label is 1. One map, no join."""
    from .common import bounded_batches

    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = held.value.score(_matrix([t or "" for t in batch.column("text").to_pylist()]))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
