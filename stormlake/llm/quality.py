"""Quality classifier: a generalised additive model with pairwise interactions.

The model is an intercept plus one lookup table a feature plus one table for
each of a few feature pairs.  Tables are learnt by boosting in a cycle over the
features: each step fits a shallow tree (at most three cuts over a feature's
bins, or one cut of each of two features) to the log-loss's gradient and adds a
small part of it to the table.  A score is the sum of looked-up bins, put through the logistic
function: a few vectorised additions a text.

Features are counts over the whole text's bytes, words and lines; labels, lang,
source and ids are never among them.

The model is fitted on at most ``MAX_ROWS`` labelled rows (those with the
smallest md5 of their id), so the driver's share of the work is bounded; every
text is scored, in Spark tasks.

Defined results: null and empty texts have the features of an empty text and get
its score; a null id is not held out; rows that repeat an id are scored one by one (in fitting, an id counts once); without labels
of both kinds the score is the share of label 1 (0.5 without any); an empty table
gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, small_batches, table

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 40
RATE = 0.1
THRESHOLD = 0.7

FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "bangs", "signs", "bars", "brackets", "spaces",
            "lines", "stops", "beyond_ascii", "distinct_words", "word_again", "line_again", "top_word", "short_words")

_CLASS = np.zeros(256, np.int64)
for _i, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!?",
                           b"$%&*#@^~+=", b"|", b"<>{}[]()/\\_", b" \t\r", b"\n", b".,;:", bytes(range(128, 256))), 1):
    _CLASS[list(_set)] = _i


def features(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "replace")
    n = max(1, len(data))
    seen = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=12)
    _, upper, lower, digits, bangs, signs, bars, brackets, spaces, lines, stops, beyond = (float(x) for x in seen[:12])
    words = data.split()
    w = max(1, len(words))
    times = Counter(words)
    rows = [x for x in data.split(b"\n") if x.strip()]
    return [np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / w, upper / max(1.0, upper + lower),
            digits / n, bangs / n, signs / n, bars / n, brackets / n, spaces / n, lines / n, stops / n, beyond / n,
            len(times) / w, sum(map(eq, words, words[1:])) / w, 1 - len(set(rows)) / max(1, len(rows)),
            max(times.values(), default=0) / w, sum(1 for x in words if len(x) <= 3) / w]


def feature_matrix(texts) -> np.ndarray:
    return np.asarray([features(t) for t in texts], float).reshape(-1, len(FEATURES))


# --- the model --------------------------------------------------------------

def _cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int, ridge: float) -> tuple[float, int]:
    """(gain, place) of the best cut of bins lo..hi-1 into lo..place-1, place..hi-1."""
    if hi - lo < 2:
        return 0.0, lo
    a, b = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    worth = lambda x, y: x * x / (y + ridge)
    gain = worth(a[:-1], b[:-1]) + worth(a[-1] - a[:-1], b[-1] - b[:-1]) - worth(a[-1], b[-1])
    best = int(np.argmax(gain))
    return float(gain[best]), lo + best + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0, cuts: int = 3) -> np.ndarray:
    """A shallow tree over ordered bins: its value in each bin."""
    leaves = [(0, len(g))]
    for _ in range(cuts):
        found = [(*_cut(g, h, lo, hi, ridge), lo, hi) for lo, hi in leaves]
        gain, at, lo, hi = max(found)
        if gain <= 1e-9:
            break
        leaves.remove((lo, hi))
        leaves += [(lo, at), (at, hi)]
    out = np.zeros(len(g))
    for lo, hi in leaves:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _square(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """A tree of one cut along one axis and one along the other on either side."""
    best_gain, best = -1.0, np.zeros_like(g)
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        gain, at = _cut(a.sum(1), b.sum(1), 0, len(a), ridge)
        if at == 0:
            continue
        out = np.zeros_like(a)
        for part in (slice(0, at), slice(at, len(a))):
            more, cut = _cut(a[part].sum(0), b[part].sum(0), 0, a.shape[1], ridge)
            gain += more
            for side in (slice(0, cut), slice(cut, a.shape[1])):
                out[part, side] = a[part, side].sum() / (b[part, side].sum() + ridge)
        if gain > best_gain:
            best_gain, best = gain, (out.T if turn else out)
    return best


class AdditiveModel:
    """Lookup tables over binned features and feature pairs."""

    def __init__(self, edges, pair_edges, intercept: float, tables, pairs):
        self.edges, self.pair_edges, self.intercept, self.tables, self.pairs = edges, pair_edges, intercept, tables, pairs

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
        at = np.linspace(0, 1, bins + 1)[1:-1]
        return [np.unique(np.quantile(col, at)) if len(col) else np.zeros(0) for col in x.T]

    @staticmethod
    def _bin(edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, col, side="right") for e, col in zip(edges, x.T, strict=True)], 1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, bins=BINS, pair_bins=PAIR_BINS, n_pairs=PAIRS,
            rounds=ROUNDS, pair_rounds=PAIR_ROUNDS, rate=RATE) -> AdditiveModel:
        edges, pair_edges = cls._edges(x, bins), cls._edges(x, pair_bins)
        tables = [np.zeros(len(e) + 1) for e in edges]
        share = float(y.mean()) if len(y) else 0.5
        if len(y) == 0 or share in (0.0, 1.0):
            share = min(max(share, 1e-6), 1 - 1e-6)
            return cls(edges, pair_edges, float(np.log(share / (1 - share))), tables, [])
        intercept = float(np.log(share / (1 - share)))
        score = np.full(len(y), intercept)
        b, pb = cls._bin(edges, x), cls._bin(pair_edges, x)
        p = lambda: 1 / (1 + np.exp(-score))
        for _ in range(rounds):
            for f, t in enumerate(tables):
                q = p()
                step = rate * _tree(np.bincount(b[:, f], y - q, len(t)), np.bincount(b[:, f], q * (1 - q), len(t)))
                t += step
                score += step[b[:, f]]
        # the pairs whose grids take most of what is left
        q = p()
        found, shape = [], [len(e) + 1 for e in pair_edges]
        for i in range(x.shape[1]):
            for j in range(i):
                cell, size = pb[:, i] * shape[j] + pb[:, j], shape[i] * shape[j]
                g, h = np.bincount(cell, y - q, size), np.bincount(cell, q * (1 - q), size)
                found.append((float((g * g / (h + 1.0)).sum()) / size, i, j))
        pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in sorted(found, reverse=True)[:n_pairs]]
        for _ in range(pair_rounds):
            for i, j, t in pairs:
                q, cell = p(), pb[:, i] * shape[j] + pb[:, j]
                g, h = np.bincount(cell, y - q, t.size), np.bincount(cell, q * (1 - q), t.size)
                step = rate * _square(g.reshape(t.shape), h.reshape(t.shape))
                t += step
                score += step.ravel()[cell]
        return cls(edges, pair_edges, intercept, tables, pairs)

    def score(self, x: np.ndarray) -> np.ndarray:
        b, pb = self._bin(self.edges, x), self._bin(self.pair_edges, x)
        total = np.full(len(x), self.intercept)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for i, j, t in self.pairs:
            total += t[pb[:, i], pb[:, j]]
        return 1 / (1 + np.exp(-total))


# --- in Spark ---------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _featurise(batches):
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "x": feature_matrix(pdf["text"]).tolist()})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Learn labels(doc_id, quality) from docs(doc_id, text).  At most max_rows
    ids, none of them held out, are taken; their texts are found by a join with
    that bounded list, and only their features come to the driver."""
    spark = docs.sparkSession
    small_batches(spark)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows).collect())
    chosen = spark.createDataFrame(known, labels.select("doc_id", F.col("quality").cast("int")).schema)
    x = (docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
         .mapInPandas(_featurise, "doc_id long, quality int, x array<double>")
         .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).orderBy("doc_id").toPandas())
    return AdditiveModel.fit(np.asarray(x["x"].tolist(), float).reshape(-1, len(FEATURES)),
                             (x["quality"] == 1).to_numpy(float))


def _score(model: AdditiveModel):
    def run(batches):
        for pdf in batches:
            score = model.score(feature_matrix(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "score": score,
                                "predicted": (score >= THRESHOLD).astype("int32")})
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, score, predicted."""
    model = fit(docs, labels, max_rows)
    return (docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
            .mapInPandas(_score(model), "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
              max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores at least threshold."""
    model = fit(pick(docs, doc_id=key, text=text), labels, max_rows)
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = (x.as_py() for x in batch.column(at))  # one at a time
            yield batch.filter(pa.array(model.score(feature_matrix(texts)) >= threshold))
    return docs.mapInArrow(run, docs.schema)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"),
            pick(table(spark, sf_dir, "labels"), doc_id="doc_id", quality="quality"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(*_inputs(spark, sf_dir))
