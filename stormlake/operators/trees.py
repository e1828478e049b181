"""Decision trees and boosted trees, many runs grown together (ML1-ML3, PL11).

A run is a data set, a family and its parameters.  All runs share one table of
binned rows and grow in rounds: a round is one job, in which tasks add up histograms keyed by
(run, node, feature, bin) over their rows and each node's best split is found where its histograms
meet.  The driver holds trees (their size is bounded by the runs' parameters), never rows.

* ``tree``: one tree, gini, level by level, with min split, min leaf, a feature share per
  node and any depth;
* ``depth``: boosting (logistic loss), level by level; the rows and the columns of each
  tree are drawn by its own seeded hash;
* ``leaf``: boosting that always splits the leaf of the largest gain next, up to a
  leaf budget, with a least gain.  Gains are known a round at a time for all leaves that the
  budget could still reach; the order of splits is replayed from them.

Gradients are rounded to integers (2^-30), so sums, splits and trees do not depend on how
rows fall into tasks.  Margins of finished trees are written with the rows every ``SAVE`` trees; in between,
tasks add the trees since then.  Ties go to the smaller feature and the smaller bin.

Defined results: a run without rows, or with rows of one class, is a single leaf (boosted: of its
prior); a feature without a value is never split on; a null value goes with the least.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlake.session import Stages

BINS = 255
SAVE = 8
UNIT = float(1 << 30)
MOST_HELD = 1 << 27  # bytes of cells that a task holds before it adds them up, or gives them out
BUCKETS = 8
_NODE_SHIFT = 32  # of a node in a cell's key, above 24 bits of feature and 8 of bin
_EDGE_ACCURACY = 100_000


@dataclass
class Run:
    """One model to fit.  ``parts``: which parts of its data set its rows are."""

    dataset: int
    family: str
    parts: tuple[int, ...] = (0,)
    trees: int = 1
    depth: int = -1
    rate: float = 0.3
    row_share: float = 1.0
    col_share: float = 1.0
    max_features: str | None = None
    min_split: int = 2
    min_leaf: int = 1
    min_gain: float = 0.0
    min_hessian: float = 0.0
    l2: float = 0.0
    leaves: int = 0
    prior: bool = False  # start from the log odds of the rows
    seed: int = 0


@dataclass
class Tree:
    """Nodes by number; feature -1: a leaf.  Rows of bin <= cut go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    level: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        for side, value in zip((self.left, self.right), values, strict=True):
            side[node] = len(self.feature)
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.level, self.level[node] + 1),
                              (self.value, value)):
                column.append(x)
        return self.left[node], self.right[node]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (np.asarray(c) for c in (self.feature, self.cut, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        rows = np.flatnonzero(feature[node] >= 0)
        while len(rows):
            at = node[rows]
            node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
            rows = rows[feature[node[rows]] >= 0]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(bins)]


@dataclass
class Model:
    run: Run
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def score(self, bins: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out += t.predict(bins)
        return out if self.run.family == "tree" else 1.0 / (1.0 + np.exp(-out))


# --- draws, gradients, splits ---------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
        return x ^ (x >> np.uint64(31))


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each 64-bit key, fixed by key and salt."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64)
        for s in salt:
            x = _mix(x + np.uint64(s % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        return (_mix(x) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def columns_of(run: Run, features: int, tree: int) -> np.ndarray:
    """The columns that a tree may use."""
    n = max(1, int(features * run.col_share))
    return np.sort(np.argsort(uniform(np.arange(features), run.seed, tree, 1), kind="stable")[:n])


def gradients(run: Run, label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(g, h) of each row as integers; for a tree (class 1, 0)."""
    if run.family == "tree":
        return label.astype(np.int64), np.zeros(len(label), np.int64)
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - label) * UNIT).astype(np.int64), np.rint(p * (1 - p) * UNIT).astype(np.int64)


def leaf_value(run: Run, n: int, g: int, h: int) -> float:
    if run.family == "tree":
        return g / n if n else 0.0
    g, h = g / UNIT, h / UNIT + run.l2
    return -run.rate * g / h if h > 0 else 0.0


def _worth(run: Run, n: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """What a node's rows are worth together: a split's gain is what its sides are worth more."""
    if run.family == "tree":  # minus n times the gini impurity, up to a constant
        return np.divide(g * g + (n - g) * (n - g), n, out=np.zeros(np.shape(n)), where=np.asarray(n) > 0)
    g, h = g / UNIT, h / UNIT + run.l2
    return np.divide(g * g, h, out=np.zeros(np.shape(h)), where=np.asarray(h) > 0)


def best_split(run: Run, hist: np.ndarray, columns: np.ndarray, node: int) -> tuple[int, int, float, np.ndarray]:
    """hist (features, bins, 3): n, g, h -> (feature or -1, bin, gain, n g h of the left side)."""
    total = hist[0].sum(0)
    none = (-1, 0, 0.0, np.zeros(3, np.int64))
    if total[0] < max(2, run.min_split) or (run.family == "tree" and total[1] in (0, total[0])):
        return none
    left = np.cumsum(hist[columns], axis=1)[:, :-1]
    right = total - left
    ok = (left[..., 0] >= max(1, run.min_leaf)) & (right[..., 0] >= max(1, run.min_leaf))
    if run.family != "tree":
        ok &= np.minimum(left[..., 2], right[..., 2]) >= run.min_hessian * UNIT
    if run.max_features:  # the first features in a drawn order, more until one can be split
        n = max(1, int(math.sqrt(len(columns)) if run.max_features == "sqrt" else math.log2(len(columns))))
        order = np.argsort(uniform(columns, run.seed, node, 2), kind="stable")
        can = ok.any(1)[order]
        ok[order[max(n, int(can.argmax()) + 1 if can.any() else n):]] = False
    if not ok.any():
        return none
    parts = [_worth(run, *(x[..., i].astype(float) for i in range(3))) for x in (left, right)]
    gain = np.where(ok, parts[0] + parts[1] - _worth(run, *total.astype(float)), -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if run.family == "depth" and gain[f, b] <= 1e-6 or run.family == "leaf" and gain[f, b] <= max(run.min_gain, 1e-12):
        return none
    return int(columns[f]), int(b), float(gain[f, b]), left[f, b]


# --- binned rows ----------------------------------------------------------------

def bin_edges(rows: DataFrame, parts: tuple[int, ...] = (0, 1), bins: int = BINS) -> dict[int, list[np.ndarray]]:
    """rows(dataset, part, features array<double>) -> dataset -> the inner edges of each feature: midpoints of its
    values where they are few, else quantiles (approximate beyond 100,000 rows).  A few numbers a feature."""
    long = rows.where(F.col("part").isin(list(parts))).select("dataset", F.posexplode("features").alias("feature", "x"))
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x"))
    share = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    seen = long.groupBy("dataset", "feature").agg(
        F.approx_count_distinct("x", 0.02).alias("kinds"), F.percentile_approx("x", share, F.lit(_EDGE_ACCURACY)).alias("cuts"))
    seen = Stages(rows.sparkSession, "edges", clean=False).save(seen)
    few = long.join(seen.where(F.col("kinds") <= bins).select("dataset", "feature"), ["dataset", "feature"], "left_semi")
    values = few.distinct().groupBy("dataset", "feature").agg(F.sort_array(F.collect_list("x")).alias("values"))  # about ``bins`` at most
    found = seen.join(values, ["dataset", "feature"], "left")
    out: dict[int, list[np.ndarray]] = {}
    width = {r["dataset"]: r["n"] for r in rows.groupBy("dataset").agg(F.max(F.size("features")).alias("n")).collect()}
    for d, n in width.items():
        out[d] = [np.zeros(0)] * n
    for r in found.collect():
        x = np.asarray(r["values"] or [], float)
        out[r["dataset"]][r["feature"]] = (x[1:] + x[:-1]) / 2 if 0 < len(x) <= bins else np.unique(np.asarray(r["cuts"], float))
    return out


def _bin(edges: dict[int, list[np.ndarray]]):
    def run(batches):
        for pdf in batches:
            out = [b""] * len(pdf)
            for d in pdf["dataset"].unique():
                at = np.flatnonzero(pdf["dataset"].to_numpy() == d)
                x = np.stack([np.asarray(v, float) for v in pdf["features"].iloc[at]])
                x = np.where(np.isnan(x), -np.inf, x)
                bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges[d])], axis=1).astype(np.uint8)
                for i, b in zip(at, bins, strict=True):
                    out[i] = b.tobytes()
            yield pdf[["dataset", "part", "rid", "label"]].assign(bins=out)
    return run


def binned(rows: DataFrame, edges: dict[int, list[np.ndarray]]) -> DataFrame:
    """rows(dataset, part, rid long, label, features) -> dataset, part, rid, label, bins (a byte a feature)."""
    rows = rows.select("dataset", "part", "rid", F.col("label").cast("int").alias("label"), "features")
    return rows.mapInPandas(_bin(edges), "dataset int, part int, rid long, label int, bins binary")


# --- growth ---------------------------------------------------------------------

@dataclass
class _Growth:
    """A run under way: finished trees, and of the growing one the nodes' splits known so far."""

    run: Run
    model: Model
    place: int  # of its margin among its data set's
    features: int
    columns: np.ndarray
    tree: Tree = field(default_factory=Tree)
    open: list[int] = field(default_factory=lambda: [0])
    splits: dict[int, tuple] = field(default_factory=dict)
    over: bool = False

    def may_part(self, node: int) -> bool:
        return self.run.depth < 0 or self.tree.level[node] < self.run.depth


def _batches_by_dataset(pdf: pd.DataFrame, saved: bool):
    for d in pdf["dataset"].unique():
        part = pdf[pdf["dataset"].to_numpy() == d]
        bins = np.frombuffer(b"".join(part["bins"]), np.uint8).reshape(len(part), -1)
        margins = np.frombuffer(b"".join(part["margins"]), np.float64).reshape(len(part), -1) if saved else None
        yield d, part, bins, margins


def _margin(bins: np.ndarray, margins: np.ndarray | None, place: int, base: float, since: list[Tree]) -> np.ndarray:
    out = np.full(len(bins), base) if margins is None else margins[:, place].copy()
    for t in since:
        out += t.predict(bins)
    return out


class _Cells:
    """Sums of (n, g, h) by (node, feature, bin), of the cells that have rows."""

    def __init__(self):
        self.key, self.sums, self.parts = np.zeros(0, np.int64), np.zeros((0, 3), np.int64), []

    def add(self, key: np.ndarray, sums: np.ndarray) -> None:
        self.parts.append((key, sums))

    def merge(self) -> None:
        key = np.concatenate([self.key, *(k for k, _ in self.parts)])
        sums = np.concatenate([self.sums, *(s for _, s in self.parts)])
        self.key, of = np.unique(key, return_inverse=True)
        order = np.argsort(of, kind="stable")
        edge = np.searchsorted(of[order], np.arange(len(self.key)))
        self.sums, self.parts = np.add.reduceat(sums[order], edge, axis=0) if len(edge) else sums, []


def _histograms(work: dict[int, list[tuple]], saved: bool):
    """mapInPandas: rows -> (run, bucket of nodes, cells): this task's histograms of the open nodes."""
    def give(held: dict[int, _Cells]) -> pd.DataFrame:
        out = []
        for number, cells in held.items():
            cells.merge()
            node = cells.key >> _NODE_SHIFT
            for bucket in np.unique(node % BUCKETS):
                at = node % BUCKETS == bucket
                out.append((number, int(bucket), cells.key[at].tobytes(), cells.sums[at].tobytes()))
        held.clear()
        return pd.DataFrame(out, columns=["run", "bucket", "cells", "sums"])

    def run(batches):
        held: dict[int, _Cells] = {}
        size = 0
        for pdf in batches:
            for d, part, bins, margins in _batches_by_dataset(pdf, saved):
                label, rid, parts = part["label"].to_numpy(), part["rid"].to_numpy(np.int64), part["part"].to_numpy()
                cell = (np.arange(bins.shape[1]) << 8) | bins
                for number, r, place, base, since, tree, open_, no in work.get(int(d), []):
                    rows = np.isin(parts, r.parts)
                    if r.row_share < 1.0:
                        rows &= uniform(rid, r.seed, no, 0) < r.row_share
                    rows = np.flatnonzero(rows)
                    node = tree.leaf_of(bins[rows])
                    wanted = np.zeros(len(tree.feature), bool)
                    wanted[open_] = True
                    rows, node = rows[wanted[node]], node[wanted[node]]
                    if not len(rows):
                        continue
                    margin = None if r.family == "tree" else _margin(
                        bins[rows], None if margins is None else margins[rows], place, base, since)
                    g, h = gradients(r, label[rows], margin)
                    each = np.stack([np.ones(len(rows), np.int64), g, h], axis=1)
                    cells = held.setdefault(number, _Cells())
                    cells.add(((node[:, None] << _NODE_SHIFT) | cell[rows]).ravel(), np.repeat(each, bins.shape[1], axis=0))
                    size += 32 * rows.size * bins.shape[1]
                    if size > MOST_HELD:
                        for c in held.values():
                            c.merge()
                        size = 32 * sum(len(c.key) for c in held.values())
                        if size > MOST_HELD // 2:
                            yield give(held)
                            size = 0
        if held:
            yield give(held)
    return run


_SPLIT = "run int, node int, feature int, cut int, gain double, n long, g long, h long, ln long, lg long, lh long"


def _choose(rules: dict[int, tuple[Run, int, np.ndarray]]):
    """applyInPandas over (run, bucket): add up the histograms, find each node's best split."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["run"].iloc[0])
        cells = _Cells()
        for key, sums in zip(pdf["cells"], pdf["sums"], strict=True):
            cells.add(np.frombuffer(key, np.int64), np.frombuffer(sums, np.int64).reshape(-1, 3))
        cells.merge()
        run, features, columns = rules[number]
        node, out = cells.key >> _NODE_SHIFT, []
        for n in np.unique(node):
            at = node == n
            hist = np.zeros((features << 8, 3), np.int64)
            hist[cells.key[at] & ((1 << _NODE_SHIFT) - 1)] = cells.sums[at]
            hist = hist.reshape(features, 256, 3)
            feature, cut, gain, left = best_split(run, hist, columns, int(n))
            out.append((number, int(n), feature, cut, gain, *hist[0].sum(0).tolist(), *(int(x) for x in left)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _SPLIT.split(", ")])
    return one


def _save_margins(work: dict[int, list[tuple]], saved: bool):
    def run(batches):
        for pdf in batches:
            out = [b""] * len(pdf)
            index = {k: i for i, k in enumerate(pdf.index)}
            for d, part, bins, margins in _batches_by_dataset(pdf, saved):
                all_ = [_margin(bins, margins, place, base, since) for place, base, since in work.get(int(d), [])]
                flat = np.stack(all_, axis=1) if all_ else np.zeros((len(part), 0))
                for k, m in zip(part.index, flat, strict=True):
                    out[index[k]] = np.ascontiguousarray(m).tobytes()
            yield pdf[["dataset", "part", "rid", "label", "bins"]].assign(margins=out)
    return run


def _take(growth: _Growth, node: int, row: dict) -> None:
    """Note a node's best split; the root's rows give its value."""
    if node == 0:
        growth.tree.value[0] = leaf_value(growth.run, row["n"], row["g"], row["h"])
    growth.splits[node] = row if row["feature"] >= 0 else None


def _part(growth: _Growth, node: int) -> tuple[int, int]:
    x = growth.splits[node]
    right = (x["n"] - x["ln"], x["g"] - x["lg"], x["h"] - x["lh"])
    return growth.tree.split(node, x["feature"], x["cut"], (leaf_value(growth.run, x["ln"], x["lg"], x["lh"]), leaf_value(growth.run, *right)))


def _level_by_level(growth: _Growth) -> list[int]:
    return [c for node in growth.open if growth.splits.get(node) for c in _part(growth, node) if growth.may_part(c)]


def _best_first(growth: _Growth) -> list[int]:
    """Nodes whose splits must be known next.  Splits are numbered as they are looked into; once all that
    the budget reaches are known, the tree is cut back to those taken in the order of gain."""
    budget = growth.run.leaves - 1
    heap, taken, front = [(-growth.splits[0]["gain"], 0)] if growth.splits.get(0) else [], [], []
    while heap and len(taken) + len(front) < budget:
        _, node = heapq.heappop(heap)
        parted = growth.tree.feature[node] >= 0
        if not parted:  # its children are not known: leaves after it might be taken too
            front.append(node)
            continue
        if not front:
            taken.append(node)
        else:
            front.append(node)
        for child in (growth.tree.left[node], growth.tree.right[node]):
            if growth.splits.get(child):
                heapq.heappush(heap, (-growth.splits[child]["gain"], child))
    new = [n for n in front if growth.tree.feature[n] < 0]
    if new:  # known at the depth limit without a look: no split; then the replay goes on
        return [c for n in new for c in _part(growth, n) if growth.may_part(c)] or _best_first(growth)
    keep = set(taken)
    for node in range(len(growth.tree.feature)):
        if growth.tree.feature[node] >= 0 and node not in keep:
            growth.tree.feature[node] = -1
    return []


def fit(rows: DataFrame, runs: list[Run], save_every: int = SAVE) -> list[Model]:
    """rows(dataset, part, rid, label, bins): a written table -> a model for each run."""
    stages = Stages(rows.sparkSession, "trees", clean=False)
    counts = {(r["dataset"], r["part"]): (r["n"], r["pos"], r["features"]) for r in rows.groupBy("dataset", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"), F.max(F.octet_length("bins")).alias("features")).collect()}
    growths, places = [], {}
    for run in runs:
        here = [counts[run.dataset, p] for p in run.parts if (run.dataset, p) in counts]
        n, pos, features = sum(c[0] for c in here), sum(c[1] for c in here), max((c[2] for c in here), default=0)
        base = 0.0
        if run.family != "tree" and run.prior and 0 < pos < n:
            base = math.log(pos / (n - pos))
        place = places.setdefault(run.dataset, 0)
        places[run.dataset] += 1
        growth = _Growth(run, Model(run, base), place, features, columns_of(run, features, 0))
        growth.over = not features or not run.trees
        growths.append(growth)
    since: list[list[Tree]] = [[] for _ in growths]
    saved = None
    while active := [i for i, x in enumerate(growths) if not x.over]:
        if any(len(since[i]) >= save_every for i in active):
            work: dict[int, list[tuple]] = {}
            for x, new in zip(growths, since, strict=True):
                work.setdefault(x.run.dataset, []).append((x.place, x.model.base, new))
            after = stages.save((saved or rows).mapInPandas(
                _save_margins(work, saved is not None), "dataset int, part int, rid long, label int, bins binary, margins binary"), "margins")
            if saved is not None:
                stages.drop(saved)
            saved, since = after, [[] for _ in growths]
        work, rules = {}, {}
        for i in active:
            x = growths[i]
            work.setdefault(x.run.dataset, []).append((
                i, x.run, x.place, x.model.base, since[i], x.tree, np.asarray(x.open), len(x.model.trees)))
            rules[i] = x.run, x.features, x.columns
        found = ((saved or rows).mapInPandas(_histograms(work, saved is not None), "run int, bucket int, cells binary, sums binary")
                 .groupBy("run", "bucket").applyInPandas(_choose(rules), _SPLIT).collect())  # a row a node
        for r in found:
            _take(growths[r["run"]], r["node"], r.asDict())
        for i in active:
            x = growths[i]
            x.open = (_best_first if x.run.family == "leaf" else _level_by_level)(x)
            if not x.open:
                x.model.trees.append(x.tree)
                since[i].append(x.tree)
                x.over = len(x.model.trees) >= x.run.trees
                x.tree, x.open, x.splits = Tree(), [0], {}
                x.columns = columns_of(x.run, x.features, len(x.model.trees))
    if saved is not None:
        stages.drop(saved)
    return [x.model for x in growths]


def predictions(rows: DataFrame, models: dict[int, Model], parts: Iterable[int]) -> DataFrame:
    """rows(dataset, part, rid, label, bins) -> run, dataset, rid, label, score, prediction for each model of the row's data set."""
    by: dict[int, list[tuple[int, Model]]] = {}
    for number, m in models.items():
        by.setdefault(m.run.dataset, []).append((number, m))

    def run(batches):
        for pdf in batches:
            for d, part, bins, _ in _batches_by_dataset(pdf, False):
                for number, m in by.get(int(d), []):
                    score = m.score(bins)
                    yield pd.DataFrame({"run": number, "dataset": int(d), "rid": part["rid"].to_numpy(), "label": part["label"].to_numpy(),
                                        "score": score, "prediction": (score > 0.5).astype(int)})

    kept = rows.where(F.col("part").isin(list(parts)))
    return kept.mapInPandas(run, "run int, dataset int, rid long, label int, score double, prediction int")
