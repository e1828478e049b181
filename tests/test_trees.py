"""Trees grown by shared histograms against plain recursive ones."""

import math

import numpy as np
import pytest

from stormlake.operators import trees as T
from stormlake.session import materialize


def _rows(spark, sets):
    """sets: dataset -> (x, y, part); binned rows and the matrix of bins."""
    data = [(d, int(p), d * 100_000 + i, int(y), [None if np.isnan(v) else float(v) for v in row])
            for d, (x, ys, ps) in sets.items() for i, (row, y, p) in enumerate(zip(x, ys, ps, strict=True))]
    df = spark.createDataFrame(data, "dataset int, part int, rid long, label int, features array<double>").repartition(5)
    rows = materialize(T.binned(df, T.bin_edges(df)))
    got = {(r.dataset, r.rid): np.frombuffer(r.bins, np.uint8) for r in rows.collect()}
    return rows, {d: np.stack([got[d, d * 100_000 + i] for i in range(len(x))]) for d, (x, _, _) in sets.items()}


def _data(n, seed, features=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, features)).round(1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] * x[:, 2] > 0.1) ^ (rng.random(n) < 0.1)).astype(int)
    return x, y, np.zeros(n)


def _options(run, bins, g, h, rows, columns):
    """Every allowed split of the rows, in the order of (feature, bin): (feature, bin, left rows, right rows)."""
    for f in columns:
        for b in range(255):
            left = bins[rows, f] <= b
            if run.min_leaf <= left.sum() <= len(rows) - run.min_leaf and left.any() and not left.all():
                l, r = rows[left], rows[~left]
                if run.family == "tree" or min(h[l].sum(), h[r].sum()) >= run.min_hessian * T.UNIT:
                    yield int(f), b, l, r


def _worth(run, g, h, rows):
    if run.family == "tree":
        n, p = float(len(rows)), float(g[rows].sum())
        return (p * p + (n - p) * (n - p)) / n
    a, b = g[rows].sum() / T.UNIT, h[rows].sum() / T.UNIT + run.l2
    return a * a / b if b > 0 else 0.0


def _best(run, bins, g, h, rows, columns):
    best = None
    if len(rows) < max(2, run.min_split) or run.family == "tree" and g[rows].sum() in (0, len(rows)):
        return None
    whole = _worth(run, g, h, rows)
    for f, b, l, r in _options(run, bins, g, h, rows, columns):
        gain = _worth(run, g, h, l) + _worth(run, g, h, r) - whole
        if best is None or gain > best[0]:
            best = (gain, f, b, l, r)
    least = {"tree": -math.inf, "depth": 1e-6, "leaf": max(run.min_gain, 1e-12)}[run.family]
    return best if best and best[0] > least else None


def _leaves(run, bins, g, h, rows, columns):
    """The rows of each leaf, by plain growth."""
    if run.family == "leaf":
        open_, leaves = [(rows, 0, _best(run, bins, g, h, rows, columns))], 1
        while leaves < run.leaves:
            able = [i for i, (_, level, b) in enumerate(open_) if b and (run.depth < 0 or level < run.depth)]
            if not able:
                break
            i = max(able, key=lambda k: open_[k][2][0])
            _, level, (_, _, _, l, r) = open_.pop(i)
            open_ += [(p, level + 1, _best(run, bins, g, h, p, columns)) for p in (l, r)]
            leaves += 1
        return [r for r, _, _ in open_]
    out, todo = [], [(rows, 0)]
    while todo:
        rows, level = todo.pop()
        best = _best(run, bins, g, h, rows, columns) if run.depth < 0 or level < run.depth else None
        if best is None:
            out.append(rows)
        else:
            todo += [(best[3], level + 1), (best[4], level + 1)]
    return out


def _value(run, g, h, rows):
    if run.family == "tree":
        return g[rows].sum() / len(rows)
    b = h[rows].sum() / T.UNIT + run.l2
    return -run.rate * (g[rows].sum() / T.UNIT) / b if b > 0 else 0.0


def _plain(run, bins, y, rid):
    """(scores, leaves of each tree); only for runs that see all rows or sample them by row_share."""
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())) if run.prior else 0.0)
    if run.family == "tree":
        margin[:] = 0.0
    sizes = []
    for no in range(run.trees):
        g, h = T.gradients(run, y, margin)
        rows = np.flatnonzero(T.uniform(rid, run.seed, no, 0) < run.row_share) if run.row_share < 1 else np.arange(len(y))
        columns = T.columns_of(run, bins.shape[1], no)
        leaves = _leaves(run, bins, g, h, rows, columns)
        sizes.append(len(leaves))
        step = np.full(len(y), np.nan)
        for l in leaves:
            step[l] = _value(run, g, h, l)
        margin = margin + step  # rows that were not drawn are nan: compared on the first tree only
        if run.row_share < 1:
            break
    return (margin if run.family == "tree" else 1 / (1 + np.exp(-margin))), sizes


def _scores(rows, models):
    out = {}
    for r in T.predictions(rows, dict(enumerate(models)), [0, 1, 2]).collect():
        out.setdefault(r.run, {})[r.rid] = r.score
    return out


RUNS = [
    T.Run(0, "tree"), T.Run(0, "tree", depth=4, min_split=20, min_leaf=7), T.Run(1, "tree", depth=40, min_leaf=2),
    T.Run(0, "depth", trees=5, depth=3, rate=0.3, l2=1.0, min_hessian=1.0),
    T.Run(1, "depth", trees=4, depth=2, rate=0.1, l2=1.0, col_share=0.6, seed=42),
    T.Run(0, "leaf", trees=4, leaves=9, rate=0.2, min_leaf=5, min_hessian=1e-3, prior=True),
    T.Run(1, "leaf", trees=3, leaves=25, depth=4, rate=0.1, min_leaf=3, min_gain=0.05, prior=True),
]


def test_many_runs_at_once_equal_plain_ones(spark):
    sets = {0: _data(300, 1), 1: _data(220, 2)}
    rows, bins = _rows(spark, sets)
    models = T.fit(rows, RUNS, save_every=2)
    got = _scores(rows, models)
    for i, run in enumerate(RUNS):
        y = sets[run.dataset][1]
        rid = run.dataset * 100_000 + np.arange(len(y))
        exp, sizes = _plain(run, bins[run.dataset], y, rid)
        assert np.allclose([got[i][k] for k in rid], exp, atol=1e-6), run
        for t, n in zip(models[i].trees, sizes, strict=True):
            reached = np.unique(t.leaf_of(bins[run.dataset]))
            assert len(reached) == n and (run.family != "leaf" or n <= run.leaves)
            assert run.depth < 0 or max(t.level[k] for k in reached) <= run.depth


def test_rows_and_columns_are_drawn_per_tree(spark):
    sets = {0: _data(300, 3)}
    rows, bins = _rows(spark, sets)
    run = T.Run(0, "depth", trees=3, depth=3, rate=0.3, l2=1.0, row_share=0.5, col_share=0.5, seed=7)
    model, = T.fit(rows, [run])
    y, rid = sets[0][1], np.arange(300)
    exp, _ = _plain(run, bins[0], y, rid)
    first = T.Model(run, 0.0, model.trees[:1]).score(bins[0])
    drawn = ~np.isnan(exp)
    assert 100 < drawn.sum() < 200 and np.allclose(first[drawn], exp[drawn], atol=1e-6)
    draws = [set(T.columns_of(run, 5, no).tolist()) for no in range(20)]
    assert all(len(d) == 2 for d in draws) and len({frozenset(d) for d in draws}) > 3
    for no, t in enumerate(model.trees):
        assert {f for f in t.feature if f >= 0} <= draws[no]


def test_feature_share_per_node(spark):
    sets = {0: _data(300, 4, features=30)}
    rows, bins = _rows(spark, sets)
    models = T.fit(rows, [T.Run(0, "tree", max_features=m, seed=1) for m in (None, "sqrt", "log2")])
    assert len({tuple(m.trees[0].feature) for m in models}) == 3
    for m in models:  # grown to the end: only rows that no bin tells apart are left together
        score = m.score(bins[0])
        for key in np.unique(bins[0], axis=0):
            same = (bins[0] == key).all(1)
            assert np.allclose(score[same], sets[0][1][same].mean())


def test_same_trees_for_any_partitions(spark):
    sets = {0: _data(300, 5)}
    rows, _ = _rows(spark, sets)
    runs = [T.Run(0, "leaf", trees=3, leaves=12, rate=0.1, prior=True), T.Run(0, "depth", trees=3, depth=4, l2=1.0)]
    a, b = (T.fit(materialize(rows.repartition(n)), runs) for n in (1, 7))
    assert [m.trees for m in a] == [m.trees for m in b]


def test_parts_one_class_nulls_and_no_rows(spark):
    x, y, p = _data(120, 6)
    p[100:] = 2
    x[::7, 0] = np.nan
    x[:, 3] = np.nan  # no value at all
    sets = {0: (x, y, p), 1: (x[:20], np.ones(20), np.zeros(20))}
    rows, bins = _rows(spark, sets)
    runs = [T.Run(0, "tree"), T.Run(1, "tree"), T.Run(1, "depth", trees=2, depth=3, l2=1.0), T.Run(9, "tree"), T.Run(0, "tree", parts=(2,))]
    models = T.fit(rows, runs)
    exp, _ = _plain(T.Run(0, "tree"), bins[0][:100], y[:100], np.arange(100))
    assert np.allclose(models[0].score(bins[0][:100]), exp)
    assert 3 not in models[0].trees[0].feature
    assert models[1].trees[0].feature == [-1] and models[1].trees[0].value == [1.0]
    assert (models[2].score(bins[1]) > 0.5).all() and models[3].trees == []
    exp, _ = _plain(T.Run(0, "tree"), bins[0][100:], y[100:], np.arange(20))
    assert np.allclose(models[4].score(bins[0][100:]), exp)


@pytest.mark.parametrize("bins", [3, 255])
def test_edges_of_few_and_of_many_values(spark, bins):
    df = spark.createDataFrame([(0, 0, i, 0, [float(i % 3), float(i), None]) for i in range(1000)],
                               "dataset int, part int, rid long, label int, features array<double>")
    few, many, none = T.bin_edges(df, bins=bins)[0]
    assert few.tolist() == [0.5, 1.5] and len(none) == 0 and len(many) == bins - 1 and (np.diff(many) > 0).all()
