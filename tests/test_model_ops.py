import itertools

import numpy as np
import pytest

from stormlake.operators import metrics, sampling
from stormlake.operators.features import one_hot, standard_scale
from stormlake.operators.joins import full_outer_null_safe
from stormlake.operators.knn import knn


def test_scaling_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "a double, b double")
    out = standard_scale(df, ["a", "b"]).collect()
    assert [r.b for r in out] == [0.0, 0.0, None]
    assert np.isclose(sum(r.a for r in out), 0.0)


def test_one_hot_null_category(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "s string")
    out = one_hot(df, "s", ["y", None, "x"]).collect()
    assert out[1]["s_nan"] == 1.0 and out[0]["s_x"] == 1.0 and out[2]["s_y"] == 1.0
    assert one_hot(df, "s", ["y", None, "x"]).columns == ["s", "s_x", "s_y", "s_nan"]


def test_full_outer_fanout_and_null_dates(spark):
    left = spark.createDataFrame([(0, "2020-01-01", 1.0), (0, None, 2.0)], "c int, d string, w double")
    right = spark.createDataFrame([(0, "2020-01-01", "A"), (0, "2020-01-01", "B"), (0, None, "C"),
                                   (0, "2021-01-01", "D")], "c int, d string, e string")
    out = full_outer_null_safe(left, right, ["c", "d"], null_safe=["d"]).collect()
    got = sorted((r.d or "", r.w or 0.0, r.e) for r in out)
    assert got == [("", 2.0, "C"), ("2020-01-01", 1.0, "A"), ("2020-01-01", 1.0, "B"), ("2021-01-01", 0.0, "D")]


def test_auc_matches_pairs_and_one_class(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = rng.integers(0, 40, 300).astype(float)   # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = metrics.roc_auc(df, parts=7).first().auc_roc
    pos, neg = s[y == 1], s[y == 0]
    exp = np.mean([(p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)])
    assert np.isclose(got, exp, rtol=1e-12)
    one = spark.createDataFrame([(1, 0.3), (1, 0.5)], "label int, score double")
    assert metrics.roc_auc(one).first().auc_roc is None


def test_split_and_undersample(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    sp = sampling.stratified_split(df, "y", ["id"]).collect()
    assert len(sp) == 1000 and len({r.id for r in sp}) == 1000
    test = [r for r in sp if r.split == "test"]
    assert sum(r.y for r in test) == 30 and len(test) == 30 + 270
    us = sampling.random_under_sample(df, "y", ["id"]).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in us} == {0: 100, 1: 100}


def _brute(x, k):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    out = {}
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if j != i)
        out[i] = [j for _, j in order[:k]]
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_knn_exact(spark, clustered):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6))
    if clustered:      # duplicates and a far outlier exercise the fallbacks
        x[:50] = x[0]
        x[299] = 100.0
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "id long, features array<double>")
    got = {}
    for r in knn(df, df, 5, block=16, q_chunk=7).collect():
        got.setdefault(r.qid, []).append((r.rank, r.nid))
    got = {q: [n for _, n in sorted(v)] for q, v in got.items()}
    assert got == _brute(x, 5)


def test_smote_balances(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=4)], int(i < 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    out = sampling.smote(df, "y").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in out} == {0: 170, 1: 170}


def test_auc_formula_beyond_64_bits(spark):
    """Counts of four thousand million a class: their product passes 64 bits."""
    n = 4_000_000_000
    row = spark.createDataFrame([(n * (n + 1) / 2.0 + n * float(n), n, n)], "rsum double, np long, nn long")
    assert abs(row.select(metrics.auc_of("rsum", "np", "nn").alias("a")).first().a - 1.0) < 1e-9


def test_balancers_raise_every_class(spark):
    from stormlake.operators import sampling
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(c, 1, 3).tolist(), c) for i, c in enumerate([0] * 10 + [1] * 20 + [2] * 70)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    n = {r.y: r["count"] for r in sampling.smote(df, "y").groupBy("y").count().collect()}
    assert n == {0: 70, 1: 70, 2: 70}


def test_knn_many_equal_points_in_small_blocks(spark):
    """Most points are one point: blocks are small and the result exact."""
    rows = [(i, [1.0, 2.0] if i < 60 else [float(i), 0.0]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    got = knn(df, df, 3, block=8, q_chunk=16).collect()
    near = {}
    for r in got:
        near.setdefault(r.qid, []).append((r.dist2, r.nid))
    p = {i: np.asarray(x) for i, x in rows}
    for q, found in near.items():
        exp = sorted((float(((p[q] - p[i]) ** 2).sum()), i) for i in p if i != q)[:3]
        assert sorted(found) == exp


def _clusters(n, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, 16)) * 5
    return centres[rng.integers(40, size=n)] + rng.normal(size=(n, 16)) * 0.3


def test_knn_leaves_out_pairs_of_far_clusters():
    from stormlake.operators.knn import Compared, nearest_in_block
    x, ids, seen = _clusters(4000), np.arange(4000), Compared()
    i, j, d = nearest_in_block(x[:500], ids[:500], np.full(500, np.inf), x, ids, 5, True, seen)
    full = ((x[:500, None] - x) ** 2).sum(-1)
    full[np.arange(500), np.arange(500)] = np.inf
    assert (j.reshape(500, 5) == np.argsort(full, axis=1, kind="stable")[:, :5]).all()
    assert seen.all == 500 * 4000 and seen.done < 0.2 * seen.all


def test_knn_sends_queries_to_few_blocks(spark):
    from stormlake.operators import knn as K
    x = _clusters(3000)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "nid long, nf array<double>")
    held, pieces = K._blocks(df, 3000, 100)
    assert held.groupBy("block").count().agg({"count": "max"}).first()[0] == 100 and held.select("block").distinct().count() == 30
    q = df.selectExpr("nid AS qid", "nf AS qf").toPandas()
    home = next(pieces.home()(iter([q])))["block"].to_numpy()
    full = np.sort(((x[:, None] - x) ** 2).sum(-1), axis=1)[:, 5]
    rest = next(pieces.others()(iter([q.iloc[:256].assign(home=home[:256], r2=full[:256])])))
    assert rest.groupby("qid").size().max() <= 29 and len(rest) < 0.4 * 256 * 30
    got = {}
    for r in K.knn(df.selectExpr("nid AS id", "nf AS features"), df.selectExpr("nid AS id", "nf AS features"), 5, block=100).collect():
        got.setdefault(r.qid, []).append((r.rank, r.nid))
    assert {q: [n for _, n in sorted(v)] for q, v in got.items()} == _brute(x, 5)


@pytest.mark.parametrize("kind", ["unit", "copies", "offset", "outlier", "grid", "ids"])
def test_knn_tiles_are_exact(kind):
    """Where bounds leave out little, tiles in single precision find the same rows as sums in double precision."""
    from stormlake.operators import knn as K
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 32))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(float)
    if kind == "grid":
        x = rng.integers(0, 2, size=(700, 8)).astype(float)
    x = x + 1e6 if kind == "offset" else x
    if kind == "outlier":
        x[7], x[9] = 1e5, -3e7
    if kind in ("copies", "ids"):
        x[100:400] = x[3]
    ids = rng.permutation(700) // (7 if kind == "ids" else 1)
    i, j, d = K.nearest_in_block(x[:150], ids[:150], np.full(150, np.inf), x, ids, 5, True)
    exp = []
    for a in range(150):
        dist = np.where(ids == ids[a], np.inf, K.exact(np.broadcast_to(x[a], x.shape), x))
        exp += [(a, ids[b], dist[b]) for b in np.lexsort((ids, dist))[:5]]
    assert list(zip(i, ids[j], d, strict=True)) == exp


def test_knn_equal_points_are_not_all_compared():
    """Of equal points only those of smallest ids can be found: the others meet no query."""
    from stormlake.operators.knn import Compared, nearest_in_block
    x, ids, seen = np.ones((3000, 4)), np.arange(3000), Compared()
    i, j, d = nearest_in_block(x[:500], ids[:500], np.full(500, np.inf), x, ids, 3, True, seen)
    assert (j.reshape(500, 3)[5:] == [0, 1, 2]).all() and j[:3].tolist() == [1, 2, 3] and not d.any()
    assert seen.done <= 500 * 8


def test_knn_sends_vectors_a_bounded_number_of_times(spark, monkeypatch):
    """Blocks grow with the table and the parts of queries are bounded in all: no more copies of a vector for more rows."""
    from stormlake.operators import knn as K
    monkeypatch.setattr(K, "BLOCK", 16)
    monkeypatch.setattr(K, "BLOCKS", 4)
    monkeypatch.setattr(K, "TASKS", 8)
    monkeypatch.setattr(K, "Q_LEAST", 8)

    def counted(*args):
        run = search(*args)

        def seen(q, p):
            assert len(q) <= 2 * n // 4 and len(p) <= -(-n // 4), (len(q), len(p))
            return run(q, p)
        return seen

    search = K._search
    monkeypatch.setattr(K, "_search", counted)
    x = np.random.default_rng(6).normal(size=(600, 12))
    for n in (200, 600):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:n])], "id long, features array<double>")
        out = K.knn(df, df, 3)
        got = {}
        for r in out.collect():
            got.setdefault(r.qid, []).append((r.rank, r.nid))
        assert {q: [m for _, m in sorted(v)] for q, v in got.items()} == _brute(x[:n], 3)
        held, _ = K._blocks(df.selectExpr("id AS nid", "features AS nf"), n, -(-n // 4))
        assert held.select("block").distinct().count() == 4
