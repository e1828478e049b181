"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are cut into blocks by range of (norm, id), so that equal vectors spread over
blocks as well as others, and each block gets a cover tree: a node's points lie
within its radius of its centre, its children's centres are points of it more
than half that radius apart (to the next power of two), and the first child keeps the
centre.  Queries are cut into blocks and get trees in the same way.

A task takes one query block and a run of data blocks, largest norms first, and
walks both trees at once.  For a query node and a data node no inner product
can be above <cq, cd> + rq |cd| + rd |cq| + rq rd; the pair is left out when
that is below the worst k-th score so far among the node's queries.  Pairs of
leaves are scored in one matrix product.  The k best of each task meet in one
window by query.

Scores are exact: components are integers and products are taken in doubles as
long as they stay below 2^53, else in 64-bit integers.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; rows that repeat an id count once (the smallest
vector); shorter vectors are taken to end in zeros; ties go to the smaller id; an
empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, pick, table

K = 20
EVERY = 20
SCALE = 64
DATA_BLOCK = 4096
QUERY_BLOCK = 1024
RUN = 8
LEAF = 64
FEW = 16


# --- cover trees ------------------------------------------------------------

class CoverTree:
    """Points in tree order; node i covers points start[i]..end[i]-1 within
    radius[i] of its centre point; its children are child[i]..child[i]+children[i]-1."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.ids, self.nodes, self.radius = points, ids, nodes, radius

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> CoverTree:
        x = points.astype(np.float64)
        order = np.arange(len(x))
        nodes, radius = [], []  # start, end, centre (place in order), first child, children

        def distance(rows, centre):
            return np.sqrt(np.maximum(0.0, ((x[rows] - x[centre]) ** 2).sum(1)))

        far = distance(order, 0) if len(x) else np.zeros(0)
        todo = [(0, 0, len(x), 0, far)]
        nodes.append([0, len(x), 0, 0, 0])
        radius.append(float(far.max()) if len(far) else 0.0)
        while todo:
            at, lo, hi, centre, far = todo.pop()
            if hi - lo <= leaf or radius[at] == 0:
                continue
            rows = order[lo:hi]
            scale = 2.0 ** (np.ceil(np.log2(radius[at])) - 1)
            centres, near, owner = [centre], far.copy(), np.zeros(len(rows), np.int64)
            # the farthest point becomes a centre until all lie within the scale; a
            # node that would fall apart into few points a child stays a leaf
            while near.max() > scale and len(centres) <= max(2 * FEW, len(rows) // FEW):
                centres.append(int(rows[int(near.argmax())]))
                d = distance(rows, centres[-1])
                closer = d < near
                owner[closer], near[closer] = len(centres) - 1, d[closer]
            if near.max() > scale:
                continue
            by = np.argsort(owner, kind="stable")
            order[lo:hi], owner, near = rows[by], owner[by], near[by]
            nodes[at][3:] = [len(nodes), len(centres)]
            edges = np.searchsorted(owner, np.arange(len(centres) + 1))
            for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                nodes.append([lo + a, lo + b, centres[c], 0, 0])
                radius.append(float(near[a:b].max()))
                todo.append((len(nodes) - 1, lo + a, lo + b, centres[c], near[a:b]))
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        table_ = np.asarray(nodes, np.int64).reshape(-1, 5)
        if len(x):
            table_[:, 2] = place[table_[:, 2]]
        return cls(points[order], ids[order], table_, np.asarray(radius))

    def dump(self) -> bytes:
        out = io.BytesIO()
        p = self.points
        small = next((t for t in (np.int8, np.int16, np.int32) if not p.size or (
            np.iinfo(t).min <= p.min() and p.max() <= np.iinfo(t).max)), np.int64)
        np.savez(out, points=p.astype(small), ids=self.ids, nodes=self.nodes, radius=self.radius)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        f = np.load(io.BytesIO(data))
        return cls(f["points"].astype(np.int64), f["ids"], f["nodes"], f["radius"])


class Search:
    """The k best of each query of one tree over any number of data trees."""

    def __init__(self, queries: CoverTree, k: int):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.worst = np.full(n, -np.inf)  # each query's k-th score so far
        self.best = (np.zeros(0, np.int64),) * 3  # query, id, score
        self.compared = 0

    def run(self, data: CoverTree) -> None:
        q, k = self.q, self.k
        dim = max(q.points.shape[1], data.points.shape[1])
        pad = lambda p: np.pad(p, ((0, 0), (0, dim - p.shape[1])))
        qi, di = pad(q.points), pad(data.points)
        top = float(np.abs(qi).max(initial=0)) * float(np.abs(di).max(initial=0)) * max(1, dim)
        kind = np.float64 if top < 2.0 ** 52 else np.int64
        qx, dx = qi.astype(kind), di.astype(kind)
        qc, dc = qi[q.nodes[:, 2]].astype(float), di[data.nodes[:, 2]].astype(float)
        qn, dn = np.sqrt((qc * qc).sum(1)), np.sqrt((dc * dc).sum(1))

        def bound(a, b):
            return qc[a] @ dc[b].T + q.radius[a] * dn[b] + data.radius[b] * qn[a] + q.radius[a] * data.radius[b]

        todo = [(float(bound(0, 0)), 0, 0)] if len(q.ids) and len(data.ids) else []
        while todo:
            most, a, b = todo.pop()
            qlo, qhi, _, qchild, qn_children = q.nodes[a]
            dlo, dhi, _, dchild, dn_children = data.nodes[b]
            if most + 1e-6 * (1 + abs(most)) < self.worst[qlo:qhi].min():
                continue
            if not qn_children and not dn_children:
                self._score(qx, dx, data.ids, int(qlo), int(qhi), int(dlo), int(dhi))
            elif dn_children and (not qn_children or data.radius[b] > 2 * q.radius[a]):  # queries part first
                below = np.arange(dchild, dchild + dn_children)
                ub = bound(a, below)
                # the last pushed is the next taken: the most promising child
                todo += [(float(ub[i]), a, int(below[i])) for i in np.argsort(ub, kind="stable")]
            else:
                todo += [(float(bound(c, b)), int(c), b) for c in range(qchild, qchild + qn_children)]

    def _score(self, qx, dx, ids, qlo, qhi, dlo, dhi, step: int = 2048) -> None:
        for lo in range(dlo, dhi, step):
            hi = min(dhi, lo + step)
            s = qx[qlo:qhi] @ dx[lo:hi].T
            self.compared += s.size
            own = self.q.ids[qlo:qhi, None] == ids[None, lo:hi]
            floor = self.worst[qlo:qhi]
            if hi - lo > self.k:  # at most one score of a row is the query's own
                kth = np.partition(s, hi - lo - self.k - 1, axis=1)[:, hi - lo - self.k - 1]
                floor = np.maximum(floor, kth)
            i, j = np.nonzero((s >= floor[:, None]) & ~own)
            if len(i):
                self._merge(qlo + i, ids[lo + j], s[i, j].astype(np.int64), qlo, qhi)

    def _merge(self, query, ids, score, qlo, qhi) -> None:
        old_q, old_i, old_s = self.best
        here = (old_q >= qlo) & (old_q < qhi)
        query, ids, score = (np.concatenate([o[here], n]) for o, n in ((old_q, query), (old_i, ids), (old_s, score)))
        by = np.lexsort((ids, -score, query))
        query, ids, score = query[by], ids[by], score[by]
        first = np.searchsorted(query, query, side="left")
        rank = np.arange(len(query)) - first
        full = rank == self.k - 1
        self.worst[query[full]] = score[full]
        keep = rank < self.k
        self.best = tuple(np.concatenate([o[~here], n[keep]]) for o, n in zip(self.best, (query, ids, score), strict=True))


# --- in Spark ---------------------------------------------------------------

def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def _plant(block_rows: int):
    """mapInPandas: rows in (norm, id) order -> one tree for every block_rows of them."""
    def tree(rows):
        width = max((len(v) for v in rows["vector"]), default=0)
        points = np.zeros((len(rows), width), np.int64)
        for i, v in enumerate(rows["vector"]):
            points[i, :len(v)] = v
        return CoverTree.build(points, rows["vec_id"].to_numpy(np.int64)).dump()

    def run(batches):
        from pyspark import TaskContext
        part, held, no = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            while len(held) >= 2 * block_rows:
                yield pd.DataFrame({"block": [part << 32 | no], "tree": [tree(held[:block_rows])]})
                held, no = held[block_rows:].reset_index(drop=True), no + 1
        if held is not None and len(held):
            yield pd.DataFrame({"block": [part << 32 | no], "tree": [tree(held)]})
    return run


def plant(stages: Stages, vectors: DataFrame, rows: int, block_rows: int) -> DataFrame:
    """vectors(vec_id, vector, norm) -> (block, tree, no): a cover tree a block,
    numbered from the largest norms down."""
    parts = max(1, -(-rows // block_rows))
    trees = stages.save(vectors.repartitionByRange(parts, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
                        .mapInPandas(_plant(block_rows), "block long, tree binary"), "trees")
    no = F.row_number().over(W.orderBy("block")) - 1  # blocks, not vectors, go through this window
    numbered = trees.select("block").withColumn("no", no)
    return trees.join(numbered, "block").drop("block")


def search(stages: Stages, vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """vectors(vec_id, vector) -> (query_id, rank, vec_id, score)."""
    once = vectors.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    normed = once.withColumn("norm", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    rows = stages.save(normed, "vectors")
    asked = rows.where(is_query)
    n, n_asked = rows.count(), asked.count()
    data = stages.save(plant(stages, rows, n, DATA_BLOCK), "data")
    queries = stages.save(plant(stages, asked, n_asked, QUERY_BLOCK), "queries")
    q_blocks, runs = queries.count(), -(-data.count() // RUN)
    if not q_blocks or not runs:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stages.keep(data, queries)
    # every query block meets every run of data blocks under a key of their own
    left = data.select(F.floor(F.col("no") / RUN).alias("run"), "no", "tree",
                       F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"))
    right = queries.select(F.col("no").alias("q"), "tree", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))).alias("run"))

    def one(blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        for tree in asked["tree"]:
            s = Search(CoverTree.load(tree), k)
            for block in blocks.sort_values("no")["tree"]:
                s.run(CoverTree.load(block))
            found = {"query_id": s.q.ids[s.best[0]], "vec_id": s.best[1], "score": s.best[2]}
        return pd.DataFrame(found)

    got = left.groupBy("q", "run").cogroup(right.groupBy("q", "run")).applyInPandas(
        one, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    vectors = pick(rows.where(usable(F.col("embedding"))), vec_id="vec_id", vector=quantised(rows["embedding"]))
    return search(Stages(spark, "topk"), vectors, F.col("vec_id") % EVERY == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
