"""Exact k-nearest neighbours (SM6) by metric partitions.

1. Pivots are picked farthest-first from a bounded sample of the points (``SAMPLE``, by the md5 of
   the id).  Every point belongs to the cell of its nearest pivot.
2. Points are numbered in the order of (cell, distance to the pivot, id) and cut into ``BLOCKS``
   blocks, or more where a block would pass ``BLOCK_BYTES``, or fewer of ``BLOCK`` points.  The pieces of cells in blocks, with the range of their pivot
   distances, are a small table (of at most ``PIECES`` + ``PIVOTS`` rows: beyond that, neighbouring blocks share one).
3. Each query first meets the block where it would lie itself; its k-th distance there, r, goes on.
4. By the triangle inequality a point at distance d of its pivot lies at least |d(q, pivot) - d|
   from the query; the query meets the other blocks that have a piece with a bound below r.
5. In a block, points are again told apart by pivots of the block; a query meets the
   groups that its k-th distance so far cannot leave out.  Where that leaves out little, all
   pairs are compared in tiles, in single precision where its rounding is small against the
   k-th distances.  Products give distances up to
   rounding; those near enough are summed left to right over dimensions, as the SQL twin does (ties by neighbour id).
   Of equal points only the smallest ids can be found, so no more of them are compared.

So a query is sent to ``BLOCKS`` blocks at most, and the queries of a block are dealt by hash into
parts, ``TASKS`` in all: vectors are sent a bounded number of times until blocks pass ``BLOCK_BYTES``.
The k best of blocks are merged by query.  What
the bounds save depends on the data: where distances between
neighbours are not small against distances to pivots (as in many
dimensions without structure), nearly all pairs are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlake.session import materialize

BLOCK = 8192    # points of a block, at least
BLOCKS = 16
BLOCK_BYTES = 32 << 20
TASKS = 384     # parts of queries, over all blocks
Q_LEAST = 256
PIVOTS = 256
SAMPLE = 4096
PIECES = 16384
GROUP = 64      # points of a group inside a block, about
GROUPS = 128
TILE = 256, 2048
SLACK = 1e-9    # of distances, against rounding


# --- one block ----------------------------------------------------------------

def farthest_first(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pivot rows, owner of each row, distance to it): the next pivot is the row farthest from all before."""
    at = [0]
    near = np.sqrt(((x - x[0]) ** 2).sum(1))
    owner = np.zeros(len(x), np.int64)
    while len(at) < most and near.max() > 0:
        at.append(int(near.argmax()))
        d = np.sqrt(((x - x[at[-1]]) ** 2).sum(1))
        closer = d < near
        owner[closer], near[closer] = len(at) - 1, d[closer]
    return np.asarray(at), owner, near


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows to all rows, up to rounding."""
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1) - 2.0 * (a @ b.T)))


def exact(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances of row pairs, summed left to right over dimensions."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        diff = q[:, j] - p[:, j]
        out += diff * diff
    return out


class Compared:
    """How many pairs a search met, and how many it compared."""

    all = done = 0


def few_copies(p: np.ndarray, pid: np.ndarray, most: int) -> np.ndarray:
    """Rows of p, in the order of ids, without those that equal ``most`` rows of smaller id."""
    order = np.argsort(pid, kind="stable")
    x = np.ascontiguousarray(p[order])
    _, kind = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    by = np.argsort(kind, kind="stable")
    nth = np.arange(len(by)) - np.searchsorted(kind[by], kind[by], side="left")
    return order[np.sort(by[nth < most])]


def _groups(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pivots, owner of each row, radius of each group); every pivot owns a row."""
    n = min(GROUPS, max(1, len(p) // GROUP))
    some = p[:: max(1, len(p) // 2048)]
    pivots = some[farthest_first(some, n)[0]]
    owner = np.concatenate([distances(p[lo:lo + 8192], pivots).argmin(1) for lo in range(0, len(p), 8192)])
    used, owner = np.unique(owner, return_inverse=True)
    pivots = pivots[used]
    radius = np.zeros(len(pivots))
    np.maximum.at(radius, owner, np.sqrt(((p - pivots[owner]) ** 2).sum(1)))
    return pivots, owner, radius


class _Found:
    """The k nearest points so far of each query, by (exact distance, point row)."""

    def __init__(self, q: np.ndarray, p: np.ndarray, k: int, r2: np.ndarray, same: tuple[np.ndarray, np.ndarray]):
        self.q, self.p, self.k, self.same = q, p, k, same
        self.i = self.j = np.zeros(0, np.int64)
        self.d = np.zeros(0)
        self.worst = r2.copy()

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of queries and points that may be among the nearest; none comes twice."""
        other = (j < self.same[0][i]) | (j >= self.same[1][i])
        i, j = i[other], j[other]
        for lo in range(0, len(i), 1 << 16):
            self._add(i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)])

    def _add(self, i, j):
        d = exact(self.q[i], self.p[j])
        good = d <= self.worst[i]
        touched = np.zeros(len(self.q), bool)
        touched[i[good]] = True
        old = touched[self.i]
        i, j, d = (np.concatenate([x[old], y[good]]) for x, y in ((self.i, i), (self.j, j), (self.d, d)))
        by = np.lexsort((j, d, i))
        i, j, d = i[by], j[by], d[by]
        place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        last = place == self.k - 1
        self.worst[i[last]] = np.minimum(self.worst[i[last]], d[last])
        keep = place < self.k
        self.i, self.j, self.d = (np.concatenate([x[~old], y[keep]]) for x, y in ((self.i, i), (self.j, j), (self.d, d)))


def _tiles(q: np.ndarray, p: np.ndarray, r2: np.ndarray, k: int, same: tuple[np.ndarray, np.ndarray],
           seen: Compared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs, tile by tile: (query, point, squared distance) of the k nearest points within r2.
    same: first row, and last + 1, of the points of each query's own id."""
    centre = p.mean(0)
    q0, p0 = q - centre, p - centre
    q_norm, p_half = np.sqrt((q0 * q0).sum(1)), (p0 * p0).sum(1) / 2
    single = [np.hstack([q0, np.ones((len(q), 1))]).astype(np.float32), np.hstack([p0, -p_half[:, None]]).astype(np.float32)]
    done = []
    for lo in range(0, len(q), TILE[0]):
        rows = np.arange(lo, min(len(q), lo + TILE[0]))
        found = _Found(q[rows], p, k, r2[rows], (same[0][rows], same[1][rows]))
        if not np.isfinite(found.worst).all():  # a first bound
            first = np.arange(min(len(p), 4 * GROUP))
            d = np.maximum(0.0, (q_norm[rows] ** 2)[:, None] + 2 * (p_half[first] - q0[rows] @ p0[first].T))
            d[(first >= found.same[0][:, None]) & (first < found.same[1][:, None])] = np.inf
            if len(first) > k:
                kth = np.partition(d, k - 1, axis=1)[:, k - 1]
                kth += 1e-12 * (q.shape[1] + 8) * (q_norm[rows] ** 2 + 2 * p_half[first].max())
                found.worst = np.minimum(found.worst, np.where(np.isfinite(kth), kth, np.inf))
        for at in range(0, len(p), TILE[1]):
            to = min(len(p), at + TILE[1])
            far = np.sqrt(2 * p_half[at:to].max())
            scale = (q.shape[1] + 8) * (q_norm[rows] * far + far * far / 2)
            # s = q.p - p.p / 2 is at least (q.q - d) / 2 for distances up to d
            least = (q_norm[rows] ** 2 * (1 - 1e-14 * (q.shape[1] + 8)) - found.worst) / 2
            if (2.0 ** -23 * scale <= 1e-3 * found.worst + 1e-300).mean() > 0.9:
                s, err = single[0][rows] @ single[1][at:to].T, 2.0 ** -22 * scale
                hit = s >= np.nextafter((least - err).astype(np.float32), np.float32(-np.inf))[:, None]
            else:
                s, err = q0[rows] @ p0[at:to].T - p_half[at:to], 2.0 ** -50 * scale
                hit = s >= (least - err)[:, None]
            seen.done += hit.size
            pair = np.flatnonzero(hit)
            if len(pair):
                found.add(pair // (to - at), at + pair % (to - at))
        done.append((rows[found.i], found.j, found.d))
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _nearest(i: np.ndarray, j: np.ndarray, d: np.ndarray, kept: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query, in order; rows of points by their place before."""
    by = np.lexsort((j, d, i))
    i, j, d = i[by], j[by], d[by]
    keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
    return i[keep], kept[j[keep]], d[keep]


def nearest_in_block(q: np.ndarray, qid: np.ndarray, r2: np.ndarray, p: np.ndarray, pid: np.ndarray, k: int,
                     exclude_self: bool, seen: Compared | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, squared distance) of the k nearest points of each query within its bound
    r2 (inf: none), ties by point id."""
    seen = seen or Compared()
    seen.all += len(q) * len(p)
    if not len(q) or not len(p):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # rows of p by id from here on
    own_rows = int(np.unique(pid, return_counts=True)[1].max()) if exclude_self else 0  # of one id
    kept = few_copies(p, pid, k + own_rows)
    p, pid = p[kept], pid[kept]
    pivots, owner, radius = _groups(p)
    by = np.argsort(owner, kind="stable")
    edge = np.searchsorted(owner[by], np.arange(len(pivots) + 1))
    qq, pp = (q * q).sum(1), (p * p).sum(1)
    err = 1e-12 * (len(q[0]) + 8) * (qq.max(initial=0) + pp.max(initial=0))
    to_pivot = distances(q, pivots)
    low = np.maximum(0.0, to_pivot - radius)
    low = np.maximum(0.0, low * low * (1 - SLACK) - 4 * err)  # of squared distances
    best = np.full((len(q), k), np.inf)
    bound = lambda rows: np.minimum(best[rows, -1], r2[rows]) + 2 * err
    parts = []
    # each query's own group first, then group after group
    own = to_pivot.argmin(1)
    for first in (True, False):
        if not first and len(p) > GROUP and (low <= bound(np.arange(len(q)))[:, None]).mean() > 0.5:
            to = np.searchsorted(pid, qid, side="right")
            same = np.where((qid == qid) & exclude_self, np.searchsorted(pid, qid), to), to
            return _nearest(*_tiles(q, p, bound(np.arange(len(q))), k, same, seen), kept, k)
        for g in range(len(pivots)):
            rows = np.flatnonzero((own == g) == first)
            rows = rows[low[rows, g] <= bound(rows)]
            if not len(rows):
                continue
            members = by[edge[g]:edge[g + 1]]
            for lo in range(0, len(rows), 4096):
                some = rows[lo:lo + 4096]
                d = qq[some, None] + pp[members] - 2.0 * (q[some] @ p[members].T)
                seen.done += d.size
                if exclude_self:
                    d[qid[some][:, None] == pid[members][None, :]] = np.inf
                held = np.concatenate([best[some], d], axis=1)
                best[some] = np.sort(np.partition(held, k - 1, axis=1)[:, :k], axis=1)
                i, j = np.nonzero(d <= bound(some)[:, None])
                i, j = i[np.isfinite(d[i, j])], j[np.isfinite(d[i, j])]
                parts.append((some[i], members[j], d[i, j]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    i, j, d = (np.concatenate(x) for x in zip(*parts, strict=True))
    near = d <= bound(i)
    i, j = i[near], j[near]
    d = np.concatenate([exact(q[i[a:a + 65536]], p[j[a:a + 65536]]) for a in range(0, len(i), 65536)] or [np.zeros(0)])
    return _nearest(i, j, d, kept, k)


def _search(k: int, exclude_self: bool, keep_cols: list[str], out_cols: list[str]):
    """Cogroup function: part of a block's queries against its points."""
    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if q.empty or p.empty:   # typed empty frame (untyped columns break the Arrow writer)
            return pd.DataFrame({c: pd.Series([], dtype={"dist2": "float64"}.get(c, object)) for c in out_cols})
        qid, nid = q["qid"].to_numpy(), p["nid"].to_numpy()
        i, j, d = nearest_in_block(np.stack(q["qf"].to_numpy()), qid, q["r2"].to_numpy(float), np.stack(p["nf"].to_numpy()),
                                   nid, k, exclude_self)
        out = {"qid": pd.Series(qid[i], dtype=object), "nid": pd.Series(nid[j], dtype=object), "dist2": d}
        for c in keep_cols:
            out[c] = pd.Series(p[c].to_numpy()[j], dtype=object)
        return pd.DataFrame(out)[out_cols]
    return run


# --- cells, blocks and pieces ---------------------------------------------------

def _with_cell(pivots: np.ndarray, vector: str):
    def run(batches):
        for pdf in batches:
            x = np.stack(pdf[vector].to_numpy()) if len(pdf) else np.zeros((0, pivots.shape[1]))
            cell = distances(x, pivots).argmin(1)
            yield pdf.assign(cell=cell.astype("int32"), dist=np.sqrt(((x - pivots[cell]) ** 2).sum(1)))
    return run


def _numbered(df: DataFrame, order: list[str], parts: int) -> DataFrame:
    """``idx``: each row's place in the order, from counts of range parts."""
    d = materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    before = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (d.join(before, "_part").withColumn("idx", F.col("_before") + F.row_number().over(inside) - 1)
            .drop("_part", "_before"))


class Pieces:
    """Cells in blocks: cell, least and greatest pivot distance, first and last block."""

    def __init__(self, rows: list, pivots: np.ndarray):
        self.cell, self.first, self.last = (np.array([r[c] for r in rows], np.int64) for c in ("cell", "first", "last"))
        self.lo, self.hi = (np.array([r[c] for r in rows], float) for c in ("lo", "hi"))
        self.pivots = pivots

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(each query's piece by its own place, lower bounds of distances to the points of every piece)."""
        d = distances(q, self.pivots)
        err = 1e-12 * (q.shape[1] + 8) * ((q * q).sum(1)[:, None] + (self.pivots ** 2).sum(1).max())  # of squares
        least, most = np.sqrt(np.maximum(0.0, d * d - err))[:, self.cell], np.sqrt(d * d + err)[:, self.cell]
        low = np.maximum(0.0, np.maximum(least - self.hi, self.lo - most)) * (1 - SLACK)
        home = np.where(self.cell == d.argmin(1)[:, None], low, np.inf).argmin(1)
        return home, low

    def home(self):
        def run(batches):
            for pdf in batches:
                if len(pdf):
                    home, _ = self.bounds(np.stack(pdf["qf"].to_numpy()))
                    yield pdf.assign(block=self.first[home], r2=np.inf)
        return run

    def others(self):
        """Queries with their home block and bound r2 -> a row for every other block they must meet."""
        def run(batches):
            for pdf in batches:
                for at in range(0, len(pdf), 256):
                    part = pdf.iloc[at:at + 256]
                    _, low = self.bounds(np.stack(part["qf"].to_numpy()))
                    hit = low * low <= part["r2"].to_numpy(float)[:, None]
                    row, block = [], []
                    for i, home in enumerate(part["home"].to_numpy()):
                        to = {b for x in np.flatnonzero(hit[i]) for b in range(self.first[x], self.last[x] + 1)} - {home}
                        row += [i] * len(to)
                        block += to
                    yield part.iloc[row].drop(columns="home").assign(block=np.asarray(block, np.int64))
        return run


def _blocks(P: DataFrame, n: int, block: int) -> tuple[DataFrame, Pieces]:
    sample = [r[0] for r in P.select("nf").orderBy(F.md5(F.col("nid").cast("string")), "nid").limit(SAMPLE).collect()]
    x = np.asarray(sample, float)
    pivots = x[farthest_first(x, min(PIVOTS, max(2, n // 1024)))[0]]
    celled = P.mapInPandas(_with_cell(pivots, "nf"), _schema(P, "cell int, dist double"))
    parts = max(int(P.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // (32 * block))
    points = materialize(_numbered(celled, ["cell", "dist", "nid"], parts).withColumn("block", F.floor(F.col("idx") / block)).drop("idx"))
    share = -(-n // (block * PIECES))
    rows = points.groupBy("cell", F.floor(F.col("block") / share).alias("_b")).agg(
        F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.min("block").alias("first"), F.max("block").alias("last")).collect()
    return points.drop("cell", "dist"), Pieces(sorted(rows, key=lambda r: (r["cell"], r["first"])), pivots)


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([f"`{c}` {t}" for c, t in df.dtypes] + [more])


def _best(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("dist2", "nid")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn(queries: DataFrame, points: DataFrame, k: int, id_col: str = "id", feat_col: str = "features",
        exclude_self: bool = True, keep_cols: list[str] | None = None, block: int | None = None, q_chunk: int | None = None) -> DataFrame:
    """(qid, nid, dist2, rank[, keep_cols of the neighbour]) for the k nearest points."""
    keep_cols = keep_cols or []
    spark = queries.sparkSession
    P = points.select(F.col(id_col).alias("nid"), F.col(feat_col).cast("array<double>").alias("nf"), *keep_cols)
    Q = queries.select(F.col(id_col).alias("qid"), F.col(feat_col).cast("array<double>").alias("qf"))
    types = dict(P.dtypes)
    out_cols = ["qid", "nid", "dist2", *keep_cols]
    schema = ", ".join([f"qid {types['nid']}", f"nid {types['nid']}", "dist2 double"] + [f"`{c}` {types[c]}" for c in keep_cols])
    final = ["qid", "nid", "dist2", "rank", *keep_cols]
    n, n_queries = P.count(), Q.count()
    if not n or not n_queries:
        return spark.createDataFrame([], f"{schema}, rank int").select(*final)
    if block is None:
        width = P.select(F.max(F.size("nf"))).first()[0] or 1
        block = max(BLOCK, min(-(-n // BLOCKS), BLOCK_BYTES // (8 * width)))
    chunk = q_chunk or min(block, max(Q_LEAST, -(-n_queries * -(-n // block) // TASKS)))
    search = _search(k, exclude_self, keep_cols, out_cols)

    def meet(asked: DataFrame, held: DataFrame) -> DataFrame:
        """asked(block, qid, qf, r2): the k best of each query among the points of its blocks."""
        sizes = materialize(asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts")))
        left = asked.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int"))
        right = held.join(sizes, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return (left.select("block", "part", "qid", "qf", "r2").groupBy("block", "part")
                .cogroup(right.select("block", "part", "nid", "nf", *keep_cols).groupBy("block", "part")).applyInPandas(search, schema))

    if n <= block:  # one block
        parts = -(-n_queries // chunk)
        part = F.pmod(F.xxhash64("qid"), F.lit(parts)).cast("int")
        left = Q.withColumns({"part": part, "r2": F.lit(math.inf)})
        right = P.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return _best(left.groupBy("part").cogroup(right.groupBy("part")).applyInPandas(search, schema), k).select(*final)

    held, pieces = _blocks(P, n, block)
    asked = materialize(Q.mapInPandas(pieces.home(), _schema(Q, "block long, r2 double")))
    first = materialize(meet(asked, held))
    worst = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist2")).otherwise(F.lit(math.inf)).alias("r2"))
    going = (asked.drop("r2").withColumnRenamed("block", "home").join(worst, "qid", "left")
             .withColumn("r2", F.coalesce("r2", F.lit(math.inf))).select("qid", "qf", "home", "r2"))
    going = materialize(going)
    rest = going.mapInPandas(pieces.others(), _schema(going.drop("home"), "block long"))  # with vectors: sent, not written
    return _best(first.unionByName(meet(rest, held)), k).select(*final)
