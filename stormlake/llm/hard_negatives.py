"""Hard negatives by angular triangle filtering.

An anchor's positives are its best other rows of the same label; a hard negative
of a positive is a row of another label whose score lies in a window just below the
positive's.  Scores are integer inner products.

1. Reference directions: orthonormal, picked from a bounded sample of the rows
   (``SAMPLE``, by the md5 of the components), each time the row that lies farthest from the
   span of those before.  Every row of the table then stores its norm and its angles to them:
   angle j is taken inside what the references before j leave of the row.
2. Rows are put in the order of (label, nearest reference, angle to it) and cut into
   blocks; so are the anchors.  A block keeps the ranges of its labels, norms
   and direction cosines.
3. Two rows whose angles to one direction are a and b lie between |a - b| and a + b
   apart.  Taken from the last reference to the first, these triangles give an interval for the
   cosine of two rows; times the norms, and widened by what rounding can do
   (``SLACK``), bounds of their score.  Block ranges give the same bounds for whole blocks.
4. Positives: blocks that share a label meet; a pair is scored if its upper
   bound reaches the anchor's worst positive so far, or what enough lower bounds promise.
5. Negatives: blocks meet if their bounds reach the lowest window of the anchors; a pair is scored if its
   interval overlaps a window that could still take it.  All other pairs get no integer scoring.

Defined results: rows whose label or vector is null, or whose vector holds a null or
non-finite component, take no part; shorter vectors end in zeros, an empty
one is all zeros; every row counts, also one that repeats another, whose ids
then appear as often as the rows do; rows without an id are no anchors and come after all others
in ties; an anchor without positives, and a positive whose score is below 0 (its window is
empty), has no negatives; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, pick, table, with_running_total
from .topk import quantised, usable

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
SAMPLE = 2000
REFERENCES = 48
ROUGH = 16
#: Angles are stored in single precision: each moves a row by at most 2^-22 on the unit sphere.
SLACK = 2 * (REFERENCES + 2) * 2.0 ** -22
DATA_BLOCK = 4096
ANCHOR_BLOCK = 512
RUN = 8
DENSE = 8


# --- angles -----------------------------------------------------------------

def reference_directions(sample: np.ndarray, most: int = REFERENCES) -> np.ndarray:
    """Up to ``most`` orthonormal directions: each time that of the row with the longest rest."""
    rest = sample.astype(np.float64)
    length = np.sqrt((rest * rest).sum(1, keepdims=True))
    rest = rest[length[:, 0] > 0] / length[length[:, 0] > 0]
    found = np.zeros((0, sample.shape[1]))
    while len(rest) and len(found) < min(most, sample.shape[1]):
        size = (rest * rest).sum(1)
        i = int(size.argmax())
        if size[i] < 1e-12:
            break
        new = rest[i] - found.T @ (found @ rest[i])
        new /= np.sqrt(new @ new)
        found = np.vstack([found, new])
        rest = rest - np.outer(rest @ new, new)
    return found


def angles_to(points: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles): angle j is that between reference j and what references 0..j-1 leave of a row."""
    x = points.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    unit = x / np.where(norm > 0, norm, 1)[:, None]
    c = unit @ references.T
    left = np.sqrt(np.maximum(0.0, 1 - np.cumsum(c * c, axis=1)))
    before = np.hstack([np.ones((len(x), 1)), left])[:, :c.shape[1]]
    cosine = np.divide(c, before, out=np.zeros_like(c), where=before > 1e-9)
    return norm, np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def spread(angles: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """(direction cosines to the first ``upto`` references, what is left): the triangles of
    angles a and b, one inside another, add up to
    cos a1 cos b1 + sin a1 sin b1 (cos a2 cos b2 + sin a2 sin b2 (... +- 1))."""
    a = angles[:, :upto].astype(np.float64)
    left = np.cumprod(np.sin(a), axis=1)
    ones = np.ones((len(a), 1))
    return np.cos(a) * np.hstack([ones, left])[:, :a.shape[1]], (left[:, -1] if a.shape[1] else ones[:, 0])


class Block:
    """Rows in order: number in the table, id (and whether there is one), label, components, norm, angles."""

    FIELDS = ("idx", "has_id", "vec_id", "label", "points", "norm", "angles")

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)
        self.points = self.points.astype(np.int64)
        self.near = {upto: spread(self.angles, upto) for upto in (ROUGH, REFERENCES)}

    def dump(self) -> bytes:
        out, p = io.BytesIO(), self.points
        small = next((t for t in (np.int8, np.int16, np.int32) if not p.size or (
            np.iinfo(t).min <= p.min() and p.max() <= np.iinfo(t).max)), np.int64)
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS} | {"points": p.astype(small)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Block:
        f = np.load(io.BytesIO(data))
        return cls(**{k: f[k] for k in cls.FIELDS})


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (i, j) of rows: one matrix product where most pairs are asked for."""
    if len(i) * DENSE > len(x) * len(y):
        return (x @ y.T)[i, j]
    out = np.empty(len(i), x.dtype)
    for lo in range(0, len(i), 1 << 15):
        at = slice(lo, lo + (1 << 15))
        out[at] = np.einsum("ij,ij->i", x[i[at]], y[j[at]])
    return out


def bounds(a: Block, d: Block, i: np.ndarray | slice, j: np.ndarray | slice, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores: of all rows against all, or of pairs (i, j)."""
    (ca, ra), (cd, rd) = a.near[upto], d.near[upto]
    if isinstance(i, slice):
        middle, give, size = ca @ cd.T, np.outer(ra, rd), np.outer(a.norm, d.norm)
    else:
        middle, give, size = _products(ca, cd, i, j), ra[i] * rd[j], a.norm[i] * d.norm[j]
    slack = SLACK * size + 1e-6
    return (middle - give) * size - slack, (middle + give) * size + slack


def scores(a: Block, d: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs, in doubles while these are exact."""
    top = float(np.abs(a.points).max(initial=0)) * float(np.abs(d.points).max(initial=0)) * max(1, a.points.shape[1])
    kind = np.float64 if top < 2.0 ** 52 else np.int64
    return _products(a.points.astype(kind), d.points.astype(kind), i, j).astype(np.int64)


class Best:
    """The k best rows of each of n keys: highest score, then smallest id (rows without an id last)."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))  # key, score, has_id, id

    def add(self, key: np.ndarray, score: np.ndarray, has_id: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(key):
            return
        key, score, has_id, vec_id = (np.concatenate(p) for p in zip(self.rows, (key, score, has_id, vec_id), strict=True))
        by = np.lexsort((vec_id, ~has_id, -score, key))
        key = key[by]
        rank = np.arange(len(key)) - np.searchsorted(key, key, side="left")
        full = rank == self.k - 1
        self.floor[key[full]] = score[by][full]
        keep = by[rank < self.k]
        self.rows = (key[rank < self.k], score[keep], has_id[keep], vec_id[keep])


def kth_largest(key: np.ndarray, value: np.ndarray, k: int, n: int) -> np.ndarray:
    """The k-th largest value of each of n keys, -inf for keys of fewer."""
    by = np.lexsort((-value, key))
    sorted_ = key[by]
    at = by[np.arange(len(by)) - np.searchsorted(sorted_, sorted_, side="left") == k - 1]
    out = np.full(n, -np.inf)
    out[key[at]] = value[at]
    return out


class Counter:
    """How many pairs were met and how many of them scored."""

    met = scored = 0


def find_positives(a: Block, blocks: list[Block], k: int, seen: Counter) -> Best:
    best = Best(len(a.idx), k)
    for d in blocks:
        _, upper = bounds(a, d, slice(None), slice(None), ROUGH)
        may = (a.label[:, None] == d.label) & (a.idx[:, None] != d.idx)
        seen.met += int(may.sum())
        i, j = np.nonzero(may & (upper >= best.floor[:, None]))
        lower, upper = bounds(a, d, i, j, REFERENCES)
        # k rows of the block surely reach the k-th largest lower bound
        floor = np.maximum(best.floor, kth_largest(i, lower, k, len(a.idx)))
        close = upper >= floor[i]
        i, j = i[close], j[close]
        seen.scored += len(i)
        best.add(i, scores(a, d, i, j), d.has_id[j], d.vec_id[j])
    return best


def window(ps: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest integer s with low * ps <= 100 * s <= high * ps, without products beyond ps."""
    whole, rest = ps // 100, ps % 100
    return low * whole - (-low * rest // 100), high * whole + high * rest // 100


def find_negatives(a: Block, windows: dict[str, np.ndarray], blocks: list[Block], k: int, low: int, high: int,
                   seen: Counter) -> Best:
    """windows: arrays anchor (row of a) and score, one entry a positive; keys of the result are their places."""
    row, ps = windows["anchor"], windows["score"]
    lowest, highest = window(ps, low, high)
    best = Best(len(row), k)
    least, most = np.full(len(a.idx), np.inf), np.full(len(a.idx), -np.inf)
    open_ = lowest <= highest
    np.maximum.at(most, row[open_], highest[open_])
    for d in blocks:
        least[:] = np.inf
        np.minimum.at(least, row[open_], np.maximum(lowest[open_], best.floor[open_]))
        lower, upper = bounds(a, d, slice(None), slice(None), ROUGH)
        may = a.label[:, None] != d.label
        seen.met += int(may.sum())
        i, j = np.nonzero(may & (upper >= least[:, None]) & (lower <= most[:, None]))
        lower, upper = bounds(a, d, i, j, REFERENCES)
        fits, floor = np.zeros(len(i), bool), best.floor.copy()
        for w, at in _entries(row, i):  # k rows surely inside a window reach the k-th largest lower bound
            inside = (lower[at] >= lowest[w]) & (upper[at] <= highest[w])
            floor = np.maximum(floor, kth_largest(w[inside], lower[at][inside], k, len(row)))
        for w, at in _entries(row, i):
            fits[at] |= open_[w] & (upper[at] >= np.maximum(lowest[w], floor[w])) & (lower[at] <= highest[w])
        i, j = i[fits], j[fits]
        s = scores(a, d, i, j)
        seen.scored += len(i)
        for w, at in _entries(row, i):
            ok = (lowest[w] <= s[at]) & (s[at] <= highest[w])
            w, at = w[ok], at[ok]
            best.add(w, s[at], d.has_id[j[at]], d.vec_id[j[at]])
    return best


def _entries(row: np.ndarray, i: np.ndarray):
    """For n = 0, 1, ...: the pairs whose anchor has an n-th entry in ``row`` (sorted): (entries, places in i)."""
    first, end = np.searchsorted(row, i, side="left"), np.searchsorted(row, i, side="right")
    n = 0
    while len(at := np.flatnonzero(first + n < end)):
        yield first[at] + n, at
        n += 1


# --- in Spark ---------------------------------------------------------------

def _annotate(references: np.ndarray, width: int):
    def run(batches):
        for pdf in batches:
            points = np.zeros((len(pdf), width), np.int64)
            for r, v in enumerate(pdf["vector"]):
                points[r, :len(v)] = v
            norm, angles = angles_to(points, references)
            c, _ = spread(angles, ROUGH)
            cell = np.abs(c).argmax(1) if c.shape[1] else np.zeros(len(pdf), np.int64)
            at = c[np.arange(len(pdf)), cell] if c.shape[1] else np.zeros(len(pdf))
            yield pd.DataFrame({
                "has_id": pdf["has_id"], "vec_id": pdf["vec_id"], "label": pdf["label"], "asked": pdf["asked"],
                "cell": np.where(at < 0, -1 - cell, cell), "lead": np.abs(at),
                "points": [p.tobytes() for p in points], "norm": norm, "angles": [x.tobytes() for x in angles]})
    return run


_ROW = "has_id boolean, vec_id long, label long, asked boolean, cell long, lead double, points binary, norm double, angles binary"
_BLOCK = "block long, label_lo long, label_hi long, norm double, left double, lo array<double>, hi array<double>, rows binary"


def _pack(width: int, references: int):
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        n = len(pdf)
        block = Block(idx=pdf["idx"].to_numpy(np.int64), has_id=pdf["has_id"].to_numpy(bool),
                      vec_id=pdf["vec_id"].to_numpy(np.int64), label=pdf["label"].to_numpy(np.int64),
                      points=np.frombuffer(b"".join(pdf["points"]), np.int64).reshape(n, width),
                      norm=pdf["norm"].to_numpy(np.float64),
                      angles=np.frombuffer(b"".join(pdf["angles"]), np.float32).reshape(n, references))
        c, left = block.near[ROUGH]
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "label_lo": [block.label.min()], "label_hi": [block.label.max()],
                             "norm": [block.norm.max()], "left": [left.max()], "lo": [c.min(0)], "hi": [c.max(0)],
                             "rows": [block.dump()]})
    return one


def _upper(a: str, d: str) -> Column:
    """Upper bound of the scores between two blocks, from their ranges."""
    col = lambda t, c: F.col(f"{t}_{c}")
    corners = F.zip_with(F.arrays_zip(col(a, "lo"), col(a, "hi")), F.arrays_zip(col(d, "lo"), col(d, "hi")), lambda x, y: F.greatest(
        *[x[f"{a}_{p}"] * y[f"{d}_{q}"] for p in ("lo", "hi") for q in ("lo", "hi")]))
    cosine = F.aggregate(corners, F.lit(0.0), lambda s, x: s + x) + col(a, "left") * col(d, "left")
    size = col(a, "norm") * col(d, "norm")
    return F.greatest(cosine, F.lit(0.0)) * size + F.lit(SLACK) * size + F.lit(1e-6)


def _prefixed(df: DataFrame, name: str, *extra: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{name}_{c}") for c in ("block", "label_lo", "label_hi", "norm", "left", "lo", "hi", *extra)])


def _met(anchors: DataFrame, data: DataFrame, n_blocks: int, keep: Column, *extra: str) -> DataFrame:
    """(a, block): which blocks meet, from their ranges alone."""
    a = _prefixed(anchors, "a", *extra).withColumn("d_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    return a.join(_prefixed(data, "d"), "d_block").where(keep).select(F.col("a_block").alias("a"), F.col("d_block").alias("block"))


def _blocks_in_groups(stages: Stages, met: DataFrame, data: DataFrame, anchors: DataFrame):
    """Groups (a, run): a block of anchors and up to RUN blocks of data."""
    met = stages.save(met.withColumn("run", F.floor(F.col("block") / RUN)), "met")
    left = met.join(data.select("block", "rows"), "block").groupBy("a", "run")
    right = (met.select(F.col("a").alias("a"), F.col("run").alias("run")).distinct()
             .join(anchors.withColumnRenamed("block", "a").drop("label_lo", "label_hi", "norm", "left", "lo", "hi"), "a").groupBy("a", "run"))
    return left.cogroup(right)


def hard_negatives(stages: Stages, rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, data_block: int = DATA_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """rows(vec_id, label long, vector array<long>, asked boolean), label and vector not null ->
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    nothing = rows.sparkSession.createDataFrame([], schema)
    rows = rows.select(F.col("vec_id").isNotNull().alias("has_id"), F.coalesce("vec_id", F.lit(0)).alias("vec_id"), "label", "vector",
                       (F.col("vec_id").isNotNull() & F.coalesce("asked", F.lit(False))).alias("asked"))
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return nothing
    sample = [r[0] for r in rows.select("vector").orderBy(F.md5(F.col("vector").cast("string"))).limit(SAMPLE).collect()]
    references = reference_directions(np.array([[*v, *[0] * (width - len(v))] for v in sample], np.int64).reshape(len(sample), width))
    near = rows.mapInPandas(_annotate(references, width), _ROW)
    indexed = stages.save(with_running_total(stages, near.withColumn("one", F.lit(1)), ["label", "cell", "lead", "has_id", "vec_id"],
                                             "one", "idx").drop("one"), "rows")
    pack = _pack(width, len(references))
    data = stages.save(indexed.withColumn("block", F.floor(F.col("idx") / data_block)).groupBy("block").applyInPandas(pack, _BLOCK), "data")
    asked = with_running_total(stages, indexed.where("asked").withColumn("one", F.lit(1)), ["idx"], "one", "place")
    anchors = stages.save(asked.withColumn("block", F.floor(F.col("place") / anchor_block)).groupBy("block").applyInPandas(pack, _BLOCK), "anchors")
    n_blocks = data.count()
    if not anchors.count():
        return nothing

    def same_label(blocks: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        a = Block.load(block["rows"].iloc[0])
        best = find_positives(a, [Block.load(x) for x in blocks.sort_values("block")["rows"]], positives, Counter())
        key, score, has_id, vec_id = best.rows
        return pd.DataFrame({"a": block["a"].iloc[0], "anchor": key, "anchor_id": a.vec_id[key], "score": score,
                             "has_id": has_id, "vec_id": vec_id})

    shares = (F.col("a_label_lo") <= F.col("d_label_hi")) & (F.col("d_label_lo") <= F.col("a_label_hi"))
    found = _blocks_in_groups(stages, _met(anchors, data, n_blocks, shares), data, anchors).applyInPandas(
        same_label, "a long, anchor long, anchor_id long, score long, has_id boolean, vec_id long")
    order = [F.desc("score"), F.desc("has_id"), "vec_id"]
    found = (found.withColumn("rank", F.row_number().over(W.partitionBy("a", "anchor").orderBy(*order)))
             .where(F.col("rank") <= positives))

    def windows_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "rank"])
        out = io.BytesIO()
        np.savez(out, **{c: pdf[c].to_numpy() for c in ("anchor", "anchor_id", "score", "has_id", "vec_id")})
        ps = pdf["score"].to_numpy(np.int64)
        return pd.DataFrame({"block": [pdf["a"].iloc[0]], "windows": [out.getvalue()],
                             "least": [float(window(ps, low, high)[0].min())]})

    windows = stages.save(found.groupBy("a").applyInPandas(windows_of, "block long, windows binary, least double"), "windows")
    wanted = anchors.join(windows, "block")

    def other_label(blocks: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        a, w = Block.load(block["rows"].iloc[0]), np.load(io.BytesIO(block["windows"].iloc[0]))
        w = {k: w[k] for k in w.files}
        best = find_negatives(a, w, [Block.load(x) for x in blocks.sort_values("block")["rows"]], negatives, low, high, Counter())
        key, score, has_id, vec_id = best.rows
        return pd.DataFrame({"a": block["a"].iloc[0], "window": key, "anchor_id": w["anchor_id"][key], "has_positive": w["has_id"][key],
                             "positive": w["vec_id"][key], "positive_score": w["score"][key], "score": score,
                             "has_id": has_id, "vec_id": vec_id})

    one_label = (F.col("a_label_lo") == F.col("a_label_hi")) & (F.col("d_label_lo") == F.col("d_label_hi")) & (
        F.col("a_label_lo") == F.col("d_label_lo"))
    reach = ~one_label & (_upper("a", "d") >= F.col("a_least"))
    met = _met(wanted, data, n_blocks, reach, "least")
    got = _blocks_in_groups(stages, met, data, wanted.drop("least")).applyInPandas(
        other_label, "a long, window long, anchor_id long, has_positive boolean, positive long, positive_score long, "
                     "score long, has_id boolean, vec_id long")
    got = got.withColumn("rank", F.row_number().over(W.partitionBy("a", "window").orderBy(*order))).where(F.col("rank") <= negatives)
    return got.select("anchor_id", F.when(F.col("has_positive"), F.col("positive")).alias("positive_id"), "rank",
                      F.when(F.col("has_id"), F.col("vec_id")).alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "embeddings")
    good = t.where(usable(F.col("embedding")) & F.col("label").isNotNull())
    label = F.when(good["vec_id"] % RELABEL_EVERY == 0, (good["label"] + 1) % 10).otherwise(good["label"]).cast("long")
    rows = pick(good, vec_id="vec_id", label=label, vector=quantised(good["embedding"], SCALE),
                asked=good["vec_id"] % ANCHOR_EVERY == 0)
    return hard_negatives(Stages(spark, "hard-negatives"), rows)


OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS MATERIALIZED (SELECT a.rid AS aid, a.vec_id AS anchor_id, c.rid, c.vec_id, a.label = c.label AS same,
    CAST(list_dot_product(a.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.rid <> c.rid WHERE a.vec_id % 100 = 0),
p AS (SELECT aid, anchor_id, rid AS pid, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.aid, p.pid ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.aid = p.aid AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
