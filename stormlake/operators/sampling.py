"""Splitting and class balancing as table operators (SM1-SM5).

Randomness is a seeded hash of each row's id (``functions.scalars.uniform``),
so every sampler is deterministic, survives task retries and re-partitioning,
and has an exact SQL twin.  Definitions follow the published methods (SMOTE:
Chawla et al. 2002; ADASYN: He et al. 2008; ENN: Wilson 1972); the random
draws are not bit-equal to any particular library's generator.

``quota_select`` picks, per class, the rows of smallest (u, id) up to a quota
without a window over a whole class: u is uniform, so rows are counted in
2^16 u-buckets per class (a small table), the boundary bucket is found from
cumulative counts, and only rows of that one bucket are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.functions.scalars import uniform
from stormlake.operators.knn import knn
from stormlake.session import materialize

U_BUCKETS = 1 << 16


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class: one row per class value (bounded by the label domain)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def quota_select(df: DataFrame, label: str, u_col: str, id_cols: list[str],
                 quotas: DataFrame, flag: str = "selected") -> DataFrame:
    """Flag rows whose rank by (u, ids) within their class is <= the class quota.

    ``quotas``: (label, quota) -- one row per class.
    """
    b = F.floor(F.col(u_col) * F.lit(U_BUCKETS)).cast("int")
    d = materialize(df.withColumn("__ub", b))  # read four times below
    hist = d.groupBy(label, "__ub").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(label).orderBy("__ub").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0)))
    hist = hist.join(quotas.withColumnRenamed("quota", "__q"), label, "left")
    # per class: the bucket holding the quota-th row, and rows before it
    bnd = (hist.where((F.col("__before") < F.col("__q")) & (F.col("__before") + F.col("__c") >= F.col("__q")))
               .select(label, F.col("__ub").alias("__bb"), F.col("__before").alias("__bbefore"),
                       "__q"))
    # a row a class, written: joined by its size, so the rows are not dealt out by a few labels
    bounds = materialize(quotas.withColumnRenamed("quota", "__q2").join(bnd, label, "left"))
    d = d.join(bounds, label, "left")
    inner = d.where(F.col("__ub") == F.col("__bb"))
    rw = Window.partitionBy(label).orderBy(u_col, *id_cols)
    inner = inner.withColumn(flag, (F.row_number().over(rw) + F.col("__bbefore")) <= F.col("__q"))
    outer = d.where(F.col("__bb").isNull() | (F.col("__ub") != F.col("__bb"))).withColumn(
        flag, F.when(F.col("__bb").isNull(), F.col("__q2") > 0).otherwise(F.col("__ub") < F.col("__bb")))
    keep = [*df.columns, flag]
    return inner.select(*keep).unionByName(outer.select(*keep))


def stratified_split(df: DataFrame, label: str, id_cols: list[str], test_size: float = C.TEST_SIZE,
                     seed: int = C.SEED) -> DataFrame:
    """SM1: add ``split`` = 'train' / 'test'; per class, ceil(test_size * n) rows go to test."""
    d = materialize(df.withColumn("__u", uniform(*id_cols, seed=seed)))
    q = d.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    q = q.select(label, (F.col("__n") - F.ceil(F.col("__n") * F.lit(test_size))).alias("quota"))
    s = quota_select(d, label, "__u", id_cols, q, flag="__train")
    return s.withColumn("split", F.when(F.col("__train"), "train").otherwise("test")).drop("__u", "__train")


def random_under_sample(df: DataFrame, label: str, id_cols: list[str], seed: int = C.SEED) -> DataFrame:
    """SM4: every class cut to the minority size, rows of smallest u kept."""
    d = df.withColumn("__u", uniform(*id_cols, seed=seed))
    counts = class_counts(df, label)          # one row per class
    n_min = min(counts.values())
    q = df.sparkSession.createDataFrame([(k, n_min) for k in counts],
                                        f"{label} {dict(df.dtypes)[label]}, quota bigint")
    s = quota_select(d, label, "__u", id_cols, q, flag="__keep")
    return s.where(F.col("__keep")).drop("__u", "__keep")


def _to_grow(df: DataFrame, label: str) -> list[tuple[object, int, int]]:
    """(class, its rows, rows it lacks to the largest class), smallest class first."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        raise ValueError("need two classes to balance")
    most = max(counts.values())
    by_size = sorted(counts.items(), key=lambda kv: (kv[1], str(kv[0])))
    return [(value, n, most - n) for value, n in by_size if n < most]


def _synthesise(base: DataFrame, quota_col: str, nn: DataFrame, feats: DataFrame, k: int,
                id_col: str, feat_col: str, label: str, label_value, seed: int) -> DataFrame:
    """New rows x + gap * (x_nn - x): ``quota_col`` rows per base row, neighbour
    rank and gap drawn from the seeded uniform of (id, seq)."""
    have = nn.groupBy("qid").agg(F.count(F.lit(1)).alias("__kk"))
    g = (base.where(F.col(quota_col) > 0)
             .select(F.col(id_col).alias("qid"), F.col(feat_col).alias("__x"),
                     F.explode(F.sequence(F.lit(1), F.col(quota_col))).alias("seq"))
             .join(have, "qid"))
    g = g.withColumn("rank", (F.floor(uniform("qid", "seq", F.lit("nn"), seed=seed) * F.col("__kk")) + 1)
                     .cast("int"))
    g = g.withColumn("__gap", uniform("qid", "seq", F.lit("gap"), seed=seed))
    g = g.join(nn.select("qid", "rank", "nid"), ["qid", "rank"])
    g = g.join(feats.select(F.col(id_col).alias("nid"), F.col(feat_col).alias("__xn")), "nid")
    new = F.zip_with("__x", "__xn", lambda a, b: a + F.col("__gap") * (b - a))
    return g.select(F.concat(F.lit("s:"), F.col("qid").cast("string"), F.lit(":"),
                             F.col("seq").cast("string")).alias("sample_id"),
                    new.alias(feat_col), F.lit(label_value).alias(label))


def _originals(df: DataFrame, id_col: str, feat_col: str, label: str) -> DataFrame:
    return df.select(F.concat(F.lit("o:"), F.col(id_col).cast("string")).alias("sample_id"),
                     F.col(feat_col), F.col(label))


def smote(df: DataFrame, label: str, id_col: str = "id", feat_col: str = "features",
          k: int = C.SMOTE_K, seed: int = C.SEED) -> DataFrame:
    """SM2: synthesize rows of every smaller class until all have as many as the largest.

    The G new rows of a class of n are spread evenly: every row of it gets
    G // n, and the G % n rows of smallest u one more.
    """
    out = _originals(df, id_col, feat_col, label)
    for value, n, G in _to_grow(df, label):
        M = df.where(F.col(label) == F.lit(value))
        nn = knn(M, M, k, id_col, feat_col)
        base = M.withColumn("__u", uniform(id_col, F.lit("base"), seed=seed))
        q = base.sparkSession.createDataFrame([(value, G % n)], f"{label} {dict(df.dtypes)[label]}, quota bigint")
        base = quota_select(base, label, "__u", [id_col], q, flag="__extra")
        base = base.withColumn("__quota", F.lit(G // n) + F.col("__extra").cast("int"))
        out = out.unionByName(_synthesise(base, "__quota", nn, M, k, id_col, feat_col, label, value, seed))
    return out


def adasyn(df: DataFrame, label: str, id_col: str = "id", feat_col: str = "features",
           k: int = C.ADASYN_K, seed: int = C.SEED) -> DataFrame:
    """SM3: like SMOTE, with each row's share of its class's G new rows
    proportional to the share of other classes among its k nearest rows of any
    class (g_i = round-half-even(r_i / sum r * G)); if no row has a neighbour of another
    class, nothing is generated."""
    out = _originals(df, id_col, feat_col, label)
    for value, _, G in _to_grow(df, label):
        M = df.where(F.col(label) == F.lit(value))
        around = knn(M, df, k, id_col, feat_col, keep_cols=[label])
        ratio = around.groupBy("qid").agg(
            (F.sum((F.col(label) != F.lit(value)).cast("double")) / F.lit(float(k))).alias("__r"))
        tot = ratio.agg(F.sum("__r").alias("__rs")).withColumn("__one", F.lit(1))
        g = ratio.withColumn("__one", F.lit(1)).join(tot, "__one").drop("__one")
        share = F.bround(F.col("__r") / F.col("__rs") * F.lit(float(G)), 0)
        g = g.withColumn("__quota", F.when(F.col("__rs") > 0, share).otherwise(F.lit(0.0)).cast("int"))
        base = M.join(g.select(F.col("qid").alias(id_col), "__quota"), id_col)
        nn = knn(M, M, k, id_col, feat_col)
        out = out.unionByName(_synthesise(base, "__quota", nn, M, k, id_col, feat_col, label, value, seed))
    return out


def edited_nearest_neighbours(df: DataFrame, label: str, id_col: str = "sample_id",
                              feat_col: str = "features", k: int = C.ENN_K) -> DataFrame:
    """ENN (all classes, kind 'all'): drop a row unless its k nearest rows all share its class."""
    nn = knn(df, df, k, id_col, feat_col, keep_cols=[label])
    lab = df.select(F.col(id_col).alias("qid"), F.col(label).alias("__own"))
    agree = (nn.join(lab, "qid")
               .groupBy("qid").agg(F.bool_and(F.col(label) == F.col("__own")).alias("__keep")))
    return df.join(agree.where("__keep").select(F.col("qid").alias(id_col)), id_col, "left_semi")


def smote_enn(df: DataFrame, label: str, id_col: str = "id", feat_col: str = "features",
              k: int = C.SMOTE_K, k_enn: int = C.ENN_K, seed: int = C.SEED) -> DataFrame:
    """SM5: SMOTE, then edited nearest neighbours over the result."""
    s = smote(df, label, id_col, feat_col, k, seed)
    s = materialize(s)
    return edited_nearest_neighbours(s, label, "sample_id", feat_col, k_enn)
