"""Window operators (WN1, WN2, WN5, WN6, WN7).

Duplicate marking and de-duplication are written as grouped aggregates plus a
join rather than as windows: the aggregate is partial (map-side), and the join
back is broadcast or skew-split by AQE, so one hot key never lands whole in a
single sort.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.session import materialize


def with_halo(df: DataFrame, keys: list[str], order: list[str | Column], block: Column,
              halo: int) -> tuple[DataFrame, list[str]]:
    """Cut each ``keys`` series into blocks and give every block a halo: copies
    of the ``halo`` rows that come just before it (from however many earlier
    blocks that takes).  Returns the rows (``__halo`` marks the copies) and
    the partition columns for windows of at most ``halo`` rows of history.

    Row positions come from a window per (keys, block) plus a small table of
    block sizes; a row at position p is copied to every later block whose
    first position s has s - halo <= p.
    """
    B = "__wblk"
    d = df.withColumn(B, block)
    part = [*keys, B]
    d = d.withColumn("__rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    blocks = d.groupBy(*part).agg(F.count(F.lit(1)).alias("__bn"))
    wk = Window.partitionBy(*keys).orderBy(B)
    blocks = blocks.withColumn("__start", F.coalesce(
        F.sum("__bn").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    nxt = F.collect_list(F.struct(F.col(B).alias("b"), F.col("__start").alias("s"))).over(
        wk.rowsBetween(1, max(halo, 1)))
    blocks = blocks.withColumn("__next", nxt).select(*part, "__start", "__next")
    d = d.join(blocks, part, "left").withColumn("__pos", F.col("__start") + F.col("__rn") - 1)
    copies = (d.select("*", F.explode(F.filter("__next", lambda t: t["s"] - halo <= F.col("__pos")))
                       .alias("__t"))
               .withColumn(B, F.col("__t.b")).drop("__t"))
    own = d.withColumn("__halo", F.lit(False))
    out = own.unionByName(copies.withColumn("__halo", F.lit(True)))
    return out.drop("__rn", "__start", "__next", "__pos"), part


def sma(df: DataFrame, col: str, keys: list[str], order: list[str | Column],
        window: int = C.MOVING_AVERAGE_WINDOW, out: str | None = None,
        block: Column | None = None) -> DataFrame:
    """WN1: trailing mean of ``window`` rows, null until the window is full of values.

    ``block`` (monotone in ``order``, e.g. the year) splits a long series so no
    task sorts a whole series; each block sees the ``window - 1`` rows before it.
    """
    out = out or f"{col}_moving_average_sma"
    x = F.col(col).cast("double")
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(window - 1), 0)
        return df.withColumn(out, F.when(F.count(x).over(w) == window, F.avg(x).over(w)))
    d, part = with_halo(df, keys, order, block, window - 1)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(window - 1), 0)
    d = d.withColumn(out, F.when(F.count(x).over(w) == window, F.avg(x).over(w)))
    return d.where(~F.col("__halo")).select(*df.columns, out)


def _fold(history: Column, alpha: float, start: Column) -> Column:
    """Run the average over an array of struct(v): state is the value so far and
    the weight it has left, which decays by (1 - alpha) a row, also over nulls."""
    keep = F.lit(1.0 - alpha)

    def step(s, x):
        v = x["v"]
        y = (F.when(v.isNull(), s["y"]).when(s["y"].isNull(), v)
             .otherwise((s["w"] * s["y"] + F.lit(alpha) * v) / (s["w"] + F.lit(alpha))))
        return F.struct(y.alias("y"), F.when(v.isNull(), s["w"] * keep).otherwise(keep).alias("w"))
    return F.aggregate(history, start, step)


def ema(df: DataFrame, col: str, keys: list[str], order: list[str | Column],
        span: int = C.MOVING_AVERAGE_WINDOW, out: str | None = None,
        block: Column | None = None) -> DataFrame:
    """WN2: exponential moving average, alpha = 2/(span+1), y0 = x0 (non-adjusted).

    A value x that comes n rows after the last one gives
    y = (w y + alpha x) / (w + alpha) with w = (1 - alpha)^n, so weights decay
    over nulls; a null row repeats the average so far.

    Every value is folded from the first row of its series.  Without ``block`` a
    row looks at all rows before it: for short series.  With ``block`` (monotone in
    ``order``) a series is cut and the average is a scan in three linear passes: each block is reduced
    to the map it makes of any state that enters it, the maps are composed along the small table of
    blocks, and each block is run once from its own entry state.  A task holds one block of one column, or one
    series' blocks (six numbers each).
    """
    out = out or f"{col}_moving_average_ema"
    alpha = 2.0 / (span + 1)
    if block is None:
        x = F.struct(F.col(col).cast("double").alias("v"))
        none = F.struct(F.lit(None).cast("double").alias("y"), F.lit(1.0).alias("w"))
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, _fold(F.collect_list(x).over(w), alpha, none)["y"])
    part = [*keys, "__wblk"]
    d = df.withColumn("__wblk", block)
    d = d.withColumn("__rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    narrow = d.select(*part, "__rn", F.col(col).cast("double").alias("__v"))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    named = lambda cols, more: ", ".join([*(f"`{c}` {types[c]}" for c in cols), *(f"{c} double" for c in more)])
    maps = narrow.groupBy(*part).applyInPandas(_block_map(part, alpha), named(part, _MAP))
    entry = materialize(maps.groupBy(*keys).applyInPandas(_compose(part, alpha), named(part, ("__y", "__w"))))
    run = _null_safe_join(narrow, entry, part).groupBy(*part).applyInPandas(
        _run_block(part, alpha), named([*part, "__rn"], ("__ema",)))
    return (_null_safe_join(d, run, [*part, "__rn"]).withColumn(out, F.col("__ema")).select(*df.columns, out))


_MAP = ("__f", "__q", "__a", "__b", "__w")


def _step(y: float | None, w: float, v: float, alpha: float) -> tuple[float | None, float]:
    """The average and the weight it has left after one more row (nan: no value)."""
    if v != v:
        return y, w * (1.0 - alpha)
    return (v if y is None else (w * y + alpha * v) / (w + alpha)), 1.0 - alpha


def _block_map(part: list[str], alpha: float):
    """A block turns the state (y, w) that enters it into (a y' + b, w'), where y' is the
    average at its first value f, k rows in: y' = (w q y + alpha f) / (w q + alpha) with q = (1 - alpha)^k."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        f, q, a, b, w = math.nan, 1.0, 1.0, 0.0, 1.0
        for v in pdf.sort_values("__rn")["__v"].to_numpy(float):
            if v != v:
                q, w = (q * (1.0 - alpha) if f != f else q), w * (1.0 - alpha)
            else:
                if f != f:
                    f = v
                else:
                    a, b = w / (w + alpha) * a, w / (w + alpha) * b + alpha * v / (w + alpha)
                w = 1.0 - alpha
        return pdf.iloc[:1][part].assign(**dict(zip(_MAP, (f, q, a, b, w), strict=True)))
    return one


def _compose(part: list[str], alpha: float):
    """One series' maps in order -> the state that enters each block (y nan: no value yet)."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__wblk", na_position="first")
        y, w, rows = math.nan, 1.0, []
        for f, q, a, b, left in zip(*(pdf[c].to_numpy(float) for c in _MAP), strict=True):
            rows.append((y, w))
            if f != f:
                w = w if y != y else w * q
            else:
                first = f if y != y else (w * q * y + alpha * f) / (w * q + alpha)
                y, w = a * first + b, left
        return pdf[part].assign(__y=[r[0] for r in rows], __w=[r[1] for r in rows])
    return one


def _run_block(part: list[str], alpha: float):
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__rn")
        y, w, out = pdf["__y"].iloc[0], pdf["__w"].iloc[0], []
        y = None if y is None or y != y else float(y)
        for v in pdf["__v"].to_numpy(float):
            y, w = _step(y, w, v, alpha)
            out.append(y)
        return pdf[[*part, "__rn"]].assign(__ema=out)
    return one


def _null_safe_join(df: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    ren = small.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(ren, cond, how).drop(*[f"__k_{k}" for k in keys])


def mark_duplicates(df: DataFrame, keys: list[str], flag: str = "is_duplicate",
                    count_col: str | None = "duplicate_count") -> DataFrame:
    """WN5: flag every member of a key seen more than once (null keys are equal)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__dup_n"))
    out = _null_safe_join(df, counts, keys).withColumn(flag, F.col("__dup_n") > 1)
    if count_col:
        out = out.withColumn(count_col, F.col("__dup_n"))
    return out.drop("__dup_n")


def duplicates_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """WN5 report: only the duplicated rows, with their group size."""
    return (mark_duplicates(df, keys)
            .where(F.col("is_duplicate")).drop("is_duplicate"))


def first_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """WN6: keep the first row (smallest ``order_col``) of every key; nulls are equal.

    A grouped ``min_by`` of the whole row: partial aggregation keeps one
    candidate per key per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    g = df.groupBy(*keys).agg(F.min_by(row, F.col(order_col)).alias("__row"))
    return g.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def year_spine(df: DataFrame, keys: list[str], year_col: str = "year") -> DataFrame:
    """WN7: every year from the key's min to max year."""
    r = df.groupBy(*keys).agg(F.min(year_col).alias("__lo"), F.max(year_col).alias("__hi"))
    return (r.where(F.col("__lo").isNotNull())
             .select(*keys, F.explode(F.sequence("__lo", "__hi")).alias(year_col)))
