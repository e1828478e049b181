"""Positional linear gap filling (WN3) and its null-share gate (WN4).

Semantics (pandas ``Series.interpolate()`` defaults): a null between two values
is filled on the straight line between them by *row position*, not by time
distance; leading nulls stay null; trailing nulls repeat the last value.

Plan.  A series (one ``keys`` value, ordered by ``order``) can be as long as a
city's whole history, so it is never sorted in one task.  It is cut into
blocks by a coarse integer that is monotone in ``order`` (the plans use the
month, so a block holds at most one month of one station):

1. one window pass per (keys, block): row number and, per column, the last
   non-null value/position at or before the row and the first at or after it;
2. a grouped summary per (keys, block): row count, first/last non-null
   value/position per column, null counts -- tiny, one row per block;
3. a window over the summary only (per key, ordered by block) turns counts into
   row offsets and carries values across blocks that are all null;
4. the summary is joined back on (keys, block) -- the big side is already
   partitioned on those columns, so only the summary moves.

The gate (WN4) comes out of the same summary: null % per key, rounded to two
digits half-even, fill only when 0 < % <= limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlake.functions.scalars import round_half_even

_UNB_P = Window.unboundedPreceding
_UNB_F = Window.unboundedFollowing


def _desc(o: str | Column) -> Column:
    return (F.col(o) if isinstance(o, str) else o).desc_nulls_last()


def _lerp(pv: Column, pp: Column, nv: Column, np_: Column, pos: Column) -> Column:
    # numpy.interp's order: slope first, then slope * dx + left value
    return ((nv - pv) / (np_ - pp)) * (pos - pp) + pv


def month_block(date: str | Column) -> Column:
    """Months since year 0: a block key that is monotone in the date."""
    return F.year(date) * 12 + F.month(date)


def interpolate_linear(df: DataFrame, cols: list[str], keys: list[str],
                       order: list[str | Column], block: Column | None = None,
                       limit: float | None = None, include_zero: bool = False,
                       report: bool = False, prune: bool = True) -> DataFrame:
    """Fill ``cols`` by row position within each ``keys`` series.

    ``block``: expression, monotone non-decreasing along ``order``, that cuts a
    series into independently sortable chunks (default: one block per series).
    ``limit``: when given, a column is filled for a key only if its rounded
    null % is in (0, limit] (WN4); otherwise it is returned unchanged.
    ``report``: also return ``__pct_{col}`` columns with that null %.
    ``prune``: first run one small aggregate (partial, per key, then over keys)
    to find the columns that some key will actually fill; the others skip the
    window work and come back unchanged.
    """
    work = columns_needing_fill(df, cols, keys, limit, include_zero) if prune else list(cols)
    if not work:  # nothing to fill anywhere: same values, same output types
        return df.withColumns({c: F.col(c).cast("double") for c in cols})
    if len(work) < len(cols):
        rest = [c for c in cols if c not in work]
        out = interpolate_linear(df, work, keys, order, block, limit, include_zero, report, prune=False)
        return out.withColumns({c: F.col(c).cast("double") for c in rest})
    B = "__blk"
    # rows without a block (no date) sort first and are a block of their own
    first = F.lit(-(1 << 31)).cast("int")
    d = df.withColumn(B, F.coalesce(block.cast("int"), first) if block is not None else F.lit(0))
    part = [*keys, B]
    w = Window.partitionBy(*part).orderBy(*order)
    d = d.withColumn("__rn", F.row_number().over(w))
    fwd = w.rowsBetween(_UNB_P, 0)
    # "first non-null at or after" as a growing frame over the reversed order:
    # a shrinking (current .. unbounded following) frame is re-aggregated per row
    rev = Window.partitionBy(*part).orderBy(*[_desc(o) for o in order]).rowsBetween(_UNB_P, 0)
    exprs = {}
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        at = F.when(x.isNotNull(), F.col("__rn"))
        exprs[f"__pv{i}"] = F.last(x, True).over(fwd)
        exprs[f"__pp{i}"] = F.last(at, True).over(fwd)
        exprs[f"__nv{i}"] = F.last(x, True).over(rev)
        exprs[f"__np{i}"] = F.last(at, True).over(rev)
    d = d.withColumns(exprs)

    # 2. per-block summary (the big side is already partitioned by `part`)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        at = F.when(x.isNotNull(), F.col("__rn"))
        aggs += [F.max_by(x, at).alias(f"__bl_v{i}"), F.max(at).alias(f"__bl_p{i}"),
                 F.min_by(x, at).alias(f"__bf_v{i}"), F.min(at).alias(f"__bf_p{i}"),
                 F.sum(x.isNull().cast("long")).alias(f"__bz{i}")]
    s = d.groupBy(*part).agg(*aggs)

    # 3. offsets, carries and gates on the summary only
    ws = Window.partitionBy(*keys).orderBy(B)
    s = s.withColumn("__off", F.coalesce(F.sum("__n").over(ws.rowsBetween(_UNB_P, -1)), F.lit(0)))
    carry = {}
    for i, _ in enumerate(cols):
        carry[f"__cpv{i}"] = F.last(f"__bl_v{i}", True).over(ws.rowsBetween(_UNB_P, -1))
        carry[f"__cpp{i}"] = F.last(F.col(f"__bl_p{i}") + F.col("__off"), True).over(
            ws.rowsBetween(_UNB_P, -1))
        carry[f"__cnv{i}"] = F.first(f"__bf_v{i}", True).over(ws.rowsBetween(1, _UNB_F))
        carry[f"__cnp{i}"] = F.first(F.col(f"__bf_p{i}") + F.col("__off"), True).over(
            ws.rowsBetween(1, _UNB_F))
        if limit is not None or report:
            wk = Window.partitionBy(*keys)
            pct = (F.sum(f"__bz{i}").over(wk) / F.sum("__n").over(wk)) * F.lit(100.0)
            carry[f"__pct{i}"] = round_half_even(pct, 2)
    s = s.withColumns(carry).select(*part, "__off", *carry.keys())

    s = s.withColumnsRenamed({k: f"__s_{k}" for k in part})
    d = d.join(s, [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in part], "left").drop(*[f"__s_{k}" for k in part])
    pos = F.col("__off") + F.col("__rn")
    out = {}
    for i, c in enumerate(cols):
        inb_p = F.col(f"__pp{i}").isNotNull()
        inb_n = F.col(f"__np{i}").isNotNull()
        pv = F.when(inb_p, F.col(f"__pv{i}")).otherwise(F.col(f"__cpv{i}"))
        pp = F.when(inb_p, F.col(f"__pp{i}") + F.col("__off")).otherwise(F.col(f"__cpp{i}"))
        nv = F.when(inb_n, F.col(f"__nv{i}")).otherwise(F.col(f"__cnv{i}"))
        np_ = F.when(inb_n, F.col(f"__np{i}") + F.col("__off")).otherwise(F.col(f"__cnp{i}"))
        x = F.col(c).cast("double")
        filled = (F.when(x.isNotNull(), x)
                   .when(pv.isNull(), F.lit(None).cast("double"))
                   .when(nv.isNull(), pv)
                   .otherwise(_lerp(pv, pp, nv, np_, pos)))
        if limit is not None:
            p = F.col(f"__pct{i}")
            lower = (p >= 0) if include_zero else (p > 0)
            filled = F.when(lower & (p <= F.lit(float(limit))), filled).otherwise(F.col(c))
        out[c] = filled
        if report:
            out[f"__pct_{c}"] = F.col(f"__pct{i}")
    d = d.withColumns(out)
    keep = [c for c in df.columns] + ([f"__pct_{c}" for c in cols] if report else [])
    return d.select(*keep)


def columns_needing_fill(df: DataFrame, cols: list[str], keys: list[str],
                         limit: float | None, include_zero: bool = False) -> list[str]:
    """Columns for which at least one key has nulls and passes the gate.

    One grouped aggregate per key and one over its (small) result; the driver
    receives a single row of flags, one per column.
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"__z{i}") for i, c in enumerate(cols)])
    flags = []
    for i, _ in enumerate(cols):
        z = F.col(f"__z{i}")
        if limit is None:
            hit = z > 0
        else:
            pct = round_half_even((z / F.col("__n")) * F.lit(100.0), 2)
            hit = (z > 0) & (pct <= F.lit(float(limit)))
        flags.append(F.max(hit.cast("int")).alias(f"__h{i}"))
    row = per_key.agg(*flags).first()
    return [c for i, c in enumerate(cols) if row is not None and row[f"__h{i}"] == 1]


def gated_fill(df: DataFrame, cols: list[str], keys: list[str], order: list[str | Column],
               limit: float, block: Column | None = None) -> DataFrame:
    """WN4: interpolate a column for a key only if 0 < null % (2 digits) <= limit."""
    return interpolate_linear(df, cols, keys, order, block=block, limit=limit)
