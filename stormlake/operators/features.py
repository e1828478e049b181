"""Feature encoding (FN10 standard scaling, FN11 one-hot, PL10 model table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.functions.scalars import with_date_parts
from stormlake.operators.project import drop_strict
from stormlake.session import materialize


def standard_scale(df: DataFrame, cols: list[str], group_cols: list[str] | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """FN10: (x - mean) / population std per group; a constant column divides by 1.

    Statistics come from one grouped aggregate over ``fit_on`` (default: the
    frame itself, written once so that it is not computed twice) -- one row per
    group, written and joined back by its measured size, so that the big side is
    not shuffled on a few group keys; nulls are skipped in the fit and stay null.
    """
    if fit_on is None:
        df = materialize(df)
    src = fit_on if fit_on is not None else df
    if not group_cols:  # one statistics row, joined on a constant key
        df, src, group_cols = df.withColumn("__g", F.lit(0)), src.withColumn("__g", F.lit(0)), ["__g"]
    stats = src.groupBy(*group_cols).agg(
        *[F.avg(F.col(c).cast("double")).alias(f"__mu{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"__sd{i}") for i, c in enumerate(cols)])
    d = df.join(materialize(stats), on=group_cols, how="left")
    out = {}
    for i, c in enumerate(cols):
        sd = F.col(f"__sd{i}")
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out[c] = (F.col(c).cast("double") - F.col(f"__mu{i}")) / scale
    d = d.withColumns(out)
    return d.drop("__g", *[f"__mu{i}" for i in range(len(cols))],
                  *[f"__sd{i}" for i in range(len(cols))])


def one_hot(df: DataFrame, col: str, categories: list[str | None], prefix: str | None = None,
            null_name: str = "nan") -> DataFrame:
    """FN11: one 0/1 double column per category (sorted), null is its own category.

    ``categories`` is a fixed vocabulary of a handful of values.
    """
    prefix = prefix or col
    cats = sorted([c for c in categories if c is not None])
    if any(c is None for c in categories):
        cats.append(None)
    out = {}
    for cat in cats:
        name = f"{prefix}_{null_name if cat is None else cat}"
        hit = F.col(col).isNull() if cat is None else F.col(col).eqNullSafe(F.lit(cat))
        out[name] = F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumns(out)


#: The seasons a date can fall into, and none (a disaster-only day of base_1 and base_2).
SEASONS: list[str | None] = [C.SEASON_WINTER, C.SEASON_SPRING, C.SEASON_SUMMER, C.SEASON_AUTUMN, None]


EXCLUDE = ["date", "season", "eventType", "disaster_occurred"]


def model_table(gold: DataFrame, group_cols: list[str] | None = None,
                seasons: list[str | None] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """PL10: scale every feature per (source, city), one-hot the season, add
    year / month / day, drop date, event type and season.

    Scaling is fitted on all rows, as in the source, unless ``fit_on`` names
    the rows to fit it on (a training part)."""
    group_cols = group_cols if group_cols is not None else ["city_id"]
    feats = [c for c in gold.columns if c not in EXCLUDE and c not in group_cols]
    d = standard_scale(gold, feats, group_cols, fit_on)
    d = one_hot(d, "season", SEASONS if seasons is None else seasons)
    d = with_date_parts(d, "date")
    return drop_strict(d, ["date", "eventType", "season"])
