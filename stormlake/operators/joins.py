"""Joins (JN1-JN4).

Equi-joins only; null-equals-null keys use ``<=>``, which Spark still plans as
a hash / sort-merge equi-join.  Broadcast is left to AQE, which switches a
join to broadcast only after measuring the smaller side at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """JN1 / JN4: left equi-join on shared key columns."""
    return left.join(right, on=keys, how="left")


def full_outer_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                         null_safe: list[str] | None = None) -> DataFrame:
    """JN2: full outer join; key columns coalesced; ``null_safe`` keys match null to null.

    Columns other than the keys must not collide (rename first).
    """
    null_safe = set(null_safe or [])
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = (F.col(k).eqNullSafe(F.col(f"__r_{k}")) if k in null_safe
             else F.col(k) == F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    j = left.join(r, cond, "full_outer")
    j = j.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    return j.drop(*[f"__r_{k}" for k in keys])


def left_null_safe_suffixed(left: DataFrame, right: DataFrame, keys: list[str],
                            suffixes: tuple[str, str] = ("_df1", "_df2")) -> DataFrame:
    """JN3: left join on several keys, null == null, overlapping non-keys suffixed."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    lren = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    rren = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    rren = rren.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return lren.join(rren, cond, "left").drop(*[f"__r_{k}" for k in keys])
