"""SC12: expand series responses into one row per time step.

A response row holds (start, end, step seconds) and one array per variable;
the output has one row per step, ``end`` excluded, arrays zipped by position.
Pure generator expressions: each response expands inside its own task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_series(df: DataFrame, value_cols: list[str], keys: list[str] | None = None,
                  start: str = "start", end: str = "end", step_seconds: str = "interval_seconds",
                  time_col: str = "date") -> DataFrame:
    keys = keys or []
    step = F.make_dt_interval(secs=F.col(step_seconds))
    times = F.sequence(F.col(start), F.col(end) - step, step)
    z = F.arrays_zip(times.alias(time_col), *[F.col(c).alias(c) for c in value_cols])
    return df.select(*keys, F.inline(z))
