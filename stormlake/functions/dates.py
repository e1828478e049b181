"""FN1: whole-file date format choice.

The source tries each format on the *whole column of one file*; the first that
parses every row wins, else the text is left as is.  Here every row is parsed
under all formats in one projection, one grouped aggregate counts the failures
per file (partial aggregation, so a huge file is still spread over tasks), and
the per-file verdict is written and read back, so that the planner joins it
by its measured size: broadcast while it is small, and the big side is not
shuffled on a handful of file keys.  Rows whose file has no winning format get a null ``date`` and keep the
text in ``date_raw``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.session import materialize


def _clean_text(c: Column) -> Column:
    head = F.substring_index(c.cast("string"), " ", 1)
    return F.when(head.isin(C.NULL_TOKENS) | head.isNull(), F.lit(None)).otherwise(head)


def parse_dates_per_file(df: DataFrame, col: str, file_keys: list[str],
                         formats: list[str] | None = None, out: str | None = None) -> DataFrame:
    """Replace text ``col`` by a DATE using the first format that fits the file.

    ``file_keys`` are the columns identifying one input file (e.g. source, city).
    Adds ``date_format`` (index of the winning format, null if none) and keeps
    the raw text in ``{out}_raw``.
    """
    formats = formats or C.DATE_FORMATS
    out = out or col
    txt = "__txt"
    parsed = [f"__p{i}" for i in range(len(formats))]
    fails = [f"__f{i}" for i in range(len(formats))]
    d = df.withColumn(txt, _clean_text(F.col(col)))
    d = d.withColumns({p: F.to_date(F.try_to_timestamp(F.col(txt), F.lit(fmt)))
                       for p, fmt in zip(parsed, formats)})
    verdict = (d.groupBy(*file_keys)
                 .agg(*[F.sum((F.col(txt).isNotNull() & F.col(p).isNull()).cast("long")).alias(f)
                        for p, f in zip(parsed, fails)]))
    choice = None
    for i in reversed(range(len(formats))):
        choice = F.when(F.col(fails[i]) == 0, F.lit(i)).otherwise(
            choice if choice is not None else F.lit(None).cast("int"))
    verdict = materialize(verdict.select(*[F.col(k).alias(f"__k_{k}") for k in file_keys], choice.alias("date_format")))
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in file_keys]  # a file of no known city is a file too
    d = d.join(verdict, same, "left").drop(*[f"__k_{k}" for k in file_keys])
    value = F.lit(None).cast("date")
    for i in reversed(range(len(formats))):
        value = F.when(F.col("date_format") == i, F.col(parsed[i])).otherwise(value)
    d = d.withColumn(f"{out}_raw", F.col(col).cast("string")).withColumn(out, value)
    return d.drop(txt, *parsed, *([col] if out != col else []))
