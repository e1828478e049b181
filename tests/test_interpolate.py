import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stormlake.operators.interpolate import gated_fill, interpolate_linear


def _run(spark, rows, block=None, limit=None):
    df = spark.createDataFrame(rows, "k int, t int, x double")
    out = interpolate_linear(df, ["x"], ["k"], ["t"], block=block, limit=limit)
    return [r.x for r in out.orderBy("k", "t").collect()]


def test_gap_fill_semantics(spark):
    vals = [None, 1.0, None, None, 4.0, None, None]
    rows = [(0, i, v) for i, v in enumerate(vals)]
    assert _run(spark, rows) == [None, 1.0, 2.0, 3.0, 4.0, 4.0, 4.0]


def test_blocks_carry_across_empty_blocks(spark):
    vals = [None, 1.0, None, None, None, None, None, None, 8.0]
    rows = [(0, i, v) for i, v in enumerate(vals)]
    # blocks of two rows: the gap crosses three block boundaries
    got = _run(spark, rows, block=F.floor(F.col("t") / 2))
    assert got == [None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]


def test_never_changes_values_and_matches_pandas(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(5):
        n = int(rng.integers(1, 60))
        x = rng.normal(size=n)
        x[rng.random(n) < 0.4] = np.nan
        rows += [(k, t, None if np.isnan(v) else float(v)) for t, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    out = interpolate_linear(df, ["x"], ["k"], ["t"], block=F.floor(F.col("t") / 7)).toPandas()
    src = pd.DataFrame(rows, columns=["k", "t", "x"])
    exp = src.groupby("k", group_keys=False)["x"].apply(lambda s: s.interpolate())
    src["exp"] = exp
    m = src.merge(out, on=["k", "t"], suffixes=("_in", "_out"))
    assert ((m.x_in.isna()) | (m.x_in == m.x_out)).all()
    assert np.allclose(m.exp.fillna(-9e9), m.x_out.fillna(-9e9), rtol=1e-12, atol=1e-12)


def test_gate(spark):
    # 1 null in 4 rows = 25 %: filled at 40, kept at 20; no nulls -> untouched
    rows = [(0, 0, 1.0), (0, 1, None), (0, 2, 3.0), (0, 3, 4.0)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    f40 = gated_fill(df, ["x"], ["k"], ["t"], 40.0).orderBy("t").collect()
    f20 = gated_fill(df, ["x"], ["k"], ["t"], 20.0).orderBy("t").collect()
    assert f40[1].x == 2.0 and f20[1].x is None
