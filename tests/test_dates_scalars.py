from pyspark.sql import functions as F

from stormlake.functions.dates import parse_dates_per_file
from stormlake.functions.scalars import occurred, round_half_even, season


def _parse(spark, texts):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "f int, i int, d string")
    return parse_dates_per_file(df, "d", ["f"]).orderBy("i").collect()


def test_format_choice_per_file(spark):
    a = _parse(spark, ["01/02/2020", "3/4/2020"])
    assert a[0].date_format == 0 and str(a[0].d) == "2020-01-02" and str(a[1].d) == "2020-03-04"
    b = _parse(spark, ["13/02/2020", "01/02/2020"])
    assert b[0].date_format == 2 and str(b[1].d) == "2020-02-01"
    c = _parse(spark, ["13/02/2020", "02/13/2020"])
    assert c[0].date_format is None and c[0].d is None and c[0].d_raw == "13/02/2020"
    d = _parse(spark, ["nan", "2020-01-01 10:00:00"])
    assert d[0].d is None and str(d[1].d) == "2020-01-01" and d[1].date_format == 1


def test_rounding_half_even(spark):
    r = spark.createDataFrame([(0.125,), (0.375,)], "x double").select(round_half_even("x").alias("r")).collect()
    assert [x.r for x in r] == [0.12, 0.38]


def test_season_and_label(spark):
    df = spark.createDataFrame([("2020-01-05", "Hail"), ("2020-04-01", None), ("2020-07-01", None),
                                ("2020-10-01", None), (None, None)], "d string, e string")
    out = df.select(season(F.to_date("d")).alias("s"), occurred("e").alias("o")).collect()
    assert [r.s for r in out] == ["Inverno", "Primavera", "Verão", "Outono", "Outono"]
    assert [r.o for r in out] == [1, 0, 0, 0, 0]
