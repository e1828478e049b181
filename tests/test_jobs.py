from pyspark.sql import functions as F

from stormlake.plans import jobs
from stormlake.session import scratch_path
from stormlake.sources import fixtures as X
from stormlake.sources.files import file_name, write_named_csv
import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _write_raw(spark, root):
    cname = X.city_name(F.col("city_id"))
    def put(df, source, kind):
        cols = [c for c in df.columns if c not in ("city_id", "ord_a", "ord_b", "ord_c")]
        when = next(c for c in cols if c.lower() in ("date", "time"))
        rows = df.withColumn("file", file_name(cname, kind)).repartition("file").sortWithinPartitions(
            "file", when, *[c for c in ("ord_a", "ord_b", "ord_c") if c in df.columns])
        write_named_csv(rows.select(*cols, "file"), f"{root}/{source}", mode="append")
    put(X.raw_base1_daily(spark, SF_SMALL), "base_1", "daily")
    put(X.raw_base1_hourly(spark, SF_SMALL), "base_1", "hourly")
    put(X.raw_base2_daily(spark, SF_SMALL), "base_2", "daily")
    put(X.raw_base3_daily(spark, SF_SMALL), "base_3", "daily")
    put(X.raw_base3_hourly(spark, SF_SMALL), "base_3", "hourly")
    d = X.storm_events_raw(spark, SF_SMALL).select(
        F.col("ordinal").cast("string").alias("EVENT_ID"), "CZ_NAME_STR", "BEGIN_DATE", "EVENT_TYPE",
        "EVENT_NARRATIVE", F.concat(F.lower(cname), F.lit("_storm_events")).alias("file"))
    write_named_csv(d.repartition("file").sortWithinPartitions("file", F.col("EVENT_ID").cast("long")),
                    f"{root}/base_disaster")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_raw_to_gold_jobs_match_queries(spark):
    raw, silver_root, gold_root = (scratch_path(spark, n) for n in ("raw", "silver", "gold"))
    _write_raw(spark, raw)
    written = jobs.raw_to_silver(spark, raw, silver_root)
    assert set(written) == {"base_1", "base_2", "base_3", "base_disaster"}
    assert jobs.silver_to_gold(spark, silver_root, gold_root) == ["base_1", "base_2", "base_3"]
    g = {s: spark.read.parquet(f"{gold_root}/{s}") for s in ("base_2", "base_3")}
    assert "dewpoint" in g["base_3"].columns and "dewpoint" not in g["base_2"].columns
    q = E.queries()
    cols = ["city_id", "date", "eventType", "disaster_occurred", "precipitation", "average_temperature"]
    for src, name in [("base_2", "gold_base2"), ("base_3", "gold_base3")]:
        got = _rows(g[src], cols)
        exp = _rows(q[name](spark, SF_SMALL), cols)
        assert got == exp, src
    rep = jobs.disaster_report(spark, silver_root)
    assert _rows(rep["over_years"], ["city_id", "year", "count"]) == \
        _rows(q["disaster_trend"](spark, SF_SMALL), ["city_id", "year", "count"])
