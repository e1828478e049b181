import os

from pyspark.sql import functions as F

from stormlake.session import scratch_path
from stormlake.streaming.ingest import (hourly_day_means_stream, read_silver_disaster,
                                        silver_disaster_stream)


def test_disaster_stream_available_now(spark, tmp_path):
    raw = tmp_path / "raw" / "file=dallas_storm_events"
    os.makedirs(raw)
    (raw / "a.csv").write_text("EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE\n"
                               "1,DALLAS,01/02/2020,Hail,x\n2,DALLAS,01/02/2020,Hail,y\n"
                               "3,DALLAS,13/02/2020,Flood,z\n")
    out = scratch_path(spark, "stream-out")
    q = silver_disaster_stream(spark, str(tmp_path / "raw"), out, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination(120)
    rows = read_silver_disaster(spark, out).collect()
    # 13/02 forces d/M/yyyy for the file; the two Hail reports of one day keep the first
    assert sorted((str(r.date), r.eventType, r.ordinal) for r in rows) == [
        ("2020-02-01", "Hail", 1), ("2020-02-13", "Flood", 3)]


def test_disaster_stream_reads_each_file_by_its_header(spark, tmp_path):
    """More columns (filled and empty) and another order: no row lost, none under wrong names."""
    files = {"dallas_a": "EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE,MAGNITUDE\n"
                         "1,DALLAS,2020-01-01,Hail,x,1.5\n2,DALLAS,2020-01-02,Flood,x,\n",
             "dallas_b": "MAGNITUDE,EVENT_TYPE,BEGIN_DATE,EVENT_ID,EVENT_NARRATIVE,CZ_NAME_STR\n"
                         "2,Hail,2020-01-03,3,y,DALLAS\n,Flood,2020-01-04,4,y,DALLAS\n",
             "dallas_c": ""}
    for name, text in files.items():
        folder = tmp_path / "raw" / f"file={name}"
        os.makedirs(folder)
        (folder / "part.csv").write_text(text)
    for most in (1, 3):
        out = scratch_path(spark, "stream-out")
        q = silver_disaster_stream(spark, str(tmp_path / "raw"), out, scratch_path(spark, "stream-ckpt"), max_files=most)
        q.awaitTermination(120)
        got = sorted((str(r.date), r.eventType, r.ordinal) for r in read_silver_disaster(spark, out).collect())
        assert got == [("2020-01-01", "Hail", 1), ("2020-01-02", "Flood", 2), ("2020-01-03", "Hail", 3), ("2020-01-04", "Flood", 4)]


def test_hourly_means_stream(spark, tmp_path):
    src = tmp_path / "hourly"
    spark.createDataFrame([(0, "2020-01-01 01:00:00", 1.0), (0, "2020-01-01 05:00:00", 3.0),
                           (0, "2020-01-03 01:00:00", 9.0)], "city_id int, ts string, x double") \
        .select("city_id", F.to_timestamp("ts").alias("obs_ts"), "x").write.parquet(str(src))
    stream = spark.readStream.schema("city_id int, obs_ts timestamp, x double").parquet(str(src))
    q = (hourly_day_means_stream(stream, ["x"]).writeStream.format("memory")
         .queryName("day_means_t").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = [(str(r.date), r.x) for r in spark.sql("SELECT * FROM day_means_t").collect()]
    assert ("2020-01-01", 2.0) in got


def test_one_file_a_batch_gives_the_batch_result(spark, tmp_path):
    """Two files of one city, each read by a batch of its own: the first report over both is kept."""
    head = "EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE\n"
    for name, rows in [("dallas_a", "5,DALLAS,01/02/2020,Hail,x\n6,DALLAS,01/03/2020,Flood,x\n"),
                       ("dallas_b", "2,DALLAS,2020-01-02,Hail,y\n7,DALLAS,2020-01-03,Flood,y\n")]:
        folder = tmp_path / "raw" / f"file={name}"
        os.makedirs(folder)
        (folder / "part.csv").write_text(head + rows)
    out = scratch_path(spark, "stream-out")
    q = silver_disaster_stream(spark, str(tmp_path / "raw"), out, scratch_path(spark, "stream-ckpt"), max_files=1)
    q.awaitTermination(120)
    assert len([f for f in os.listdir(out.removeprefix("file:")) if f.startswith("batch_id=")]) == 2
    got = sorted((str(r.date), r.eventType, r.ordinal) for r in read_silver_disaster(spark, out).collect())
    assert got == [("2020-01-02", "Hail", 2), ("2020-01-03", "Flood", 6)]


def test_unknown_cities_keep_their_own_reports(spark, tmp_path):
    for name, row in (("boston", 1), ("seattle", 2), ("dallas", 3)):
        folder = tmp_path / "raw" / f"file={name}_storms"
        os.makedirs(folder)
        (folder / "a.csv").write_text("EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE\n"
                                      f"{row},X,2020-01-02,Tornado,x\n{row + 10},X,2020-01-02,Tornado,x\n")
    for most in (1, 3):
        out = scratch_path(spark, "stream-out")
        q = silver_disaster_stream(spark, str(tmp_path / "raw"), out, scratch_path(spark, "stream-ckpt"), max_files=most)
        q.awaitTermination(120)
        got = sorted((r.file, r.ordinal) for r in read_silver_disaster(spark, out).collect())
        assert got == [("boston_storms", 1), ("dallas_storms", 3), ("seattle_storms", 2)]
