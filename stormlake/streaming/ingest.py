"""Incremental raw -> silver with Structured Streaming.

The source processes whole folders in batch; new raw files can instead be
picked up as they land.  Both forms write what each micro-batch adds to a folder
of its own (overwritten when a batch is tried again) and are merged on read, so
the result does not depend on how files fall into batches, and no batch
rewrites what earlier ones wrote.

* ``silver_disaster_stream`` / ``read_silver_disaster``: a file stream of
  storm-report CSVs.  The stream carries the files' paths; each batch reads its
  files by the names in their own headers, as the batch job does, whatever their
  layouts.  A file is never split between batches, so the per-file
  date format is chosen within one; each batch is reduced to its first report
  of every (city, date, event type), and the first over all batches is taken on read.
* ``day_partials_to_parquet`` / ``read_day_means``: AG1 on arriving hourly
  observations: sums and counts per city and day of each batch, added up on read.
* ``hourly_day_means_stream``: AG1 as a watermarked one-day window per city, a
  day being given out once it is closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stormlake import config as C
from stormlake.plans.silver import merge_first, silver_disaster
from stormlake.sources.files import csv_headers, read_csv_lenient

DISASTER_COLS = ["EVENT_ID", *C.DISASTER_SELECT]


def raw_disaster_paths(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File stream of the paths of storm-report CSVs (a stream's schema is fixed,
    the files' headers are not); contents are not read here."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).options(recursiveFileLookup=True, pathGlobFilter="*.[cC][sS][vV]")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path")


def read_disaster_files(spark: SparkSession, files: list[str]) -> DataFrame | None:
    """Raw storm reports of the files, by name; None if all are empty.  A file
    without one of the columns that are needed raises."""
    headers = csv_headers(spark, files)
    for header, having in headers.items():
        if missing := [c for c in DISASTER_COLS if c not in header]:
            raise ValueError(f"no column {', '.join(missing)} in {having[0]}")
    if not headers:
        return None
    return read_csv_lenient(spark, files, DISASTER_COLS, multi_line=True, headers=headers).drop("granularity", "row_order")


def silver_disaster_stream(spark: SparkSession, raw_path: str, out_path: str, checkpoint: str,
                           available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Start the raw storm-report -> silver stream (PL4 per micro-batch)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        raw = read_disaster_files(session, [r["path"] for r in batch.collect()])
        if raw is None:
            raw = session.createDataFrame([], ", ".join(f"{c} string" for c in [*DISASTER_COLS, "source", "file", "city"]) + ", city_id int")
        s = silver_disaster(raw.withColumn("ordinal", F.col("EVENT_ID").cast("long")))
        s.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = (raw_disaster_paths(spark, raw_path, max_files).writeStream
         .foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_silver_disaster(spark: SparkSession, out_path: str) -> DataFrame:
    """The silver table of all batches so far."""
    return merge_first(spark.read.parquet(out_path).drop("batch_id", "source"))


def hourly_day_means_stream(hourly: DataFrame, cols: list[str], ts: str = "obs_ts",
                            lateness: str = "1 day") -> DataFrame:
    """AG1 on a stream: per city and UTC day, mean of each column."""
    return (hourly.withWatermark(ts, lateness)
            .groupBy("city_id", F.window(ts, "1 day").alias("day"))
            .agg(*[F.avg(c).alias(c) for c in cols])
            .select("city_id", F.to_date(F.col("day.start")).alias("date"), *cols))


def day_partials_to_parquet(spark: SparkSession, src_path: str, schema: str, cols: list[str],
                            out_path: str, checkpoint: str, ts: str = "obs_ts",
                            max_files: int | None = None) -> StreamingQuery:
    """Sums and counts per (city, day) of each micro-batch of a Parquet file stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        day = batch.withColumn("date", F.to_date(ts))
        (day.groupBy("city_id", "date").agg(
            *[F.sum(c).alias(f"sum_{c}") for c in cols], *[F.count(c).alias(f"n_{c}") for c in cols])
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    return (reader.parquet(src_path).writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_day_means(spark: SparkSession, out_path: str, cols: list[str]) -> DataFrame:
    """Day means over all batches so far; a day without any value of a column has none."""
    d = spark.read.parquet(out_path).groupBy("city_id", "date").agg(
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in cols], *[F.sum(f"n_{c}").alias(f"n_{c}") for c in cols])
    return d.select("city_id", "date", *[
        F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}") / F.col(f"n_{c}")).alias(c) for c in cols])
