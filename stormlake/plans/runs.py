"""Model run log (RN1) and run comparison (RN2, PL12).

Runs are rows of a Parquet table: identity, status, times, and free-form
``params`` (MAP<STRING,STRING>) and ``metrics`` (MAP<STRING,DOUBLE>), so runs
with different keys stack without schema changes (ST5).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = ("run_id string, experiment string, status string, start_time bigint, "
              "end_time bigint, params map<string,string>, metrics map<string,double>")


def run_rows(experiment: str, params: dict, metrics: dict, start_time: float, status: str = "FINISHED") -> tuple:
    """One run as a row of ``RUN_SCHEMA``."""
    return (uuid.uuid4().hex, experiment, status, int(start_time * 1000), int(time.time() * 1000),
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None})


def run_row(spark: SparkSession, experiment: str, params: dict, metrics: dict,
            start_time: float, status: str = "FINISHED") -> DataFrame:
    """RN1: one run as a one-row frame (append it to the runs table)."""
    return spark.createDataFrame([run_rows(experiment, params, metrics, start_time, status)], RUN_SCHEMA)


def log_runs(runs: DataFrame, path: str) -> None:
    """RN1 sink: append runs to the Parquet table, partitioned by experiment."""
    runs.write.mode("append").partitionBy("experiment").parquet(path)


def run_table(runs: DataFrame, experiment: str) -> DataFrame:
    """RN2: runs of one experiment with every param and metric key as a column.

    Keys are discovered from the data (a distinct over map keys -- bounded by
    the key vocabulary, not by the number of runs); an unknown experiment is
    an error, as in the source.
    """
    r = runs.where(F.col("experiment") == F.lit(experiment))
    keys = (r.select(F.explode(F.map_keys("params")).alias("k"), F.lit("p").alias("t"))
             .union(r.select(F.explode(F.map_keys("metrics")).alias("k"), F.lit("m").alias("t")))
             .distinct().collect())
    if not keys and r.limit(1).count() == 0:
        raise LookupError(f"Experiment '{experiment}' not found")
    pk = sorted(k for k, t in keys if t == "p")
    mk = sorted(k for k, t in keys if t == "m")
    return r.select("run_id", "status", "start_time", "end_time",
                    *[F.col("params")[k].alias(k) for k in pk],
                    *[F.col("metrics")[k].alias(k) for k in mk if k not in pk])
