"""End-to-end jobs over folder layouts (the source's stage scripts E1-E4).

* ``raw_to_silver``: every raw source folder -> its silver tables
  ``{silver}/{source}/{daily|hourly}`` (Parquet, partitioned by city); a folder of no
  known source passes through as it is.
* ``silver_to_gold``: silver -> ``{gold}/{source}`` partitioned by city, a table a
  source, since their columns differ.
* ``disaster_report``: the PL8/PL9 tables from silver disasters.
* ``train_models``: allow-listed gold cities -> run rows appended to ``{runs}``.

Raw layout as the source writes it: ``{raw}/{source}/*.csv``, every file read by
its own header; ``daily`` in a file's name makes it daily, any other is hourly.
City and file stay columns all the way, so a file of no known city keeps its own
date format, gaps and name.  One job per stage covers every city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.operators.features import model_table
from stormlake.operators.profile import null_percentages, schema_profile
from stormlake.plans import gold, silver, trends
from stormlake.plans.runs import log_runs
from stormlake.sources.files import (column_map_dict, csv_headers, exists, headers_by_kind, load_column_map,
                                     read_csv_lenient, read_gold, source_folders, write_parquet)
from stormlake.session import materialize

# raw columns that are text; every other column of a weather folder is a number
TEXT_COLUMNS = {"base_1": ["date"], "base_2": ["DATE", "NAME", "STATION", "PGTM"], "base_3": ["time"]}
PROCESSORS = {"base_1": silver.silver_base1, "base_2": silver.silver_base2, "base_3": silver.silver_base3}


def _numeric(source: str, mapping: dict[str, dict[str, str]]) -> list[str]:
    return [c for c in mapping.get(source, {}) if c not in TEXT_COLUMNS[source]]


def _tidy(df: DataFrame) -> DataFrame:
    return df.drop("source", "row_order")


def raw_to_silver(spark: SparkSession, raw: str, out: str, column_map: str | None = None) -> dict[str, str]:
    """E1: scan every folder, clean known sources per their rules, write silver.  The files of
    a folder are told apart by their headers; each kind is read with the columns that its own files have.
    ``column_map``: a JSON file of raw and canonical names a source, in place of the library's own."""
    written = {}
    mapping = column_map_dict(load_column_map(spark, column_map)) if column_map else C.COLUMN_MAP
    for source in source_folders(spark, raw):
        folder = f"{raw.rstrip('/')}/{source}"
        headers = csv_headers(spark, folder)
        if not headers:
            continue
        if source in PROCESSORS:
            for kind, files in headers_by_kind(headers).items():
                part = read_csv_lenient(spark, folder, None, _numeric(source, mapping), headers=files)
                write_parquet(_tidy(PROCESSORS[source](part, mapping=mapping)).drop("granularity"), f"{out}/{source}/{kind}", ["city"])
        elif source == "base_disaster":
            df = read_csv_lenient(spark, folder, multi_line=True, headers=headers)
            s = silver.silver_disaster(df.drop("granularity").withColumn("ordinal", F.col("row_order")), mapping=mapping)
            write_parquet(_tidy(s).drop("ordinal"), f"{out}/{source}", ["city"])
        else:
            write_parquet(_tidy(read_csv_lenient(spark, folder, headers=headers)), f"{out}/{source}", ["city"])
        written[source] = f"{out}/{source}"
    return written


def _silver(spark: SparkSession, root: str, source: str, kind: str) -> DataFrame | None:
    path = f"{root}/{source}/{kind}"
    return spark.read.parquet(path).drop("file") if exists(spark, path) else None


def silver_to_gold(spark: SparkSession, root: str, out: str) -> list[str]:
    """E2: one gold table per source, all cities together, partitioned by city.
    A source without daily silver is left out, and so are hourly means without hourly silver."""
    dis = spark.read.parquet(f"{root}/base_disaster")
    done = []
    for source in PROCESSORS:
        daily, hourly = (_silver(spark, root, source, kind) for kind in ("daily", "hourly"))
        if daily is None:
            continue
        if source == "base_2":
            g = gold.gold_base2(daily.drop("city"), dis)
        elif hourly is None:
            raise FileNotFoundError(f"{root}/{source}/hourly: {source} needs its hourly silver")
        else:
            g = (gold.gold_base1 if source == "base_1" else gold.gold_base3)(daily.drop("city"), hourly.drop("city"), dis)
        names = F.array(*[F.lit(c) for c in C.CITIES])
        g = g.withColumns({"source": F.lit(source), "city": F.when(
            F.col("city_id").isNotNull(), F.element_at(names, F.col("city_id") + 1))})
        write_parquet(g, f"{out}/{source}", ["city"])
        done.append(source)
    return done


def disaster_report(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """E4 / PL9: profile, null shares, trend and count tables for every city at
    once; ``report_rank`` gives the order in which a table is presented."""
    d = spark.read.parquet(f"{root}/base_disaster")
    return report_tables(d.select("city_id", "location", "date", "eventType"))


def report_tables(d: DataFrame) -> dict[str, DataFrame]:
    return {
        "profile": schema_profile(d),
        "null_pct": trends.ranked(null_percentages(d, ["location", "date", "eventType"], ["city_id"]),
                                  [F.desc("null_pct"), "column_name"], ["city_id"]),
        "over_years": trends.disasters_over_years(d),
        "by_year": trends.ranked(trends.disasters_by_year(d), ["year"], ["city_id"]),
        "by_type": trends.ranked(trends.disasters_by_type(d), ["count", "eventType"], ["city_id"]),
        "by_season": trends.ranked(trends.disasters_by_season(d), ["season"], ["city_id"]),
        "by_city": trends.ranked(trends.disasters_by_city(d), ["count", "city_id"]),
        "types_over_years": trends.event_types_over_years(d),
    }


def train_models(spark: SparkSession, gold_root: str, runs_path: str,
                 models: list[str] | None = None, balancers: list[str | None] | None = None,
                 n_trials: int = C.N_TRIALS, allow: dict[str, list[str]] | None = None) -> DataFrame:
    """E3 / PL11: allow-listed (source, city) tables x balancers x models -> run
    rows, appended to ``runs_path``, failed ones with their error."""
    from stormlake.plans.training import train_matrix

    allow = allow or C.TRAINING_CITIES
    tables = {}
    for source in sorted(allow):
        if not exists(spark, f"{gold_root}/{source}"):
            continue
        g = read_gold(spark, f"{gold_root}/{source}", {source: allow[source]})
        for city in sorted(allow[source]):
            part = g.where(F.col("city") == city).drop("source", "city")
            if not part.isEmpty():
                tables[(source, city)] = materialize(model_table(part, ["city_id"]))
    return train_matrix(spark, tables, models, balancers, n_trials, log=lambda r: log_runs(r, runs_path),
                        models_path=f"{runs_path}-models")
