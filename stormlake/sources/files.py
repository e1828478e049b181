"""File sources and sinks (SC1-SC11).

Identity (source, city, granularity) lives in file and folder names in the
raw layout ``{root}/{source}/{city}_{daily|hourly}_1973_2024.csv``; it is parsed
once at scan from ``_metadata.file_path`` into real columns.  Spark-written
layouts (``{root}/{source}/file={stem}/part-*.csv``) parse the same way.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormlake import config as C
from stormlake.operators.project import coalesce_nan
from stormlake.operators.sets import union_all_by_name

OVERFLOW = "_overflow"


# --------------------------------------------------------------------------
# identity from paths
# --------------------------------------------------------------------------
def _path() -> Column:
    return F.url_decode(F.col("_metadata.file_path"))


def file_stem(path: Column) -> Column:
    """File name without extension, or the ``file=`` folder value of a Spark layout."""
    spark_layout = F.regexp_extract(path, r"/file=([^/]+)/[^/]+$", 1)
    flat = F.regexp_extract(path, r"/([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1)
    return F.when(spark_layout != "", spark_layout).otherwise(flat)


def source_of(path: Column) -> Column:
    """The folder right above the file (or above its ``file=`` folder)."""
    return F.regexp_extract(path, r"/([^/=]+)/(?:file=[^/]+/)?[^/]+$", 1)


def city_of(name: Column, cities: list[str] | None = None) -> Column:
    """SC7: first known city name found in a file name, case-blind; else null."""
    cities = cities or C.CITIES
    alt = "|".join(re.escape(c) for c in cities)
    hit = F.regexp_extract(F.lower(name), f"({alt})", 1)
    return F.when(hit != "", hit)


def city_id_of(city: Column, cities: list[str] | None = None) -> Column:
    cities = cities or C.CITIES
    pos = F.array_position(F.array(*[F.lit(c) for c in cities]), city)
    return F.when(pos > 0, (pos - 1).cast("int"))


def granularity_of(name: Column) -> Column:
    """``daily`` if the file name says so, else ``hourly``, as the source takes it."""
    return F.when(F.contains(F.lower(name), F.lit("daily")), F.lit("daily")).otherwise(F.lit("hourly"))


def with_identity(df: DataFrame) -> DataFrame:
    p = _path()
    stem = file_stem(p)
    return df.withColumns({
        "source": source_of(p), "file": stem, "city": city_of(stem),
        "granularity": granularity_of(stem)}).withColumn("city_id", city_id_of(F.col("city")))


# --------------------------------------------------------------------------
# SC1: CSV with the source's bad-line policy
# --------------------------------------------------------------------------
def _first_record(pieces: Iterable[bytes]) -> list[str]:
    """Fields of the first CSV record of a file that comes in pieces; reads no further
    than the piece that ends it, however long it is."""
    head, quoted = [], False
    for piece in pieces:
        end = None
        for m in re.finditer(rb'["\r\n]', piece):
            if m.group() == b'"':
                quoted = not quoted
            elif not quoted:
                end = m.start()
                break
        head.append(piece[:end])
        if end is not None:
            break
    csv.field_size_limit(sys.maxsize)
    return next(csv.reader(io.StringIO(b"".join(head).decode("utf-8-sig", "replace"))), [])


def _header(names: list[str]) -> list[str]:
    return [n.strip() or f"_c{i}" for i, n in enumerate(names)]


def _read_headers(batches):
    """mapInPandas: paths -> their headers; null where the store is not open to Python."""
    from pyarrow import fs
    piece = 1 << 16

    def header(path):
        try:
            store, at = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            stream = store.open_input_stream(unquote(at) if path.startswith("file:") else at)
        except (OSError, ValueError):
            return None
        with stream:
            return _header(_first_record(iter(lambda: stream.read(piece), b"")))

    for pdf in batches:
        yield pdf.assign(header=[header(p) for p in pdf["path"]])


def _headers_by_client(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Headers of files in a store that only Spark's own client opens."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            out[path] = _header(_first_record(iter(lambda: bytes(stream.readNBytes(1 << 16)), b"")))  # noqa: B023
        finally:
            stream.close()
    return out


def csv_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the CSV files under ``path`` (a folder or glob, read through
    subfolders; or a list of files) that have it.

    Spark lists the files, tasks read the first record of each, and the driver gets them grouped
    by header.  Empty files have no header and are left out; a missing location gives no files."""
    if path == []:
        return {}
    try:
        files = (spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.[cC][sS][vV]")
                 .load(path).where("length > 0").select("path"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    groups = (files.mapInPandas(_read_headers, "path string, header array<string>")
              .groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files")).collect())
    found = {tuple(r["header"]): list(r["files"]) for r in groups if r["header"]}
    unread = [p for r in groups if r["header"] is None for p in r["files"]]
    for p, header in _headers_by_client(spark, unread).items():
        if header:
            found.setdefault(tuple(header), []).append(p)
    return dict(sorted(found.items(), key=lambda kv: kv[1][0]))


def headers_by_kind(headers: dict[tuple[str, ...], list[str]]) -> dict[str, dict[tuple[str, ...], list[str]]]:
    """The headers of the daily and of the hourly files, as ``granularity_of`` tells them apart."""
    out: dict[str, dict[tuple[str, ...], list[str]]] = {}
    for header, files in headers.items():
        for f in files:
            parts = unquote(f).split("/")
            stem = next((x[len("file="):] for x in parts[-2:-1] if x.startswith("file=")), parts[-1].rsplit(".", 1)[0])
            kind = "daily" if "daily" in stem.lower() else "hourly"
            out.setdefault(kind, {}).setdefault(header, []).append(f)
    return out


def _unique(names: tuple[str, ...]) -> list[str]:
    """Column names told apart as a repeated header name needs (x, x.1, ...)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n.lower(), 0)
        seen[n.lower()] = k + 1
        out.append(n if k == 0 else f"{n}.{k}")
    return out


def read_csv_lenient(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                     numeric: list[str] | None = None, multi_line: bool = False,
                     headers: dict[tuple[str, ...], list[str]] | None = None) -> DataFrame:
    """Read the CSV files under ``path`` (or the listed files), each by the names in its own header.

    Files are read in one scan for each different header and put together by name;
    a column that a file lacks is null there.  ``columns`` keeps the named ones
    that some file has (default: all).  Rows with more fields than their header
    are skipped (what ``on_bad_lines='skip'`` does), rows with fewer keep nulls.
    Null tokens become null; ``numeric`` columns (default: none) are parsed with ``try_cast``.
    ``multi_line``: quoted fields may span lines; such a file is one task's work.
    ``headers``: what ``csv_headers`` gave for these files, if it was asked before.
    Adds the file's identity and ``row_order``, which orders files by path and rows as
    they stand in them, however files are cut into splits.
    """
    headers = csv_headers(spark, path) if headers is None else headers
    if not headers:
        raise FileNotFoundError(f"no CSV file under {path}")
    parts = []
    for header, files in headers.items():
        names = _unique(header)
        schema = T.StructType([T.StructField(f"_f{i}", T.StringType()) for i in range(len(names))]
                              + [T.StructField(OVERFLOW, T.StringType())])
        df = (spark.read.schema(schema)
              .options(header=True, multiLine=multi_line, escape='"', mode="PERMISSIVE", enforceSchema=True,
                       maxColumns=max(20480, len(names) + 2)).csv(files))
        df = with_identity(df).withColumn("row_order", F.struct(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row")))
        keep = [(i, n) for i, n in enumerate(names) if columns is None or n in columns]
        value = lambda i: F.when(F.col(f"_f{i}").isin(C.NULL_TOKENS), F.lit(None)).otherwise(F.col(f"_f{i}"))
        cast = lambda i, n: value(i).try_cast("double") if n in (numeric or []) else value(i)
        parts.append(df.where(F.col(OVERFLOW).isNull()).select(
            *[cast(i, n).alias(n) for i, n in keep], "source", "file", "city", "granularity", "city_id", "row_order"))
    return coalesce_nan(union_all_by_name(parts))


def with_file_ordinals(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows of each file from 0, as they stand in it, whatever splits
    and tasks it was read in: rows are numbered inside their split, and the counts of
    the splits before (a small table) are added."""
    path, split = F.col("row_order.path"), F.col("row_order.split")
    d = df.withColumns({"__path": path, "__split": split})
    inside = Window.partitionBy("__path", "__split").orderBy("row_order.row")
    splits = d.groupBy("__path", "__split").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("__path", "__split", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (d.withColumn("__row", F.row_number().over(inside) - 1).join(splits, ["__path", "__split"])
            .withColumn(name, F.col("__before") + F.col("__row")).drop("__path", "__split", "__before", "__row"))


def read_csv_or_none(spark: SparkSession, path: str, columns: list[str] | None = None,
                     numeric: list[str] | None = None, multi_line: bool = False) -> DataFrame | None:
    """SC1 error path: a missing location, or one without CSV files, gives None."""
    try:
        return read_csv_lenient(spark, path, columns, numeric, multi_line)
    except FileNotFoundError:
        return None


# --------------------------------------------------------------------------
# SC6: every source folder under a root, dispatched on its name
# --------------------------------------------------------------------------
def source_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under ``root``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(root)
    return sorted(x.getPath().getName() for x in at.getFileSystem(conf).listStatus(at)
                  if x.isDirectory() and not x.getPath().getName().startswith(("_", ".")))


def scan_raw(spark: SparkSession, root: str, processors: dict | None = None,
             numeric: dict[str, list[str]] | None = None, multi_line: tuple[str, ...] = ("base_disaster",)) -> dict[str, DataFrame]:
    """Read every folder under ``root`` and apply its processor.

    A folder without a processor passes through unchanged (the generic
    processor); one without CSV files is left out.  ``numeric``: folder -> columns read as numbers.
    """
    processors, numeric = processors or {}, numeric or {}
    out = {}
    for name in source_folders(spark, root):
        df = read_csv_or_none(spark, f"{root.rstrip('/')}/{name}", None, numeric.get(name), name in multi_line)
        if df is not None:
            out[name] = processors.get(name, lambda d: d)(df)
    return out


# --------------------------------------------------------------------------
# sinks
# --------------------------------------------------------------------------
def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """SC3/SC4: snappy Parquet, partitioned by identity columns; dirs are made."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """SC2: Parquet scan; a missing location gives None."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_named_csv(df: DataFrame, path: str, name_col: str = "file", mode: str = "overwrite") -> None:
    """SC5: CSV with header, one folder per file name (``file={name}``)."""
    (df.write.mode(mode).partitionBy(name_col)
       .options(header=True, escape='"', quoteAll=False).csv(path))


def file_name(city: Column, granularity: Column | str, span: str = "1973_2024") -> Column:
    """``{city}_{granularity}_1973_2024`` (the source's naming)."""
    g = F.lit(granularity) if isinstance(granularity, str) else granularity
    return F.concat_ws("_", city, g, F.lit(span))


# --------------------------------------------------------------------------
# SC8-SC10: small JSON dimensions
# --------------------------------------------------------------------------
def load_cities(spark: SparkSession, path: str) -> DataFrame:
    """SC8: [{city, coordinates: [lat, lon]}] -> (city, lat, lon)."""
    d = spark.read.option("multiLine", True).json(path)
    return d.select("city", F.element_at("coordinates", 1).alias("lat"),
                    F.element_at("coordinates", 2).alias("lon"))


def load_stations(spark: SparkSession, path: str) -> DataFrame:
    """SC9: [{city, sation}] -> (city, station); the source's key is misspelt."""
    d = spark.read.option("multiLine", True).json(path)
    key = "sation" if "sation" in d.columns else "station"
    return d.select("city", F.col(key).cast("int").alias("station"))


def load_column_map(spark: SparkSession, path: str) -> DataFrame:
    """SC10: {source: {raw: canonical}} -> (source, raw, canonical) rows."""
    d = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    parts = [d.select(F.lit(s).alias("source"),
                      F.explode(F.from_json(F.to_json(F.col(f"`{s}`")), "map<string,string>")))
             for s in d.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnsRenamed({"key": "raw", "value": "canonical"})


def column_map_dict(df: DataFrame) -> dict[str, dict[str, str]]:
    """Collect the (tiny, fixed-size) map for use in renames."""
    out: dict[str, dict[str, str]] = {}
    for r in df.collect():
        out.setdefault(r["source"], {})[r["raw"]] = r["canonical"]
    return out


# --------------------------------------------------------------------------
# SC11: gold scan limited to chosen cities per source
# --------------------------------------------------------------------------
def allow_list_filter(allow: dict[str, list[str]] | None = None) -> Column:
    """``(source = s AND city IN (...)) OR ...`` -- prunes partitions at scan."""
    allow = allow or C.TRAINING_CITIES
    cond = None
    for s, cities in allow.items():
        c = (F.col("source") == F.lit(s)) & F.col("city").isin(cities)
        cond = c if cond is None else cond | c
    return cond


def read_gold(spark: SparkSession, path: str, allow: dict[str, list[str]] | None = None) -> DataFrame:
    """One gold table (of one source, or of several with the same columns), pruned to the chosen cities."""
    return spark.read.parquet(path).where(allow_list_filter(allow))
