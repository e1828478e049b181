import json
import os

from stormlake import config as C
from stormlake.session import scratch_path
from stormlake.sources.files import (column_map_dict, load_cities, load_column_map,
                                     load_stations, read_csv_lenient, read_csv_or_none)

COLS = ["EVENT_ID", "CZ_NAME_STR", "BEGIN_DATE", "EVENT_TYPE", "EVENT_NARRATIVE"]


def dump_json(obj, path):
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(obj, fh, ensure_ascii=False)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_bad_line_policy(spark, tmp_path):
    root = tmp_path / "raw"
    _write(str(root / "base_disaster" / "new york_storm_events.csv"),
           "EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE\n"
           '1,NEW YORK,01/02/2020,Hail,"two\nlines"\n'
           "2,NEW YORK,01/03/2020\n"                      # short: padded
           "3,NEW YORK,01/04/2020,Hail,x,surplus\n"       # long: skipped
           "4,NEW YORK,01/05/2020,Flood,NA\n")
    df = read_csv_lenient(spark, str(root / "base_disaster"), COLS, multi_line=True)
    rows = {r.EVENT_ID: r for r in df.collect()}
    assert sorted(rows) == ["1", "2", "4"]
    assert rows["1"].EVENT_NARRATIVE == "two\nlines"
    assert rows["2"].EVENT_TYPE is None and rows["4"].EVENT_NARRATIVE is None
    r = rows["1"]
    assert (r.source, r.city, r.city_id) == ("base_disaster", "new york", 4)


def test_missing_folder_is_none(spark, tmp_path):
    assert read_csv_or_none(spark, str(tmp_path / "nope"), COLS) is None


def test_json_dimensions(spark, tmp_path):
    cities = [{"city": c, "coordinates": list(C.CITY_COORDINATES[c])} for c in C.CITIES]
    stations = [{"city": c, "sation": C.CITY_STATIONS[c]} for c in C.CITIES]
    dump_json(cities, str(tmp_path / "c.json"))
    dump_json(stations, str(tmp_path / "s.json"))
    dump_json(C.COLUMN_MAP, str(tmp_path / "m.json"))
    c = {r.city: (r.lat, r.lon) for r in load_cities(spark, str(tmp_path / "c.json")).collect()}
    assert c["miami"] == C.CITY_COORDINATES["miami"]
    s = {r.city: r.station for r in load_stations(spark, str(tmp_path / "s.json")).collect()}
    assert s == C.CITY_STATIONS
    m = column_map_dict(load_column_map(spark, str(tmp_path / "m.json")))
    assert m == C.COLUMN_MAP


def test_scratch_under_checkpoint_dir(spark):
    from stormlake.session import ensure_checkpoint_dir
    assert scratch_path(spark, "x").startswith(ensure_checkpoint_dir(spark).rstrip("/"))


def test_scan_raw_dispatch_and_missing(spark, tmp_path):
    from stormlake.sources.files import read_parquet_or_none, scan_raw
    root = tmp_path / "raw"
    _write(str(root / "disaster" / "chicago_x.csv"), "A,B\n1,2\n")
    os.makedirs(root / "base_9")
    out = scan_raw(spark, str(root), numeric={"disaster": ["B"]})
    assert set(out) == {"disaster"}                       # a folder without files is left out
    r = out["disaster"].first()                           # no processor: passed through
    assert (r.A, r.B, r.city, r.source) == ("1", 2.0, "chicago", "disaster")
    assert read_parquet_or_none(spark, str(tmp_path / "none")) is None


def test_headers_by_name(spark, tmp_path):
    """Files of one folder with their own headers, a surplus column, a city not known."""
    d = tmp_path / "raw" / "base_2"
    _write(str(d / "dallas_daily.csv"), "DATE,PRCP,TMIN\n2020-01-01,1.5,-3\n")
    _write(str(d / "houston.csv"), "TMIN,STATION,DATE,PRCP\n7,X9,2020-01-02,20\n")
    _write(str(d / "boston_daily_1973_2024.csv"), "DATE,TMIN\n2020-01-03,4\n")
    df = read_csv_lenient(spark, str(d), ["DATE", "PRCP", "TMIN"], ["PRCP", "TMIN"])
    rows = {r.file: r for r in df.collect()}
    r = rows["dallas_daily"]
    assert (r.DATE, r.PRCP, r.TMIN, r.city, r.granularity) == ("2020-01-01", 1.5, -3.0, "dallas", "daily")
    r = rows["houston"]
    assert (r.DATE, r.PRCP, r.TMIN, r.city, r.granularity) == ("2020-01-02", 20.0, 7.0, "houston", "hourly")
    r = rows["boston_daily_1973_2024"]
    assert (r.DATE, r.PRCP, r.TMIN, r.city, r.city_id) == ("2020-01-03", None, 4.0, None, None)
    assert "STATION" not in df.columns


def test_unknown_folder_passes_through(spark, tmp_path):
    from stormlake.plans import jobs
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    _write(f"{raw}/base_9/miami_x.csv", "A,B\n1,2\n")
    _write(f"{raw}/base_2/boston_daily.csv", "DATE,PRCP,TMAX,TMIN\n13/02/2020,1,5,1\n14/02/2020,,6,2\n15/02/2020,3,7,3\n")
    _write(f"{raw}/base_disaster/miami_storms.csv",
           "EVENT_ID,STATE,CZ_NAME_STR,BEGIN_DATE,MAGNITUDE,EVENT_TYPE,EVENT_NARRATIVE\n"
           "9,FL,MIAMI,01/02/2020,1,Hail,\"a\nb\"\n3,FL,MIAMI,01/02/2020,2,Hail,later\n")
    assert set(jobs.raw_to_silver(spark, raw, out)) == {"base_2", "base_9", "base_disaster"}
    assert spark.read.parquet(f"{out}/base_9").first().A == "1"
    b = sorted((str(r.date), r.city) for r in spark.read.parquet(f"{out}/base_2/daily").collect())
    assert b == [("2020-02-13", None), ("2020-02-14", None), ("2020-02-15", None)]
    s = spark.read.parquet(f"{out}/base_disaster").collect()
    assert [(str(r.date), r.eventType, r.city) for r in s] == [("2020-01-02", "Hail", "miami")]


def test_reports_of_unknown_cities_repeat_inside_their_file(spark, tmp_path):
    from stormlake.plans import jobs
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    head = "EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE,EVENT_NARRATIVE\n"
    for name, row in (("boston", 1), ("seattle", 2)):
        _write(f"{raw}/base_disaster/{name}_storms.csv", f"{head}{row},{name.upper()},2020-01-02,Tornado,x\n{row + 10},{name.upper()},2020-01-02,Tornado,later\n")
    for name, row in (("a", 3), ("b", 4)):  # two files of one city: the first by path and place
        _write(f"{raw}/base_disaster/dallas_{name}.csv", f"{head}{row},DALLAS,2020-01-02,Tornado,x\n")
    jobs.raw_to_silver(spark, raw, out)
    got = sorted((r.file, r.city, r.eventType) for r in spark.read.parquet(f"{out}/base_disaster").collect())
    assert got == [("boston_storms", None, "Tornado"), ("dallas_a", "dallas", "Tornado"), ("seattle_storms", None, "Tornado")]


def test_headers_of_any_length(spark, tmp_path):
    names = [f"column_with_a_long_name_{i:05d}" for i in range(4000)]  # 124 kB
    _write(str(tmp_path / "wide" / "miami.csv"), ",".join(names) + "\n" + "\n".join(",".join(str(k) for _ in names) for k in range(3)) + "\n")
    df = read_csv_lenient(spark, str(tmp_path / "wide"), [names[0], names[-1]], [names[-1]])
    assert sorted((r[names[0]], r[names[-1]]) for r in df.collect()) == [("0", 0.0), ("1", 1.0), ("2", 2.0)]


def test_first_record_in_pieces():
    from stormlake.sources.files import _first_record
    text = b'\xef\xbb\xbfa,"b\n""c""",d\r\n1,2,3\n'
    for size in (1, 2, 7, 100):
        read = []
        pieces = (read.append(i) or text[i:i + size] for i in range(0, len(text), size))
        assert _first_record(pieces) == ["a", 'b\n"c"', "d"]
        assert max(read) <= text.index(b"\r\n")  # reads no further than the record's end
    assert _first_record(iter([])) == []


def test_headers_by_the_stores_client(spark, tmp_path):
    from stormlake.sources.files import _headers_by_client, csv_headers, headers_by_kind
    _write(str(tmp_path / "h" / "a b%20c_daily.csv"), "x, y\n1,2\n")
    _write(str(tmp_path / "h" / "sub" / "d.CSV"), "x, y\n1,2\n")
    _write(str(tmp_path / "h" / "empty.csv"), "")
    found = csv_headers(spark, str(tmp_path / "h"))
    assert list(found) == [("x", "y")] and len(found["x", "y"]) == 2
    assert _headers_by_client(spark, found["x", "y"]) == {p: ["x", "y"] for p in found["x", "y"]}
    assert {k: len(v["x", "y"]) for k, v in headers_by_kind(found).items()} == {"daily": 1, "hourly": 1}
    assert read_csv_lenient(spark, str(tmp_path / "h")).count() == 2


def test_first_report_and_row_numbers_for_any_split_size(spark, tmp_path):
    from pyspark.sql import functions as F
    from stormlake.operators.window import first_per_key
    from stormlake.sources.files import with_file_ordinals
    for name in ("dallas_a", "dallas_b", "boston"):
        _write(str(tmp_path / "s" / f"{name}.csv"), "id,key\n" + "".join(f"{i},{i % 7}\n" for i in range(3000)))
    found = []
    for size in ("1k", "5k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = read_csv_lenient(spark, str(tmp_path / "s"))
            rows = with_file_ordinals(df, "n").select("file", "id", "n").collect()
            assert len(rows) == 9000 and all(int(r.id) == r.n for r in rows)
            first = first_per_key(df.withColumn("o", F.col("row_order")), ["city", "key"], "o")
            found.append(sorted((r.city or "", r.file, r.id) for r in first.select("city", "file", "id").collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] == found[2]
    assert found[0] == sorted([("", "boston", str(k)) for k in range(7)] + [("dallas", "dallas_a", str(k)) for k in range(7)])


def test_job_with_a_column_map_from_its_file(spark, tmp_path):
    from stormlake.plans import jobs
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    _write(f"{raw}/base_disaster/miami_storms.csv", "EVENT_ID,CZ_NAME_STR,BEGIN_DATE,EVENT_TYPE\n1,MIAMI,2020-01-02,Hail\n")
    mapping = {"base_disaster": {"CZ_NAME_STR": "place", "BEGIN_DATE": "date", "EVENT_TYPE": "eventType"}}
    dump_json(mapping, str(tmp_path / "m.json"))
    jobs.raw_to_silver(spark, raw, out, str(tmp_path / "m.json"))
    assert [(r.place, r.eventType) for r in spark.read.parquet(f"{out}/base_disaster").collect()] == [("MIAMI", "Hail")]
