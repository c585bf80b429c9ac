"""Readers, sinks, layers and the whole pipeline on a few files."""

import contextlib
import json
import sqlite3
import zipfile
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from velograph.functions.geometry import from_wkb
from velograph.params import Params
from velograph.plans import run, tools
from velograph.plans.run import build, main
from velograph.sources import layers, readers, sinks

HEAD = "GPS,GPS_HEIGHT,GPS_LAT,GPS_LON,GPS_SPEED,GPS_TIME,DIN,ZAPLON,SYGNALIZACJA_SWIETLNA,SYGNALIZACJA_DZWIEKOWA,ETL_CZAS"


def line(gps, lat, lon, speed, at):
    return f"{gps},200,{lat},{lon},{speed},{at},0,0,1,0,"


def weather_file(path: Path, start="2022-01-01T00:00", hours=48, **change):
    import datetime as d

    t0 = d.datetime.fromisoformat(start)
    hourly = {"time": [(t0 + d.timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(hours)]} | {c: [0.0] * hours for c in readers.HOURLY}
    path.write_text(json.dumps({"latitude": 50.0, "longitude": 20.0, "elevation": 200.0, "hourly": hourly | change}))
    return str(path)


def test_batches_and_discovery(tmp_path):
    assert readers.in_batches([("a", 4), ("b", 4), ("c", 9), ("d", 1)], 8) == [["a", "b"], ["c"], ["d"]]
    (tmp_path / "x").mkdir()
    for n in ("b.csv", "x/a.CSV", "._b.csv", "c.txt"):
        (tmp_path / n).write_text("")
    assert [p.name for p in readers.find_csv(tmp_path)] == ["b.csv", "a.CSV"]


def test_archives_stay_inside(tmp_path):
    (tmp_path / "z").mkdir()
    with zipfile.ZipFile(tmp_path / "z" / "a.zip", "w") as z:
        z.writestr("ok.csv", "x" * 60)
        z.writestr("tiny.csv", "x")
    assert [p.name for p in readers.extract_archives(tmp_path / "z", tmp_path / "out")] == ["ok.csv"]
    with zipfile.ZipFile(tmp_path / "z" / "b.zip", "w") as z:
        z.writestr("../bad.csv", "x" * 60)
    with pytest.raises(ValueError):
        readers.extract_archives(tmp_path / "z", tmp_path / "out2")


def test_weather_gaps_are_errors(spark, tmp_path):
    good = readers.read_weather(spark, weather_file(tmp_path / "w.json"), "m")
    assert good.count() == 48 and good.select("weather_category").distinct().first()[0] == "NO_RECORDED_PRECIPITATION"
    with pytest.raises(ValueError):
        readers.read_weather(spark, weather_file(tmp_path / "v.json", hours=2, time=["2022-01-01T00:00", "2022-01-01T02:00"]), "m")
    with pytest.raises(ValueError):
        readers.read_weather(spark, weather_file(tmp_path / "u.json", rain=[0.0]), "m")


def test_corrupt_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEAD, line(1, 50.0, 20.0, 100, "2022-01-01 10:00:00"), "x,y,z"]))
    rows = readers.read_telemetry(spark, str(tmp_path)).cache()
    assert rows.count() == 2 and rows.filter("_corrupt_record is not null").count() == 1
    # a narrow query sees them, too
    narrow = readers.read_telemetry(spark, str(tmp_path)).select("DIN", "_corrupt_record")
    assert sorted(r[1] is None for r in narrow.collect()) == [False, True]


def test_sorted_files_are_one_file_in_order_sorted_by_many_tasks(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), F.encode(F.col("id").cast("string"), "UTF-8").alias("raw"), F.when(F.col("id") % 3 > 0, F.lit(0.5)).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that small ranges aren't merged
    try:
        assert sinks.write_sorted(rows.repartition(6), f"{tmp_path}/t.parquet", ["id"], csv=True, metadata={"k": "v"}) == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    (one,) = (tmp_path / "t.parquet").iterdir()
    table = pq.read_table(one)
    assert table["id"].to_pylist() == list(range(5000)) and table.schema.metadata[b"k"] == b"v" and not (tmp_path / "t.parquet.parts").exists()
    assert sinks.csv_twin_failures(spark, str(tmp_path), "t") == [] and spark.read.parquet(f"{tmp_path}/t.parquet").count() == 5000
    assert sinks.write_sorted(rows.filter("false"), f"{tmp_path}/e.parquet", ["id"], csv=True) == 0 and spark.read.parquet(f"{tmp_path}/e.parquet").columns == ["id", "raw", "v"]


def test_spatial_parquet_says_what_it_holds(spark, tmp_path):
    rows = spark.sql("SELECT 'b' AS road_feature_id, array(named_struct('x', 19.5D, 'y', 50D), named_struct('x', 20D, 'y', 50.5D)) AS line UNION ALL SELECT 'a', array(named_struct('x', 19D, 'y', 51D), named_struct('x', 19.2D, 'y', 51D))")
    assert sinks.write_geoparquet(rows, f"{tmp_path}/g.parquet", ["road_feature_id"]) == 2
    (one,) = (tmp_path / "g.parquet").iterdir()
    table = pq.read_table(one)
    geo = json.loads(table.schema.metadata[b"geo"])
    assert geo["columns"]["geometry"] == {"encoding": "WKB", "geometry_types": ["LineString"], "bbox": [19.0, 50.0, 20.0, 51.0]} and table["road_feature_id"].to_pylist() == ["a", "b"]
    back = spark.read.parquet(f"{tmp_path}/g.parquet").select(from_wkb("geometry").alias("line")).collect()
    assert [tuple(v) for v in back[1]["line"]] == [(19.5, 50.0), (20.0, 50.5)]


def test_geopackage_holds_layers_and_tables(spark, tmp_path):
    rows = spark.sql("SELECT 'b' AS road_feature_id, array(named_struct('x', 19.5D, 'y', 50D), named_struct('x', 20D, 'y', 50.5D)) AS line")
    sinks.write_geopackage({"roads": rows}, {"season": spark.sql("SELECT 'b' AS road_feature_id, 3L AS n")}, tmp_path / "a.gpkg", "road_feature_id")
    with contextlib.closing(sqlite3.connect(tmp_path / "a.gpkg")) as db:
        assert db.execute("PRAGMA application_id").fetchone()[0] == 0x47504B47
        assert db.execute("SELECT table_name, data_type, min_x, max_y, srs_id FROM gpkg_contents ORDER BY 1").fetchall() == [("roads", "features", 19.5, 50.5, 4326), ("season", "attributes", None, None, None)]
        assert db.execute("SELECT fid, n FROM season").fetchall() == [(1, 3)]
        (blob,) = db.execute("SELECT geom FROM roads").fetchone()
        assert blob[:8] == b"GP\x00\x01\xe6\x10\x00\x00" and len(blob) == 8 + 9 + 32
        assert {r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'index' AND sql IS NOT NULL")} == {"roads_road_feature_id", "season_road_feature_id"}
    back = spark.createDataFrame([(bytearray(blob[8:]),)], "geometry binary").select(from_wkb("geometry")).first()[0]
    assert [tuple(v) for v in back] == [(19.5, 50.0), (20.0, 50.5)]


def test_partitions_are_split_by_size_and_replaced_alone(spark, tmp_path):
    rows = spark.range(20000).select((F.col("id") % 2).alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        sinks.write_partitions(rows.repartition(8), f"{tmp_path}/p", "year")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "p" / "year=0").glob("*.parquet"))) > 1
    sinks.write_partitions(rows.filter("year = 1").limit(5), f"{tmp_path}/p", "year")
    assert {r["year"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/p").groupBy("year").count().collect()} == {0: 10000, 1: 5}


def test_json_package_and_database(spark, tmp_path):
    sinks.write_json(tmp_path / "a.json", {"b": float("nan"), "a": (1, 2)})
    assert json.loads((tmp_path / "a.json").read_text()) == {"a": [1, 2], "b": None}
    sinks.write_attribute_database({"t": spark.sql("SELECT 1 AS road_feature_id, 'x' AS n, date'2022-01-01' AS d")}, tmp_path / "a.db", "road_feature_id")
    out = sinks.build_package({"data/a.json": tmp_path / "a.json"}, tmp_path / "pkg", {"title": "T", "version": "1", "authors": ["A"]}, "# {{TITLE}} {{VERSION}}\n")
    assert sinks.checksum_failures(out, required=True) == [] and (out / "README.md").read_text() == "# T 1\n"
    (out / "extra").write_text("x")
    assert sinks.checksum_failures(out) == ["not listed: extra"]
    with pytest.raises(FileExistsError):
        sinks.build_package({}, tmp_path / "pkg", {"title": "T", "version": "1", "authors": ["A"]}, "")


def test_layers_notice_change_and_swap_back(tmp_path):
    root = tmp_path / "layer"
    root.mkdir()
    (root / "f").write_text("1")
    layers.finish_step(root, "gold", "s", ["f"], "k")
    layers.finish_layer(root, "gold", "k", ["f"])
    assert layers.step_is_done(root, "gold", "s", "k") and layers.layer_is_done(root, "gold", "k", ["f"]) and not layers.layer_is_done(root, "gold", "other")
    (root / "f").write_text("22")
    assert not layers.step_is_done(root, "gold", "s", "k") and not layers.layer_is_done(root, "gold", "k")
    (tmp_path / "stage" / "n").mkdir(parents=True)
    (tmp_path / "stage" / "n" / "g").write_text("x")
    layers.swap_in(tmp_path / "stage" / "n", root, tmp_path / "stage")
    assert [p.name for p in root.iterdir()] == ["g"]
    with pytest.raises(ValueError):
        layers.swap_in(root, tmp_path / "q", tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        layers.swap_in(tmp_path / "stage" / "gone", root, tmp_path / "stage")


def test_whole_pipeline(spark, tmp_path):
    csv = tmp_path / "csv"
    csv.mkdir()
    rows = [line(7, 50.0647, 19.945 + i * 2e-5, 1000 + i, f"2022-01-01 10:00:{i:02d}") for i in range(30)]
    (csv / "a.csv").write_text("\n".join([HEAD, *rows, rows[0], line(7, 0, 20, 1, "2022-01-01 10:00:00"), line("", 50.0, 20.0, 1, "2022-01-01 10:00:00")]))
    (csv / "b.csv").write_text("\n".join([HEAD, rows[0], line(7, 40.0, 20.0, 1, "2030-01-01 10:00:00")]))
    roads = spark.sql("SELECT 11L AS osm_id, cast(null as string) AS name, 'primary' AS highway, '40' AS maxspeed, 'yes' AS oneway, 'LINESTRING (19.944 50.0647, 19.946 50.0647)' AS wkt")
    roads.write.parquet(str(tmp_path / "roads"))
    counts = build(spark, csv, str(tmp_path / "roads"), weather_file(tmp_path / "w.json"), tmp_path / "out", Params())
    assert (counts["raw_rows"], counts["invalid_coordinate_rows"], counts["missing_identifier_rows"], counts["outside_period_rows"]) == (35, 1, 1, 1)
    assert spark.read.parquet(str(tmp_path / "out/bronze/points")).count() == 30
    silver = spark.read.parquet(str(tmp_path / "out/silver/points"))
    assert silver.count() == 30 and silver.filter("within_primary_match_radius and travel_direction = 'FORWARD'").count() == 29
    season = spark.read.parquet(str(tmp_path / "out/gold/season.parquet"))
    assert season.agg(F.sum("n_samples")).first()[0] == 30 and sinks.csv_twin_failures(spark, str(tmp_path / "out/gold"), "season") == []
    flat = spark.read.parquet(str(tmp_path / "out/gold/flat.parquet")).first()
    assert flat["name"] == "Unnamed road (primary)" and flat["operating_speed_reference_kmh"] == 40 and flat["road_length_m"] == pytest.approx(143.2, abs=0.5)
    before = layers.layer_marker(tmp_path / "out/gold")
    build(spark, csv, str(tmp_path / "roads"), str(tmp_path / "w.json"), tmp_path / "out", Params())
    assert layers.layer_marker(tmp_path / "out/gold") == before
    assert main(["--csv", "x", "--roads", "x", "--weather", "x", "--out", "x", "--params", '{"max_gap": 0}']) == 2
    # what the run was made with, and checks of what it made
    manifest = json.loads((tmp_path / "out/reports/run.json").read_text())
    assert manifest["fingerprint"] == Params().fingerprint() and manifest["stages"] == ["bronze", "silver", "gold"] and manifest["packages"]["pyspark"]
    assert run.recorded_radii(tmp_path / "out", Params(radii=(1.0, 2.0, 3.0), primary_radius=1.0)) == (15.0, 40.0, "run manifest")
    assert run.recorded_radii(tmp_path / "none", Params()) == (15.0, 40.0, "parameters")
    assert tools.main(["validate", "--gold", str(tmp_path / "out/gold"), "--report", str(tmp_path / "report.json")], spark) == 0
    report = json.loads((tmp_path / "report.json").read_text())
    assert report["failures"] == [] and {t["table"]: t["n_samples"] for t in report["tables"]} == dict.fromkeys(("season", "month", "weekday", "time_of_day", "flat"), 30)
    metrics, found = tools.matches(spark, tmp_path / "out", Params(), 10)
    assert found["rows"] == 10 and {r["metric"]: r["value"] for r in metrics.collect()}["violations_total"] == 0.0
    (tmp_path / "meta.json").write_text(json.dumps({"title": "T", "version": "1", "authors": ["A"]}))
    (tmp_path / "readme.md").write_text("# {{TITLE}}")
    assert tools.main(["package", "--gold", str(tmp_path / "out/gold"), "--output", str(tmp_path / "pkg"), "--metadata", str(tmp_path / "meta.json"), "--readme", str(tmp_path / "readme.md")]) == 0
    assert sinks.checksum_failures(tmp_path / "pkg", required=True) == [] and (tmp_path / "pkg/flat.parquet").is_dir()
    # planted faults are found
    bad = spark.read.parquet(str(tmp_path / "out/gold/season.parquet")).withColumns({"season": F.lit("SPRINGTIME"), "road_feature_id": F.lit("nowhere")})
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    sinks.write_sorted(bad, str(tmp_path / "out/gold/season.parquet"), ["road_feature_id"])
    failures, _ = tools.validate(spark, str(tmp_path / "out/gold"), Params())
    assert any("SPRINGTIME" in f for f in failures) and any("orphans" in f for f in failures)


def test_a_broken_off_run_goes_on_after_its_last_batch(spark, tmp_path, monkeypatch):
    csv = tmp_path / "csv"
    csv.mkdir()
    for n, day in (("a", 1), ("b", 2), ("c", 3)):
        (csv / f"{n}.csv").write_text("\n".join([HEAD, *[line(7, 50.0647, 19.945, 1000 + i, f"2022-01-0{day} 10:00:{i:02d}") for i in range(5)], line(7, 50.0, 20.0, 5, "2022-01-01 12:00:00")]))
    files, read, real = readers.find_csv(csv), [], run.read_telemetry

    def breaks_at_c(spark, names):
        read.append([Path(n).name for n in names])
        if read[-1] == ["c.csv"] and len(read) < 4:
            raise ValueError("broken off")
        return real(spark, names)

    monkeypatch.setattr(run, "read_telemetry", breaks_at_c)
    with pytest.raises(ValueError, match="broken off"):
        run.build_bronze(spark, files, tmp_path / "stage", Params(), 1)
    rows, counts, key = run.build_bronze(spark, files, tmp_path / "stage", Params(), 1)
    assert read == [["a.csv"], ["b.csv"], ["c.csv"], ["c.csv"]]
    assert rows.count() == 16 and counts["raw_rows"] == 18 and {r["source_file"].rsplit("/")[-1] for r in rows.filter("GPS_SPEED = 5").collect()} == {"a.csv"}
    # all batches have ended: they can be published without the files, but not under other parameters
    again, same, key_again = run.build_bronze(spark, [], tmp_path / "stage", Params(), 1)
    assert again.count() == 16 and same == counts and key_again == key == layers.inputs_key(Params().fingerprint(), files)
    with pytest.raises(FileNotFoundError):
        run.build_bronze(spark, [], tmp_path / "stage", Params(max_gap=31), 1)


def test_stale_layers_and_stray_files_are_noticed(tmp_path):
    (tmp_path / "silver").mkdir()
    (tmp_path / "silver" / "f").write_text("1")
    assert not layers.is_stale(tmp_path / "silver", "a")
    layers.finish_layer(tmp_path / "silver", "silver", "a", ["f"])
    assert layers.is_stale(tmp_path / "silver", "b") and not layers.is_stale(tmp_path / "silver", "a")
    for n in ("._f", ".DS_Store", "_SUCCESS"):
        (tmp_path / "silver" / n).write_text("")
    assert layers.drop_strays(tmp_path) == 2 and (tmp_path / "silver" / "_SUCCESS").exists() and layers.layer_is_done(tmp_path / "silver", "silver", "a")
    assert layers.is_sidecar("x/.f.crc") and layers.is_sidecar("_complete.json") and not layers.is_sidecar("flat.parquet")
