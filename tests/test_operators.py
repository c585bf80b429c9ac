"""Operators on small tables, against brute force where there is one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from velograph.operators import enrich, identity, kinematics, matching, profiles, reports
from velograph.params import Params

P = Params()
SEGMENT = "match_segment_id string, road_feature_id string, x1 double, y1 double, x2 double, y2 double, road_azimuth double, oneway boolean"


def distance(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    q = dx * dx + dy * dy
    u = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / q)) if q else 0.0
    return math.hypot(px - x1 - u * dx, py - y1 - u * dy)


@pytest.mark.parametrize("cell", [7.0, 100.0])
def test_grid_join_equals_brute_force(spark, cell):
    r = random.Random(5)
    pts = [(i, r.uniform(-200, 200), r.uniform(-200, 200)) for i in range(120)]
    segs = [(f"s{i}", f"r{i % 9}", *(r.uniform(-200, 200) for _ in range(4)), 0.0, False) for i in range(40)]
    got = matching.grid_join(spark.createDataFrame(pts, "point_id long, x double, y double"), spark.createDataFrame(segs, SEGMENT), 25.0, cell)
    want = {(p[0], s[0]) for p in pts for s in segs if distance(p[1], p[2], *s[2:6]) <= 25.0}
    rows = [tuple(x) for x in got.select("point_id", "match_segment_id").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def track(spark, rows):
    return spark.createDataFrame(rows, "source_entity_id string, point_id string, t string, x double, y double, GPS_SPEED double").withColumn("timestamp_utc", F.col("t").cast("timestamp")).drop("t")


def test_speeds_and_chunks(spark):
    rows = [("a", "p1", "2022-03-31 23:59:50", 0.0, 0.0, 3333.0), ("a", "p2", "2022-04-01 00:00:00", 0.0, 50.0, -1.0), ("a", "p3", "2022-04-01 00:02:00", 0.0, 60.0, 0.0), ("b", "p4", "2022-04-01 00:00:00", 5.0, 5.0, None)]
    whole = {r["point_id"]: r for r in kinematics.derive(track(spark, rows), P).collect()}
    assert whole["p1"]["calc_speed_kmh"] == pytest.approx(119.988) and whole["p2"]["calc_speed_kmh"] is None
    assert whole["p2"]["displacement_speed_kmh"] == pytest.approx(18.0) and whole["p2"]["traj_azimuth"] == 0.0
    q = Params(speed_source="displacement")
    reasons = {r["point_id"]: r["speed_derivation_reason"] for r in kinematics.derive(track(spark, rows), q).collect()}
    assert reasons == {"p1": "FIRST_POINT_FOR_SOURCE", "p2": "USABLE_DISPLACEMENT_INTERVAL", "p3": "GAP_EXCEEDS_MAX", "p4": "FIRST_POINT_FOR_SOURCE"}
    a, b = kinematics.derive_chunks([track(spark, rows[:1]), track(spark, rows[1:])], q)
    assert {r["point_id"]: r["speed_derivation_reason"] for r in a.unionByName(b).collect()} == reasons


def test_primary_radius_comes_first(spark):
    segs = spark.createDataFrame([("s1", "far", 0.0, 20.0, 100.0, 20.0, math.pi / 2, False), ("s2", "near", 0.0, -14.0, 0.0, -114.0, math.pi, True)], SEGMENT)
    pts = spark.createDataFrame([("p", 0.0, 0.0, math.pi / 2, 30.0)], "point_id string, x double, y double, traj_azimuth double, calc_speed_kmh double")
    got = matching.match(pts, segs, P).first()
    assert got["road_feature_id"] == "near" and got["within_primary_match_radius"] and got["candidate_count"] == 1
    assert got["match_radius_tier"] == "LE_15_M" and got["dist_margin_m"] is None and got["candidate_count_radius_3"] == 2


def test_unmatched_points_are_counted(spark):
    segs = spark.createDataFrame([("s1", "r", 0.0, 0.0, 100.0, 0.0, 0.0, False)], SEGMENT)
    pts = spark.createDataFrame([(i, 50.0, y) for i, y in enumerate((10.0, 60.0, 140.0, 900.0))], "point_id long, x double, y double")
    got = {r["distance_bucket"]: r["unmatched_point_count"] for r in matching.unmatched_summary(pts, segs, P, keys=()).collect()}
    assert got == {"GT_40_LE_75_M": 1, "GT_75_LE_150_M": 1, "GT_150_M_OR_NO_CANDIDATE": 1}


def test_dedup_does_not_depend_on_order(spark):
    rows = [("k1", "b", 1), ("k1", "a", 2), ("k1", "a", 1), ("k2", "c", None)]
    for part in (rows, rows[::-1]):
        got = identity.dedup_least(spark.createDataFrame(part, "id string, source_file string, v int"), "id", "source_file")
        assert sorted(map(tuple, got.collect())) == [("k1", "a", 1), ("k2", "c", None)]


def test_profile_of_two_speeds(spark):
    rows = [("r", 15, "x", "p1", "s", 0.0, "g"), ("r", 15, "x", "p2", "s", 20.0, "g")]
    df = spark.createDataFrame(rows, "road_feature_id string, operating_speed_reference_kmh int, operating_speed_reference_source string, point_id string, source_entity_id string, calc_speed_kmh double, speed_source string")
    df = df.withColumn("observation_date", F.expr("date'2022-01-01' + int(right(point_id, 1))"))
    got = profiles.profile(df, ("road_feature_id", "operating_speed_reference_kmh"), P).first()
    assert (got["n_samples"], got["n_unique_source_ids"], got["n_unique_observation_days"]) == (2, 1, 2)
    assert (got["avg_travel_speed_kmh"], got["avg_running_speed_kmh"], got["stopped_observation_ratio"], got["delta_operating_speed_reference_kmh"]) == (10.0, 20.0, 0.5, -5.0)


def test_outliers_need_support(spark):
    rows = [("r", float(v)) for v in [10] * 12 + [12] * 12 + [90]] + [("q", 1.0), ("q", 500.0)]
    df = spark.createDataFrame(rows, "road_feature_id string, calc_speed_kmh double")
    got = enrich.flag_outliers(df, enrich.group_speed_stats(df), P).filter("is_high_speed_iqr_outlier").collect()
    assert [(r["road_feature_id"], r["calc_speed_kmh"]) for r in got] == [("r", 90.0)]


def test_bottom_k_keeps_least_ids(spark):
    df = spark.createDataFrame([(x, "m") for x in ("f0", "0a", "10", "0a", None)], "point_id string, highway string")
    assert sorted(r["point_id"] for r in reports.bottom_k(df, 3, ("highway",), "point_id").collect()) == ["0a", "0a", "10"]


def test_checks_find_each_fault(spark):
    base = {"road_feature_id": "r", "season": "SUMMER", "avg_travel_speed_kmh": 20.0, "operating_speed_reference_kmh": 50, "n_samples": 12, "n_unique_source_ids": 2, "n_unique_observation_days": 3, "stopped_observation_ratio": 0.1, "meets_min_sample_count": True, "delta_operating_speed_reference_kmh": -30.0}
    schema = "road_feature_id string, season string, avg_travel_speed_kmh double, operating_speed_reference_kmh int, n_samples long, n_unique_source_ids long, n_unique_observation_days long, stopped_observation_ratio double, meets_min_sample_count boolean, delta_operating_speed_reference_kmh double"
    check = lambda *rows: reports.structural_violations(spark.createDataFrame([tuple(r.values()) for r in rows], schema), P, ("road_feature_id", "season")).first().asDict()
    assert sum(check(base).values()) == 0
    for change, name in (({"delta_operating_speed_reference_kmh": -29.0}, "delta_mismatch"), ({"n_unique_source_ids": 13}, "sources_exceed_samples"), ({"stopped_observation_ratio": 1.1}, "ratio_out_of_range"), ({"meets_min_sample_count": False}, "support_flag_mismatch")):
        assert {k for k, v in check(base | change).items() if v} == {name}
    assert check(base, base)["repeated_keys"] == 1
    vocabulary = reports.unexpected_values(spark.createDataFrame([("SUNNY",)], "weather_category string"), {"weather_category": ("FOG",)}).collect()
    assert [(r["column"], r["values"]) for r in vocabulary] == [("weather_category", ["SUNNY"])]


def test_labels_are_refused_if_they_repeat_or_cannot_be_read(spark):
    sample = spark.createDataFrame([("a",), ("b",)], "point_id string")
    labels = lambda *rows: spark.createDataFrame(rows, "point_id string, correct string")
    assert tuple(reports.label_accuracy(sample, labels(("a", "Yes"), ("b", "0")), "point_id", "correct").first()) == (2, 0.5)
    for bad in (labels(("a", "1"), ("a", "1")), labels(("a", "maybe"))):
        with pytest.raises(ValueError):
            reports.label_accuracy(sample, bad, "point_id", "correct")
