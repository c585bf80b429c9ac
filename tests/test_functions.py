"""Scalar operators on literal rows."""

import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velograph.functions import geometry as g
from velograph.functions import roads as tags
from velograph.functions import telemetry as t
from velograph.functions import weather
from velograph.functions.timeparts import calendar, resolve_timestamps
from velograph.params import Params

P = Params()


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_maxspeed_table(spark):
    rows = [("50",), ("30 mph",), ("PL:living_street",), (None,), ("none",), ("7.5mph",), ("nan",), ("",)]
    got = values(spark, rows, "v string", tags.maxspeed(F.col("v"), F.lit("x"), P.default_speeds)["value_kmh"], tags.maxspeed(F.col("v"), F.lit("x"), P.default_speeds)["source"])
    assert [x[0] for x in got] == [50, 48, 20, 50, 50, 12, 50, 50]
    assert [x[1] for x in got[3:5]] == ["IMPUTED_HIGHWAY_DEFAULT", "IMPUTED_UNPARSEABLE_TAG"]


def test_angles(spark):
    rad = math.radians
    got = values(spark, [(rad(359), rad(1)), (0.0, math.pi)], "a double, b double", g.circular_difference(F.col("a"), F.col("b")), g.undirected(g.circular_difference(F.col("a"), F.col("b"))))
    assert got[0][0] == pytest.approx(rad(2)) and got[1] == pytest.approx((math.pi, 0.0))


def test_other_tag_with_commas_and_escapes(spark):
    text = '"note"=>"a, \\"oneway\\"=>\\"no\\"","oneway"=>"yes"'
    assert values(spark, [(text,), (None,), ("",)], "t string", tags.other_tag(F.col("t"), "oneway")) == [("yes",), (None,), (None,)]
    assert values(spark, [(text,)], "t string", tags.other_tag(F.col("t"), "note")) == [('a, "oneway"=>"no"',)]


def test_weather_categories(spark):
    rows = [(0, 0.0, 0.0), (61, 0.0, 0.0), (71, 0.0, 0.0), (45, 0.0, 0.0), (None, None, None), (10, 0.0, 0.0), (0, 0.2, 0.0)]
    got = [x[0].split("_")[0] for x in values(spark, rows, "c int, p double, s double", weather.category(F.col("c"), F.col("p"), F.col("s")))]
    assert got == ["NO", "RAIN", "SNOWFALL", "FOG", "UNKNOWN", "OTHER", "RAIN"]


def test_speed_outcomes(spark):
    rows = [(0.0,), (None,), (float("nan"),), (-1.0,), (float("inf"),)]
    got = [x[0] for x in values(spark, rows, "v double", t.speed_outcome(F.col("v")))]
    assert got == ["USABLE_GPS_SPEED_CM_PER_S", "GPS_SPEED_MISSING", "GPS_SPEED_NON_FINITE", "GPS_SPEED_NEGATIVE", "GPS_SPEED_NON_FINITE"]


def test_timestamps_survive_garbage(spark):
    rows = [("2022-06-01 10:00:00", "2022-06-01 12:00:10"), ("garbage", "2022-01-01 01:00:00"), (None, None)]
    got = resolve_timestamps(spark.createDataFrame(rows, "GPS_TIME string, ETL_CZAS string"), P).select("timestamp_source", "timestamp_disagreement_sec", F.date_format("timestamp_utc", "HH:mm:ss")).collect()
    assert [tuple(r) for r in got] == [("GPS_TIME_UTC", 10, "10:00:00"), ("ETL_CZAS_LOCAL_FALLBACK", None, "00:00:00"), ("MISSING_OR_INVALID", None, None)]


def test_calendar_week_begins_on_monday(spark):
    df = calendar(spark.sql("SELECT timestamp'2022-12-04 23:00:00' AS timestamp_local"))
    assert tuple(df.select("day_of_week_iso", "is_weekend", "quarter", "season").first()) == (7, True, "Q4", "WINTER")


def test_swapped_pair_is_flagged_though_valid(spark):
    got = values(spark, [(20.0, 50.0), (50.0, 20.0)], "lat double, lon double", t.swapped_suspect(F.col("lat"), F.col("lon"), P.study_box), t.reject_reason(F.col("lat"), F.col("lon"), P.study_box))
    assert got == [(True, None), (False, None)]


def test_projection_of_a_known_place(spark):
    e, n = g.project(F.lit(19.9450), F.lit(50.0647))
    got = spark.range(1).select(e.alias("e"), n.alias("n")).first()
    assert got["e"] == pytest.approx(567613.619, abs=1e-3) and got["n"] == pytest.approx(244587.531, abs=1e-3)


def test_clipping_cuts_and_splits(spark):
    line = "array(named_struct('x', -5d, 'y', 5d), named_struct('x', 5d, 'y', 5d), named_struct('x', 5d, 'y', 20d), named_struct('x', 8d, 'y', 20d), named_struct('x', 8d, 'y', 5d))"
    got = g.clip_polylines(spark.sql(f"SELECT 'r' AS road_feature_id, {line} AS line"), (0.0, 0.0, 10.0, 10.0)).orderBy("part").collect()
    assert [[tuple(v) for v in r["line"]] for r in got] == [[(0.0, 5.0), (5.0, 5.0), (5.0, 10.0)], [(8.0, 10.0), (8.0, 5.0)]]


def test_wkt_of_other_kinds_is_null(spark):
    assert values(spark, [("POINT (1 2)",), ("linestring(1 2, 3 4)",), (None,)], "w string", g.to_wkt(g.from_wkt(F.col("w")))) == [(None,), ("LINESTRING (1.0 2.0, 3.0 4.0)",), (None,)]


@given(st.fixed_dictionaries({"radii": st.tuples(st.floats(1, 10), st.floats(11, 20), st.floats(21, 30)), "max_gap": st.integers(1, 99)}))
def test_fingerprint_follows_every_parameter(changes):
    changes["primary_radius"] = changes["radii"][0]
    a = Params(**changes)
    assert a.fingerprint() == Params(**changes).fingerprint() != Params(**(changes | {"running_above": 3.0})).fingerprint()


@pytest.mark.parametrize("bad", [{"radii": (3.0, 2.0, 1.0)}, {"speed_source": "x"}, {"study_box": (0.0, 0.0, 1.0, 1.0)}, {"max_gap": 0}, {"period": ("2022-01-02", "2022-01-01")}])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        Params(**bad)
