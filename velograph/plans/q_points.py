"""Telemetry, kinematics, geometry, matching, weather and tags over points and segments."""

from __future__ import annotations

import math
from pyspark.sql import functions as F

from velograph.functions import geometry as g
from velograph.functions import roads as tags
from velograph.functions import telemetry as t
from velograph.functions.timeparts import calendar, day_name, hour_bucket, month_name, resolve_timestamps, season, time_of_day
from velograph.functions.weather import category
from velograph.operators import enrich, identity, kinematics, matching, reports
from velograph.params import Params
from velograph.plans.standins import POINTS_SQL, SEGMENTS_SQL, points, segments, table

P = Params()
QUERIES, ORACLES = {}, {}


def add(name, sql=None):
    def hold(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return hold


# --- timestamps and labels ------------------------------------------------------------------------------------------------

_RAW = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'garbage' WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS gps,
CASE WHEN event_id % 11 = 0 THEN NULL ELSE strftime(ts + to_minutes((event_id % 20)::INT), '%Y-%m-%d %H:%M:%S') END AS etl, date_trunc('second', ts) AS ts FROM events"""


def raw_timestamps(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("u", F.col("ts").cast("timestamp"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    later = F.timestamp_seconds(F.unix_timestamp("u") + (F.col("event_id") % 20) * 60)
    return e.select("event_id", F.when(F.col("event_id") % 7 == 0, "garbage").when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(text(F.col("u"))).alias("GPS_TIME"), F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(text(later)).alias("ETL_CZAS"))


@add("timestamp_resolution", f"""WITH r AS ({_RAW}), x AS (SELECT event_id, CASE WHEN gps <> 'garbage' THEN epoch(ts)::BIGINT END AS a, CASE WHEN etl IS NOT NULL THEN epoch(ts)::BIGINT + (event_id % 20) * 60 END AS b FROM r)
SELECT event_id, coalesce(a, b) AS chosen, CASE WHEN a IS NOT NULL THEN 'GPS_TIME_UTC' WHEN b IS NOT NULL THEN 'ETL_CZAS_LOCAL_FALLBACK' ELSE 'MISSING_OR_INVALID' END AS timestamp_source,
abs(a - b) AS timestamp_disagreement_sec, abs(a - b) > 300 AS timestamp_sources_disagree FROM x""")
def timestamp_resolution(spark, sf_dir):
    """Local time is UTC here, so that both engines share one zone."""
    df = resolve_timestamps(raw_timestamps(spark, sf_dir), Params(local_zone="UTC"))
    return df.select("event_id", F.unix_timestamp("timestamp_utc").alias("chosen"), "timestamp_source", "timestamp_disagreement_sec", "timestamp_sources_disagree")


@add("local_time", """SELECT event_id, strftime(timezone('Europe/Warsaw', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local_text FROM events""")
def local_time(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.date_format(F.from_utc_timestamp(F.col("ts").cast("timestamp"), P.local_zone), "yyyy-MM-dd HH:mm:ss").alias("local_text"))


@add("signal_mode", f"""WITH {POINTS_SQL} SELECT point_id, CASE WHEN lights IS NULL OR sound IS NULL THEN 'SIGNAL_MISSING' WHEN lights NOT IN (0, 1) OR sound NOT IN (0, 1) THEN 'SIGNAL_INVALID'
WHEN lights = 1 AND sound = 1 THEN 'LIGHT_ON_SOUND_ON' WHEN lights = 1 THEN 'LIGHT_ON_SOUND_OFF' WHEN sound = 1 THEN 'LIGHT_OFF_SOUND_ON' ELSE 'LIGHT_OFF_SOUND_OFF' END AS signal_mode FROM pts""")
def signal_mode(spark, sf_dir):
    return points(spark, sf_dir).select("point_id", t.signal_mode(F.col("lights"), F.col("sound")).alias("signal_mode"))


@add("calendar_fields", """SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, 'Q' || quarter(ts) AS quarter, day(ts)::INT AS day, hour(ts)::INT AS hour, isodow(ts)::INT AS day_of_week_iso, isodow(ts) >= 6 AS is_weekend,
CASE WHEN month(ts) IN (12, 1, 2) THEN 'WINTER' WHEN month(ts) IN (3, 4, 5) THEN 'SPRING' WHEN month(ts) IN (6, 7, 8) THEN 'SUMMER' ELSE 'AUTUMN' END AS season, dayname(ts) AS day_name, monthname(ts) AS month_name FROM events""")
def calendar_fields(spark, sf_dir):
    df = calendar(table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "ts").drop("ts")
    return df.withColumns({"day_name": day_name(F.col("day_of_week_iso")), "month_name": month_name(F.col("month"))})


@add("time_of_day", "SELECT CASE WHEN hour(ts) BETWEEN 7 AND 9 THEN 'PEAK_MORNING' WHEN hour(ts) BETWEEN 10 AND 14 THEN 'OFF_PEAK_DAY' WHEN hour(ts) BETWEEN 15 AND 18 THEN 'PEAK_EVENING' ELSE 'NIGHT' END AS time_of_day, count(*) AS n FROM events GROUP BY 1")
def time_of_day_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(time_of_day(F.hour("ts")).alias("time_of_day")).agg(F.count(F.lit(1)).alias("n"))


@add("season_label", "SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'WINTER' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'SPRING' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'SUMMER' ELSE 'AUTUMN' END AS season, count(*) AS n FROM orders GROUP BY 1")
def season_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


# --- validity ---------------------------------------------------------------------------------------------------------------

_VALID = "(lat IS NOT NULL AND lon IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND lat <> 0 AND lon <> 0)"


@add("reject_reasons", f"""WITH {POINTS_SQL} SELECT CASE WHEN {_VALID} THEN 'NONE' WHEN lat IS NULL OR lon IS NULL THEN 'NULL_FIELD' WHEN lat = 0 OR lon = 0 THEN 'ZERO_COORDINATE' WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN 'OUT_OF_WORLD_RANGE' ELSE 'UNCLASSIFIED' END AS reason, count(*) AS n FROM pts GROUP BY 1""")
def reject_reasons(spark, sf_dir):
    reason = F.coalesce(t.reject_reason(F.col("lat"), F.col("lon"), P.study_box), F.lit("NONE"))
    return points(spark, sf_dir).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@add("bbox_membership", f"""WITH {POINTS_SQL} SELECT point_id, {_VALID} AS valid, {_VALID} AND lat BETWEEN 49.967665 AND 50.126135 AND lon BETWEEN 19.792238 AND 20.217346 AS in_study, {_VALID} AND lat BETWEEN 49.90 AND 50.22 AND lon BETWEEN 19.65 AND 20.30 AS in_roads FROM pts""")
def bbox_membership(spark, sf_dir):
    lat, lon = F.col("lat"), F.col("lon")
    ok = t.coordinate_is_valid(lat, lon)
    return points(spark, sf_dir).select("point_id", ok.alias("valid"), (ok & t.in_box(lat, lon, P.study_box)).alias("in_study"), (ok & t.in_box(lat, lon, P.road_box)).alias("in_roads"))


@add("period_filter", "SELECT count(*) AS n, count(CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 1 END) AS inside FROM orders")
def period_filter(spark, sf_dir):
    inside = t.within_period(F.to_date("o_orderdate"), ("1995-01-01", "1996-12-31"))
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"), reports.tally(inside).alias("inside"))


def raw_rows(spark, sf_dir):
    """events as raw telemetry rows."""
    p, r = points(spark, sf_dir), raw_timestamps(spark, sf_dir)
    rows = p.join(r, p["point_id"] == r["event_id"]).select(
        F.when(F.col("point_id") % 61 != 0, F.col("source_entity_id")).alias("GPS"), F.col("lat").alias("GPS_LAT"), F.col("lon").alias("GPS_LON"), F.col("raw_speed").alias("GPS_SPEED"), "GPS_TIME", "ETL_CZAS",
        F.col("lights").alias("SYGNALIZACJA_SWIETLNA"), F.col("sound").alias("SYGNALIZACJA_DZWIEKOWA"), F.when(F.col("point_id") % 101 == 0, "x").alias("_corrupt_record"), "point_id",
    )
    p = Params(local_zone="UTC", period=("2024-01-05", "2024-01-25"))
    return t.flag_rows(resolve_timestamps(rows, p), p), p


@add("attrition_metrics", f"""WITH {POINTS_SQL}, r AS ({_RAW}), x AS (SELECT pts.*, CASE WHEN gps <> 'garbage' THEN ts END AS a, CASE WHEN etl IS NOT NULL THEN ts + to_minutes((event_id % 20)::INT) END AS b FROM pts JOIN r ON event_id = point_id),
f AS (SELECT *, {_VALID} AS ok, coalesce(a, b) AS u, coalesce(lat BETWEEN 49.967665 AND 50.126135 AND lon BETWEEN 19.792238 AND 20.217346, false) AND {_VALID} AS inside FROM x),
c AS (SELECT count(*) AS raw_rows, count_if(point_id % 101 = 0) AS corrupt_rows, count_if(point_id % 61 = 0) AS missing_identifier_rows, count_if(NOT ok) AS invalid_coordinate_rows,
count_if(NOT ok AND (lat IS NULL OR lon IS NULL)) AS coordinate_null_field_rows, count_if(NOT ok AND lat IS NOT NULL AND lon IS NOT NULL AND (lat = 0 OR lon = 0)) AS coordinate_zero_coordinate_rows,
count_if(NOT ok AND lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0) AS coordinate_out_of_world_range_rows, 0 AS swapped_lat_lon_suspect_rows, count_if(u IS NULL) AS invalid_timestamp_rows,
count_if(u IS NOT NULL AND NOT CAST(u AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25') AS outside_period_rows, count_if(a IS NOT NULL) AS gps_timestamp_rows, count_if(a IS NULL AND b IS NOT NULL) AS etl_timestamp_rows,
count_if(abs(epoch(a) - epoch(b)) > 300) AS timestamp_disagreement_rows, count_if(inside) AS inside_study_aoi_rows, count_if(ok AND NOT inside) AS outside_study_aoi_rows FROM f)
SELECT metric, value::BIGINT AS value FROM (UNPIVOT c ON COLUMNS(*) INTO NAME metric VALUE value)""")
def attrition_metrics(spark, sf_dir):
    flagged, p = raw_rows(spark, sf_dir)
    return reports.as_rows(flagged.agg(*[e.alias(n) for n, e in reports.attrition(p).items()]))


@add("accepted_rows", f"""WITH {POINTS_SQL}, r AS ({_RAW}) SELECT point_id FROM (SELECT pts.*, coalesce(CASE WHEN gps <> 'garbage' THEN ts END, CASE WHEN etl IS NOT NULL THEN ts + to_minutes((event_id % 20)::INT) END) AS u FROM pts JOIN r ON event_id = point_id)
WHERE {_VALID} AND point_id % 101 <> 0 AND point_id % 61 <> 0 AND CAST(u AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""")
def accepted_rows(spark, sf_dir):
    return raw_rows(spark, sf_dir)[0].filter(t.is_accepted()).select("point_id")


# --- identity -----------------------------------------------------------------------------------------------------------------

_ID = "sha256(coalesce(event_id::VARCHAR, '<NULL>') || chr(31) || coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id::VARCHAR END, '<NULL>') || chr(31) || coalesce(event_type, '<NULL>'))"


@add("content_hash", f"SELECT event_id, {_ID} AS point_hash FROM events")
def content_hash(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("u", F.when(F.col("event_id") % 3 != 0, F.col("user_id")))
    return e.select("event_id", t.content_id(("event_id", "u", "event_type")).alias("point_hash"))


@add("dedup_min_struct", "WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS r FROM events) SELECT user_id, event_type, event_id FROM r WHERE r = 1")
def dedup_min_struct(spark, sf_dir):
    return identity.dedup_least(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_type")


@add("dedup_across_batches", "SELECT event_id, 'file' || min(CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 1 ELSE 2 END) AS source_file, min(user_id) AS user_id FROM events GROUP BY event_id")
def dedup_across_batches(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    batch = lambda cond, n: e.filter(cond).select("event_id", F.lit(f"file{n}").alias("source_file"), "user_id")
    return identity.dedup_batches([batch("event_id % 3 < 2", 1), batch("event_id % 3 > 0", 2), batch("event_id % 3 = 0", 3)], "event_id", "source_file")


@add("one_per_key", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def one_per_key(spark, sf_dir):
    return identity.one_per_key(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id")


@add("source_shards", "SELECT count(*) AS n, count(DISTINCT user_id) AS sources FROM events")
def source_shards(spark, sf_dir):
    """Shards put together again: every row once, no source in two shards."""
    e = table(spark, sf_dir, "events").withColumn("shard", identity.shard(F.col("user_id"), 5))
    per = e.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("sources"))
    return per.agg(F.sum("n").alias("n"), F.sum("sources").alias("sources"))


# --- kinematics -------------------------------------------------------------------------------------------------------------

_LAG = f"""WITH {POINTS_SQL}, l AS (SELECT *, lag(timestamp_utc) OVER w AS pt, lag(x) OVER w AS px, lag(y) OVER w AS py FROM pts WINDOW w AS (PARTITION BY source_entity_id ORDER BY timestamp_utc, point_id)),
k AS (SELECT *, floor(epoch(timestamp_utc))::BIGINT - floor(epoch(pt))::BIGINT AS d, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS m FROM l)"""
_GAP = Params(speed_source="displacement", max_gap=1800)


def derived(spark, sf_dir, p=_GAP):
    return kinematics.derive(points(spark, sf_dir).withColumnRenamed("raw_speed", "GPS_SPEED"), p)


@add("kinematics_lag", _LAG + " SELECT point_id, d AS time_delta_sec, round(m, 6) AS dist_delta_meters FROM k")
def kinematics_lag(spark, sf_dir):
    return kinematics.with_previous(points(spark, sf_dir)).select("point_id", "time_delta_sec", F.round("dist_delta_meters", 6).alias("dist_delta_meters"))


@add("speed_reason_counts", _LAG + """ SELECT CASE WHEN d > 0 AND d <= 1800 THEN 'USABLE_DISPLACEMENT_INTERVAL' WHEN pt IS NULL THEN 'FIRST_POINT_FOR_SOURCE' WHEN d <= 0 THEN 'NON_INCREASING_TIMESTAMP' WHEN d > 1800 THEN 'GAP_EXCEEDS_MAX' ELSE 'INTERVAL_NOT_USABLE' END AS reason, count(*) AS n FROM k GROUP BY 1""")
def speed_reason_counts(spark, sf_dir):
    return derived(spark, sf_dir).groupBy(F.col("speed_derivation_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@add("gps_speed_outcomes", f"""WITH {POINTS_SQL} SELECT CASE WHEN raw_speed >= 0 THEN 'USABLE_GPS_SPEED_CM_PER_S' WHEN raw_speed IS NULL THEN 'GPS_SPEED_MISSING' ELSE 'GPS_SPEED_NEGATIVE' END AS reason, count(*) AS n, round(sum(CASE WHEN raw_speed >= 0 THEN raw_speed * 0.036 END), 3) AS total FROM pts GROUP BY 1""")
def gps_speed_outcomes(spark, sf_dir):
    df = derived(spark, sf_dir, P)
    return df.groupBy(F.col("speed_derivation_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("gps_speed_kmh"), 3).alias("total"))


@add("displacement_speed", _LAG + """ SELECT point_id, CASE WHEN d > 0 AND d <= 1800 THEN round(m / d * 3.6, 6) END AS displacement_speed_kmh,
CASE WHEN d > 0 AND d <= 1800 AND m >= 1 THEN round(CASE WHEN atan2(x - px, y - py) < 0 THEN atan2(x - px, y - py) + 2 * pi() ELSE atan2(x - px, y - py) END, 9) END AS traj_azimuth FROM k""")
def displacement_speed(spark, sf_dir):
    return derived(spark, sf_dir).select("point_id", F.round("displacement_speed_kmh", 6).alias("displacement_speed_kmh"), F.round("traj_azimuth", 9).alias("traj_azimuth"))


@add("carry_state_latest", f"WITH {POINTS_SQL}, r AS (SELECT source_entity_id, point_id, row_number() OVER (PARTITION BY source_entity_id ORDER BY timestamp_utc DESC, point_id DESC) AS r FROM pts) SELECT source_entity_id, point_id FROM r WHERE r = 1")
def carry_state_latest(spark, sf_dir):
    return kinematics.last_rows(points(spark, sf_dir)).select("source_entity_id", "point_id")


@add("chunked_equals_whole", _LAG + " SELECT point_id, d AS time_delta_sec, CASE WHEN d > 0 AND d <= 1800 THEN round(m / d * 3.6, 6) END AS displacement_speed_kmh FROM k")
def chunked_equals_whole(spark, sf_dir):
    """Two chunks of time with carried rows, put together."""
    rows = points(spark, sf_dir).withColumnRenamed("raw_speed", "GPS_SPEED")
    early = F.col("timestamp_utc") < F.lit("2024-01-16").cast("timestamp")
    a, b = kinematics.derive_chunks([rows.filter(early), rows.filter(~early)], _GAP)
    return a.unionByName(b).select("point_id", "time_delta_sec", F.round("displacement_speed_kmh", 6).alias("displacement_speed_kmh"))


@add("event_gap_sessions", _LAG + """, s AS (SELECT source_entity_id, sum(CASE WHEN d > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY source_entity_id ORDER BY timestamp_utc, point_id) AS s FROM k)
SELECT source_entity_id, count(DISTINCT s) AS n_sessions, count(*) AS n FROM s GROUP BY 1""")
def event_gap_sessions(spark, sf_dir):
    return kinematics.sessions(points(spark, sf_dir), 3600).groupBy("source_entity_id").agg(F.count_distinct("session_id").alias("n_sessions"), F.count(F.lit(1)).alias("n"))


# --- angles and geometry ------------------------------------------------------------------------------------------------------

_ANGLES = "WITH a AS (SELECT event_id, CAST(event_id % 360 AS DOUBLE) * pi() / 180 AS a, CAST((event_id * 7) % 360 AS DOUBLE) * pi() / 180 AS b FROM events), d AS (SELECT *, least(abs(a - b), 2 * pi() - abs(a - b)) AS d FROM a)"


def angles(spark, sf_dir):
    rad = lambda e: F.expr(e).cast("double") * math.pi / 180
    df = table(spark, sf_dir, "events").select("event_id", rad("event_id % 360").alias("a"), rad("(event_id * 7) % 360").alias("b"))
    return df.withColumn("d", g.circular_difference(F.col("a"), F.col("b")))


@add("angle_difference", _ANGLES + " SELECT event_id, round(d, 9) AS d FROM d")
def angle_difference(spark, sf_dir):
    return angles(spark, sf_dir).select("event_id", F.round("d", 9).alias("d"))


@add("heading_alignment", _ANGLES + " SELECT event_id, round(least(d, pi() - d), 9) AS d FROM d")
def heading_alignment(spark, sf_dir):
    return angles(spark, sf_dir).select("event_id", F.round(g.undirected(F.col("d")), 9).alias("d"))


@add("match_score", _ANGLES + " SELECT event_id, round(CASE WHEN event_id % 4 = 0 THEN (event_id % 40) / 15.0 ELSE 0.65 * ((event_id % 40) / 15.0) + 0.35 * (least(d, pi() - d) / (pi() / 2)) END, 9) AS score FROM d")
def match_score(spark, sf_dir):
    align = F.when(F.col("event_id") % 4 != 0, g.undirected(F.col("d")))
    return angles(spark, sf_dir).select("event_id", F.round(g.match_score((F.col("event_id") % 40).cast("double"), align, P.primary_radius, P.heading_weight), 9).alias("score"))


@add("travel_direction", _ANGLES + " SELECT CASE WHEN event_id % 5 = 0 THEN 'UNKNOWN_STATIONARY_OR_SHORT_MOVE' WHEN d > pi() / 2 AND event_id % 2 = 0 THEN 'AGAINST_ONEWAY_DIGITIZED_DIRECTION' WHEN d > pi() / 2 THEN 'BACKWARD' ELSE 'FORWARD' END AS travel_direction, count(*) AS n FROM d GROUP BY 1")
def travel_direction(spark, sf_dir):
    d = F.when(F.col("event_id") % 5 != 0, F.col("d"))
    return angles(spark, sf_dir).groupBy(matching.travel_direction(d, F.col("event_id") % 2 == 0).alias("travel_direction")).agg(F.count(F.lit(1)).alias("n"))


def _project_sql() -> str:
    n, c = g._N, g._FORTH
    root = 2 * math.sqrt(n) / (1 + n)
    term = lambda f, h: " + ".join(f"{a!r} * {f}({2 * j} * xi) * {h}({2 * j} * eta)" for j, a in enumerate(c, 1))
    return f"""WITH d AS (SELECT event_id, radians(50 + (event_id % 1000) / 5000.0::DOUBLE) AS lat, radians(19.6 + (event_id % 777) / 1100.0::DOUBLE - 19.0) AS turn FROM events),
t AS (SELECT event_id, turn, sinh(atanh(sin(lat)) - {root!r} * atanh({root!r} * sin(lat))) AS t FROM d),
x AS (SELECT event_id, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(1 + t * t)) AS eta FROM t)
SELECT event_id, round({g.FALSE_EAST} + {g._RADIUS!r} * (eta + {term("cos", "sinh")}), 3) AS east, round({g.FALSE_NORTH} + {g._RADIUS!r} * (xi + {term("sin", "cosh")}), 3) AS north FROM x"""


@add("project_metric", _project_sql())
def project_metric(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    east, north = g.project(19.6 + (F.col("event_id") % 777) / 1100.0, 50 + (F.col("event_id") % 1000) / 5000.0)
    return e.select("event_id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


@add("project_round_trip", "SELECT count(*) AS n, count(*) AS exact FROM events")
def project_round_trip(spark, sf_dir):
    """How many places come back within 1e-8 degrees (a millimetre)."""
    lon, lat = 19.6 + (F.col("event_id") % 777) / 1100.0, 50 + (F.col("event_id") % 1000) / 5000.0
    back = g.unproject(*g.project(lon, lat))
    return table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"), reports.tally((F.abs(back[0] - lon) < 1e-8) & (F.abs(back[1] - lat) < 1e-8)).alias("exact"))


@add("azimuth", f"WITH {SEGMENTS_SQL} SELECT match_segment_id, CASE WHEN x1 <> x2 OR y1 <> y2 THEN round(CASE WHEN atan2(x2 - x1, y2 - y1) < 0 THEN atan2(x2 - x1, y2 - y1) + 2 * pi() ELSE atan2(x2 - x1, y2 - y1) END, 9) END AS azimuth FROM seg")
def azimuth(spark, sf_dir):
    return segments(spark, sf_dir).select("match_segment_id", F.round(g.azimuth(*map(F.col, ("x1", "y1", "x2", "y2"))), 9).alias("azimuth"))


def lines(spark, sf_dir):
    """Polylines of three vertices from segments; the third is off to the east."""
    s = segments(spark, sf_dir)
    v = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    c = F.col
    return s.select(c("match_segment_id").alias("road_feature_id"), F.array(v(c("x1"), c("y1")), v(c("x2"), c("y2")), v(c("x2") + 30, c("y2"))).alias("line"))


_LENGTH = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"


@add("polyline_length", f"WITH {SEGMENTS_SQL} SELECT match_segment_id AS road_feature_id, round({_LENGTH} + 30, 3) AS road_length_m FROM seg")
def polyline_length(spark, sf_dir):
    return lines(spark, sf_dir).select("road_feature_id", F.round(g.polyline_length(F.col("line")), 3).alias("road_length_m"))


@add("atomic_segments", f"WITH {SEGMENTS_SQL} SELECT match_segment_id || ':0' AS match_segment_id, x1, y1, x2, y2 FROM seg WHERE x1 <> x2 OR y1 <> y2 UNION ALL SELECT match_segment_id || ':1', x2, y2, x2 + 30, y2 FROM seg")
def atomic_segments(spark, sf_dir):
    return g.atomic_segments(lines(spark, sf_dir)).select("match_segment_id", "x1", "y1", "x2", "y2")


@add("reversed_polyline", f"WITH {SEGMENTS_SQL} SELECT match_segment_id AS road_feature_id, x2 + 30 AS first_x, x1 AS last_x FROM seg")
def reversed_polyline(spark, sf_dir):
    back = g.reversed_polyline(F.col("line"))
    return lines(spark, sf_dir).select("road_feature_id", F.get(back, F.lit(0))["x"].alias("first_x"), F.element_at(back, -1)["x"].alias("last_x"))


@add("total_bounds", f"WITH {SEGMENTS_SQL}, v AS (SELECT x1 AS x, y1 AS y FROM seg UNION ALL SELECT x2, y2 FROM seg UNION ALL SELECT x2 + 30, y2 FROM seg) SELECT min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM v")
def total_bounds(spark, sf_dir):
    return g.bounds(lines(spark, sf_dir))


_BOX = (500.0, 500.0, 2000.0, 2200.0)


def _clip_sql(a: str) -> str:
    """A segment's share of the box's inside, by the parameter at which it meets each edge."""
    return f"""SELECT id, k, x1, y1, x2, y2, greatest(0, CASE WHEN x2 > x1 THEN (500 - x1) / (x2 - x1) WHEN x2 < x1 THEN (2000 - x1) / (x2 - x1) END, CASE WHEN y2 > y1 THEN (500 - y1) / (y2 - y1) WHEN y2 < y1 THEN (2200 - y1) / (y2 - y1) END) AS lo,
least(1, CASE WHEN x2 > x1 THEN (2000 - x1) / (x2 - x1) WHEN x2 < x1 THEN (500 - x1) / (x2 - x1) END, CASE WHEN y2 > y1 THEN (2200 - y1) / (y2 - y1) WHEN y2 < y1 THEN (500 - y1) / (y2 - y1) END) AS hi,
(x1 <> x2 OR x1 BETWEEN 500 AND 2000) AND (y1 <> y2 OR y1 BETWEEN 500 AND 2200) AS ok FROM {a}"""


_PAIRS = f"{SEGMENTS_SQL}, ab AS (SELECT match_segment_id AS id, 0 AS k, x1, y1, x2, y2 FROM seg UNION ALL SELECT match_segment_id, 1, x2, y2, x2 + 30, y2 FROM seg), c AS ({_clip_sql('ab')})"


@add("clipped_length", f"WITH {_PAIRS} SELECT id AS road_feature_id, round(sum((hi - lo) * {_LENGTH}), 3) AS inside_m FROM c WHERE ok AND lo < hi AND {_LENGTH} > 0 GROUP BY id HAVING sum((hi - lo) * {_LENGTH}) > 0")
def clipped_length(spark, sf_dir):
    cut = g.clip_polylines(lines(spark, sf_dir), _BOX)
    return cut.groupBy("road_feature_id").agg(F.round(F.sum(g.polyline_length(F.col("line"))), 3).alias("inside_m"))


@add("envelope_flag", f"WITH {_PAIRS} SELECT id AS road_feature_id, bool_or(ok AND lo <= hi) AS touches FROM c GROUP BY id")
def envelope_flag(spark, sf_dir):
    return lines(spark, sf_dir).select("road_feature_id", g.touches_box(F.col("line"), _BOX).alias("touches"))


@add("geometry_validity", f"WITH {SEGMENTS_SQL} SELECT match_segment_id AS road_feature_id, match_segment_id % 9 <> 0 AND match_segment_id % 10 <> 0 AS valid FROM seg")
def geometry_validity(spark, sf_dir):
    line = F.when(F.col("road_feature_id") % 9 == 0, F.slice("line", 1, 1)).when(F.col("road_feature_id") % 10 != 0, F.col("line"))
    return lines(spark, sf_dir).select("road_feature_id", g.is_valid_polyline(line).alias("valid"))


@add("wkt_wkb_round_trip", f"WITH {SEGMENTS_SQL} SELECT match_segment_id AS road_feature_id, true AS same FROM seg")
def wkt_wkb_round_trip(spark, sf_dir):
    line = F.col("line")
    return lines(spark, sf_dir).select("road_feature_id", ((g.from_wkt(g.to_wkt(line)) == line) & (g.from_wkb(g.to_wkb("line")) == line)).alias("same"))


# --- matching -----------------------------------------------------------------------------------------------------------------

_DIST = "round(sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2)), 6)"
_T = "CASE WHEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) > 0 THEN greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) ELSE 0 END"


def _near_sql(radius: float) -> str:
    return f"""{POINTS_SQL}, {SEGMENTS_SQL}, prs AS (SELECT point_id, match_segment_id, road_feature_id, {_DIST} AS dist_to_axis FROM (SELECT *, {_T} AS t FROM pts JOIN seg
ON x BETWEEN least(x1, x2) - {radius} AND greatest(x1, x2) + {radius} AND y BETWEEN least(y1, y2) - {radius} AND greatest(y1, y2) + {radius}))"""


def places(spark, sf_dir):
    return points(spark, sf_dir).select("point_id", "x", "y")


def pairs(spark, sf_dir, radius=40.0):
    return matching.grid_join(places(spark, sf_dir), segments(spark, sf_dir), radius, P.grid_cell, 6, ("point_id", "match_segment_id", "dist_to_axis"))


@add("candidate_join_grid", f"WITH {_near_sql(40)} SELECT point_id, match_segment_id, dist_to_axis FROM prs WHERE dist_to_axis <= 40")
def candidate_join_grid(spark, sf_dir):
    return pairs(spark, sf_dir)


@add("nearest_distance", f"WITH {_near_sql(150)} SELECT point_id, d AS nearest_road_distance_m FROM (SELECT point_id FROM pts) LEFT JOIN (SELECT point_id, min(dist_to_axis) AS d FROM prs WHERE dist_to_axis <= 150 GROUP BY 1) USING (point_id)")
def nearest_distance(spark, sf_dir):
    return matching.nearest(places(spark, sf_dir), segments(spark, sf_dir), 150.0, 150.0, digits=6).select("point_id", "nearest_road_distance_m")


@add("unmatched_buckets", f"""WITH {_near_sql(150)}, n AS (SELECT point_id, d FROM (SELECT point_id FROM pts) LEFT JOIN (SELECT point_id, min(dist_to_axis) AS d FROM prs WHERE dist_to_axis <= 150 GROUP BY 1) USING (point_id))
SELECT CASE WHEN d <= 75 THEN 'GT_40_LE_75_M' WHEN d <= 150 THEN 'GT_75_LE_150_M' ELSE 'GT_150_M_OR_NO_CANDIDATE' END AS distance_bucket, count(*) AS unmatched_point_count FROM n WHERE d IS NULL OR d > 40 GROUP BY 1""")
def unmatched_buckets(spark, sf_dir):
    return matching.unmatched_summary(places(spark, sf_dir), segments(spark, sf_dir), P, keys=(), digits=6)


def ranked(spark, sf_dir):
    """Best roads without headings, so that the score is the distance alone."""
    return matching.best_roads(places(spark, sf_dir), segments(spark, sf_dir), P, digits=6)


_BEST = f"WITH {_near_sql(40)}, s AS (SELECT *, row_number() OVER (PARTITION BY point_id, road_feature_id ORDER BY dist_to_axis, match_segment_id) AS r FROM prs WHERE dist_to_axis <= 40), f AS (SELECT point_id, road_feature_id, match_segment_id, dist_to_axis FROM s WHERE r = 1)"
_ROAD = _BEST + """, k AS (SELECT *, row_number() OVER w AS r, lead(dist_to_axis) OVER w AS nd, count(*) OVER (PARTITION BY point_id) AS c3, count(CASE WHEN dist_to_axis <= 15 THEN 1 END) OVER (PARTITION BY point_id) AS c1,
count(CASE WHEN dist_to_axis <= 25 THEN 1 END) OVER (PARTITION BY point_id) AS c2 FROM f WINDOW w AS (PARTITION BY point_id ORDER BY dist_to_axis <= 15 DESC, dist_to_axis, road_feature_id)), b AS (SELECT * FROM k WHERE r = 1)"""


#: Candidates of moving points, scored by distance and alignment, as by the two of a road's segments and of a point's roads.
_HEADED = _LAG + f""", {SEGMENTS_SQL}, a AS (SELECT point_id, x, y, CASE WHEN d > 0 AND d <= 1800 AND m >= 1 THEN CASE WHEN atan2(x - px, y - py) < 0 THEN atan2(x - px, y - py) + 2 * pi() ELSE atan2(x - px, y - py) END END AS az FROM k),
g AS (SELECT *, CASE WHEN x1 <> x2 OR y1 <> y2 THEN CASE WHEN atan2(x2 - x1, y2 - y1) < 0 THEN atan2(x2 - x1, y2 - y1) + 2 * pi() ELSE atan2(x2 - x1, y2 - y1) END END AS road_az FROM seg),
prs AS (SELECT *, {_DIST} AS dist_to_axis, least(abs(az - road_az), 2 * pi() - abs(az - road_az)) AS turn FROM (SELECT *, {_T} AS t FROM a JOIN g ON x BETWEEN least(x1, x2) - 40 AND greatest(x1, x2) + 40 AND y BETWEEN least(y1, y2) - 40 AND greatest(y1, y2) + 40)),
sc AS (SELECT *, CASE WHEN az IS NOT NULL AND road_az IS NOT NULL THEN turn END AS azimuth_diff, CASE WHEN az IS NOT NULL AND road_az IS NOT NULL THEN least(turn, pi() - turn) END AS al FROM prs WHERE dist_to_axis <= 40),
z AS (SELECT *, CASE WHEN al IS NULL THEN dist_to_axis / 15.0::DOUBLE ELSE 0.65::DOUBLE * (dist_to_axis / 15.0::DOUBLE) + 0.35::DOUBLE * (al / (pi() / 2)) END AS score FROM sc),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY point_id, road_feature_id ORDER BY score, dist_to_axis, al NULLS LAST, match_segment_id) AS r1 FROM z) WHERE r1 = 1),
h AS (SELECT *, row_number() OVER w AS r2, lead(score) OVER w AS ns, count(*) OVER (PARTITION BY point_id) AS c3, count(CASE WHEN dist_to_axis <= 15 THEN 1 END) OVER (PARTITION BY point_id) AS c1
FROM f WINDOW w AS (PARTITION BY point_id ORDER BY dist_to_axis <= 15 DESC, score, dist_to_axis, al NULLS LAST, road_feature_id))"""


def headed(spark, sf_dir):
    """Points with the heading of their last move, and segments with their own."""
    moving = derived(spark, sf_dir).select("point_id", "x", "y", "traj_azimuth")
    return moving, segments(spark, sf_dir).withColumn("road_azimuth", g.azimuth(*map(F.col, ("x1", "y1", "x2", "y2"))))


@add("best_segment_heading", _HEADED + " SELECT point_id, road_feature_id, match_segment_id, round(score, 9) AS match_score, round(al, 9) AS heading_alignment_diff FROM f")
def best_segment_heading(spark, sf_dir):
    df = matching.best_segments(*headed(spark, sf_dir), P, 6, ("point_id", "road_feature_id", "match_segment_id", "match_score", "heading_alignment_diff"))
    at9 = lambda c: (F.floor(F.col(c) * 1e9 + 0.5) / F.lit(1e9)).alias(c)  # noqa: E731  # a row a pair: round() goes by decimals
    return df.select("point_id", "road_feature_id", "match_segment_id", at9("match_score"), at9("heading_alignment_diff"))


@add("best_road_heading", _HEADED + """ SELECT point_id, road_feature_id, match_segment_id, dist_to_axis <= 15 AS within_primary_match_radius, CASE WHEN (CASE WHEN dist_to_axis <= 15 THEN c1 ELSE c3 END) > 1 THEN round(ns - score, 9) END AS score_margin,
CASE WHEN azimuth_diff IS NULL THEN 'UNKNOWN_STATIONARY_OR_SHORT_MOVE' WHEN azimuth_diff > pi() / 2 THEN 'BACKWARD' ELSE 'FORWARD' END AS travel_direction FROM h WHERE r2 = 1""")
def best_road_heading(spark, sf_dir):
    best = matching.best_roads(*headed(spark, sf_dir), P, digits=6)
    way = matching.travel_direction(F.col("azimuth_diff"), F.lit(False))
    return best.select("point_id", "road_feature_id", "match_segment_id", "within_primary_match_radius", F.round("score_margin", 9).alias("score_margin"), way.alias("travel_direction"))


@add("best_segment", _BEST + " SELECT point_id, road_feature_id, match_segment_id, dist_to_axis FROM f")
def best_segment(spark, sf_dir):
    return matching.best_segments(places(spark, sf_dir), segments(spark, sf_dir), P, 6, ("point_id", "road_feature_id", "match_segment_id", "dist_to_axis"))


@add("best_road", _ROAD + " SELECT point_id, road_feature_id, dist_to_axis, dist_to_axis <= 15 AS within_primary_match_radius FROM b")
def best_road(spark, sf_dir):
    return ranked(spark, sf_dir).select("point_id", "road_feature_id", "dist_to_axis", "within_primary_match_radius")


@add("candidate_counts", _ROAD + " SELECT point_id, c1 AS candidate_count_radius_1, c2 AS candidate_count_radius_2, c3 AS candidate_count_radius_3, CASE WHEN dist_to_axis <= 15 THEN c1 ELSE c3 END AS candidate_count FROM b")
def candidate_counts(spark, sf_dir):
    return ranked(spark, sf_dir).select("point_id", *[f"candidate_count_radius_{i}" for i in (1, 2, 3)], "candidate_count")


@add("runner_up_margin", _ROAD + " SELECT point_id, CASE WHEN (CASE WHEN dist_to_axis <= 15 THEN c1 ELSE c3 END) > 1 THEN round(nd - dist_to_axis, 6) END AS dist_margin_m FROM b")
def runner_up_margin(spark, sf_dir):
    return ranked(spark, sf_dir).select("point_id", F.round("dist_margin_m", 6).alias("dist_margin_m"))


@add("radius_tier", _ROAD + " SELECT CASE WHEN dist_to_axis <= 15 THEN 'LE_15_M' WHEN dist_to_axis <= 25 THEN 'GT_15_LE_25_M' ELSE 'GT_25_LE_40_M' END AS match_radius_tier, count(*) AS n FROM b GROUP BY 1")
def radius_tier(spark, sf_dir):
    return ranked(spark, sf_dir).groupBy("match_radius_tier").agg(F.count(F.lit(1)).alias("n"))


@add("distance_bucket", "SELECT CASE WHEN d <= 15 THEN 'LE_15_M' WHEN d <= 25 THEN 'GT_15_LE_25_M' WHEN d <= 40 THEN 'GT_25_LE_40_M' WHEN d <= 75 THEN 'GT_40_LE_75_M' WHEN d <= 150 THEN 'GT_75_LE_150_M' ELSE 'GT_150_M_OR_NO_CANDIDATE' END AS bucket, count(*) AS n FROM (SELECT CASE WHEN event_id % 9 <> 0 THEN event_id % 200 END AS d FROM events) GROUP BY 1")
def distance_bucket(spark, sf_dir):
    d = F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 200)
    return table(spark, sf_dir, "events").groupBy(t.distance_bucket(d).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@add("match_metrics", _ROAD + """, m AS (SELECT dist_to_axis AS d, CASE WHEN dist_to_axis <= 15 THEN c1 ELSE c3 END AS c FROM b), v AS (SELECT count(*)::DOUBLE AS sample_rows, round(avg(d), 6) AS distance_mean, round(quantile_cont(d, 0.5), 6) AS distance_p50, round(quantile_cont(d, 0.9), 6) AS distance_p90,
round(quantile_cont(d, 0.95), 6) AS distance_p95, round(avg((d <= 15)::INT), 6) AS primary_share, round(avg((c > 1)::INT), 6) AS ambiguous_share, 0::DOUBLE AS violations_total FROM m)
SELECT metric, value FROM (UNPIVOT v ON COLUMNS(*) INTO NAME metric VALUE value)""")
def match_metrics(spark, sf_dir):
    best = ranked(spark, sf_dir).withColumns({"calc_speed_kmh": F.lit(1.0), "weather_join_status": F.lit("MATCHED"), "is_high_speed_iqr_outlier": F.lit(False)})
    names = ("sample_rows", "distance_mean", "distance_p50", "distance_p90", "distance_p95", "primary_share", "ambiguous_share", "violations_total")
    return reports.match_metrics(best, P).filter(F.col("metric").isin(*names)).withColumn("value", F.round("value", 6))


# --- weather, tags, summaries -----------------------------------------------------------------------------------------------------

_HOURS = "h AS (SELECT DISTINCT date_trunc('hour', ts) AS weather_hour_utc FROM events WHERE hour(ts) % 5 <> 0)"


def hourly(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("hour(ts) % 5 <> 0")
    h = e.select(hour_bucket(F.col("ts").cast("timestamp")).alias("weather_hour_utc")).distinct()
    return h.withColumns({"weather_category": F.when(F.hour("weather_hour_utc") % 2 == 0, "RAIN_OR_LIQUID_PRECIPITATION").otherwise("NO_RECORDED_PRECIPITATION"), "weather_model": F.lit("m")})


@add("weather_bucket_join", f"WITH {POINTS_SQL}, {_HOURS} SELECT point_id, CASE WHEN weather_hour_utc IS NULL THEN 'UNKNOWN_WEATHER' WHEN hour(weather_hour_utc) % 2 = 0 THEN 'RAIN_OR_LIQUID_PRECIPITATION' ELSE 'NO_RECORDED_PRECIPITATION' END AS weather_category, CASE WHEN weather_hour_utc IS NULL THEN 'MISSING_WEATHER_HOUR' ELSE 'MATCHED' END AS weather_join_status, CASE WHEN weather_hour_utc IS NULL THEN 'era5' ELSE 'm' END AS weather_model FROM pts LEFT JOIN h ON date_trunc('hour', timestamp_utc) = weather_hour_utc")
def weather_bucket_join(spark, sf_dir):
    return enrich.join_weather(points(spark, sf_dir), hourly(spark, sf_dir), P).select("point_id", "weather_category", "weather_join_status", "weather_model")


@add("missing_hours", f"WITH {_HOURS}, r AS (SELECT unnest(generate_series(min(weather_hour_utc), max(weather_hour_utc), INTERVAL 1 HOUR)) AS h FROM h) SELECT epoch(r.h)::BIGINT AS hour_epoch FROM r WHERE r.h NOT IN (SELECT weather_hour_utc FROM h)")
def missing_hours(spark, sf_dir):
    return enrich.missing_hours(hourly(spark, sf_dir)).select(F.unix_timestamp("weather_hour_utc").alias("hour_epoch"))


@add("wmo_category", """WITH w AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_id % 100 END AS code, CASE WHEN event_id % 7 <> 0 THEN (event_id % 3)::DOUBLE END AS p, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 1.0 ELSE 0.0 END AS s FROM events)
SELECT event_id, CASE WHEN code IS NULL AND p IS NULL AND s IS NULL THEN 'UNKNOWN_WEATHER' WHEN s > 0 OR code IN (66, 67, 71, 73, 75, 77, 85, 86) THEN 'SNOWFALL_OR_FREEZING_PRECIPITATION' WHEN p > 0 OR code IN (51, 53, 55, 56, 57, 61, 63, 65, 80, 81, 82, 95, 96, 99) THEN 'RAIN_OR_LIQUID_PRECIPITATION'
WHEN code IN (45, 48) THEN 'FOG_OR_LOW_VISIBILITY' WHEN code IN (0, 1, 2, 3) THEN 'NO_RECORDED_PRECIPITATION' ELSE 'OTHER_OR_UNCLASSIFIED_WEATHER' END AS category FROM w""")
def wmo_category(spark, sf_dir):
    e = F.col("event_id")
    code, p = F.when(e % 10 != 0, e % 100), F.when(e % 7 != 0, (e % 3).cast("double"))
    s = F.when(e % 5 != 0, F.when(e % 4 == 0, 1.0).otherwise(0.0))
    return table(spark, sf_dir, "events").select("event_id", category(code, p, s).alias("category"))


_TAGS = ("50", "30 mph", "PL:living_street", None, "none", "50;30", "walk", "150", "60 km/h", "7.5mph", " ", "signals", "PL:rural", "4")
_PARSED = ((50, "OSM_NUMERIC_KMH"), (48, "OSM_NUMERIC_MPH_CONVERTED"), (20, "OSM_SYMBOLIC_TAG"), (30, "IMPUTED_HIGHWAY_DEFAULT"), (30, "IMPUTED_UNPARSEABLE_TAG"), (50, "OSM_NUMERIC_KMH"), (5, "OSM_SYMBOLIC_TAG"), (30, "IMPUTED_UNPARSEABLE_TAG"), (60, "OSM_NUMERIC_KMH"), (12, "OSM_NUMERIC_MPH_CONVERTED"), (30, "IMPUTED_HIGHWAY_DEFAULT"), (30, "IMPUTED_UNPARSEABLE_TAG"), (90, "OSM_SYMBOLIC_TAG"), (30, "IMPUTED_UNPARSEABLE_TAG"))


@add("maxspeed_parse", "SELECT p_partkey, CASE p_partkey % 14 " + " ".join(f"WHEN {i} THEN {v}" for i, (v, _) in enumerate(_PARSED)) + " END::INT AS value_kmh, CASE p_partkey % 14 " + " ".join(f"WHEN {i} THEN '{s}'" for i, (_, s) in enumerate(_PARSED)) + " END AS source FROM part")
def maxspeed_parse(spark, sf_dir):
    """Literal tags dealt out to parts; the road is a service road, whose default is 30."""
    tag = F.get(F.array(*[F.lit(x).cast("string") for x in _TAGS]), (F.col("p_partkey") % 14).cast("int"))
    s = tags.maxspeed(tag, F.lit("service"), P.default_speeds)
    return table(spark, sf_dir, "part").select("p_partkey", s["value_kmh"].alias("value_kmh"), s["source"].alias("source"))


@add("other_tags", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand || ', "x"' END AS brand FROM part""")
def other_tags(spark, sf_dir):
    text = F.concat(F.lit('"a,b"=>"c","brand"=>"'), F.col("p_brand"), F.lit(', \\"x\\"","z"=>"1"'))
    text = F.when(F.col("p_partkey") % 3 == 0, F.lit('"nobrand"=>"\\"brand\\"=>1"')).otherwise(text)
    return table(spark, sf_dir, "part").select("p_partkey", tags.other_tag(text, "brand").alias("brand"))


@add("oneway_parse", "SELECT p_partkey, p_partkey % 6 IN (0, 1, 2, 3) AS oneway, p_partkey % 6 = 3 AS reversed FROM part")
def oneway_parse(spark, sf_dir):
    tag = F.get(F.array(*[F.lit(x).cast("string") for x in ("yes", "True", "1", "-1", "no", None)]), (F.col("p_partkey") % 6).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", tags.is_oneway(tag).alias("oneway"), tags.is_oneway_reversed(tag).alias("reversed"))


@add("road_names", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'Unnamed link (trunk_link)' WHEN p_partkey % 4 = 1 THEN 'Unnamed road (service)' ELSE p_name END AS name, 'osm:' || p_partkey || ':' || p_size || ':0:' || substr(sha256(p_name), 1, 16) AS feature_id, p_partkey % 4 <> 2 AS kept FROM part")
def road_names(spark, sf_dir):
    k = F.col("p_partkey") % 4
    highway = F.when(k == 0, "trunk_link").when(k == 2, "footway").otherwise("service")
    name = F.when(k == 1, "  ").when(k > 1, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", tags.display_name(name, highway).alias("name"), tags.feature_id(F.col("p_partkey"), F.col("p_size"), F.lit(0), F.col("p_name").cast("binary")).alias("feature_id"), tags.is_road_class(highway).alias("kept"))


_FLAGS = "CASE WHEN event_id % 3 > 0 THEN true ELSE false END AS near, event_id % 7 = 0 AS out, event_id % 4 = 0 AS dry"


def flagged_matches(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select((e % 3 > 0).alias("within_primary_match_radius"), (e % 7 == 0).alias("is_high_speed_iqr_outlier"), F.when(e % 4 == 0, "MISSING_WEATHER_HOUR").otherwise("MATCHED").alias("weather_join_status"))


@add("silver_summary", f"WITH f AS (SELECT {_FLAGS} FROM events) SELECT 7::BIGINT AS bronze_rows, 5::BIGINT AS usable_speed_rows, count(*) AS matched_rows, count(CASE WHEN near THEN 1 END) AS primary_radius_rows, count(CASE WHEN NOT near THEN 1 END) AS sensitivity_only_rows, count(CASE WHEN out THEN 1 END) AS outlier_rows, count(CASE WHEN dry THEN 1 END) AS missing_weather_rows FROM f")
def silver_summary(spark, sf_dir):
    return reports.silver_summary(flagged_matches(spark, sf_dir), 7, 5)


@add("gold_reconciliation", f"WITH f AS (SELECT {_FLAGS} FROM events) SELECT count(*) AS silver_input_rows, count(CASE WHEN near THEN 1 END) AS primary_radius_silver_rows, count(CASE WHEN near AND NOT out THEN 1 END) AS gold_included_rows, count(CASE WHEN NOT near THEN 1 END) AS sensitivity_only_silver_rows, count(CASE WHEN NOT near THEN 1 END) AS excluded_sensitivity_only_rows, count(CASE WHEN near AND out THEN 1 END) AS excluded_primary_high_speed_iqr_outlier_rows FROM f")
def gold_reconciliation(spark, sf_dir):
    return reports.gold_reconciliation(flagged_matches(spark, sf_dir), P)


@add("partial_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def partial_counts(spark, sf_dir):
    """Counts of two chunks merged."""
    e = table(spark, sf_dir, "events")
    part = lambda cond: e.filter(cond).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return reports.merge_counts([part("event_id % 2 = 0"), part("event_id % 2 = 1")], ("event_type",), "n")


@add("json_properties", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_properties(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
