"""The pipeline's stages as plans: weather, roads, bronze, silver, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.functions import roads as tags
from velograph.functions.geometry import atomic_segments, clip_polylines, is_valid_polyline, polyline_length, project, reversed_polyline, touches_box
from velograph.functions.telemetry import content_id, flag_rows, is_accepted, signal_mode
from velograph.functions.timeparts import calendar, resolve_timestamps
from velograph.operators.enrich import flag_outliers, group_speed_stats, join_weather
from velograph.operators.identity import dedup_least, one_per_key
from velograph.operators.kinematics import derive, with_metric_place
from velograph.operators.matching import match, travel_direction
from velograph.operators.profiles import all_profiles, flat_with_roads, observations
from velograph.operators.reports import observe_attrition
from velograph.params import Params
from velograph.sources.readers import require

# The columns of a matched point.
SILVER = (
    "point_id", "source_entity_id", "timestamp_utc", "timestamp_local", "timestamp_source", "timestamp_disagreement_sec",
    "timestamp_sources_disagree", "year", "month", "quarter", "season", "day", "hour", "day_of_week_iso", "is_weekend", "inside_study_aoi",
    "inside_road_extraction_bbox", "GPS_LAT", "GPS_LON", "GPS_SPEED", "signal_mode", "x", "y", "prev_timestamp_utc", "time_delta_sec",
    "dist_delta_meters", "displacement_speed_kmh", "gps_speed_kmh", "calc_speed_kmh", "speed_source", "speed_derivation_reason",
    "traj_azimuth", "road_feature_id", "match_segment_id", "osm_id", "name", "highway", "maxspeed_raw", "maxspeed_kmh", "maxspeed_source",
    "oneway", "dist_to_axis", "azimuth_diff", "heading_alignment_diff", "match_score", "candidate_count", "candidate_count_primary_radius",
    "candidate_count_radius_1", "candidate_count_radius_2", "candidate_count_radius_3", "candidate_count_sensitivity_max_radius",
    "within_primary_match_radius", "selected_match_radius_m", "match_radius_tier", "score_margin", "dist_margin_m", "travel_direction",
    "weather_hour_utc", "weather_category", "weather_model", "weather_join_status", "road_speed_sample_count", "road_speed_q1_kmh",
    "road_speed_q3_kmh", "road_speed_iqr_kmh", "high_speed_outlier_threshold_kmh", "is_high_speed_iqr_outlier",
)


def metric_box(box: tuple[float, float, float, float], df: DataFrame) -> tuple[float, float, float, float]:
    """The extent of a box of degrees in metres (its corners and the middles of its sides)."""
    w, s, e, n = box
    rows = df.sparkSession.createDataFrame([(x, y) for x in (w, (w + e) / 2, e) for y in (s, (s + n) / 2, n)], "lon double, lat double")
    x, y = project(F.col("lon"), F.col("lat"))
    r = rows.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    return tuple(r)


def normalise_roads(raw: DataFrame, p: Params) -> DataFrame:
    """Roads of the kept classes in metres, clipped to the road box, with parsed tags.

    raw: osm_id, name, highway, maxspeed, oneway, line (degrees); optional u, v, key and other_tags.
    """
    raw = require(raw, "osm_id", "highway", "line", what="roads")
    for name, kind in (("name", "string"), ("maxspeed", "string"), ("oneway", "string"), ("u", "long"), ("v", "long"), ("key", "int"), ("other_tags", "string")):
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast(kind))
    raw = raw.withColumns({c: F.coalesce(c, tags.other_tag(F.col("other_tags"), c)) for c in ("maxspeed", "oneway", "name")})
    rows = raw.filter(tags.is_road_class(F.col("highway"))).filter(is_valid_polyline(F.col("line")))
    speed = tags.maxspeed(F.col("maxspeed"), F.col("highway"), p.default_speeds)
    back = tags.is_oneway_reversed(F.col("oneway"))
    metric = F.transform("line", lambda v: F.struct(*[e.alias(n) for e, n in zip(project(v["x"], v["y"]), ("x", "y"), strict=True)]))
    rows = rows.select(
        F.col("osm_id").cast("long"), F.col("osm_id").cast("string").alias("osm_ids_raw"), "name", "highway", F.col("maxspeed").alias("maxspeed_raw"), speed.alias("__s"),
        tags.is_oneway(F.col("oneway")).alias("oneway"), F.col("oneway").alias("oneway_raw"), back.alias("oneway_reversed"), "u", "v", "key",
        F.when(back, reversed_polyline(metric)).otherwise(metric).alias("line"),
    )
    rows = clip_polylines(rows, metric_box(p.road_box, raw), feature="osm_id").drop("part")
    text = F.concat_ws(",", F.transform("line", lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))))
    node = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    rows = rows.withColumn("road_feature_id", tags.feature_id(node("u"), node("v"), F.coalesce(F.col("key").cast("string"), F.col("osm_id").cast("string")), text))
    rows = rows.withColumns({"maxspeed_kmh": F.col("__s.value_kmh"), "maxspeed_source": F.col("__s.source"), "intersects_study_box": touches_box(F.col("line"), metric_box(p.study_box, raw))})
    return one_per_key(rows.drop("__s", "u", "v", "key"), "road_feature_id")


def bronze(raw: DataFrame, p: Params):
    """(deduplicated rows, observation of attrition): raw telemetry to accepted points, one pass."""
    flagged, seen = observe_attrition(flag_rows(resolve_timestamps(raw, p), p), p)
    rows = flagged.filter(is_accepted()).withColumns({
        "source_entity_id": F.col("GPS").cast("string"), "signal_mode": signal_mode(F.col("SYGNALIZACJA_SWIETLNA"), F.col("SYGNALIZACJA_DZWIEKOWA")), "point_id": content_id(),
    })
    return dedup_least(calendar(rows).drop("_corrupt_record", "coordinate_reject_reason"), "point_id", "source_file"), seen


def silver(bronze_rows: DataFrame, roads: DataFrame, weather: DataFrame, p: Params) -> DataFrame:
    """Points with kinematics, best road, direction, weather and outlier flag."""
    points = derive(with_metric_place(bronze_rows), p)
    attributes = ["road_feature_id", "osm_id", "name", "highway", "maxspeed_raw", "maxspeed_kmh", "maxspeed_source", "oneway"]
    segments = atomic_segments(roads.select(*attributes, "line"))
    matched = match(points, segments, p).withColumn("travel_direction", travel_direction(F.col("azimuth_diff"), F.col("oneway")))
    matched = join_weather(matched, weather, p)
    return flag_outliers(matched, group_speed_stats(matched), p).select(*SILVER)


def base_roads(roads: DataFrame) -> DataFrame:
    """What profiles say of a road."""
    return roads.select(
        "road_feature_id", "osm_id", "osm_ids_raw", tags.display_name(F.col("name"), F.col("highway")).alias("name"), "highway", "maxspeed_raw",
        F.col("maxspeed_kmh").alias("operating_speed_reference_kmh"), F.col("maxspeed_source").alias("operating_speed_reference_source"),
        "oneway", "oneway_raw", "oneway_reversed", "intersects_study_box", F.round(polyline_length(F.col("line")), 3).alias("road_length_m"), "line",
    )


def gold(silver_rows: DataFrame, roads: DataFrame, p: Params, keep=lambda df, name: df) -> dict[str, DataFrame]:
    """base, the four marginal profiles, and flat (the joint profile with road attributes). keep: see all_profiles()."""
    base = base_roads(roads)
    reference = base.select("road_feature_id", "operating_speed_reference_kmh", "operating_speed_reference_source")
    rows = observations(silver_rows, p).join(reference, "road_feature_id")
    tables = all_profiles(rows, p, keep)
    tables["flat"] = flat_with_roads(tables["flat"], base)
    return {"base": base, **tables}
