"""Weather by the hour, and the two-pass outlier rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.functions.timeparts import hour_bucket
from velograph.operators.identity import one_per_key
from velograph.params import Params


def join_weather(points: DataFrame, weather: DataFrame, p: Params, ts: str = "timestamp_utc") -> DataFrame:
    """Left join on the hour; what is missing is named as such. weather: weather_hour_utc, weather_category, weather_model."""
    hours = one_per_key(weather.select("weather_hour_utc", "weather_category", "weather_model"), "weather_hour_utc")
    out = points.withColumn("weather_hour_utc", hour_bucket(F.col(ts))).join(hours, "weather_hour_utc", "left")
    out = out.withColumn("weather_join_status", F.when(F.col("weather_category").isNull(), "MISSING_WEATHER_HOUR").otherwise("MATCHED"))
    return out.withColumns({"weather_category": F.coalesce("weather_category", F.lit("UNKNOWN_WEATHER")), "weather_model": F.coalesce("weather_model", F.lit(p.weather_model))})


def missing_hours(weather: DataFrame, hour: str = "weather_hour_utc") -> DataFrame:
    """Hours between the first and the last that have no row."""
    ends = weather.agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    every = ends.select(F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias(hour))
    return every.join(weather.select(hour), hour, "left_anti")


def group_speed_stats(df: DataFrame, group: str = "road_feature_id", speed: str = "calc_speed_kmh", accuracy: int = 10000) -> DataFrame:
    """Support and quartiles of each group over the rows within the primary radius, if that is known."""
    rows = df.filter("within_primary_match_radius") if "within_primary_match_radius" in df.columns else df
    q = F.percentile_approx(speed, F.array(F.lit(0.25), F.lit(0.75)), F.lit(accuracy))
    out = rows.groupBy(group).agg(F.count(speed).alias("road_speed_sample_count"), q.alias("q"))
    return out.select(group, "road_speed_sample_count", F.get("q", F.lit(0)).alias("road_speed_q1_kmh"), F.get("q", F.lit(1)).alias("road_speed_q3_kmh"))


def flag_outliers(df: DataFrame, stats: DataFrame, p: Params, group: str = "road_feature_id", speed: str = "calc_speed_kmh") -> DataFrame:
    """High outliers: above q3 plus a multiple of the quartiles' distance, in groups with enough support."""
    spread = F.col("road_speed_q3_kmh") - F.col("road_speed_q1_kmh")
    out = df.join(stats, group, "left").withColumn("road_speed_iqr_kmh", spread)
    limit = F.when(F.col("road_speed_sample_count") >= p.iqr_min_group, F.col("road_speed_q3_kmh") + p.iqr_multiplier * F.col("road_speed_iqr_kmh"))
    out = out.withColumn("high_speed_outlier_threshold_kmh", limit)
    return out.withColumn("is_high_speed_iqr_outlier", F.coalesce(F.col(speed) > F.col("high_speed_outlier_threshold_kmh"), F.lit(False)))
