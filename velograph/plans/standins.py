"""The supplied tables in the roles of telemetry, roads and observations, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Expressions that mean the same in both dialects; the place of a point is a whole number of metres.
POINT = {
    "point_id": "event_id",
    "source_entity_id": "user_id",
    "x": "CAST((event_id * 7919) % 2999 AS DOUBLE)",
    "y": "CAST((event_id * 104729) % 3001 AS DOUBLE)",
    "raw_speed": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1.0 ELSE CAST((event_id * 31) % 5000 AS DOUBLE) END",
    "lights": "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 3 END AS INT)",
    "sound": "CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 2 END AS INT)",
    "lat": "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 51 = 0 THEN 0.0 WHEN event_id % 53 = 0 THEN 95.5 ELSE CAST(49850 + event_id % 450 AS DOUBLE) / 1000 END",
    "lon": "CASE WHEN event_id % 57 = 0 THEN NULL ELSE CAST(19600 + (event_id * 7) % 800 AS DOUBLE) / 1000 END",
}
SEGMENT = {
    "match_segment_id": "p_partkey",
    "road_feature_id": "p_partkey % 400",
    "x1": "CAST((p_partkey * 6007) % 2999 AS DOUBLE)",
    "y1": "CAST((p_partkey * 3571) % 3001 AS DOUBLE)",
    "x2": "CAST((p_partkey * 6007) % 2999 + p_size * 4 - 100 AS DOUBLE)",
    "y2": "CAST((p_partkey * 3571) % 3001 + (p_partkey % 41) * 5 - 97 AS DOUBLE)",
}
OBSERVATION = {
    "road_feature_id": "p_brand",
    "operating_speed_reference_kmh": "CAST(20 + LENGTH(p_type) AS INT)",
    "travel_direction": "CASE WHEN l_linestatus = 'O' THEN 'FORWARD' ELSE 'BACKWARD' END",
    "calc_speed_kmh": "l_quantity",
    "point_id": "l_orderkey",
    "source_entity_id": "l_suppkey",
    "observation_date": "CAST(l_shipdate AS DATE)",
    "speed_source": "l_returnflag",
    "inside": "l_discount > 0.05",
}


def select_sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as points: POINT, and timestamp_utc."""
    df = table(spark, sf_dir, "events")
    return df.select(*[F.expr(e).alias(n) for n, e in POINT.items()], F.col("ts").cast("timestamp").alias("timestamp_utc"), "event_type", "value", "props")


POINTS_SQL = "pts AS (" + select_sql(POINT, "events").replace(" FROM events", ", ts AS timestamp_utc, event_type, value, props FROM events") + ")"


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*[F.expr(e).alias(n) for n, e in SEGMENT.items()])


SEGMENTS_SQL = "seg AS (" + select_sql(SEGMENT, "part") + ")"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations of roads (part), which bring the reference speed by an inner join."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rows = li.join(part, li["l_partkey"] == part["p_partkey"])
    return rows.select(*[F.expr(e).alias(n) for n, e in OBSERVATION.items()], F.col("l_shipdate").cast("timestamp").alias("timestamp_local"), "l_partkey")


OBSERVATIONS_SQL = "obs AS (" + select_sql(OBSERVATION, "lineitem JOIN part ON l_partkey = p_partkey").replace(" FROM lineitem", ", l_shipdate AS timestamp_local, l_partkey FROM lineitem") + ")"
