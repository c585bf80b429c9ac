"""What lies between the stages: eligible speeds, the rows and profiles of gold, summaries of bronze, samples, coercions and scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.functions import roads as tags
from velograph.functions.telemetry import speed_is_eligible
from velograph.operators import profiles, reports
from velograph.params import Params
from velograph.plans.q_profiles import LABELS_SQL, labelled
from velograph.plans.standins import OBSERVATIONS_SQL, POINTS_SQL, points, table

P = Params()
QUERIES, ORACLES = {}, {}


def add(name, sql):
    def hold(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return hold


@add("eligible_speeds", f"""WITH {POINTS_SQL}, v AS (SELECT point_id, raw_speed * 0.036 AS v FROM pts)
SELECT 'gps_speed' AS mode, count(*) AS n, count(CASE WHEN v >= 0 THEN 1 END) AS eligible FROM v UNION ALL SELECT 'displacement', count(*), count(CASE WHEN v BETWEEN 0 AND 150 THEN 1 END) FROM v""")
def eligible_speeds(spark, sf_dir):
    """Both modes: any speed from 0 on, or a range."""
    rows = points(spark, sf_dir).select((F.col("raw_speed") * 0.036).alias("calc_speed_kmh"))
    count = lambda mode: rows.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"), reports.tally(speed_is_eligible(Params(speed_source=mode))).alias("eligible"))
    return count("gps_speed").unionByName(count("displacement"))


#: lineitem as matched points: flags, labels of the road's reference, and the hour of the order's number.
_MATCHED = """mat AS (SELECT *, point_id % 5 <> 0 AS near, point_id % 7 = 0 AS far_out, CASE WHEN point_id % 3 = 0 THEN 'OSM_NUMERIC_KMH' ELSE 'IMPUTED_HIGHWAY_DEFAULT' END AS ref_source,
CASE WHEN point_id % 2 = 0 THEN 'LIGHT_ON_SOUND_ON' ELSE 'SIGNAL_MISSING' END AS signal_mode, CASE WHEN point_id % 11 = 0 THEN 'UNKNOWN_WEATHER' ELSE 'FOG_OR_LOW_VISIBILITY' END AS weather_category FROM lab)"""


def matched(spark, sf_dir):
    k = F.col("point_id")
    return labelled(spark, sf_dir).drop("day_name", "month_name", "time_of_day", "spatial_scope", "observation_date").withColumns({
        "within_primary_match_radius": k % 5 != 0, "is_high_speed_iqr_outlier": k % 7 == 0, "inside_study_aoi": F.col("inside"),
        "operating_speed_reference_source": F.when(k % 3 == 0, "OSM_NUMERIC_KMH").otherwise("IMPUTED_HIGHWAY_DEFAULT"),
        "signal_mode": F.when(k % 2 == 0, "LIGHT_ON_SOUND_ON").otherwise("SIGNAL_MISSING"), "weather_category": F.when(k % 11 == 0, "UNKNOWN_WEATHER").otherwise("FOG_OR_LOW_VISIBILITY"),
    })


@add("gold_observations", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, {_MATCHED}
SELECT spatial_scope, time_of_day, month_name, day_name, count(*) AS n, count(DISTINCT CAST(timestamp_local AS DATE)) AS days FROM mat WHERE near AND NOT far_out GROUP BY ALL""")
def gold_observations(spark, sf_dir):
    """The rows that profiles count, by their labels."""
    rows = profiles.observations(matched(spark, sf_dir), P)
    return rows.groupBy("spatial_scope", "time_of_day", "month_name", "day_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("observation_date").alias("days"))


@add("gold_observations_sensitivity", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, {_MATCHED} SELECT near, far_out, count(*) AS n FROM mat GROUP BY ALL""")
def gold_observations_sensitivity(spark, sf_dir):
    """Both filters switched off."""
    rows = profiles.observations(matched(spark, sf_dir), Params(keep_sensitivity_only=True, drop_outliers=False))
    return rows.groupBy(F.col("within_primary_match_radius").alias("near"), F.col("is_high_speed_iqr_outlier").alias("far_out")).agg(F.count(F.lit(1)).alias("n"))


_KEYS = "road_feature_id, operating_speed_reference_kmh, ref_source, travel_direction, signal_mode, weather_category, spatial_scope"
_TEMPORAL = {"season": "season", "month": "season, month, month_name", "weekday": "day_of_week_iso, day_name, is_weekend", "time_of_day": "time_of_day", "flat": "season, month, month_name, day_of_week_iso, day_name, is_weekend, time_of_day"}


def _gold_sql(name: str) -> str:
    return f"""SELECT '{name}' AS profile, count(*) AS n_rows, sum(n)::BIGINT AS n_samples, sum(s)::BIGINT AS sources, sum(d)::BIGINT AS days, sum(m)::BIGINT AS methods, sum(q50)::BIGINT AS medians, sum(q85)::BIGINT AS p85s, count(CASE WHEN n >= 10 THEN 1 END) AS supported
FROM (SELECT count(*) AS n, count(DISTINCT source_entity_id) AS s, count(DISTINCT CAST(timestamp_local AS DATE)) AS d, count(DISTINCT speed_source) AS m, quantile_disc(calc_speed_kmh, 0.5) AS q50, quantile_disc(calc_speed_kmh, 0.85) AS q85
FROM mat WHERE near AND NOT far_out GROUP BY {_KEYS}, {_TEMPORAL[name]})"""


@add("gold_profiles", f"WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, {_MATCHED} " + " UNION ALL ".join(map(_gold_sql, _TEMPORAL)))
def gold_profiles(spark, sf_dir):
    """All five profiles of gold, from one table of speed counts and one of labels; a row of sums for each."""
    made = profiles.all_profiles(profiles.observations(matched(spark, sf_dir), P), P)
    whole = lambda c: F.sum(F.col(c).cast("long"))

    def sums(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("profile"), F.count(F.lit(1)).alias("n_rows"), whole("n_samples").alias("n_samples"), whole("n_unique_source_ids").alias("sources"), whole("n_unique_observation_days").alias("days"),
            whole("n_speed_derivation_methods").alias("methods"), whole("median_speed_kmh").alias("medians"), whole("p85_speed_kmh").alias("p85s"), reports.tally(F.col("meets_min_sample_count")).alias("supported"),
        )

    return reduce(DataFrame.unionByName, (sums(n, df) for n, df in made.items()))


@add("bronze_summary", f"WITH {POINTS_SQL} SELECT count(*) AS n, epoch(min(date_trunc('second', timestamp_utc)))::BIGINT AS first_epoch, epoch(max(date_trunc('second', timestamp_utc)))::BIGINT AS last_epoch FROM pts")
def bronze_summary(spark, sf_dir):
    return reports.layer_summary(points(spark, sf_dir))


@add("bronze_coverage", """SELECT 'year_month' AS report_type, year(ts) || '-' || month(ts) AS category, count(*) AS count FROM events GROUP BY ALL UNION ALL SELECT 'source', user_id::VARCHAR, count(*) FROM events GROUP BY ALL""")
def bronze_coverage(spark, sf_dir):
    rows = points(spark, sf_dir).select(F.concat_ws("-", F.year("timestamp_utc"), F.month("timestamp_utc")).alias("year_month"), F.col("source_entity_id").cast("string").alias("source"))
    part = lambda c: reports.coverage(rows, c, c).withColumnRenamed(c, "category")
    return part("year_month").unionByName(part("source"))


@add("strata_count", "SELECT count(DISTINCT (event_type, month(ts))) AS strata FROM events")
def strata_count(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type"), F.month("ts").alias("month")).distinct().agg(F.count(F.lit(1)).alias("strata"))


_TEXTS = ("12", " 7.5 ", "1e3", "x", "", None, "-4", "NaN km")


@add("numeric_coercion", "SELECT event_id, CASE event_id % 8 WHEN 0 THEN 12 WHEN 1 THEN 7.5 WHEN 2 THEN 1000 WHEN 6 THEN -4 END::DOUBLE AS value FROM events")
def numeric_coercion(spark, sf_dir):
    """Text to numbers; what is none becomes null."""
    text = F.get(F.array(*[F.lit(x).cast("string") for x in _TEXTS]), (F.col("event_id") % 8).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", text.try_cast("double").alias("value"))


@add("first_of_list", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'residential' WHEN 1 THEN p_brand WHEN 2 THEN 'none' ELSE 'none' END AS highway FROM part")
def first_of_list(spark, sf_dir):
    """Tags that came as lists: the first, or a default where there is none."""
    k, none = F.col("p_partkey") % 4, F.lit(None).cast("array<string>")
    values = F.when(k == 0, F.array(F.lit("residential"), F.lit("service"))).when(k == 1, F.array("p_brand")).when(k == 2, F.array().cast("array<string>")).otherwise(none)
    return table(spark, sf_dir, "part").select("p_partkey", tags.first_of(values, F.lit("none")).alias("highway"))


@add("road_class_filter", "SELECT p_partkey FROM part WHERE p_partkey % 5 IN (0, 1, 3)")
def road_class_filter(spark, sf_dir):
    kind = F.get(F.array(*map(F.lit, ("motorway_link", "living_street", "footway", "unclassified", "cycleway"))), (F.col("p_partkey") % 5).cast("int"))
    return table(spark, sf_dir, "part").filter(tags.is_road_class(kind)).select("p_partkey")


@add("feature_ids", "SELECT p_partkey, 'osm:' || p_partkey || ':' || p_size || ':0:' || substr(sha256(p_name || ':' || p_brand), 1, 16) AS feature_id FROM part")
def feature_ids(spark, sf_dir):
    content = F.concat_ws(":", "p_name", "p_brand").cast("binary")
    return table(spark, sf_dir, "part").select("p_partkey", tags.feature_id(F.col("p_partkey"), F.col("p_size"), F.lit(0), content).alias("feature_id"))


@add("multi_path_scan", "SELECT n_regionkey, count(*) AS n FROM (SELECT n_regionkey FROM nation UNION ALL SELECT n_regionkey FROM nation) GROUP BY 1")
def multi_path_scan(spark, sf_dir):
    """Several paths as one scan."""
    return spark.read.parquet(*[f"{sf_dir}/nation.parquet"] * 2).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@add("first_row", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 1")
def first_row(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy("ts", "event_id").limit(1).select("event_id", "user_id")
