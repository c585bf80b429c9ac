"""Profiles, outliers, roll-ups and reconciliation over observations."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from velograph.functions.roads import coverage_class
from velograph.functions.telemetry import spatial_scope
from velograph.functions.timeparts import calendar, day_name, month_name, month_start, time_of_day
from velograph.operators import enrich, profiles, reports
from velograph.params import Params
from velograph.plans.standins import OBSERVATIONS_SQL, observations, table

P = Params()
QUERIES, ORACLES = {}, {}
COMMON = ("road_feature_id", "travel_direction", "spatial_scope", "operating_speed_reference_kmh")

# exact half-up rounding from whole sums
_MEAN = "(((200 * sum(CASE WHEN {c} THEN calc_speed_kmh::BIGINT END) + count(CASE WHEN {c} THEN 1 END)) // (2 * count(CASE WHEN {c} THEN 1 END)))::DOUBLE / 100)"
MEASURES_SQL = f"""{_MEAN.format(c="true")} AS avg_travel_speed_kmh, {_MEAN.format(c="calc_speed_kmh > 2")} AS avg_running_speed_kmh,
quantile_disc(calc_speed_kmh, 0.5) AS median_speed_kmh, quantile_disc(calc_speed_kmh, 0.85) AS p85_speed_kmh, round(stddev_samp(calc_speed_kmh), 2) AS stddev_speed_kmh,
count(point_id) AS n_samples, count(DISTINCT source_entity_id) AS n_unique_source_ids, count(DISTINCT observation_date) AS n_unique_observation_days,
count(DISTINCT speed_source) AS n_speed_derivation_methods,
((20000 * count(CASE WHEN calc_speed_kmh <= 2 THEN 1 END) + count(*)) // (2 * count(*)))::DOUBLE / 10000 AS stopped_observation_ratio"""
LABELS_SQL = """lab AS (SELECT *, CASE WHEN inside THEN 'OFFICIAL_BOUNDING_BOX' ELSE 'EXTENDED_PROCESSING_AREA' END AS spatial_scope, month(timestamp_local)::INT AS month,
isodow(timestamp_local)::INT AS day_of_week_iso, isodow(timestamp_local) >= 6 AS is_weekend, monthname(timestamp_local) AS month_name, dayname(timestamp_local) AS day_name,
CASE WHEN month(timestamp_local) IN (12, 1, 2) THEN 'WINTER' WHEN month(timestamp_local) IN (3, 4, 5) THEN 'SPRING' WHEN month(timestamp_local) IN (6, 7, 8) THEN 'SUMMER' ELSE 'AUTUMN' END AS season,
CASE WHEN point_id % 24 BETWEEN 7 AND 9 THEN 'PEAK_MORNING' WHEN point_id % 24 BETWEEN 10 AND 14 THEN 'OFF_PEAK_DAY' WHEN point_id % 24 BETWEEN 15 AND 18 THEN 'PEAK_EVENING' ELSE 'NIGHT' END AS time_of_day FROM obs)"""
KEYS = {"season": ("season",), "month": ("season", "month", "month_name"), "weekday": ("day_of_week_iso", "day_name", "is_weekend"), "time_of_day": ("time_of_day",), "flat": ("season", "month", "month_name", "day_of_week_iso", "day_name", "is_weekend", "time_of_day")}


def labelled(spark, sf_dir):
    """Observations with their temporal labels; the hour is taken from the order's number, as ship dates have none."""
    df = calendar(observations(spark, sf_dir), "timestamp_local").withColumn("hour", (F.col("point_id") % 24).cast("int"))
    return df.withColumns({"day_name": day_name(F.col("day_of_week_iso")), "month_name": month_name(F.col("month")), "time_of_day": time_of_day(F.col("hour")), "spatial_scope": spatial_scope(F.col("inside"), P)})


def profile_query(name, spark, sf_dir):
    keys = COMMON if name != "flat" else COMMON[:1] + COMMON[3:]
    return profiles.profile(labelled(spark, sf_dir), (*keys, *KEYS[name]), P, exact_decimals=0)


for _name, _keys in KEYS.items():
    _all = ", ".join((COMMON if _name != "flat" else COMMON[:1] + COMMON[3:]) + _keys)
    QUERIES[f"profile_{_name}"] = partial(profile_query, _name)
    ORACLES[f"profile_{_name}"] = f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, p AS (SELECT {_all}, {MEASURES_SQL} FROM lab GROUP BY {_all})
SELECT *, round(avg_travel_speed_kmh - operating_speed_reference_kmh, 2) AS delta_operating_speed_reference_kmh, n_samples >= 10 AS meets_min_sample_count, 10::INT AS min_sample_count FROM p"""


def add(name, sql):
    def hold(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return hold


@add("profile_grouping_sets", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}
SELECT road_feature_id, season, time_of_day, count(*) AS n_samples, count(DISTINCT source_entity_id) AS n_sources, sum(calc_speed_kmh::BIGINT)::BIGINT AS total
FROM lab GROUP BY GROUPING SETS ((road_feature_id, season), (road_feature_id, time_of_day), (road_feature_id))""")
def profile_grouping_sets(spark, sf_dir):
    """Marginal profiles in one plan."""
    rows = labelled(spark, sf_dir)
    c = F.col
    sets = [[c("road_feature_id"), c("season")], [c("road_feature_id"), c("time_of_day")], [c("road_feature_id")]]
    return rows.groupingSets(sets, "road_feature_id", "season", "time_of_day").agg(F.count(F.lit(1)).alias("n_samples"), F.count_distinct("source_entity_id").alias("n_sources"), F.sum(c("calc_speed_kmh").cast("long")).alias("total"))


_SEASON = f"WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, p AS (SELECT road_feature_id, season, {MEASURES_SQL} FROM lab GROUP BY road_feature_id, season)"


def season_profile(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return profiles.summarise(rows, ("road_feature_id", "season"), P, exact_decimals=0).withColumn("meets_min_sample_count", F.col("n_samples") >= 600)


@add("support_rollup", _SEASON + " SELECT road_feature_id, sum(n_samples)::BIGINT AS n_samples, bool_or(n_samples >= 600) AS supported FROM p GROUP BY road_feature_id")
def support_rollup(spark, sf_dir):
    return reports.support_rollup(season_profile(spark, sf_dir))


@add("coverage_class", _SEASON + """, r AS (SELECT road_feature_id, sum(n_samples)::BIGINT AS n, bool_or(n_samples >= 600) AS ok FROM p WHERE season <> 'WINTER' GROUP BY road_feature_id),
b AS (SELECT DISTINCT p_brand AS road_feature_id FROM part UNION SELECT 'Brand#none')
SELECT road_feature_id, coalesce(n, 0) AS n_samples, CASE WHEN coalesce(n, 0) = 0 THEN 'NONE' WHEN ok THEN 'SUPPORTED' ELSE 'OBSERVED' END AS coverage FROM b LEFT JOIN r USING (road_feature_id)""")
def coverage(spark, sf_dir):
    base = table(spark, sf_dir, "part").select(F.col("p_brand").alias("road_feature_id")).union(spark.sql("SELECT 'Brand#none'")).distinct()
    got = base.join(reports.support_rollup(season_profile(spark, sf_dir).filter("season <> 'WINTER'")), "road_feature_id", "left")
    return got.select("road_feature_id", F.coalesce("n_samples", F.lit(0)).alias("n_samples"), coverage_class(F.col("n_samples"), F.col("supported")).alias("coverage"))


@add("profile_coverage", _SEASON + """ SELECT count(*) AS n_rows, sum(n_samples)::BIGINT AS n_samples, count(DISTINCT road_feature_id) AS n_roads, count(CASE WHEN n_samples >= 600 THEN 1 END) AS supported_rows,
count(DISTINCT CASE WHEN n_samples >= 600 THEN road_feature_id END) AS supported_roads, round(avg((n_samples >= 600)::INT), 6) AS supported_share FROM p""")
def profile_coverage(spark, sf_dir):
    return reports.profile_coverage(season_profile(spark, sf_dir)).withColumn("supported_share", F.round("supported_share", 6))


@add("weighted_mean", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, c AS (SELECT season, time_of_day, calc_speed_kmh::BIGINT AS v, count(*) AS n FROM lab GROUP BY ALL)
SELECT season, round(sum(v * n)::DOUBLE / sum(n)::DOUBLE, 6) AS weighted_mean, sum(n)::BIGINT AS weight FROM c GROUP BY season""")
def weighted_mean(spark, sf_dir):
    counts = labelled(spark, sf_dir).groupBy("season", "time_of_day", F.col("calc_speed_kmh").cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return reports.weighted_mean(counts, "v", "n", "season").withColumn("weighted_mean", F.round("weighted_mean", 6))


@add("monthly_rollup", f"WITH {OBSERVATIONS_SQL} SELECT CAST(make_date(year(timestamp_local), month(timestamp_local), 1) AS VARCHAR) AS month_start, count(*) AS n, sum(calc_speed_kmh::BIGINT)::BIGINT AS total FROM obs GROUP BY 1")
def monthly_rollup(spark, sf_dir):
    rows = observations(spark, sf_dir)
    first = month_start(F.year("timestamp_local"), F.month("timestamp_local")).cast("string")
    return rows.groupBy(first.alias("month_start")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("calc_speed_kmh").cast("long")).alias("total"))


_BANDS = ("PEAK_MORNING", "OFF_PEAK_DAY", "PEAK_EVENING", "NIGHT", "NEVER")


@add("category_reindex", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, k(time_of_day, position) AS (VALUES ('PEAK_MORNING', 0), ('OFF_PEAK_DAY', 1), ('PEAK_EVENING', 2), ('NIGHT', 3), ('NEVER', 4))
SELECT time_of_day, position::INT AS position, coalesce(n, 0) AS n FROM k LEFT JOIN (SELECT time_of_day, count(*) AS n FROM lab GROUP BY 1) USING (time_of_day)""")
def category_reindex(spark, sf_dir):
    return reports.over_categories(labelled(spark, sf_dir).groupBy("time_of_day").agg(F.count(F.lit(1)).alias("n")), "time_of_day", _BANDS)


_STATS = f"WITH {OBSERVATIONS_SQL}, st AS (SELECT l_partkey, count(calc_speed_kmh) AS road_speed_sample_count, quantile_disc(calc_speed_kmh, 0.25) AS road_speed_q1_kmh, quantile_disc(calc_speed_kmh, 0.75) AS road_speed_q3_kmh FROM obs GROUP BY l_partkey)"


@add("group_iqr_stats", _STATS + " SELECT * FROM st")
def group_iqr_stats(spark, sf_dir):
    return enrich.group_speed_stats(observations(spark, sf_dir), "l_partkey")


@add("iqr_outliers", _STATS + """, f AS (SELECT l_partkey, point_id, calc_speed_kmh, road_speed_q3_kmh + 0.5 * (road_speed_q3_kmh - road_speed_q1_kmh) AS t, road_speed_sample_count AS n FROM obs JOIN st USING (l_partkey))
SELECT l_partkey, count(*) AS n_rows, count(CASE WHEN n >= 20 AND calc_speed_kmh > t THEN 1 END) AS n_outliers, max(CASE WHEN n >= 20 THEN t END) AS threshold FROM f GROUP BY l_partkey""")
def iqr_outliers(spark, sf_dir):
    p = Params(iqr_multiplier=0.5)
    rows = observations(spark, sf_dir)
    flagged = enrich.flag_outliers(rows, enrich.group_speed_stats(rows, "l_partkey"), p, "l_partkey")
    return flagged.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_rows"), reports.tally(F.col("is_high_speed_iqr_outlier")).alias("n_outliers"), F.max("high_speed_outlier_threshold_kmh").alias("threshold"))


@add("histogram_counts", """WITH h AS (SELECT floor(l_extendedprice / 500)::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY 1)
SELECT bin, n, sum(n) OVER (ORDER BY bin)::BIGINT AS cumulative FROM h""")
def histogram_counts(spark, sf_dir):
    return reports.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 500)


@add("histogram_percentile", """WITH h AS (SELECT floor(l_extendedprice / 500)::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS cum FROM h),
w AS (SELECT share::DOUBLE AS share, share::DOUBLE * (SELECT sum(n)::BIGINT - 1 FROM h) AS rank FROM (VALUES (0.05), (0.5), (0.95)) v(share)),
e AS (SELECT share, rank, (SELECT min(bin) FROM c WHERE cum > floor(rank)) AS lo, (SELECT min(bin) FROM c WHERE cum > ceil(rank)) AS hi FROM w)
SELECT share, round((lo + 0.5) * 500 + (hi - lo) * 500 * (rank - floor(rank)), 3) AS value FROM e""")
def histogram_percentile(spark, sf_dir):
    bins = reports.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 500)
    return reports.histogram_percentiles(bins, (0.05, 0.5, 0.95), 500).withColumn("value", F.round("value", 3))


@add("distance_summary", """SELECT count(*) AS n_rows, count(l_quantity) AS n, min(l_quantity) AS least, max(l_quantity) AS most, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS deviation,
round(count(CASE WHEN l_quantity <= 15 THEN 1 END)::DOUBLE / count(*), 6) AS share_le_15, round(count(CASE WHEN l_quantity <= 40 THEN 1 END)::DOUBLE / count(*), 6) AS share_le_40 FROM lineitem""")
def distance_summary(spark, sf_dir):
    df = reports.distance_summary(table(spark, sf_dir, "lineitem"), "l_quantity", (15.0, 40.0))
    return df.select(*[F.round(c, 6).alias(c) if c in ("mean", "deviation") or c.startswith("share") else F.col(c) for c in df.columns])


@add("exact_percentile", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1")
def exact_percentile(spark, sf_dir):
    df = reports.exact_percentiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.5, 0.9, 0.95), "l_returnflag")
    return df.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p95")])


@add("two_source_comparison", """WITH j AS (SELECT o_orderpriority, year(o_orderdate)::INT AS year, date_diff('day', o_orderdate, l_shipdate)::BIGINT AS a, l_quantity::BIGINT AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderpriority, year, count(*) AS overlap_count, round(avg(a - b), 6) AS mean_signed_difference_kmh, quantile_disc(abs(a - b), 0.5)::BIGINT AS median_absolute_difference_kmh, quantile_disc(abs(a - b), 0.95)::BIGINT AS p95_absolute_difference_kmh FROM j GROUP BY ALL""")
def two_source_comparison(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select("o_orderpriority", F.year("o_orderdate").alias("year"), F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("long").alias("a"), F.col("l_quantity").cast("long").alias("b"))
    found = reports.two_speed_comparison(rows, ("o_orderpriority", "year"), "a", "b", exact=True).withColumn("mean_signed_difference_kmh", F.round("mean_signed_difference_kmh", 6))
    return found.withColumns({c: F.col(c).cast("long") for c in ("median_absolute_difference_kmh", "p95_absolute_difference_kmh")})


@add("bottom_k_strata", """WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY sha256(event_id::VARCHAR)) AS r, sha256(event_id::VARCHAR) AS point_id FROM events)
SELECT event_type, event_id, point_id FROM r WHERE r <= 10""")
def bottom_k_strata(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("point_id"))
    return reports.bottom_k(rows, 10, ("event_type",), "point_id")


@add("orphans_anti", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 10 = 0)")
def orphans_anti(spark, sf_dir):
    """Customers without any order whose key ends in 0: planted orphans, as every customer has an order."""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 10 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return reports.orphans(table(spark, sf_dir, "customer"), orders, "c_custkey").select("c_custkey", "c_nationkey")


@add("duplicate_keys", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return reports.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@add("vocab_violations", """WITH v AS (SELECT 'l_returnflag' AS "column", l_returnflag AS x FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') UNION SELECT 'l_linestatus', l_linestatus FROM lineitem WHERE l_linestatus NOT IN ('O', 'F'))
SELECT "column", array_to_string(list_sort(list(DISTINCT x))[1:5], ',') AS "values" FROM v GROUP BY 1""")
def vocab_violations(spark, sf_dir):
    found = reports.unexpected_values(table(spark, sf_dir, "lineitem"), {"l_returnflag": ("A", "N"), "l_linestatus": ("O", "F")})
    return found.withColumn("values", F.array_join("values", ","))


@add("sum_reconciliation", """WITH a AS (SELECT count(*) AS n FROM lineitem), t AS (SELECT sum(c)::BIGINT AS v FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag) UNION ALL SELECT sum(c)::BIGINT FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_linestatus, l_linenumber))
SELECT count(*) AS n_tables, min(v) AS least, max(v) AS most, min(v) = max(v) AS agree FROM t""")
def sum_reconciliation(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1)).alias("n_samples")
    return reports.sums_agree(reports.table_totals({"flag": li.groupBy("l_returnflag").agg(n), "status": li.groupBy("l_linestatus", "l_linenumber").agg(n)}))


@add("table_totals", """SELECT 'flag_rows' AS metric, count(*)::BIGINT AS value FROM (SELECT DISTINCT l_returnflag FROM lineitem) UNION ALL SELECT 'flag_sample_sum', count(*)::BIGINT FROM lineitem""")
def table_totals(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return reports.table_totals({"flag": li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_samples"))})


@add("scope_sums", f"WITH {OBSERVATIONS_SQL}, {LABELS_SQL} SELECT spatial_scope, count(*) AS n_samples FROM lab GROUP BY 1")
def scope_sums(spark, sf_dir):
    return labelled(spark, sf_dir).groupBy("spatial_scope").agg(F.count(F.lit(1)).alias("n_samples"))


@add("structural_checks", f"""WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, p AS (SELECT road_feature_id, season, operating_speed_reference_kmh, count(*) AS n, count(DISTINCT source_entity_id) AS s FROM lab GROUP BY ALL)
SELECT 0::BIGINT AS n_samples_below_one, count(CASE WHEN s > n THEN 1 END) AS sources_exceed_samples, 0::BIGINT AS days_exceed_samples, 0::BIGINT AS ratio_out_of_range,
count(CASE WHEN (n >= 10) <> (n >= 12) THEN 1 END) AS support_flag_mismatch, 0::BIGINT AS delta_mismatch,
(SELECT count(*) FROM (SELECT 1 FROM p GROUP BY road_feature_id, season HAVING count(*) > 1)) AS repeated_keys FROM p""")
def structural_checks(spark, sf_dir):
    """A profile with a wrong support flag, checked against another parameter."""
    rows = profiles.profile(labelled(spark, sf_dir), ("road_feature_id", "season", "operating_speed_reference_kmh"), P, exact_decimals=0)
    return reports.structural_violations(rows, Params(min_samples=12), ("road_feature_id", "season"))


@add("null_counts", """SELECT 'lat' AS "column", count(CASE WHEN event_id % 50 = 0 THEN 1 END) AS nulls FROM events UNION ALL SELECT 'event_id', 0::BIGINT""")
def null_counts(spark, sf_dir):
    return reports.null_counts(table(spark, sf_dir, "events").select(F.expr("CASE WHEN event_id % 50 = 0 THEN NULL ELSE 1 END").alias("lat"), "event_id"))


@add("category_counts", "SELECT event_type, count(*) AS count, 'event_type' AS report_type FROM events GROUP BY 1")
def category_counts(spark, sf_dir):
    return reports.coverage(table(spark, sf_dir, "events"), "event_type", "event_type")


@add("log_bins", "SELECT CASE WHEN c >= 3 THEN '3+' ELSE c::VARCHAR END AS bin, round(log10(count(*)), 9) AS log_n FROM (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1) GROUP BY 1")
def log_bins(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy(F.when(F.col("c") >= 3, "3+").otherwise(F.col("c").cast("string")).alias("bin")).agg(F.round(F.log10(F.count(F.lit(1))), 9).alias("log_n"))


@add("label_accuracy", "SELECT count(*) AS reviewed, round(avg(quality), 6) AS accuracy FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL")
def label_accuracy(spark, sf_dir):
    got = reports.label_accuracy(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", "quality")
    return got.withColumn("accuracy", F.round("accuracy", 6))


@add("profile_join_roads", """SELECT p_partkey, p_brand, p_type, n FROM part JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey WHERE p_size <= 10""")
def profile_join_roads(spark, sf_dir):
    """Roads joined with a filtered profile, as a consumer would."""
    counts = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    part = table(spark, sf_dir, "part").filter("p_size <= 10")
    return part.join(counts, part["p_partkey"] == counts["l_partkey"]).select("p_partkey", "p_brand", "p_type", "n")


@add("flat_with_roads", """WITH f AS (SELECT l_partkey AS road_feature_id, count(*) AS n_samples FROM lineitem GROUP BY 1)
SELECT road_feature_id, n_samples, p_name AS name, p_size FROM f LEFT JOIN part ON p_partkey = road_feature_id""")
def flat_with_roads(spark, sf_dir):
    flat = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("road_feature_id")).agg(F.count(F.lit(1)).alias("n_samples"))
    roads = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("road_feature_id"), F.col("p_name").alias("name"), "p_size")
    return profiles.flat_with_roads(flat, roads)
