"""Attrition, summaries, distributions, reconciliation and roll-ups; every report is one declarative plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velograph.params import Params


def tally(condition: Column) -> Column:
    """How many rows meet a condition; 0 for no rows."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


# --- attrition ----------------------------------------------------------------------------------------------------------


def attrition(p: Params) -> dict[str, Column]:
    """Counts over flagged raw rows (see telemetry.flag_rows), by name."""
    c = F.col
    ok, known = c("physically_valid_coordinate"), c("timestamp_utc").isNotNull()
    reasons = {f"coordinate_{r.lower()}_rows": tally(c("coordinate_reject_reason") == r) for r in ("NULL_FIELD", "ZERO_COORDINATE", "OUT_OF_WORLD_RANGE")}
    return {
        "raw_rows": F.count(F.lit(1)),
        "corrupt_rows": tally(c("_corrupt_record").isNotNull()),
        "missing_identifier_rows": tally(~c("valid_identifier")),
        "invalid_coordinate_rows": tally(~ok),
        **reasons,
        "swapped_lat_lon_suspect_rows": tally(c("swapped_lat_lon_suspect")),
        "invalid_timestamp_rows": tally(~known),
        "outside_period_rows": tally(known & ~c("within_expected_period")),
        "gps_timestamp_rows": tally(c("timestamp_source").startswith("GPS_TIME_UTC")),
        "etl_timestamp_rows": tally(c("timestamp_source").startswith("ETL_CZAS_LOCAL")),
        "timestamp_disagreement_rows": tally(c("timestamp_sources_disagree")),
        "inside_study_aoi_rows": tally(c("inside_study_aoi")),
        "outside_study_aoi_rows": tally(ok & ~c("inside_study_aoi")),
    }


def observe_attrition(flagged: DataFrame, p: Params, name: str = "attrition") -> tuple[DataFrame, Observation]:
    """flagged, and an observation that holds the counts once any action over it has run: no second pass."""
    seen = Observation(name)
    return flagged.observe(seen, *[e.alias(n) for n, e in attrition(p).items()]), seen


def as_rows(wide: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A row of counts as (name, value) rows."""
    return wide.unpivot([], [F.col(c).cast("long").alias(c) for c in wide.columns], name, value)


def coverage(df: DataFrame, report: str, *keys: str) -> DataFrame:
    """Counts by keys in the long form of the reports: report_type and category beside them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).withColumn("report_type", F.lit(report))


def layer_summary(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """One row: how many rows, and the first and last second."""
    at = F.unix_timestamp(ts)
    return df.agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_epoch"), F.max(at).alias("last_epoch"))


def silver_summary(silver: DataFrame, bronze_rows: int, usable_rows: int) -> DataFrame:
    """One row: how many points were read, usable, matched, within the primary radius, outliers and without weather."""
    return silver.agg(
        F.lit(bronze_rows).cast("long").alias("bronze_rows"), F.lit(usable_rows).cast("long").alias("usable_speed_rows"), F.count(F.lit(1)).alias("matched_rows"),
        tally(F.col("within_primary_match_radius")).alias("primary_radius_rows"), tally(~F.col("within_primary_match_radius")).alias("sensitivity_only_rows"),
        tally(F.col("is_high_speed_iqr_outlier")).alias("outlier_rows"), tally(F.col("weather_join_status") == "MISSING_WEATHER_HOUR").alias("missing_weather_rows"),
    )


def gold_reconciliation(silver: DataFrame, p: Params) -> DataFrame:
    """One row: how matched points divide into included ones and those left out, and why."""
    near, out = F.col("within_primary_match_radius"), F.col("is_high_speed_iqr_outlier")
    kept = near | F.lit(p.keep_sensitivity_only)
    dropped = out & F.lit(p.drop_outliers)
    return silver.agg(
        F.count(F.lit(1)).alias("silver_input_rows"), tally(near).alias("primary_radius_silver_rows"), tally(kept & ~dropped).alias("gold_included_rows"),
        tally(~near).alias("sensitivity_only_silver_rows"), tally(~kept).alias("excluded_sensitivity_only_rows"), tally(kept & dropped).alias("excluded_primary_high_speed_iqr_outlier_rows"),
    )


def table_totals(tables: dict[str, DataFrame], samples: str = "n_samples") -> DataFrame:
    """(metric, value): rows and sum of samples of each table."""
    one = lambda n, t: as_rows(t.agg(F.count(F.lit(1)).alias(f"{n}_rows"), F.coalesce(F.sum(samples), F.lit(0)).alias(f"{n}_sample_sum")))
    return reduce(DataFrame.unionByName, (one(n, t) for n, t in tables.items()))


def sums_agree(totals: DataFrame, suffix: str = "_sample_sum") -> DataFrame:
    """One row: whether all tables' sums are one number, with their count, least and most."""
    v = totals.filter(F.col("metric").endswith(suffix))
    return v.agg(F.count(F.lit(1)).alias("n_tables"), F.min("value").alias("least"), F.max("value").alias("most"), (F.min("value") == F.max("value")).alias("agree"))


def merge_counts(parts: list[DataFrame], keys: tuple[str, ...], value: str) -> DataFrame:
    """Counts of chunks to counts of the whole."""
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum(value).alias(value))


def two_speed_comparison(df: DataFrame, keys: tuple[str, ...], first: str = "gps_speed_kmh", second: str = "displacement_speed_kmh", accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """Of rows with both speeds: how many, mean signed and median and 95th percentile of absolute difference.

    exact: quantiles are the least values that as large a share doesn't exceed; a group holds its distinct differences then.
    """
    d = F.col(first) - F.col(second)
    disc = lambda share: F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY abs(`{first}` - `{second}`))")
    q = disc if exact else lambda share: F.percentile_approx(F.abs(d), F.lit(share), F.lit(accuracy))
    return df.filter(d.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("overlap_count"), F.avg(d).alias("mean_signed_difference_kmh"), q(0.5).alias("median_absolute_difference_kmh"), q(0.95).alias("p95_absolute_difference_kmh")
    )


# --- distributions ------------------------------------------------------------------------------------------------------


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """(bin, n, cumulative): fixed-width bins from 0."""
    bins = df.filter(F.col(value).isNotNull()).groupBy(F.floor(F.col(value) / width).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.withColumn("cumulative", F.sum("n").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))


def refuse_outside(df: DataFrame, value: str, most: float) -> None:
    """An error if any value lies outside 0 to most."""
    n = df.filter((F.col(value) < 0) | (F.col(value) > most) | F.isnan(F.col(value).cast("double"))).count()
    if n:
        raise ValueError(f"{n} values of {value} lie outside 0 to {most}")


def histogram_percentiles(bins: DataFrame, shares: tuple[float, ...], width: float) -> DataFrame:
    """(share, value): percentiles at rank share * (n - 1), interpolated between the middles of the bins of both neighbours.

    The histogram has few rows, whatever was counted.
    """
    total = bins.agg(F.sum("n").alias("total"))
    wanted = total.select(F.explode(F.array(*map(F.lit, shares))).alias("share"), "total")
    rank = F.col("share") * (F.col("total") - 1)
    wanted = wanted.select("share", rank.alias("rank")).select("share", "rank", F.explode(F.array(F.floor("rank"), F.ceil("rank"))).alias("place"))
    # the bin of a 0-based place is the first whose cumulative count exceeds it
    place = F.array_min(F.transform(F.filter("bins", lambda b: b["cumulative"] > F.col("place")), lambda b: b["bin"]))
    held = bins.agg(F.collect_list(F.struct("bin", "cumulative")).alias("bins"))
    middle = wanted.join(held).select("share", "rank", "place", ((place + 0.5) * width).alias("m"))
    out = middle.groupBy("share", "rank").agg(F.min_by("m", "place").alias("lo"), F.max_by("m", "place").alias("hi"))
    return out.select("share", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))).alias("value"))


def distance_summary(df: DataFrame, value: str, thresholds: tuple[float, ...]) -> DataFrame:
    """One row: count, least, most, mean, sample deviation (from sums), and the share within each threshold."""
    v = F.col(value)
    n, s, s2 = F.count(v), F.sum(v), F.sum(v * v)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), n.alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), (s / n).alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest((s2 - s * s / n) / (n - 1), F.lit(0.0)))).alias("deviation"),
        *[(tally(v <= t) / n).alias(f"share_le_{t:g}".replace(".", "_")) for t in thresholds],
    )


def exact_percentiles(df: DataFrame, value: str, shares: tuple[float, ...], *keys: str) -> DataFrame:
    """Percentiles with linear interpolation, in columns p<share in percent>."""
    return df.groupBy(*keys).agg(*[F.percentile(value, F.lit(s)).alias(f"p{round(100 * s)}") for s in shares])


def bottom_k(df: DataFrame, k: int, strata: tuple[str, ...], key: str) -> DataFrame:
    """The k rows of each stratum with the least keys; null keys and strata are left out. Top-k per task before the shuffle."""
    rows = df.dropna(subset=[key, *strata])
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(*strata).orderBy(key))).filter(F.col("__r") <= k).drop("__r")


# --- matches and labels -------------------------------------------------------------------------------------------------


def match_metrics(sample: DataFrame, p: Params) -> DataFrame:
    """(metric, value): sizes, means, quantiles and shares of matched points, and how often each invariant is broken."""
    c = F.col
    near = c("within_primary_match_radius")
    broken = {
        "distance_beyond_max_radius": c("dist_to_axis") > max(p.radii), "negative_distance": c("dist_to_axis") < 0,
        "primary_flag_mismatch": near != (c("dist_to_axis") <= p.primary_radius), "heading_alignment_out_of_range": ~c("heading_alignment_diff").between(0, 1.5707963267948966),
        "candidate_count_below_one": c("candidate_count") < 1, "negative_speed": c("calc_speed_kmh") < 0,
        "margin_without_runner_up": (c("candidate_count") <= 1) & c("dist_margin_m").isNotNull(),
    }
    wide = sample.agg(
        F.count(F.lit(1)).cast("double").alias("sample_rows"), F.avg("dist_to_axis").alias("distance_mean"),
        *[F.percentile("dist_to_axis", F.lit(s)).alias(f"distance_p{round(100 * s)}") for s in (0.5, 0.9, 0.95)],
        *[F.percentile("heading_alignment_diff", F.lit(s)).alias(f"heading_alignment_p{round(100 * s)}") for s in (0.5, 0.95)],
        F.avg(near.cast("double")).alias("primary_share"), F.avg((c("candidate_count") > 1).cast("double")).alias("ambiguous_share"),
        F.avg((c("weather_join_status") == "MATCHED").cast("double")).alias("weather_share"), F.avg(c("is_high_speed_iqr_outlier").cast("double")).alias("outlier_share"),
        *[tally(e).cast("double").alias(f"violation_{n}") for n, e in broken.items()],
        reduce(lambda a, b: a + b, (tally(e) for e in broken.values())).cast("double").alias("violations_total"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")


def as_label(text: Column) -> Column:
    """true/false from common spellings; null for anything else."""
    t = F.lower(F.trim(text.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y", "t"), True).when(t.isin("false", "0", "no", "n", "f"), False)


def label_accuracy(sample: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row: reviewed rows and the share that labels call right. Repeated keys and unreadable labels are refused."""
    if not labels.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"labels repeat a {key}")
    read = labels.select(key, as_label(F.col(label)).alias("__ok"), F.col(label).alias("__raw"))
    if not read.filter("__ok is null and __raw is not null").isEmpty():
        raise ValueError("labels that are neither true nor false")
    joined = sample.join(read.filter("__ok is not null"), key)
    return joined.agg(F.count(F.lit(1)).alias("reviewed"), F.avg(F.col("__ok").cast("double")).alias("accuracy"))


# --- checks -------------------------------------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(df: DataFrame, base: DataFrame, key: str) -> DataFrame:
    return df.join(base.select(key).distinct(), key, "left_anti")


def unexpected_values(df: DataFrame, allowed: dict[str, tuple[str, ...]], first: int = 5) -> DataFrame:
    """(column, values): of each column that holds values outside its vocabulary, the first few in order."""
    own = {c: v for c, v in allowed.items() if c in df.columns}
    found = df.agg(*[F.slice(F.sort_array(F.collect_set(F.when(~F.col(c).isin(*v), F.col(c).cast("string")))), 1, first).alias(c) for c, v in own.items()])
    return found.unpivot([], found.columns, "column", "values").filter(F.size("values") > 0)


def structural_violations(profile: DataFrame, p: Params, keys: tuple[str, ...]) -> DataFrame:
    """One row of counts: broken relations between the columns of a profile, and repeated keys."""
    c = F.col
    delta = c("avg_travel_speed_kmh") - c("operating_speed_reference_kmh")
    wide = profile.agg(
        tally(c("n_samples") < 1).alias("n_samples_below_one"), tally(c("n_unique_source_ids") > c("n_samples")).alias("sources_exceed_samples"),
        tally(c("n_unique_observation_days") > c("n_samples")).alias("days_exceed_samples"), tally(~c("stopped_observation_ratio").between(0, 1)).alias("ratio_out_of_range"),
        tally(c("meets_min_sample_count") != (c("n_samples") >= p.min_samples)).alias("support_flag_mismatch"),
        tally(F.abs(c("delta_operating_speed_reference_kmh") - delta) > 0.011 + 1e-5 * F.abs(delta)).alias("delta_mismatch"),
    )
    return wide.crossJoin(duplicate_keys(profile, *keys).agg(F.count(F.lit(1)).alias("repeated_keys")))


# --- roll-ups -----------------------------------------------------------------------------------------------------------


def support_rollup(profile: DataFrame, key: str = "road_feature_id") -> DataFrame:
    return profile.groupBy(key).agg(F.sum("n_samples").alias("n_samples"), F.bool_or("meets_min_sample_count").alias("supported"))


def profile_coverage(profile: DataFrame, key: str = "road_feature_id") -> DataFrame:
    """One row: rows, samples, roads, supported rows and roads, and the share of supported rows."""
    ok = F.col("meets_min_sample_count")
    return profile.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_samples").alias("n_samples"), F.count_distinct(key).alias("n_roads"), tally(ok).alias("supported_rows"),
        F.count_distinct(F.when(ok, F.col(key))).alias("supported_roads"), F.avg(ok.cast("double")).alias("supported_share"),
    )


def weighted_mean(df: DataFrame, value: str, weight: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"), F.sum(weight).alias("weight"))


def over_categories(counts: DataFrame, column: str, categories: tuple, value: str = "n") -> DataFrame:
    """A row for each category in order (position from 0); those without a count have 0."""
    fixed = counts.sparkSession.createDataFrame([(c, i) for i, c in enumerate(categories)], f"{column} {counts.schema[column].dataType.simpleString()}, position int")
    return fixed.join(counts, column, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(*[tally(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, "column", "nulls")
