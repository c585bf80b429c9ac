"""Speed profiles: support, averages and quantiles by road and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velograph.functions.telemetry import spatial_scope
from velograph.functions.timeparts import day_name, month_name, time_of_day
from velograph.params import Params

# The columns that profiles are made by.
COMMON = ("road_feature_id", "operating_speed_reference_kmh", "operating_speed_reference_source", "travel_direction", "signal_mode", "weather_category", "spatial_scope")
TEMPORAL = {
    "season": ("season",),
    "month": ("season", "month", "month_name"),
    "weekday": ("day_of_week_iso", "day_name", "is_weekend"),
    "time_of_day": ("time_of_day",),
    "flat": ("season", "month", "month_name", "day_of_week_iso", "day_name", "is_weekend", "time_of_day"),
}


def observations(silver: DataFrame, p: Params) -> DataFrame:
    """The rows that profiles count, with their labels."""
    rows = silver if p.keep_sensitivity_only else silver.filter("within_primary_match_radius")
    rows = rows.filter("not is_high_speed_iqr_outlier") if p.drop_outliers else rows
    return rows.withColumns({
        "day_name": day_name(F.col("day_of_week_iso")), "month_name": month_name(F.col("month")), "time_of_day": time_of_day(F.col("hour")),
        "spatial_scope": spatial_scope(F.col("inside_study_aoi"), p), "observation_date": F.to_date("timestamp_local"),
    })


def speed_counts(rows: DataFrame, keys: tuple[str, ...], speed: str = "calc_speed_kmh") -> DataFrame:
    """keys, speed, n_rows, n: how many rows and points have each speed; n_rows and n of a table that counts already are summed."""
    counted = {"n_rows", "n"} <= set(rows.columns)
    n = (F.sum("n_rows"), F.sum("n")) if counted else (F.count(F.lit(1)), F.count("point_id"))
    return rows.groupBy(*keys, F.col(speed).alias("speed") if speed != "speed" else "speed").agg(n[0].alias("n_rows"), n[1].alias("n"))


def measures(counts: DataFrame, keys: tuple[str, ...], p: Params, exact_decimals: int | None = None) -> DataFrame:
    """Of each group of speed_counts() its support, averages, deviation and quantiles, the least speed that the share doesn't exceed.

    exact_decimals: averages over decimals of that scale, which no order of summation changes.
    """
    own = W.partitionBy(*keys)
    v, n = F.col("speed"), F.col("n_rows")
    known = F.when(v.isNotNull(), n)
    counts = counts.withColumns({
        "upto": F.sum(known).over(own.orderBy("speed").rowsBetween(W.unboundedPreceding, 0)), "total": F.sum(known).over(own),
        "mean": F.sum(v * n).over(own) / F.sum(known).over(own),
    })
    d = v if exact_decimals is None else v.cast(f"decimal(18,{exact_decimals})")
    average = lambda on: F.round(F.try_divide(F.sum(F.when(on, d * n)).cast("double"), F.sum(F.when(on, n))), 2)
    quantile = lambda share: F.round(F.min(F.when(F.col("upto") >= F.col("total") * share, v)), 2)
    square = F.sum(n * (v - F.col("mean")) * (v - F.col("mean")))
    few = F.coalesce(F.sum(known), F.lit(0)) < 2
    return counts.groupBy(*keys).agg(
        average(v.isNotNull()).alias("avg_travel_speed_kmh"), average(v > p.running_above).alias("avg_running_speed_kmh"),
        quantile(0.5).alias("median_speed_kmh"), quantile(0.85).alias("p85_speed_kmh"), F.when(~few, F.round(F.sqrt(square / (F.sum(known) - 1)), 2)).alias("stddev_speed_kmh"),
        F.sum("n").alias("n_samples"), F.round(F.coalesce(F.sum(F.when(v <= p.running_above, n)), F.lit(0)) / F.sum(n), 4).alias("stopped_observation_ratio"),
    )


#: What is counted without repetition, and the names of the counts (fixed values).
DISTINCT = {"source_entity_id": "n_unique_source_ids", "observation_date": "n_unique_observation_days", "speed_source": "n_speed_derivation_methods"}
MEASURES = (
    "avg_travel_speed_kmh", "avg_running_speed_kmh", "median_speed_kmh", "p85_speed_kmh", "stddev_speed_kmh", "n_samples",
    "n_unique_source_ids", "n_unique_observation_days", "n_speed_derivation_methods", "stopped_observation_ratio",
)


def summarise(rows: DataFrame, keys: tuple[str, ...], p: Params, exact_decimals: int | None = None, labels: DataFrame | None = None) -> DataFrame:
    """keys and MEASURES. rows may be speed_counts() of finer keys, labels the distinct DISTINCT columns with those keys.

    Speeds are counted before the shuffle, so quantiles come from a running sum over distinct speeds, without a sketch for each
    group; distinct counts are a plan of their own, as they would multiply the rows that quantiles see.
    """
    found = measures(speed_counts(rows, keys, "speed" if "n_rows" in rows.columns else "calc_speed_kmh"), keys, p, exact_decimals)
    unlike = (rows if labels is None else labels).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(*[F.count_distinct(c).alias(n) for c, n in DISTINCT.items()])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return found.join(unlike, same).select(*keys, *MEASURES)


def with_support(profile: DataFrame, p: Params) -> DataFrame:
    """The difference to the reference speed, and whether the support suffices."""
    return profile.withColumns({
        "delta_operating_speed_reference_kmh": F.round(F.col("avg_travel_speed_kmh") - F.col("operating_speed_reference_kmh"), 2),
        "meets_min_sample_count": F.col("n_samples") >= p.min_samples, "min_sample_count": F.lit(p.min_samples),
    })


def profile(rows: DataFrame, keys: tuple[str, ...], p: Params, exact_decimals: int | None = None) -> DataFrame:
    return with_support(summarise(rows, keys, p, exact_decimals), p)


def all_profiles(rows: DataFrame, p: Params, keep=lambda df, name: df) -> dict[str, DataFrame]:
    """The four marginal profiles and the joint one. keep(df, name) may write a table and read it back: all profiles come from the
    speed counts and the distinct labels by every key, so rows are read twice instead of ten times."""
    every = (*COMMON, *TEMPORAL["flat"])
    counts = keep(speed_counts(rows, every), "speed_counts")
    labels = keep(rows.select(*every, *DISTINCT).distinct(), "labels")
    out = {name: with_support(summarise(counts, (*COMMON, *keys), p, labels=labels), p) for name, keys in TEMPORAL.items()}
    return {name: df.withColumnRenamed("day_of_week_iso", "day_of_week") for name, df in out.items()}


def flat_with_roads(flat: DataFrame, roads: DataFrame) -> DataFrame:
    """The joint profile with the attributes of its roads."""
    own = [c for c in roads.columns if c not in flat.columns or c == "road_feature_id"]
    return flat.join(roads.select(*own), "road_feature_id", "left")
