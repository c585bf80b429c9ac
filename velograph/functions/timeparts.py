"""Timestamps with provenance, and the calendar columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velograph.params import Params

# Names by ISO weekday and by month.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def resolve_timestamps(df: DataFrame, p: Params, gps: str = "GPS_TIME", etl: str = "ETL_CZAS") -> DataFrame:
    """Two source timestamps (UTC, and local time) to one, with its source, the sources' difference and local time.

    Text that is no timestamp counts as missing, whatever the session's ANSI mode.
    """
    first = F.try_to_timestamp(F.col(gps).cast("string"))
    second = F.to_utc_timestamp(F.try_to_timestamp(F.col(etl).cast("string")), p.local_zone)
    df = df.withColumns({"timestamp_gps_utc": first, "timestamp_etl_utc": second})
    order = [("timestamp_gps_utc", "GPS_TIME_UTC"), ("timestamp_etl_utc", "ETL_CZAS_LOCAL")]
    if p.primary_timestamp == "ETL_CZAS_LOCAL":
        order.reverse()
    (a, a_name), (b, b_name) = order
    gap = F.abs(F.unix_timestamp("timestamp_gps_utc") - F.unix_timestamp("timestamp_etl_utc"))
    return df.withColumns({
        "timestamp_utc": F.coalesce(a, b),
        "timestamp_source": F.when(F.col(a).isNotNull(), a_name).when(F.col(b).isNotNull(), f"{b_name}_FALLBACK").otherwise("MISSING_OR_INVALID"),
        "timestamp_disagreement_sec": gap,
        "timestamp_sources_disagree": gap > p.max_disagreement,
        "timestamp_local": F.from_utc_timestamp(F.coalesce(a, b), p.local_zone),
    })


def iso_weekday(ts: Column) -> Column:
    return F.weekday(ts) + 1


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "WINTER").when(month.isin(3, 4, 5), "SPRING").when(month.isin(6, 7, 8), "SUMMER").otherwise("AUTUMN")


def time_of_day(hour: Column) -> Column:
    return F.when(hour.between(7, 9), "PEAK_MORNING").when(hour.between(10, 14), "OFF_PEAK_DAY").when(hour.between(15, 18), "PEAK_EVENING").otherwise("NIGHT")


def _name(names: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), number - 1)


def day_name(iso: Column) -> Column:
    """Null outside 1 to 7."""
    return _name(DAY_NAMES, iso)


def month_name(month: Column) -> Column:
    """Null outside 1 to 12."""
    return _name(MONTH_NAMES, month)


def calendar(df: DataFrame, ts: str = "timestamp_local") -> DataFrame:
    t = F.col(ts)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "quarter": F.concat(F.lit("Q"), F.quarter(t).cast("string")), "day": F.dayofmonth(t), "hour": F.hour(t),
        "day_of_week_iso": iso_weekday(t), "is_weekend": iso_weekday(t) >= 6, "season": season(F.month(t)),
    })


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
