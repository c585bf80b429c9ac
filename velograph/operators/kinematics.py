"""Speeds and headings along each source's history, whole or in chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velograph.functions.geometry import azimuth, planar_distance, project
from velograph.functions.telemetry import interval_outcome, is_finite, speed_outcome
from velograph.params import Params

KEY, ORDER = "source_entity_id", ("timestamp_utc", "point_id")


def with_metric_place(df: DataFrame, lon: str = "GPS_LON", lat: str = "GPS_LAT") -> DataFrame:
    x, y = project(F.col(lon), F.col(lat))
    return df.withColumns({"x": x, "y": y})


def with_previous(df: DataFrame) -> DataFrame:
    """prev_timestamp_utc, prev_x, prev_y, time_delta_sec and dist_delta_meters of the row before, by source."""
    w = W.partitionBy(KEY).orderBy(*ORDER)
    before = {"prev_timestamp_utc": "timestamp_utc", "prev_x": "x", "prev_y": "y"}
    df = df.withColumns({name: F.lag(c).over(w) for name, c in before.items()})
    return df.withColumns({
        "time_delta_sec": F.unix_timestamp("timestamp_utc") - F.unix_timestamp("prev_timestamp_utc"),
        "dist_delta_meters": planar_distance(F.col("prev_x"), F.col("prev_y"), F.col("x"), F.col("y")),
    })


def derive(df: DataFrame, p: Params) -> DataFrame:
    """Both speeds, the chosen one with its source and outcome, and the heading. Needs x, y, GPS_SPEED (see with_metric_place)."""
    df = with_previous(df)
    usable = F.coalesce((F.col("time_delta_sec") > 0) & (F.col("time_delta_sec") <= p.max_gap) & F.col("dist_delta_meters").isNotNull(), F.lit(False))
    raw = F.col("GPS_SPEED").cast("double")
    good = is_finite(raw) & (raw >= 0.0)
    df = df.withColumns({
        "displacement_speed_kmh": F.when(usable, F.col("dist_delta_meters") / F.col("time_delta_sec") * 3.6),
        "gps_speed_kmh": F.when(good, raw * p.speed_factor),
    })
    if p.speed_source == "gps_speed":
        chosen = {
            "calc_speed_kmh": F.col("gps_speed_kmh"),
            "speed_source": F.when(good, "GPS_SPEED_CM_PER_S_PRIMARY").otherwise("UNUSABLE_GPS_SPEED"),
            "speed_derivation_reason": speed_outcome(raw),
        }
    else:
        chosen = {
            "calc_speed_kmh": F.col("displacement_speed_kmh"),
            "speed_source": F.when(usable, "DISPLACEMENT_BETWEEN_PINGS").otherwise("UNUSABLE_INTERVAL"),
            "speed_derivation_reason": interval_outcome(usable, F.col("prev_timestamp_utc"), F.col("time_delta_sec"), F.col("prev_x"), p.max_gap),
        }
    moved = usable & (F.col("dist_delta_meters") >= p.min_heading_move)
    return df.withColumns(chosen).withColumn("traj_azimuth", F.when(moved, azimuth(*map(F.col, ("prev_x", "prev_y", "x", "y")))))


def last_rows(df: DataFrame) -> DataFrame:
    """The latest row of each source: what the next chunk needs. One aggregation, no window."""
    rest = [c for c in df.columns if c not in (KEY, *ORDER)]
    out = df.groupBy(KEY).agg(F.max(F.struct(*ORDER, *rest)).alias("__last"))
    return out.select(*[F.col(c) if c == KEY else F.col(f"__last.{c}") for c in df.columns])


def derive_chunks(chunks: list[DataFrame], p: Params) -> list[DataFrame]:
    """derive() of consecutive chunks of time, each with the last rows before it as predecessors only."""
    out, carry = [], None
    for chunk in chunks:
        rows = chunk.withColumn("__carried", F.lit(False))
        if carry is not None:
            rows = rows.unionByName(carry.withColumn("__carried", F.lit(True)))
        out.append(derive(rows, p).filter("not __carried").drop("__carried"))
        carry = last_rows(chunk if carry is None else chunk.unionByName(carry))
    return out


def sessions(df: DataFrame, gap: int) -> DataFrame:
    """session_id within each source: a new one begins after more than gap seconds."""
    w = W.partitionBy(KEY).orderBy(*ORDER)
    apart = F.unix_timestamp("timestamp_utc") - F.unix_timestamp(F.lag("timestamp_utc").over(w))
    df = df.withColumn("__new", F.coalesce((apart > gap).cast("int"), F.lit(0)))
    return df.withColumn("session_id", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__new")
