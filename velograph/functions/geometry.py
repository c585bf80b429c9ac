"""Planar geometry as plain columns: points are x (east) and y (north), polylines arrays of struct<x,y>."""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF_PI, TWO_PI = math.pi / 2, 2 * math.pi
POLYLINE = "array<struct<x:double,y:double>>"
POLYLINE_TYPE = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


# --- angles -------------------------------------------------------------------------------------------------------------


def circular_difference(a: Column, b: Column) -> Column:
    """Smallest angle between two directions within [0, 2 pi), in [0, pi]; null if either is."""
    d = F.abs(a - b)
    return F.least(d, F.lit(TWO_PI) - d)


def undirected(d: Column) -> Column:
    """A difference of directions as one of lines, in [0, pi/2]."""
    return F.least(d, F.lit(math.pi) - d)


def azimuth(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Clockwise from north in [0, 2 pi); null for coinciding points."""
    turn = F.atan2(x2 - x1, y2 - y1)
    return F.when((x1 != x2) | (y1 != y2), F.when(turn < 0, turn + TWO_PI).otherwise(turn))


def match_score(distance: Column, alignment: Column, radius: float, weight: float) -> Column:
    """Distance alone without a heading (null alignment), else distance and alignment weighted."""
    near = distance / radius
    return F.coalesce((1.0 - weight) * near + weight * (alignment / HALF_PI), near)


# --- distances ----------------------------------------------------------------------------------------------------------


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def point_segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance to the nearest place of a segment; a segment without length is a point."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / square))).otherwise(0.0)
    return planar_distance(px, py, x1 + t * dx, y1 + t * dy)


# --- transverse Mercator ------------------------------------------------------------------------------------------------
# The projection's public parameters (GRS80 ellipsoid, central meridian 19 E, scale, false origin).
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
MERIDIAN, SCALE, FALSE_EAST, FALSE_NORTH = 19.0, 0.9993, 500000.0, -5300000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORTH = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres east and north (series of third order in the third flattening)."""
    root = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - root * F.atanh(root * s))
    turn = F.radians(lon - MERIDIAN)
    xi, eta = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_FORTH, 1):
        east += a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north += a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + _RADIUS * east, FALSE_NORTH + _RADIUS * north


def unproject(east: Column, north: Column) -> tuple[Column, Column]:
    """Metres to degrees of longitude and latitude."""
    xi, eta = (north - FALSE_NORTH) / _RADIUS, (east - FALSE_EAST) / _RADIUS
    u, v = xi, eta
    for j, b in enumerate(_BACK, 1):
        u -= b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v -= b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    lat = chi
    for j, d in enumerate(_LATITUDE, 1):
        lat += d * F.sin(2 * j * chi)
    return MERIDIAN + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(lat)


# --- polylines ----------------------------------------------------------------------------------------------------------


def pairs(line: Column) -> Column:
    """Consecutive vertices as an array of struct<x1,y1,x2,y2>."""
    n = F.size(line)
    steps = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    at = lambda i, f: F.get(line, i)[f]
    return F.transform(steps, lambda i: F.struct(at(i, "x").alias("x1"), at(i, "y").alias("y1"), at(i + 1, "x").alias("x2"), at(i + 1, "y").alias("y2")))


def polyline_length(line: Column) -> Column:
    return F.aggregate(pairs(line), F.lit(0.0), lambda total, s: total + planar_distance(s["x1"], s["y1"], s["x2"], s["y2"]))


def is_valid_polyline(line: Column) -> Column:
    """Two vertices or more, all finite, of positive length."""
    bad = F.exists(line, lambda v: v["x"].isNull() | v["y"].isNull() | F.isnan(v["x"]) | F.isnan(v["y"]) | (F.abs(v["x"]) == float("inf")) | (F.abs(v["y"]) == float("inf")))
    return F.coalesce((F.size(line) >= 2) & ~bad & (polyline_length(line) > 0), F.lit(False))


def reversed_polyline(line: Column) -> Column:
    return F.reverse(line)


def bounds(df: DataFrame, line: str = "line") -> DataFrame:
    """One row with the extent of all polylines."""
    v = df.select(F.explode(line).alias("v"))
    return v.agg(F.min("v.x").alias("min_x"), F.min("v.y").alias("min_y"), F.max("v.x").alias("max_x"), F.max("v.y").alias("max_y"))


def atomic_segments(roads: DataFrame, line: str = "line", feature: str = "road_feature_id") -> DataFrame:
    """A row for each consecutive pair of vertices, with match_segment_id (feature:index) and road_azimuth; none without length."""
    rest = [c for c in roads.columns if c != line]
    rows = roads.select(*rest, F.posexplode(pairs(F.col(line))).alias("segment_index", "s")).select(*rest, "segment_index", "s.*")
    rows = rows.filter("x1 <> x2 OR y1 <> y2")
    return rows.withColumn("match_segment_id", F.concat_ws(":", F.col(feature).cast("string"), F.col("segment_index").cast("string"))).withColumn("road_azimuth", azimuth(*map(F.col, ("x1", "y1", "x2", "y2"))))


def clip_range(x1: Column, y1: Column, x2: Column, y2: Column, box: tuple[float, float, float, float]) -> tuple[Column, Column, Column]:
    """Of a segment the share (from, to) within the box, and whether any is: each edge narrows the range of the parameter."""
    west, south, east, north = box
    lo, hi, ok = F.lit(0.0), F.lit(1.0), F.lit(True)
    for step, room in ((x1 - x2, x1 - west), (x2 - x1, east - x1), (y1 - y2, y1 - south), (y2 - y1, north - y1)):
        at = F.when(step != 0, room / step)
        lo = F.greatest(lo, F.when(step < 0, at))
        hi = F.least(hi, F.when(step > 0, at))
        ok = ok & ((step != 0) | (room >= 0))
    return lo, hi, ok & (lo <= hi)


def clip_polylines(roads: DataFrame, box: tuple[float, float, float, float], line: str = "line", feature: str = "road_feature_id") -> DataFrame:
    """Polylines cut to a box, a row (with part, from 0) for each connected run inside; runs without length go.

    Segments are cut alone, then runs of adjoining pieces are put together again, in order.
    """
    rest = [c for c in roads.columns if c != line]
    rows = roads.select(*rest, F.col(line).alias("__line"))

    def piece(s: Column) -> Column:
        lo, hi, ok = clip_range(s["x1"], s["y1"], s["x2"], s["y2"], box)
        dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
        at = lambda t: F.struct((s["x1"] + t * dx).alias("x"), (s["y1"] + t * dy).alias("y"))
        return F.when(ok & (lo < hi), F.struct(at(lo).alias("a"), at(hi).alias("b")))

    rows = rows.withColumn("__cut", F.transform(pairs(F.col("__line")), piece))
    zero = F.expr(f"cast(array() as array<{POLYLINE}>)")

    def grow(parts: Column, c: Column) -> Column:
        last = F.element_at(parts, -1)
        joined = F.when(F.size(parts) > 0, F.element_at(last, -1) == c["a"]).otherwise(False)
        kept = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.when(c.isNull(), parts).when(joined, F.concat(kept, F.array(F.concat(last, F.array(c["b"]))))).otherwise(F.concat(parts, F.array(F.array(c["a"], c["b"]))))

    rows = rows.withColumn("__parts", F.aggregate("__cut", zero, grow))
    return rows.select(*rest, F.posexplode("__parts").alias("part", line)).filter(polyline_length(F.col(line)) > 0)


def touches_box(line: Column, box: tuple[float, float, float, float]) -> Column:
    return F.exists(pairs(line), lambda s: clip_range(s["x1"], s["y1"], s["x2"], s["y2"], box)[2])


# --- text and binary forms ------------------------------------------------------------------------------------------------


def from_wkt(text: Column) -> Column:
    """LINESTRING text to a polyline; null for other text."""
    inner = F.regexp_extract(text, r"(?i)^\s*LINESTRING\s*\(([^()]*)\)\s*$", 1)
    vertex = lambda v: F.struct(F.element_at(v, 1).try_cast("double").alias("x"), F.element_at(v, 2).try_cast("double").alias("y"))
    return F.when(inner != "", F.transform(F.split(inner, ","), lambda v: vertex(F.split(F.trim(v), r"\s+"))))


def to_wkt(line: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(line, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))), ", "), F.lit(")"))


@F.pandas_udf(POLYLINE_TYPE)
def from_wkb(values: pd.Series) -> pd.Series:
    """Well-known binary of a line string (either byte order) to a polyline; null for null. Used at the edge only."""

    def one(raw):
        if raw is None:
            return None
        raw = bytes(raw)
        order = "<" if raw[0] == 1 else ">"
        kind, n = struct.unpack_from(f"{order}II", raw, 1)
        if kind != 2:
            raise ValueError(f"no line string: type {kind}")
        flat = struct.unpack_from(f"{order}{2 * n}d", raw, 9)
        return [{"x": x, "y": y} for x, y in zip(flat[::2], flat[1::2], strict=True)]

    return values.map(one)


@F.pandas_udf(T.BinaryType())
def to_wkb(values: pd.Series) -> pd.Series:
    """A polyline to well-known binary, little-endian."""
    return values.map(lambda line: None if line is None else struct.pack(f"<BII{2 * len(line)}d", 1, 2, len(line), *(c for v in line for c in (v["x"], v["y"]))))
