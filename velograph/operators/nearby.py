"""Segments near points, tile by tile: a tile's pairs are judged where they meet, and only what they decide leaves it.

A dense tile holds far more pairs than points, so pairs are neither shuffled nor sorted. Within a tile points are halved
by place until few are left, and with each half go only those segments that its box can reach; what is left is judged as
one matrix of distances. All bounds are exact: no point and no segment in reach is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from velograph.functions.geometry import HALF_PI, TWO_PI, point_segment_distance

#: Points of a group, points of a matrix, elements of a matrix, metres by which bounds are widened for rounding.
PART, LEAF, BLOCK, SLACK = 65536, 32, 1 << 18, 1e-5
LINE = ("x1", "y1", "x2", "y2")


# --- dealing out --------------------------------------------------------------------------------------------------------


def in_place():
    """Whether a point has a place: neither coordinate null, NaN or infinite."""
    return F.coalesce((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")), F.lit(False))


def by_tile(points: DataFrame, segments: DataFrame, radius: float, cell: float, run: Callable[[pa.Table, pa.Table], Iterable[dict]], schema: T.StructType, share: int = 1) -> DataFrame:
    """run(points of a tile, segments in reach of it) for all tiles with points; the columns of some rows at a time, as schema says.

    A segment is listed in the tiles of its box grown by the radius. A crowded tile is dealt out in parts by point_id, each
    with the tile's segments, so wide tiles and large parts list segments least often. share: a group has PART / share points,
    for a run() whose results hold many rows a point. Only crowded tiles are broadcast, at most one for PART / share points;
    listed segments never are, as the planner takes them for as small as the file that they come from. Work isn't in
    proportion to bytes, so groups go to the session's number of partitions as it is.
    """
    fields = to_arrow_schema(schema)

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return fields.empty_table()
        # chunks stay apart, so that Spark reads one at a time
        return pa.concat_tables([fields.empty_table(), *[pa.table(_columns_of(found, fields), schema=fields) for found in run(left, right)]])

    keys, placed, listed = dealt(points, segments, radius, cell, share)
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [df.repartition(n, *keys).groupBy(*keys) for df in (placed, listed)]
    return sides[0].cogroup(sides[1]).applyInArrow(group, schema)


def stream_by_tile(points: DataFrame, segments: DataFrame, radius: float, cell: float, run: Callable[[pa.Table, pa.Table], Iterable[dict]], schema: T.StructType, share: int = 1) -> DataFrame:
    """As by_tile(), for a run() that returns a row a pair: what it yields leaves the task at once, so a group's results are never held.

    Both sides travel as one table, so no name may be on both. A segment is listed only in the tiles that it can reach.
    """
    fields, lefts, rights = to_arrow_schema(schema), points.columns, segments.columns

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches)
        left, right = (whole.filter(pc.equal(whole["__point"], side)).select(names).combine_chunks() for side, names in ((True, lefts), (False, rights)))
        for found in run(left, right) if len(left) and len(right) else ():
            yield from pa.table(_columns_of(found, fields), schema=fields).combine_chunks().to_batches()

    keys, placed, listed = dealt(points, segments, radius, cell, share, along=True)
    both = placed.withColumn("__point", F.lit(True)).unionByName(listed.withColumn("__point", F.lit(False)), allowMissingColumns=True)
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, *keys).groupBy(*keys).applyInArrow(group, schema)


def dealt(points: DataFrame, segments: DataFrame, radius: float, cell: float, share: int = 1, along: bool = False) -> tuple[list[str], DataFrame, DataFrame]:
    """The keys of groups, and both sides with them. along: of the tiles of a segment's box only those that it can reach."""
    tile = ["__cx", "__cy"]
    at = lambda v: F.floor(v / cell).cast("long")
    every = lambda a, b: F.explode(F.sequence(at(F.least(a, b) - radius), at(F.greatest(a, b) + radius)))
    placed = points.filter(in_place()).withColumns({"__cx": at(F.col("x")), "__cy": at(F.col("y"))})
    crowded = placed.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) * share / PART).alias("__parts")).filter("__parts > 1")
    n_parts = F.coalesce("__parts", F.lit(1).cast("long"))
    listed = segments.withColumn("__cx", every(F.col("x1"), F.col("x2"))).withColumn("__cy", every(F.col("y1"), F.col("y2")))
    if along:
        middle = point_segment_distance(*((F.col(c) + 0.5) * cell for c in tile), *map(F.col, LINE))
        listed = listed.filter(middle <= radius + cell * 0.5**0.5 + SLACK)
    listed = listed.join(F.broadcast(crowded), tile, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1))).drop("__parts")
    placed = placed.join(F.broadcast(crowded), tile, "left").withColumn("__part", F.pmod(F.xxhash64("point_id"), n_parts)).drop("__parts")
    return [*tile, "__part"], placed, listed


def _columns_of(found: dict, fields: pa.Schema) -> list:
    whole = lambda c: c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, from_pandas=True)
    return [whole(found[f.name]).cast(f.type) for f in fields]


# --- within a tile ------------------------------------------------------------------------------------------------------


def numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as doubles, null as NaN."""
    return [table[n].cast(pa.float64()).to_numpy() for n in names]


def distance(px, py, x1, y1, x2, y2) -> np.ndarray:
    """functions.geometry.point_segment_distance, in the same order of operations."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = (px - x1) * dx
    t += (py - y1) * dy
    t /= np.where(square > 0, square, 1.0)
    np.clip(t, 0.0, 1.0, out=t)
    a, b = t * dx, t
    b *= dy
    a += x1
    b += y1
    a -= px
    b -= py
    a *= a
    b *= b
    a += b
    return np.sqrt(a, out=a)


def rounded(d: np.ndarray, digits: int | None) -> np.ndarray:
    return d if digits is None else np.floor(d * 10.0**digits + 0.5) / 10.0**digits


def leaves(boxes: tuple[np.ndarray, ...], lines: list[np.ndarray], reach: Callable[[np.ndarray, float], float]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(points, segments) as ascending places; boxes: west, east, south and north of each point.

    reach(distances of segments from the middle of a box, half its diagonal): how far from the middle a segment may matter.
    """
    west, east, south, north = boxes
    waiting = [(np.arange(len(west)), np.arange(len(lines[0])))]
    while waiting:
        rows, cols = waiting.pop()
        w, e, s, n = west[rows].min(), east[rows].max(), south[rows].min(), north[rows].max()
        if len(cols):
            d = distance((w + e) / 2, (s + n) / 2, *(c[cols] for c in lines))
            cols = cols[d <= reach(d, math.hypot(e - w, n - s) / 2) + SLACK]
        if not len(cols) or len(rows) == 1 or len(rows) <= LEAF and len(rows) * len(cols) <= BLOCK:
            yield np.sort(rows), cols
        else:
            order = np.argpartition((west if e - w >= n - s else south)[rows], len(rows) // 2)
            waiting += [(rows[order[: len(rows) // 2]], cols), (rows[order[len(rows) // 2 :]], cols)]


def nearest_of(left: pa.Table, right: pa.Table, radius: float, digits: int | None) -> np.ndarray:
    """Of each point the distance of the nearest segment, NaN beyond the radius."""
    (x, y), lines = numbers(left, "x", "y"), numbers(right, *LINE)
    out = np.full(len(x), np.nan)
    for rows, cols in leaves((x, x, y, y), lines, lambda d, h: min(radius, np.fmin.reduce(d) + h) + h):
        if len(cols):
            out[rows] = np.fmin.reduce(distance(x[rows, None], y[rows, None], *(c[cols] for c in lines)), axis=1)
    out = rounded(out, digits)
    return np.where(out <= radius, out, np.nan)


def pairs_of(left: pa.Table, right: pa.Table, radius: float, digits: int | None) -> Iterator[dict]:
    """Both sides' columns of all pairs within the radius, with dist_to_axis, of some points at a time."""
    (x, y), lines = numbers(left, "x", "y"), numbers(right, *LINE)
    found, n = [], 0

    def columns() -> dict:
        rows, cols, d = map(np.concatenate, zip(*found, strict=True))
        return {c: t[c].take(pa.array(at)) for t, at in ((left, rows), (right, cols)) for c in t.column_names} | {"dist_to_axis": d}

    for rows, cols in leaves((x, x, y, y), lines, lambda d, h: radius + h):
        if len(cols):
            d = distance(x[rows, None], y[rows, None], *(c[cols] for c in lines))
            r, c = np.nonzero(d <= radius + SLACK)
            d = rounded(d[r, c], digits)
            kept = d <= radius
            found.append((rows[r[kept]], cols[c[kept]], d[kept]))
            n += len(found[-1][0])
        if n >= PART:
            yield columns()
            found, n = [], 0
    if n:
        yield columns()


class Candidates:
    """Best segments of a tile's points by road: by score, distance, alignment (unknown last), then segment id.

    Rows that share a point_id are one point. Segments stand in order of road and segment id, nulls first.
    """

    def __init__(self, left: pa.Table, right: pa.Table, radius: float, primary: float, weight: float, digits: int | None) -> None:
        order = pc.sort_indices(right, [("road_feature_id", "ascending"), ("match_segment_id", "ascending")], null_placement="at_start")
        self.left, self.right = left.combine_chunks(), right.take(order).combine_chunks()
        self.radius, self.primary, self.weight, self.digits = radius, primary, weight, digits
        self.headed = "traj_azimuth" in left.column_names and "road_azimuth" in right.column_names
        self.road = self._codes(self.right["road_feature_id"])
        self.known = self.right["road_feature_id"].is_valid().to_numpy()

    @staticmethod
    def _codes(column: pa.ChunkedArray) -> np.ndarray:
        return column.combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.empty(0, np.int64)

    def by_leaf(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Of some points at a time: point, row, segment, distance, angle, alignment (both NaN if unknown) and score of each road's best, by point and road."""
        (x, y), lines = numbers(self.left, "x", "y"), numbers(self.right, *LINE)
        point = self._codes(self.left["point_id"])
        order = np.argsort(point, kind="stable")
        first = np.append(np.flatnonzero(np.diff(point[order], prepend=-1)), len(order))
        low, high = np.minimum.reduceat, np.maximum.reduceat
        boxes = tuple(f(v[order], first[:-1]) for v in (x, y) for f in (low, high))
        for points, cols in leaves(boxes, lines, lambda d, h: self.radius + h):
            if len(cols):
                rows = np.concatenate([order[first[i] : first[i + 1]] for i in points]) if len(order) >= len(first) else order[first[points]]
                yield self._leaf(point[rows], rows, cols, x[rows, None], y[rows, None], [c[cols] for c in lines], len(rows) > len(points))

    def _leaf(self, point, rows, cols, x, y, lines, copies: bool) -> tuple[np.ndarray, ...]:
        d = rounded(distance(x, y, *lines), self.digits)
        score, turn, alignment = d / self.primary, None, None
        if self.headed:
            a, b = numbers(self.left, "traj_azimuth")[0][rows, None], numbers(self.right, "road_azimuth")[0][cols]
            turn = np.abs(a - b)
            turn = np.minimum(turn, TWO_PI - turn)
            alignment = np.minimum(turn, math.pi - turn)
            score = np.where(np.isnan(alignment), score, (1.0 - self.weight) * score + self.weight * (alignment / HALF_PI))
        score[~(d <= self.radius)] = np.inf
        road = self.road[cols]
        starts = np.flatnonzero(np.diff(road, prepend=-1))
        size = np.diff(np.append(starts, len(road)))
        least = np.minimum.reduceat(score, starts, axis=1)
        r, c = np.nonzero((score == np.repeat(least, size, axis=1)) & (score < np.inf))
        key, far = point[r] * (len(self.road) + 1) + road[c], np.full(len(r), np.nan)
        d, s = d[r, c], score[r, c]
        turn, alignment = (far, far) if turn is None else (turn[r, c], alignment[r, c])
        last = np.where(np.isnan(alignment), np.inf, alignment)
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        if copies:
            order = np.lexsort((c, last, d, s, key))
            kept = order[np.diff(key[order], prepend=-1) != 0]
        elif again.any():
            tied = again.copy()
            tied[:-1] |= again[1:]
            some = np.flatnonzero(tied)
            some = some[np.lexsort((c[some], last[some], d[some], key[some]))]
            kept = np.sort(np.append(np.flatnonzero(~tied), some[np.diff(key[some], prepend=-1) != 0]))
        else:
            kept = slice(None)
        r, c = r[kept], c[kept]
        return point[r], rows[r], cols[c], d[kept], turn[kept], alignment[kept], s[kept]

    def _columns(self, rows, cols, names: list[str] | None = None, **more) -> dict:
        sides = [(t, pa.array(at), [c for c in t.column_names if (names is None or c in names) and c not in besides]) for t, at, besides in ((self.left, rows, ()), (self.right, cols, self.left.column_names))]
        return {c: t[c].take(at) for t, at, chosen in sides for c in chosen} | more

    def segments(self, names: list[str]) -> Iterator[dict]:
        """The columns of names of all best segments, of some points at a time."""
        for _, rows, cols, d, turn, alignment, s in self.by_leaf():
            yield self._columns(rows, cols, names, dist_to_axis=d, azimuth_diff=turn, heading_alignment_diff=alignment, match_score=s)

    def roads(self, within: dict[str, float]) -> dict:
        """Of each point the best road, counts of roads by distance, and score and distance of the runner-up (NaN if there is none)."""
        found = [self._best(within, *x) for x in self.by_leaf()]
        rows, cols, d, turn, alignment, s, next_s, next_d, known, *counts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [*[np.empty(0, int)] * 2, *[np.empty(0)] * 6, *[np.empty(0, int)] * (1 + len(within))]
        more = dict(zip(within, counts, strict=True))
        return self._columns(rows, cols, dist_to_axis=d, azimuth_diff=turn, heading_alignment_diff=alignment, match_score=s, next_score=next_s, next_dist=next_d, candidate_count_sensitivity_max_radius=known, **more)

    def _best(self, within, point, rows, cols, d, turn, alignment, s) -> list[np.ndarray]:
        starts = np.flatnonzero(np.diff(point, prepend=-1))
        size = np.diff(np.append(starts, len(point)))
        if not len(starts):
            return [*[np.empty(0, int)] * 2, *[np.empty(0)] * 6, *[np.empty(0, int)] * (1 + len(within))]
        ranks = ((d > self.primary).astype(float), s, d, np.where(np.isnan(alignment), np.inf, alignment))

        def first(live: np.ndarray) -> np.ndarray:
            """Of each point the place of its least live candidate, len(d) if none lives."""
            for k in ranks:
                v = np.where(live, k, np.inf)
                live = live & (v == np.repeat(np.minimum.reduceat(v, starts), size))
            return np.minimum.reduceat(np.where(live, np.arange(len(d)), len(d)), starts)

        best = first(np.ones(len(d), bool))
        live = np.ones(len(d), bool)
        live[best] = False
        second = first(live)
        count = lambda mask: np.add.reduceat(mask.astype(np.int64), starts)
        after = lambda v: np.append(v, np.nan)[second]
        return [*[v[best] for v in (rows, cols, d, turn, alignment, s)], after(s), after(d), count(self.known[cols]), *[count(d <= r) for r in within.values()]]
