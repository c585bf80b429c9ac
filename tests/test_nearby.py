"""Matching of dense tables: pairs stay in their tile, and nothing in reach is lost."""

import math
import random

import duckdb
import pyarrow as pa
import pytest

from velograph.operators import matching, nearby
from velograph.params import Params
from velograph.plans import registry
from velograph.plans.standins import POINTS_SQL, SEGMENTS_SQL

P = Params()
PLACES = 2999 * 3001  # ids below that stand for all places


@pytest.fixture(scope="module")
def dense(tmp_path_factory):
    """300 points and 300 segments that begin within 25 m of each other."""
    at = str(tmp_path_factory.mktemp("dense"))
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    ids = lambda a, b: f"(SELECT range AS i FROM range({PLACES}) WHERE (range * {a}) % 2999 < 20 AND (range * {b}) % 3001 < 15)"
    con.sql(f"COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i % 9999) AS ts, i % 3 AS user_id, 'a' AS event_type, 1.0 AS value, '{{}}' AS props FROM {ids(7919, 104729)}) TO '{at}/events.parquet'")
    con.sql(f"COPY (SELECT i AS p_partkey, (i % 50 + 1)::INT AS p_size FROM {ids(6007, 3571)}) TO '{at}/part.parquet'")
    for t in ("events", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    return at, con


def rows_of(spark, kind="Join", metric="number of output rows") -> int:
    """Rows that operators of a kind put out in the last query."""
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList().last().executionId()
    nodes, values = store.planGraph(last).allNodes(), store.executionMetrics(last)
    total = 0
    for node in (nodes.apply(i) for i in range(nodes.size())):
        for m in (node.metrics().apply(i) for i in range(node.metrics().size())) if kind in node.name() else ():
            if m.name() == metric and values.contains(m.accumulatorId()):
                total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return total


def holds(spark, dense, name) -> int:
    at, con = dense
    df, want = registry.queries()[name](spark, at), con.sql(registry.oracle_sql()[name])
    order = sorted(df.columns)
    rows = df.collect()
    joined = rows_of(spark)
    plain = lambda rows, columns: sorted(tuple(str(r[columns.index(c)]) for c in order) for r in rows)
    assert plain(rows, df.columns) == plain(want.fetchall(), list(want.columns))
    return joined


def test_best_road_passes_on_no_pairs(spark, dense):
    """90,000 pairs."""
    assert holds(spark, dense, "best_road") < 10_000


@pytest.mark.parametrize("headed", [False, True])
def test_best_segments_and_roads_equal_brute_force(spark, headed):
    """Whole metres, so that many candidates tie; text ids, one of them null, and two rows of some points."""
    r = random.Random(11)
    turn = lambda: r.choice([None, *(k * math.pi / 4 for k in range(8))]) if headed else None
    pts = [(f"p{i}", float(r.randrange(160)), float(r.randrange(160)), turn()) for i in range(240)]
    pts += [(*p[:3], turn()) for p in pts[:60]] + [("none", None, 1.0, None)]
    segs = [(f"s{i}", r.choice([None, "a", "b", "c", "d"]), *(float(r.randrange(160)) for _ in range(4)), turn()) for i in range(60)]
    segs.append(("s9x", "a", 3.0, 3.0, 3.0, 3.0, None))
    points = spark.createDataFrame(pts, "point_id string, x double, y double, traj_azimuth double")
    lines = spark.createDataFrame(segs, "match_segment_id string, road_feature_id string, x1 double, y1 double, x2 double, y2 double, road_azimuth double")

    def judged(p, s):
        (_, x, y, a), (i, _, x1, y1, x2, y2, b) = p, s
        dx, dy = x2 - x1, y2 - y1
        q = dx * dx + dy * dy
        u = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / q)) if q else 0.0
        ex, ey = x1 + u * dx - x, y1 + u * dy - y
        d = math.floor(math.sqrt(ex * ex + ey * ey) * 1e6 + 0.5) / 1e6
        if a is None or b is None:
            return d / 15, d, math.inf, i
        t = min(abs(a - b), 2 * math.pi - abs(a - b))
        al = min(t, math.pi - t)
        return 0.65 * (d / 15) + 0.35 * (al / (math.pi / 2)), d, al, i

    want = {}
    for p in pts[:-1]:
        for s in segs:
            if (k := judged(p, s))[1] <= 40:
                want[p[0], s[1]] = min(want.get((p[0], s[1]), k), k)
    got = matching.best_segments(points, lines, P, digits=6).collect()
    assert {(g["point_id"], g["road_feature_id"]): (g["match_score"], g["dist_to_axis"], math.inf if g["heading_alignment_diff"] is None else g["heading_alignment_diff"], g["match_segment_id"]) for g in got} == want
    assert len(got) == len(want)
    found = {g["point_id"]: g for g in matching.best_roads(points, lines, P, digits=6).collect()}
    assert found.keys() == {p for p, _ in want}
    for p, g in found.items():
        ranks = sorted(((k[1] > 15, *k[:3], road is not None, road or ""), k) for (q, road), k in want.items() if q == p)
        first = ranks[0][1]
        assert (g["match_segment_id"], g["dist_to_axis"], g["match_score"]) == (first[3], first[1], first[0])
        assert [g[f"candidate_count_radius_{i}"] for i in (1, 2, 3)] == [sum(k[1] <= m for _, k in ranks) for m in (15, 25, 40)]
        assert g["candidate_count_sensitivity_max_radius"] == sum(rank[4] for rank, _ in ranks)
        assert g["dist_margin_m"] == (ranks[1][1][1] - first[1] if g["candidate_count"] > 1 else None)


def test_nearest_distance_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "nearest_distance") < 10_000


def test_nearest_distance_broadcasts_no_segments(spark, dense):
    """The planner takes listed segments for as small as the file that they come from."""
    holds(spark, dense, "nearest_distance")
    assert rows_of(spark, "BroadcastExchange") == 0


@pytest.mark.parametrize("name", ["nearest_distance", "best_road_heading"])
def test_crowded_tiles_are_dealt_out_in_parts(spark, dense, name, monkeypatch):
    monkeypatch.setattr(nearby, "PART", 50)
    holds(spark, dense, name)
    assert 0 < rows_of(spark, "BroadcastExchange") < 10


def test_points_without_a_place_stay(spark):
    points = spark.createDataFrame([(1, 0.0, 3.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, float("inf"), 1.0), (5, 1e6, 1e6)], "point_id long, x double, y double")
    lines = spark.createDataFrame([(0.0, 0.0, 9.0, 0.0), (0.0, 0.0, None, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    assert {g[0]: g["nearest_road_distance_m"] for g in matching.nearest(points, lines, 150.0).collect()} == {1: 3.0, 2: None, 3: None, 4: None, 5: None}


def test_unmatched_buckets_pass_on_no_pairs(spark, dense):
    assert holds(spark, dense, "unmatched_buckets") < 10_000


def test_unmatched_buckets_broadcast_no_segments(spark, dense):
    holds(spark, dense, "unmatched_buckets")
    assert rows_of(spark, "BroadcastExchange") == 0


def crowd(spark, x):
    """20,000 points in one place of 100 m by 100 m, and 1,000 segments along a meridian."""
    points = spark.range(20_000).selectExpr("id AS point_id", "CAST(id % 100 AS DOUBLE) AS x", "CAST(id DIV 100 % 100 AS DOUBLE) AS y", "0D AS traj_azimuth")
    y = "CAST(id AS DOUBLE) / 10"
    return points, spark.range(1_000).selectExpr("id AS match_segment_id", "id % 5 AS road_feature_id", f"{x} AS x1", f"{y} AS y1", f"{x} AS x2", f"{y} + 1 AS y2", "0D AS road_azimuth")


def test_unmatched_points_list_segments_seldom(spark):
    """Some 11,000 times with tiles as wide as the radius and parts of 8,192 points."""
    got = {g[0]: g[1] for g in matching.unmatched_summary(*crowd(spark, "200D"), P, keys=()).collect()}
    assert rows_of(spark, "Exchange", "shuffle records written") < 20_000 + 6_000
    assert got == {"GT_75_LE_150_M": 10_000, "GT_150_M_OR_NO_CANDIDATE": 10_000}


def test_candidate_counts_pass_on_no_pairs(spark, dense):
    assert holds(spark, dense, "candidate_counts") < 10_000


def test_match_metrics_pass_on_no_pairs(spark, dense):
    assert holds(spark, dense, "match_metrics") < 10_000


def test_radius_tier_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "radius_tier") < 10_000


def test_runner_up_margin_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "runner_up_margin") < 10_000


def test_best_road_heading_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "best_road_heading") < 10_000


def test_best_road_heading_broadcasts_no_segments(spark, dense):
    holds(spark, dense, "best_road_heading")
    assert rows_of(spark, "BroadcastExchange") == 0


def test_best_roads_list_segments_seldom(spark):
    """Some 3,600 times with tiles as wide as a cell, and 5,600 times with parts of 8,192 points, too."""
    got = matching.best_roads(*crowd(spark, "110D"), P, digits=6).select("point_id", "dist_to_axis").collect()
    assert rows_of(spark, "Exchange", "shuffle records written") < 20_000 + 3_000
    assert {(g[0], g[1]) for g in got} == {(i, 110.0 - i % 100) for i in range(20_000) if i % 100 >= 70} and len(got) == 6_000


def test_best_segment_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "best_segment") < 10_000


def test_best_segments_come_some_points_at_a_time(dense):
    """90,000 pairs, which a task never holds at once, whichever part of a tile they lie in."""
    con = dense[1]
    left = con.sql(f"WITH {POINTS_SQL} SELECT point_id, x, y FROM pts").to_arrow_table()
    right = con.sql(f"WITH {SEGMENTS_SQL} SELECT * FROM seg").to_arrow_table()
    names = ["point_id", "road_feature_id", "match_segment_id", "dist_to_axis"]
    found = [pa.table(x).select(names) for x in nearby.Candidates(left, right, 40.0, 15.0, 0.35, 6).segments(names)]
    assert len(found) > 5 and max(len(set(t["point_id"].to_pylist())) for t in found) <= nearby.LEAF
    want = con.sql(registry.oracle_sql()["best_segment"]).to_arrow_table().select(names)
    assert sorted(map(str, pa.concat_tables(found).to_pylist())) == sorted(map(str, want.to_pylist()))


def test_best_segment_heading_passes_on_no_pairs(spark, dense):
    assert holds(spark, dense, "best_segment_heading") < 10_000


def test_best_segment_heading_rounds_without_decimals(spark, dense):
    """round() of a double goes by way of a decimal, for every pair twice."""
    df = registry.queries()["best_segment_heading"](spark, dense[0])
    assert "round(" not in df._jdf.queryExecution().toString()


def test_candidate_join_grid_broadcasts_no_segments(spark, dense):
    holds(spark, dense, "candidate_join_grid")
    assert rows_of(spark, "BroadcastExchange") == 0


def test_candidate_join_grid_lists_segments_seldom(spark, dense):
    """No pair is shuffled, joined or sorted; an equi-join on cells of 25 m shuffled 9,316 rows."""
    assert holds(spark, dense, "candidate_join_grid") < 10_000
    assert 600 <= rows_of(spark, "Exchange", "shuffle records written") < 3_000


def test_pairs_of_crowded_tiles_are_dealt_out_in_parts(spark, dense, monkeypatch):
    monkeypatch.setattr(nearby, "PART", 400)
    holds(spark, dense, "candidate_join_grid")
    assert 0 < rows_of(spark, "BroadcastExchange") < 10


def test_pairs_come_some_points_at_a_time(dense):
    """90,000 pairs, which a task never holds at once."""
    con = dense[1]
    left = con.sql(f"WITH {POINTS_SQL} SELECT point_id, x, y FROM pts").to_arrow_table()
    right = con.sql(f"WITH {SEGMENTS_SQL} SELECT match_segment_id, x1, y1, x2, y2 FROM seg").to_arrow_table()
    found = [len(t["dist_to_axis"]) for t in nearby.pairs_of(left, right, 40.0, 6)]
    assert len(found) > 1 and max(found) < nearby.PART + nearby.BLOCK and sum(found) == con.sql(registry.oracle_sql()["candidate_join_grid"]).count("*").fetchall()[0][0]


def test_pairs_keep_odd_columns_and_places(spark):
    """Points and segments without a place meet nothing; text ids, nulls and other columns stay; copies are rows of their own."""
    points = spark.createDataFrame([("a", 0.0, 3.0, [1]), ("a", 0.0, 3.0, None), (None, 1.0, 40.0, [2]), ("n", None, 1.0, None), ("n", float("nan"), 1.0, None), ("n", float("inf"), 1.0, None), ("far", 1e6, 1e6, None)], "point_id string, x double, y double, more array<int>")
    lines = spark.createDataFrame([(7, 0.0, 0.0, 9.0, 0.0, None), (None, 0.0, 0.0, 0.0, 0.0, "t"), (8, 0.0, 0.0, None, 0.0, "t"), (9, 0.0, 0.0, float("nan"), 0.0, "t")], "match_segment_id long, x1 double, y1 double, x2 double, y2 double, tag string")
    got = matching.grid_join(points, lines, 40.0, digits=6)
    assert got.columns == [*points.columns, *lines.columns, "dist_to_axis"]
    rows = sorted(str((g["point_id"], g["more"], g["match_segment_id"], g["tag"], g["dist_to_axis"])) for g in got.collect())
    assert rows == sorted(map(str, [("a", [1], 7, None, 3.0), ("a", [1], None, "t", 3.0), ("a", None, 7, None, 3.0), ("a", None, None, "t", 3.0), (None, [2], 7, None, 40.0)]))


def test_a_long_segment_is_listed_along_itself(spark):
    """160,000 cells of its box, some 3,000 in reach."""
    r = random.Random(3)
    points = spark.createDataFrame([(i, r.uniform(0, 1e4), r.uniform(0, 1e4)) for i in range(2000)] + [(-1, 5000.0, 5039.0)], "point_id long, x double, y double")
    line = spark.createDataFrame([("s", 0.0, 0.0, 1e4, 1e4)], "match_segment_id string, x1 double, y1 double, x2 double, y2 double")
    got = {g["point_id"] for g in matching.grid_join(points, line, 40.0, 25.0).collect()}
    assert rows_of(spark, "BroadcastExchange") + rows_of(spark, "Exchange", "shuffle records written") < 20_000
    assert got == {p["point_id"] for p in points.collect() if abs(p["x"] - p["y"]) <= 40 * math.sqrt(2)} and -1 in got
