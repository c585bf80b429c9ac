"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from velograph.plans import registry
from velograph.plans.standins import segments

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET enable_progress_bar = false; SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, columns, order):
    at = [columns.index(c) for c in order]
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = registry.queries()[name](spark, SF)
    want = db.sql(registry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    assert plain(df.collect(), df.columns, order) == plain(want.fetchall(), list(want.columns), order)


def test_whole_matching_leaves_no_point_out(spark, db):
    """The nine matching queries over every point, against pairs by nested loops."""
    run = registry.queries()
    pts = db.sql("SELECT event_id, ((event_id * 7919) % 2999)::DOUBLE, ((event_id * 104729) % 3001)::DOUBLE FROM events").fetchall()
    segs = segments(spark, SF).select("match_segment_id", "x1", "y1", "x2", "y2").collect()
    near = {}
    for p, x, y in pts:
        for s, x1, y1, x2, y2 in segs:
            q = (x2 - x1) ** 2 + (y2 - y1) ** 2
            u = max(0.0, min(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / q)) if q else 0.0
            near[p, s] = round(math.hypot(x - x1 - u * (x2 - x1), y - y1 - u * (y2 - y1)), 6)
    least = {p: min(near[p, s[0]] for s in segs) for p, _, _ in pts}
    pairs = {(r[0], r[1]) for r in run["candidate_join_grid"](spark, SF).collect()}
    assert pairs == {k for k, d in near.items() if d <= 40} and any(p % 3 for p, _ in pairs)
    found = {r[0]: r[1] for r in run["nearest_distance"](spark, SF).collect()}
    assert found.keys() == least.keys() and all(found[p] == pytest.approx(d) if d <= 150 else found[p] is None for p, d in least.items())
    assert sum(r["unmatched_point_count"] for r in run["unmatched_buckets"](spark, SF).collect()) == sum(d > 40 for d in least.values())
    matched = {p for p, d in least.items() if d <= 40}
    for name in ("best_segment", "best_road", "candidate_counts", "runner_up_margin"):
        assert {r["point_id"] for r in run[f"{name}"](spark, SF).collect()} == matched
    assert sum(r["n"] for r in run["radius_tier"](spark, SF).collect()) == len(matched)
    assert {r["metric"]: r["value"] for r in run["match_metrics"](spark, SF).collect()}["sample_rows"] == len(matched)


def test_the_comparison_of_two_sources_takes_every_line(spark, db):
    got = registry.queries()["two_source_comparison"](spark, SF)
    assert got.agg({"overlap_count": "sum"}).first()[0] == db.sql("SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey").fetchall()[0][0]
