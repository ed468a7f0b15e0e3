import numpy as np
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from conftest import SF_CHECK, points_df
from pinwheel.operators import geometry
from pinwheel.sources import tables
from pinwheel.sources.text import parse_points


def _bw(spark, pts, radius, active=None, hot=geometry.HOT_CELL):
    df = points_df(spark, pts)
    act = df if active is None else df.filter(F.col("id").isin([int(i) for i in np.nonzero(active)[0]]))
    out = geometry.ball_weights(df, act, radius, hot_cell=hot).orderBy("id").collect()
    return np.array([r["ball_weight"] for r in out])


@pytest.mark.parametrize("hot", [0, 10 ** 9])
@pytest.mark.parametrize("d", [1, 2, 3, 5])
def test_ball_weights_match_bruteforce(spark, d, hot):
    # hot = 0 forces the fine-cell aggregation, 10**9 the plain grid join.
    rng = np.random.default_rng(7 + d)
    # A dense cluster, a spread cloud and integer points (exact boundary distances).
    pts = np.vstack([rng.normal(0, 0.01, (40, d)), rng.uniform(-5, 5, (60, d)),
                     rng.integers(-3, 4, (40, d)).astype(float)])
    for radius in [0.0, 0.5, 1.0, 2.0, 50.0]:
        got = _bw(spark, pts, radius, hot=hot)
        want = bf.ball_weights(pts, np.ones(len(pts), dtype=np.int64), np.ones(len(pts), bool), radius)
        assert (got == want).all(), (d, radius)


def test_crowded_balls_list_no_pairs(spark):
    """Crowded balls are counted by blocks and trees: no join on cells lists their points."""
    rng = np.random.default_rng(12)
    pts = np.vstack([rng.normal(0, 1, (3000, 2)), rng.uniform(-50, 50, (300, 2)), np.zeros((40, 2))])
    df = points_df(spark, pts)
    out = geometry.ball_weights(df, df, 1.5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan
    want = [int((np.sqrt((p[0] - pts[:, 0]) ** 2 + (p[1] - pts[:, 1]) ** 2) <= 1.5).sum()) for p in pts]
    assert [r["ball_weight"] for r in out.orderBy("id").collect()] == want


@pytest.mark.parametrize("hot", [0, 10 ** 9])
def test_ball_weights_active_subset(spark, hot):
    rng = np.random.default_rng(3)
    pts = rng.integers(0, 6, (80, 2)).astype(float) + rng.integers(0, 2, (80, 1)) * 0.5
    active = rng.random(80) < 0.5
    got = _bw(spark, pts, 1.5, active, hot)
    want = bf.ball_weights(pts, np.ones(80, dtype=np.int64), active, 1.5)
    assert (got == want).all()


@pytest.mark.parametrize("hot", [0, 10 ** 9])
def test_ball_boundary_inclusive(spark, hot):
    pts = [[0.0, 0.0], [3.0, 4.0]]
    assert list(_bw(spark, np.array(pts), 5.0, hot=hot)) == [2, 2]
    assert list(_bw(spark, np.array(pts), np.nextafter(5.0, 0), hot=hot)) == [1, 1]


def test_ball_members_and_removal(spark):
    pts = points_df(spark, [[0.0], [1.0], [2.5], [10.0]])
    pairs = {(r["id"], r["member_id"]) for r in geometry.ball_members(pts, 1.5).collect()}
    assert pairs == {(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (1, 2), (2, 1), (3, 3)}
    left = [r["id"] for r in geometry.ball_removal(pts, points_df(spark, [[0.0]]), 2.5, 1).orderBy("id").collect()]
    assert left == [3]


def test_heaviest_ball_ties_to_lowest_ord(spark):
    w = spark.createDataFrame([(5, 9, 3), (6, 2, 3), (7, 1, 2)], "id long, ord long, ball_weight long")
    row = geometry.heaviest_ball(w).collect()[0]
    assert (row["id"], row["ball_weight"]) == (6, 3)


def test_nearest_center_ties_and_distances(spark):
    pts = points_df(spark, [[0.0, 0.0], [2.0, 0.0], [5.0, 5.0]])
    centers = points_df(spark, [[1.0, 0.0], [3.0, 0.0]], ids=[10, 11])
    rows = geometry.nearest_center(pts, centers).orderBy("id").collect()
    assert [r["center_id"] for r in rows] == [10, 10, 11]  # point 1 is equidistant
    assert rows[0]["dist"] == 1.0


def test_dist_to_centers_matches_bruteforce(spark):
    emb = tables.points_embeddings(spark, SF_CHECK)
    data = emb.orderBy("id").collect()
    pts = np.array([r["coords"] for r in data])
    centers = [pts[0], pts[5], pts[9]]
    cdf = emb.filter(F.col("id").isin([data[0]["id"], data[5]["id"], data[9]["id"]]))
    got = np.array([r["dist"] for r in geometry.dist_to_centers(emb, cdf).orderBy("id").collect()])
    want = np.min(np.vstack([bf.dist_to(pts, c) for c in centers]), axis=0)
    assert np.array_equal(got, want)


def test_validation_errors(spark):
    with pytest.raises(ValueError):
        geometry.validate_points(points_df(spark, [[1.0, 2.0], [1.0, 2.0, 3.0]]))
    with pytest.raises(ValueError):
        geometry.validate_points(points_df(spark, [[1.0, float("nan")]]))


def test_parse_points_trailing_separators(spark):
    lines = spark.createDataFrame([(0, "1,2,,"), (1, "3.5,-4")], "id long, value string")
    rows = parse_points(lines).orderBy("id").collect()
    assert [list(r["coords"]) for r in rows] == [[1.0, 2.0], [3.5, -4.0]]


def test_initial_guess_first_points(spark):
    pts = points_df(spark, [[0.0], [10.0], [4.0], [4.5]])
    assert geometry.initial_guess(pts, 3, 1).collect()[0]["r0"] == 2.0
    assert geometry.initial_guess(pts, 4, 1).collect()[0]["r0"] == 0.25


@pytest.mark.parametrize("limits", [{}, {"literal_values": 0}, {"literal_values": 0, "block_values": 9},
                                    {"literal_values": 0, "block_values": 9, "leaf": 1}])
def test_center_sets_of_any_size(spark, limits):
    """Literals, one broadcast row, and the join by space: same answers."""
    rng = np.random.default_rng(5)
    pts = rng.integers(0, 20, (200, 2)).astype(float)
    cs = rng.integers(0, 20, (60, 2)).astype(float)
    df = points_df(spark, pts)
    cdf = points_df(spark, cs, ids=list(range(100, 160)))
    rows = geometry.nearest_center(df, cdf, **limits).orderBy("id").collect()
    arg, best = bf.nearest(pts, list(cs))
    assert [r["center_id"] for r in rows] == [100 + int(a) for a in arg]
    assert np.array_equal(np.array([r["dist"] for r in rows]), best)
    dist = [r["dist"] for r in geometry.dist_to_centers(df, cdf, **limits).orderBy("id").collect()]
    assert np.array_equal(np.array(dist), best)
    none = geometry.nearest_center(df, cdf.limit(0), **limits).collect()
    assert len(none) == 200 and all(r["dist"] is None and r["center_id"] is None for r in none)


def test_join_by_space_saves_cells_not_centers(spark, monkeypatch):
    """Few points against many centers: what is written between jobs is cells, not a row per center;
    crowded blocks are cut on both sides; a center with a null coordinate is nearest to nothing."""
    from pinwheel.operators.neighbours import nearest_by_cells
    rng = np.random.default_rng(5)
    ys, xs = rng.random((3000, 2)) * [1000, 50], rng.random((12, 2)) * [1000, 50]
    rows = [(k, k, [float(v) for v in y]) for k, y in enumerate(ys)] + [(5000, 7, [None, 1.0]), (5001, 8, [float("nan"), 1.0])]
    centers = spark.createDataFrame(rows, "o long, i long, c array<double>")
    pts = spark.createDataFrame([(k, [float(v) for v in x]) for k, x in enumerate(xs)], "id long, coords array<double>")
    saved, plain = [], type(pts).checkpoint
    def noted(df, *args, **kwargs):
        out = plain(df, *args, **kwargs)
        saved.append(out.count())
        return out
    monkeypatch.setattr(type(pts), "checkpoint", noted)
    want = [(k, int(d.argmin()), float(d.min())) for k, d in enumerate(np.sqrt(((xs[:, None] - ys[None]) ** 2).sum(2)))]
    for split in (1 << 17, 100, 2):
        saved.clear()
        got = sorted((r["id"], r["center_id"], r["dist"]) for r in nearest_by_cells(pts, centers, 2, split=split).collect())
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-14)
        assert sum(saved) < len(ys) / 10


@pytest.mark.parametrize("leaf", [1, 4, 1000])
def test_join_by_space_equals_all_pairs(spark, leaf):
    rng = np.random.default_rng(31)
    for d in (1, 3, 10):
        cs = np.vstack([rng.normal(0, 0.01, (150, d)), rng.integers(-4, 5, (150, d)), rng.uniform(-1e3, 1e3, (20, d))]).astype(float)
        cs[:, 1:2] = 7.0  # a dimension in which nothing varies
        pts = np.vstack([cs[::9], rng.integers(-4, 5, (60, d)), rng.normal(0, 0.01, (60, d)), rng.uniform(-1e5, 1e5, (10, d))]).astype(float)
        df, cdf = points_df(spark, pts), points_df(spark, cs, ids=list(range(1000, 1000 + len(cs))))
        rows = geometry.nearest_center(df, cdf, literal_values=0, block_values=0, leaf=leaf).orderBy("id").collect()
        arg, best = bf.nearest(pts, list(cs))
        assert np.array_equal(np.array([r["dist"] for r in rows]), best), d
        assert [r["center_id"] for r in rows] == [1000 + int(a) for a in arg], d
    one = geometry.nearest_center(df, cdf.limit(1), literal_values=0, block_values=0, leaf=leaf).collect()
    assert len(one) == len(pts) and all(r["center_id"] is not None for r in one)


@pytest.mark.parametrize("d", [1, 2, 3])
def test_candidates_of_cells_equal_all_pairs(spark, d):
    """A point meets few of many centers, and still its nearest one (ties: the lowest ord)."""
    rng = np.random.default_rng(d)
    cs = np.vstack([rng.integers(-20, 20, (150, d)), rng.normal(0, 0.01, (150, d)), rng.uniform(-1e3, 1e3, (50, d))]).astype(float)
    pts = np.vstack([cs[::9], rng.integers(-20, 20, (100, d)), rng.uniform(-1e4, 1e4, (100, d)), [[np.inf] * d]]).astype(float)
    df, cdf = points_df(spark, pts), points_df(spark, cs, ids=list(range(1000, 1000 + len(cs))))
    rows = geometry.nearest_center(df, cdf, d).orderBy("id").collect()
    arg, best = bf.nearest(pts, list(cs))
    assert np.array_equal(np.array([r["dist"] for r in rows]), best)
    assert [r["center_id"] for r in rows] == [1000 + int(a) for a in arg]
    spread = points_df(spark, rng.uniform(-1e4, 1e4, (350, d)))
    block = spread.agg(F.collect_list(F.struct(F.col("ord").alias("o"), F.col("id").alias("i"), F.col("coords").alias("c"))).alias("_cs")).withColumn("_k", F.lit(0))
    met = geometry._with_candidates(spread, block, 350, d).agg(F.avg(F.size("_cs"))).first()[0]
    assert met < 350 / 5


def test_join_by_space_needs_no_driver(spark):
    """No center is broadcast or gathered: neither collect_list nor a broadcast of more than one row."""
    pts = tables.points_customer(spark, SF_CHECK)
    df = geometry.nearest_center(pts, tables.points_orders(spark, SF_CHECK), literal_values=0, block_values=0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("ResolvedHint") == 0 and plan.count("rightHint=(strategy=broadcast)") <= 1


@pytest.mark.parametrize("bad", [[None, [1.0, 2.0]], [[1.0, None], [1.0, 2.0]]])
def test_null_coordinates_are_refused(spark, bad):
    df = spark.createDataFrame([(i, i, c) for i, c in enumerate(bad)], "id long, ord long, coords array<double>")
    with pytest.raises(ValueError, match="null coordinate"):
        geometry.validate_points(df)
    with pytest.raises(ValueError, match="null coordinate"):
        geometry.nearest_center(df, points_df(spark, [[0.0, 0.0]]))


def test_initial_guess_equals_all_pairs(spark):
    rng = np.random.default_rng(8)
    for d in (1, 2, 4):
        pts = rng.uniform(-50, 50, (120, d))
        want = min(np.sqrt(((a - b) ** 2).sum()) for i, a in enumerate(pts) for b in pts[:i]) / 2
        assert geometry.initial_guess(points_df(spark, pts), 500, d).collect()[0]["r0"] == pytest.approx(want)
    assert geometry.initial_guess(points_df(spark, [[1.0]]), 5, 1).collect()[0]["r0"] is None
    assert geometry.initial_guess(points_df(spark, [[1.0], [2.0], [1.0]]), 3, 1).collect()[0]["r0"] == 0.0


@pytest.mark.parametrize("d", [1, 2, 3, 6])
def test_tree_of_centers_equals_all_pairs(spark, d):
    """Equal and crowded centers, ties, and points that no box bounds."""
    rng = np.random.default_rng(40 + d)
    cs = np.vstack([np.repeat(rng.integers(-5, 5, (30, d)), 20, axis=0), rng.normal(0, 0.01, (150, d)), rng.uniform(-1e6, 1e6, (20, d)),
                    [[1e200] * d]]).astype(float)
    pts = np.vstack([cs[::9], rng.integers(-5, 5, (100, d)), rng.uniform(-1e6, 1e6, (200, d)), [[np.inf] * d, [-1e300] * d]]).astype(float)
    df, cdf = points_df(spark, pts), points_df(spark, cs, ids=list(range(1000, 1000 + len(cs))))
    near = geometry.nearest_center(df, cdf, d, literal_values=0)
    rows = near.orderBy("id").collect()
    arg, best = bf.nearest(pts, list(cs))
    assert np.array_equal(np.array([r["dist"] for r in rows]), best)
    assert [r["center_id"] for r in rows] == [1000 + int(a) for a in arg]
    # No fold over lists of centers per point, however many equal centers there are.
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "_cs" not in plan


def test_tree_of_centers_skips_missing_coordinates(spark):
    rows = [(0, 0, [0.0, 1.0]), (1, 1, [None, 1.0]), (2, 2, [float("nan"), 1.0]), (3, 3, None)]
    df = spark.createDataFrame(rows, "id long, ord long, coords array<double>")
    cdf = spark.createDataFrame([(7, 7, [None, 0.0]), (8, 8, [float("nan"), 0.0]), (9, 9, [0.0, 0.0])], "id long, ord long, coords array<double>")
    got = geometry.nearest_center(df, cdf, 2, literal_values=0).orderBy("id").collect()
    assert [(r["dist"], r["center_id"]) for r in got] == [(1.0, 9)] + [(float("inf"), None)] * 3
