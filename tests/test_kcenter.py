import numpy as np
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from conftest import SF_CHECK, points_df
from pinwheel.operators import geometry, kcenter
from pinwheel.sources import tables


def _arrays(df):
    rows = df.orderBy("ord").collect()
    pts = np.array([r["coords"] for r in rows], dtype=float)
    w = np.array([r["w"] if "w" in df.columns else 1 for r in rows], dtype=np.int64)
    return pts, w, np.array([r["ord"] for r in rows]), np.array([r["id"] for r in rows])


@pytest.mark.parametrize("table,k,z,guesses,ncenters", [
    (tables.points_supplier, 4, 6, 4, 3),
    (tables.points_customer, 4, 6, 3, 4),
])
def test_kcenter_matches_bruteforce(spark, table, k, z, guesses, ncenters):
    pts_df = table(spark, SF_CHECK)
    res = kcenter.kcenter_outliers(pts_df, k, z, 0.0)
    pts, w, o, ids = _arrays(pts_df)
    cs, r0, rf, g = bf.kcenter(pts, w, o, ids, k, z, 0.0)
    got = [r["id"] for r in res.centers.orderBy("step").collect()]
    assert got == cs
    assert (res.initial_guess, res.final_guess, res.guesses) == (r0, rf, g)
    assert (res.guesses, len(got)) == (guesses, ncenters)
    assert len(got) <= k and res.left_weight <= z


@pytest.mark.parametrize("hot", [0, 10 ** 9])
def test_greedy_cover_fixed_radius(spark, hot):
    # hot = 0 forces fine-cell aggregation, 10**9 the plain grid join.
    pts_df = tables.points_customer(spark, SF_CHECK)
    stats = geometry.validate_points(pts_df)
    merged, _ = kcenter._cached_merge(geometry.with_weight(pts_df))
    res = kcenter.greedy_batch(merged, stats, [(0, 400.0, 1200.0), (1, 800.0, 2400.0)], 4, hot_cell=hot)
    merged.unpersist()
    pts, w, o, ids = _arrays(pts_df)
    mp, mw, mo, mi = bf.merge(pts, w, o, ids)
    for g, r in ((0, 400.0), (1, 800.0)):
        cs, bws, want_left = bf.greedy(mp, mw, mo, mi, r, 3 * r, 4)
        rows = res.centers.where(F.col("g") == g).orderBy("step").collect()
        assert [r["id"] for r in rows] == cs
        assert [r["ball_weight"] for r in rows] == bws
        assert res.left[g] == want_left


def test_all_points_equal(spark):
    res = kcenter.kcenter_outliers(points_df(spark, [[1.0, 1.0]] * 20), 2, 3)
    assert res.centers.count() == 1 and res.final_guess == 0.0


def test_duplicates_among_first_points(spark):
    coords = [[0.0], [0.0], [0.0], [10.0], [20.0], [30.0], [40.0], [50.0]]
    res = kcenter.kcenter_outliers(points_df(spark, coords), 2, 1)
    pts = np.array(coords)
    cs, r0, rf, g = bf.kcenter(pts, np.ones(8, dtype=np.int64), np.arange(8), np.arange(8), 2, 1, 0.0)
    assert r0 == 0.0 and res.initial_guess == 0.0
    assert [r["id"] for r in res.centers.orderBy("step").collect()] == cs
    assert (res.final_guess, res.guesses) == (rf, g)


def test_few_points_clamps_first_block(spark):
    res = kcenter.kcenter_outliers(points_df(spark, [[0.0], [1.0], [3.0], [7.0], [15.0]]), 3, 1)
    assert res.centers.count() <= 3 and res.left_weight <= 1


def test_guards(spark):
    pts = points_df(spark, [[float(i)] for i in range(5)])
    assert kcenter.kcenter_outliers(pts, 6, 0).centers.count() == 0
    assert kcenter.kcenter_outliers(pts, 2, 5).guesses == 0
    res = kcenter.kcenter_outliers(pts, 5, 0)
    assert res.centers.count() == 5 and res.guesses == 0 and res.final_guess == 0.0
    empty = pts.filter(F.col("id") < 0)
    assert kcenter.kcenter_outliers(empty, 1, 0).centers.count() == 0


def test_bad_arguments(spark):
    pts = points_df(spark, [[0.0], [1.0]])
    with pytest.raises(ValueError):
        kcenter.kcenter_outliers(pts, 0, 1)
    with pytest.raises(ValueError):
        kcenter.kcenter_outliers(pts, 1, -1)


def test_weighted_points(spark):
    coords = [[0.0], [1.0], [10.0], [11.0], [30.0]]
    weights = [5, 1, 1, 1, 3]
    res = kcenter.kcenter_outliers(points_df(spark, coords, weights), 2, 1, 2.0)
    pts = np.array(coords)
    cs, r0, rf, g = bf.kcenter(pts, np.array(weights), np.arange(5), np.arange(5), 2, 1, 2.0)
    assert [r["id"] for r in res.centers.orderBy("step").collect()] == cs
    assert (res.initial_guess, res.final_guess, res.guesses) == (r0, rf, g)


def test_hot_spot(spark, monkeypatch):
    """A third of the points in one tight cluster: the solver picks fine-cell aggregation by
    itself and still matches the sequential result."""
    picked = set()
    real = kcenter.ball_weight_sums

    def spy(*args, **kwargs):
        picked.add(kwargs.get("aggregate"))
        return real(*args, **kwargs)

    monkeypatch.setattr(kcenter, "ball_weight_sums", spy)
    base = tables.points_customer(spark, SF_CHECK).orderBy("ord").collect()
    rng = np.random.default_rng(11)
    hot = np.array([5000.0, 1200.0]) + rng.normal(0, 0.5, (800, 2))
    coords = [list(r["coords"]) for r in base] + hot.tolist()
    res = kcenter.kcenter_outliers(points_df(spark, coords), 4, 6, 0.0)
    pts = np.array(coords)
    n = len(coords)
    cs, r0, rf, g = bf.kcenter(pts, np.ones(n, dtype=np.int64), np.arange(n), np.arange(n), 4, 6, 0.0)
    assert [r["id"] for r in res.centers.orderBy("step").collect()] == cs
    assert (res.initial_guess, res.final_guess, res.guesses) == (r0, rf, g)
    assert picked == {True}


def test_certified_steps_on_separated_clusters(spark, monkeypatch):
    """Well-separated clusters: several centers are certified in one pass, same result."""
    taken = []
    real = kcenter._take_certain

    def spy(cells, chosen, k):
        before = len(chosen)
        out = real(cells, chosen, k)
        taken.append(len(chosen) - before)
        return out

    monkeypatch.setattr(kcenter, "_take_certain", spy)
    rng = np.random.default_rng(4)
    centers = np.array([[0.0, 0.0], [1000.0, 0.0], [0.0, 1000.0], [1000.0, 1000.0]])
    coords = np.vstack([c + rng.normal(0, 5, (60, 2)) for c in centers] + [rng.uniform(-3000, 3000, (3, 2))])
    n = len(coords)
    res = kcenter.kcenter_outliers(points_df(spark, coords.tolist()), 4, 3, 0.0)
    cs, r0, rf, g = bf.kcenter(coords, np.ones(n, dtype=np.int64), np.arange(n), np.arange(n), 4, 3, 0.0)
    assert [r["id"] for r in res.centers.orderBy("step").collect()] == cs
    assert (res.initial_guess, res.final_guess, res.guesses) == (r0, rf, g)
    assert max(taken) > 1


@pytest.mark.parametrize("hi", [(1e6, 0.0), (1e6, 1.0), (1e6, 1e6), (0.0, 0.0), (5.0, 5.0, 5.0), (1e9, 1.0, 1e-9)])
def test_certification_grid_is_bounded(hi):
    """However flat or unequal the extents, at most CERT_CELLS cells: what a pass returns."""
    stats = geometry.PointStats(1_000_000, len(hi), 1e9, tuple(0.0 for _ in hi), hi)
    for r in (0.0, 1e-9, 1.0, 1e7):
        grid = kcenter._cert_grid(r, 3 * r, stats)
        assert 1 <= grid.res.prod() <= kcenter.CERT_CELLS
        assert (grid.res[np.array(hi) == 0] == 1).all()


def test_flat_points_collect_few_rows(spark, monkeypatch):
    rows = []
    real = kcenter._CellMaxima.__init__

    def spy(self, grid, found, d):
        rows.append(len(found))
        real(self, grid, found, d)

    monkeypatch.setattr(kcenter._CellMaxima, "__init__", spy)
    rng = np.random.default_rng(2)
    coords = np.stack([rng.uniform(0, 1e6, 5000), np.full(5000, 3.0)], axis=1)
    centers, left = kcenter.greedy_cover(points_df(spark, coords.tolist()), 5.0, 2)
    cs, bws, want = bf.greedy(coords, np.ones(5000, dtype=np.int64), np.arange(5000), np.arange(5000), 5.0, 15.0, 2)
    assert [r["id"] for r in centers.orderBy("step").collect()] == cs and left == want
    assert rows and max(rows) <= kcenter.CERT_CELLS


def test_larger_guesses_are_dropped(spark):
    pts_df = tables.points_supplier(spark, SF_CHECK)
    stats = geometry.validate_points(pts_df)
    merged, _ = kcenter._cached_merge(geometry.with_weight(pts_df))
    res = kcenter.greedy_batch(merged, stats, [(g, 4000.0 * 2 ** g, 12000.0 * 2 ** g) for g in range(6)], 4, enough=6)
    merged.unpersist()
    assert res.left[0] <= 6 and min(g for g, lw in res.left.items() if lw <= 6) == 0


def test_guesses_that_certainly_fail_are_not_run(spark, monkeypatch):
    rng = np.random.default_rng(3)
    coords = (rng.uniform(0, 1, (1200, 3)) * [1000, 5, 5]).round(2)
    weights = [int(v) for v in rng.integers(0, 4, len(coords))]
    df = points_df(spark, coords.tolist(), weights)
    pts, w, o, ids = _arrays(df)
    cs, r0, rf, g = bf.kcenter(pts, w, o, ids, 3, 40, 0.0)
    run, batch = [], kcenter.greedy_batch

    def recorded(merged, stats, guesses, *args, **kwargs):
        run.extend(guess[0] for guess in guesses)
        return batch(merged, stats, guesses, *args, **kwargs)

    monkeypatch.setattr(kcenter, "greedy_batch", recorded)
    res = kcenter.kcenter_outliers(df, 3, 40, 0.0, batch=1)
    assert [r["id"] for r in res.centers.orderBy("step").collect()] == cs
    assert (res.initial_guess, res.final_guess, res.guesses) == (r0, rf, g)
    assert g > 2 and 0 not in run


def test_ball_bound(spark):
    rng = np.random.default_rng(1)
    coords = np.concatenate([rng.normal(0, 5, (300, 3)), rng.uniform(-100, 100, (300, 3)), np.full((1, 3), 7.0)])
    weights = [int(v) for v in rng.integers(0, 5, len(coords))]
    df = points_df(spark, coords.tolist(), weights)
    bound = kcenter._BallBound(df, geometry.validate_points(df))
    dist = np.sqrt(((coords[:, None] - coords) ** 2).sum(2))
    for radius in (0.0, 0.5, 5.0, 60.0, 1000.0):
        assert bound.most(radius) >= ((dist <= radius) @ np.array(weights)).max()
    assert bound.most(0.5) < sum(weights) / 2 and bound.most(1000.0) == sum(weights)
    # A negative weight proves nothing; equal points have one cell.
    one = points_df(spark, [[1.0, 2.0]] * 3, [5, -1, 2])
    assert not kcenter._BallBound(one, geometry.validate_points(one)).fails(0.0, 1, 0)
