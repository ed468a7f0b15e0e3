import numpy as np
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from conftest import SF_CHECK, points_df
from pinwheel.operators import coreset, objective
from pinwheel.sources import tables


def test_fft_and_weights_match_bruteforce(spark):
    pts_df = coreset.assign_parts(tables.points_orders(spark, SF_CHECK), 4)
    m = 11
    centers = coreset.fft_centers(pts_df, m)
    weights = {(r["part"], r["step"]): r["w"] for r in coreset.coreset_weights(pts_df, centers).collect()}
    got = {}
    for r in centers.collect():
        got.setdefault(r["part"], []).append((r["step"], r["id"]))
    rows = pts_df.collect()
    for part in range(4):
        sel = sorted([r for r in rows if r["part"] == part], key=lambda r: r["ord"])
        pts = np.array([r["coords"] for r in sel])
        chosen = bf.fft(pts, np.array([r["ord"] for r in sel]), m)
        assert [i for _, i in sorted(got[part])] == [sel[c]["id"] for c in chosen]
        arg, _ = bf.nearest(pts, [pts[c] for c in chosen])
        counts = np.bincount(arg, minlength=len(chosen))
        assert [weights.get((part, s), 0) for s in range(len(chosen))] == list(counts)
    assert sum(weights.values()) == len(rows)


def test_fft_stops_on_few_distinct_points(spark):
    pts = points_df(spark, [[1.0], [1.0], [2.0], [1.0]])
    centers = coreset.fft_centers(coreset.assign_parts(pts, 1), 5)
    assert sorted(r["id"] for r in centers.collect()) == [0, 2]


def test_empty_groups_are_skipped(spark):
    pts = points_df(spark, [[0.0], [5.0], [9.0]])
    core = coreset.partition_coreset(pts, 1, 0, 8)
    assert core.agg(F.sum("w")).collect()[0][0] == 3
    assert sorted(r["part"] for r in core.collect()) == [0, 1, 2]


def test_equal_points_across_groups_merge_weights(spark):
    pts = points_df(spark, [[1.0], [1.0], [4.0], [9.0]])
    res = coreset.mr_kcenter(pts, 1, 1, 2)
    assert res.solution.centers.count() == 1


def test_two_round_skewed_orders(spark):
    res = coreset.mr_kcenter(tables.points_orders_skewed(spark, SF_CHECK, 4), 4, 6, 4)
    assert (res.solution.guesses, res.solution.centers.count()) == (10, 3)
    core_w = res.coreset.agg(F.sum("w")).collect()[0][0]
    assert core_w == 15000


def test_two_round_orders(spark):
    res = coreset.mr_kcenter(tables.points_orders(spark, SF_CHECK), 4, 6, 4)
    assert (res.solution.guesses, res.solution.centers.count()) == (1, 2)


def _obj(spark):
    pts = tables.points_part_1d(spark, SF_CHECK)
    centers = spark.createDataFrame([(0, 0, [10.0]), (1, 1, [40.0])], "id long, ord long, coords array<double>")
    return pts, centers


def test_objectives_on_ties(spark):
    pts, centers = _obj(spark)
    assert objective.objective_value(objective.objective_distinct(pts, centers, 5)) == 10.0
    assert objective.objective_value(objective.objective_partitioned(pts, centers, 5, 4)) == 14.0
    assert objective.objective_value(objective.objective_points(pts, centers, 5)) == 15.0


def test_partitioned_with_one_group_equals_distinct(spark):
    pts, centers = _obj(spark)
    assert objective.objective_value(objective.objective_partitioned(pts, centers, 5, 1)) == \
        objective.objective_value(objective.objective_distinct(pts, centers, 5))


def test_objective_guards(spark):
    pts = points_df(spark, [[0.0], [3.0]])
    empty = pts.filter(F.col("id") < 0)
    assert objective.objective_value(objective.objective_distinct(pts, empty, 0)) == 0.0
    assert objective.objective_value(objective.objective_partitioned(pts, empty, 0, 2)) == 0.0
    assert objective.objective_value(objective.objective_distinct(pts, pts, 0)) == 0.0
    with pytest.raises(Exception):
        objective.objective_value(objective.objective_points(pts, pts.limit(1), 5))


@pytest.mark.parametrize("cells", [1, 4, 64, 1024])
def test_fft_certified_cells_exact_with_ties(spark, cells):
    pts_df = coreset.assign_parts(tables.points_part_1d(spark, SF_CHECK), 3)
    m = 9
    got = {}
    for r in coreset.fft_centers(pts_df, m, cells=cells).collect():
        got.setdefault(r["part"], []).append((r["step"], r["id"]))
    rows = pts_df.collect()
    for part in range(3):
        sel = sorted([r for r in rows if r["part"] == part], key=lambda r: r["ord"])
        pts = np.array([r["coords"] for r in sel])
        chosen = bf.fft(pts, np.array([r["ord"] for r in sel]), m)
        assert [i for _, i in sorted(got[part])] == [sel[c]["id"] for c in chosen]


def test_fft_high_dimension_matches_bruteforce(spark):
    emb = coreset.assign_parts(tables.points_embeddings(spark, SF_CHECK).drop("label"), 2)
    m = 6
    got = {}
    for r in coreset.fft_centers(emb, m).collect():
        got.setdefault(r["part"], []).append((r["step"], r["id"]))
    rows = emb.collect()
    for part in range(2):
        sel = sorted([r for r in rows if r["part"] == part], key=lambda r: r["ord"])
        pts = np.array([r["coords"] for r in sel])
        chosen = bf.fft(pts, np.array([r["ord"] for r in sel]), m)
        assert [i for _, i in sorted(got[part])] == [sel[c]["id"] for c in chosen]


def test_partition_independence_of_iterative_operators(spark):
    from pinwheel.operators import kcenter
    results = []
    for n in (1, 4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        pts = coreset.assign_parts(tables.points_supplier(spark, SF_CHECK), 3)
        fft = sorted(tuple(r) for r in coreset.fft_centers(pts, 5).select("part", "step", "id").collect())
        res = kcenter.kcenter_outliers(pts.drop("part"), 4, 6)
        results.append((fft, [r["id"] for r in res.centers.orderBy("step").collect()], res.final_guess))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("broadcast_values,pending,every", [(10 ** 6, 8, 8), (0, 3, 2)])
def test_many_centers_per_group(spark, broadcast_values, pending, every, monkeypatch):
    """Broadcast or joined, with few or many written states: the same centers and weights."""
    monkeypatch.setattr(coreset, "PENDING_CENTERS", pending)
    monkeypatch.setattr(coreset, "STATES_PER_CHECKPOINT", every)
    pts_df = coreset.assign_parts(tables.points_supplier(spark, SF_CHECK), 2)
    m = 24
    found = coreset.traverse(pts_df, m, broadcast_values=broadcast_values)
    centers = found.centers
    weights = {(r["part"], r["step"]): r["w"] for r in
               coreset.coreset_weights(pts_df, centers, broadcast_values=broadcast_values).collect()}
    own = {(r["part"], r["near"]): r["count"] for r in found.state.groupBy("part", "near").count().collect()}
    assert own == weights
    found.cached.unpersist()
    got = {}
    for r in centers.collect():
        got.setdefault(r["part"], []).append((r["step"], r["id"]))
    rows = pts_df.collect()
    for part in range(2):
        sel = sorted([r for r in rows if r["part"] == part], key=lambda r: r["ord"])
        pts = np.array([r["coords"] for r in sel])
        chosen = bf.fft(pts, np.array([r["ord"] for r in sel]), m)
        assert [i for _, i in sorted(got[part])] == [sel[c]["id"] for c in chosen]
        arg, _ = bf.nearest(pts, [pts[c] for c in chosen])
        assert [weights.get((part, s), 0) for s in range(len(chosen))] == list(np.bincount(arg, minlength=len(chosen)))


@pytest.mark.parametrize("z", [0, 6, 300])
def test_objectives_match_bruteforce(spark, z):
    pts_df = tables.points_customer(spark, SF_CHECK)
    centers = pts_df.where(F.col("id") % 400 == 3)
    rows = pts_df.collect()
    pts, ids = np.array([r["coords"] for r in rows]), np.array([r["id"] for r in rows])
    _, dist = bf.nearest(pts, [np.array(r["coords"]) for r in centers.collect()])
    pairs = {(i % 4, v) for i, v in zip(ids.tolist(), dist.tolist())}
    want = (sorted(set(dist.tolist()))[-z - 1], sorted(v for _, v in pairs)[-z - 1], sorted(dist.tolist())[-z - 1])
    got = (objective.objective_distinct(pts_df, centers, z), objective.objective_partitioned(pts_df, centers, z, 4),
           objective.objective_points(pts_df, centers, z))
    assert tuple(objective.objective_value(g) for g in got) == want


@pytest.mark.parametrize("z", [0, 6, 300])
def test_one_pass_equals_two(spark, z, monkeypatch):
    monkeypatch.setattr(objective, "GATHERED", 50)
    pts = tables.points_customer(spark, SF_CHECK)
    centers = pts.where(F.col("id") % 400 == 3)
    value = objective.objective_value
    assert value(objective.distinct_in_one_pass(pts, centers, z)) == value(objective.objective_distinct(pts, centers, z))
    assert value(objective.partitioned_in_one_pass(pts, centers, z, 4)) == value(objective.objective_partitioned(pts, centers, z, 4))
    assert value(objective.points_in_one_pass(pts, centers, z)) == value(objective.objective_points(pts, centers, z))


def test_one_pass_guards(spark):
    pts = points_df(spark, [[0.0], [3.0]])
    empty = pts.filter(F.col("id") < 0)
    value = objective.objective_value
    assert value(objective.distinct_in_one_pass(pts, empty, 0)) == value(objective.partitioned_in_one_pass(pts, empty, 0, 2)) == 0.0
    assert value(objective.distinct_in_one_pass(pts, pts, 0)) == 0.0
    for bad in ([[0.0], [None]], [[0.0], [float("nan")]], [[0.0], [1.0, 2.0]]):
        rows = spark.createDataFrame([(i, i, c) for i, c in enumerate(bad)], "id long, ord long, coords array<double>")
        with pytest.raises(Exception):
            value(objective.points_in_one_pass(rows, pts.limit(1), 0))
    with pytest.raises(Exception, match="fewer than 6"):
        value(objective.points_in_one_pass(pts, pts.limit(1), 5))


def test_one_pass_scans_once(spark):
    pts = tables.points_customer(spark, SF_CHECK)
    centers = pts.where(F.col("id") % 400 == 3).limit(2)
    for df in (objective.distinct_in_one_pass(pts, centers, 5), objective.points_in_one_pass(pts, centers, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Window" not in plan


def test_traversal_state_is_spread(spark):
    coords = np.random.default_rng(5).uniform(0, 100, (3000, 2)).tolist()
    one = points_df(spark, coords).coalesce(1)
    found = coreset.traverse(one, 3, parts=2)
    few = coreset.traverse(points_df(spark, coords).repartition(4), 3, parts=2)
    assert found.cached.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, found.centers.select("part", "step", "id").collect())) == sorted(map(tuple, few.centers.select("part", "step", "id").collect()))
    for t in (found, few):
        t.cached.unpersist()
