"""Registered distance, ball, k-center, coreset and objective queries, with SQL oracles.

Inputs (all rows of the tables, see FIXTURES.md):
supplier points (s_acctbal, 100 * s_nationkey), customer points (c_acctbal,
100 * c_nationkey), part points (p_size, p_retailprice) and (p_size), order points
(o_totalprice, o_custkey) and the 64-dimensional embeddings.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pinwheel.operators import coreset, geometry, kcenter, objective
from pinwheel.plans import iterative_sql as isql
from pinwheel.sources import tables
from pinwheel.sources.text import parse_points, read_points

# Parameters of the registered queries.
K, Z = 4, 6
PARTS = 4
BALL_RADIUS = 250.0
COVER_RADIUS = 400.0
EMB_DIM = 64
OBJ_CENTERS = [[10.0], [40.0]]
OBJ_Z = 5


def _sql_dist(a: str, b: str, cols: list[str]) -> str:
    terms = [f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols]
    return "sqrt(" + " + ".join(terms) + ")"


def _sql_vec_dist(a: str, b: str, d: int) -> str:
    terms = [f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, d + 1)]
    return "sqrt(" + " + ".join(terms) + ")"


XY = ["x", "y"]
PTS_S = "SELECT s_suppkey AS id, s_acctbal AS x, CAST(s_nationkey * 100 AS DOUBLE) AS y FROM supplier"
PTS_C = ("SELECT c_custkey AS id, c_nationkey AS nat, c_acctbal AS x, CAST(c_nationkey * 100 AS DOUBLE) AS y "
         "FROM customer")
EMB = "SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"


def _xy(df):
    return df.select("*", F.col("coords").getItem(0).alias("x0"), F.col("coords").getItem(1).alias("x1"))


# ---------------------------------------------------------------- sources and distances

def q_points_parse(spark, sf_dir):
    """Point lines (with a trailing separator) parsed back into vectors."""
    part = tables.load(spark, sf_dir, "part")
    lines = part.select(F.col("p_partkey").alias("id"),
                        F.concat(F.concat_ws(",", F.col("p_size").cast("string"),
                                             F.col("p_retailprice").cast("string")), F.lit(",")).alias("value"))
    pts = parse_points(lines)
    return pts.select("id", F.size("coords").alias("dim"), F.col("coords").getItem(0).alias("x0"),
                      F.col("coords").getItem(1).alias("x1"))


def _label_seeds(points):
    first = points.groupBy("label").agg(F.min(F.struct("id", "coords")).alias("s"))
    return first.select("label", F.col("s.id").alias("id"), F.col("s.id").alias("ord"), F.col("s.coords").alias("coords"))


def q_euclidean_pairs(spark, sf_dir):
    """Distance from every embedding to the first embedding (lowest id) of its label."""
    emb = tables.points_embeddings(spark, sf_dir)
    return geometry.pair_distances(emb, _label_seeds(emb), ["label"], EMB_DIM)


def q_dist_to_centers(spark, sf_dir):
    """Distance from every embedding to the nearest label seed."""
    emb = tables.points_embeddings(spark, sf_dir)
    return geometry.dist_to_centers(emb, _label_seeds(emb)).select("id", "dist")


def _nation_seeds(spark, sf_dir):
    c = tables.load(spark, sf_dir, "customer")
    first = c.groupBy("c_nationkey").agg(F.min(F.struct("c_custkey", "c_acctbal")).alias("s"))
    return first.select(F.col("s.c_custkey").alias("id"), F.col("s.c_custkey").alias("ord"),
                        F.array(F.col("s.c_acctbal"), (F.col("c_nationkey") * 100).cast("double")).alias("coords"))


def q_nearest_center(spark, sf_dir):
    """Nearest nation seed (lowest customer key per nation) of every customer point."""
    pts = tables.points_customer(spark, sf_dir)
    return geometry.nearest_center(pts, _nation_seeds(spark, sf_dir)).select("id", "center_id", "dist")


def q_initial_guess(spark, sf_dir):
    """Half the smallest distance among the first k+z+1 customer points."""
    return geometry.initial_guess(tables.points_customer(spark, sf_dir), K + Z + 1, 2)


# ---------------------------------------------------------------- balls

def q_ball_members(spark, sf_dir):
    return geometry.ball_members(tables.points_supplier(spark, sf_dir), BALL_RADIUS)


def q_ball_weights(spark, sf_dir):
    pts = tables.points_supplier(spark, sf_dir)
    return geometry.ball_weights(pts, pts, BALL_RADIUS)


def _heaviest(spark, sf_dir):
    pts = tables.points_supplier(spark, sf_dir)
    return pts, geometry.heaviest_ball(geometry.ball_weights(pts, pts, BALL_RADIUS))


def q_heaviest_ball(spark, sf_dir):
    return _heaviest(spark, sf_dir)[1]


def q_ball_removal(spark, sf_dir):
    """Points left after removing the outer ball (3r) of the heaviest ball's center."""
    pts, best = _heaviest(spark, sf_dir)
    return geometry.ball_removal(pts, pts.join(best.select("id"), "id"), 3 * BALL_RADIUS, 2).select("id")


# ---------------------------------------------------------------- greedy cover and k-center

def q_greedy_cover(spark, sf_dir):
    centers, left = kcenter.greedy_cover(tables.points_customer(spark, sf_dir), COVER_RADIUS, K)
    return _xy(centers).select("step", "id", "x0", "x1", "ball_weight",
                               F.lit(left).cast("long").alias("left_weight"))


def _kc(spark, sf_dir):
    return kcenter.kcenter_outliers(tables.points_customer(spark, sf_dir), K, Z, 0.0)


def q_kcenter_outliers(spark, sf_dir):
    return _xy(_kc(spark, sf_dir).centers).select("step", "id", "x0", "x1")


def q_kcenter_metrics(spark, sf_dir):
    pts = tables.points_customer(spark, sf_dir)
    res = kcenter.kcenter_outliers(pts, K, Z, 0.0)
    obj = objective.objective_value(objective.distinct_in_one_pass(pts, res.centers, Z, stats=res.stats))
    return res.metrics(spark, obj).select("n", "k", "z", "initial_guess", "final_guess", "guesses",
                                          "left_weight", "objective")


GUARD_SCHEMA = T.StructType([
    T.StructField("case_name", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("k", T.LongType()), T.StructField("z", T.LongType()),
    T.StructField("centers", T.LongType()), T.StructField("guesses", T.LongType()),
    T.StructField("initial_guess", T.DoubleType()), T.StructField("final_guess", T.DoubleType())])


def q_kcenter_guards(spark, sf_dir):
    """The degenerate cases on the supplier points: k = n, k = n + 1 and z = n."""
    pts = tables.points_supplier(spark, sf_dir)
    stats = geometry.validate_points(pts)
    n = stats.n
    rows = []
    for name, k, z in [("k_eq_n", n, Z), ("k_gt_n", n + 1, Z), ("z_ge_n", K, n)]:
        res = kcenter.kcenter_outliers(pts, k, z, 0.0, stats=stats)
        rows.append((name, res.n, k, z, res.centers.count(), res.guesses, res.initial_guess, res.final_guess))
    return spark.createDataFrame(rows, GUARD_SCHEMA)


# ---------------------------------------------------------------- coreset and two rounds

def _orders(spark, sf_dir):
    return coreset.assign_parts(tables.points_orders(spark, sf_dir), PARTS)


def q_fft_centers(spark, sf_dir):
    return coreset.fft_centers(_orders(spark, sf_dir), K + Z + 1).select("part", "step", "id")


def q_coreset_weights(spark, sf_dir):
    pts = _orders(spark, sf_dir)
    return coreset.coreset_weights(pts, coreset.fft_centers(pts, K + Z + 1))


def q_partition_coreset(spark, sf_dir):
    core = coreset.partition_coreset(_orders(spark, sf_dir), K, Z, PARTS)
    return _xy(core).select("ord", "part", "step", "id", "w", "x0", "x1")


def q_total_weight(spark, sf_dir):
    core = coreset.partition_coreset(tables.points_customer(spark, sf_dir), K, Z, PARTS)
    return core.agg(F.sum("w").cast("long").alias("total_weight"))


def q_mr_kcenter(spark, sf_dir):
    res = coreset.mr_kcenter(tables.points_orders_skewed(spark, sf_dir, PARTS), K, Z, PARTS)
    return _xy(res.solution.centers).select("step", "id", "x0", "x1")


def q_mr_kcenter_metrics(spark, sf_dir):
    out = None
    for name, pts in [("orders", tables.points_orders(spark, sf_dir)),
                      ("orders_skewed", tables.points_orders_skewed(spark, sf_dir, PARTS))]:
        res = coreset.mr_kcenter(pts, K, Z, PARTS)
        m = res.solution.metrics(spark, res.objective).select(
            F.lit(name).alias("input"), "n", "k", "z", F.lit(PARTS).cast("long").alias("parts"), "initial_guess",
            "final_guess", "guesses", "left_weight", "objective")
        out = m if out is None else out.unionByName(m)
    return out


# ---------------------------------------------------------------- objectives

def _obj_input(spark, sf_dir):
    pts = tables.points_part_1d(spark, sf_dir)
    centers = spark.createDataFrame([(i, i, c) for i, c in enumerate(OBJ_CENTERS)], "id long, ord long, coords array<double>")
    return pts, centers


def q_objective_distinct(spark, sf_dir):
    pts, centers = _obj_input(spark, sf_dir)
    return objective.objective_distinct(pts, centers, OBJ_Z)


def q_objective_partitioned(spark, sf_dir):
    pts, centers = _obj_input(spark, sf_dir)
    return objective.objective_partitioned(pts, centers, OBJ_Z, PARTS)


def q_objective_points(spark, sf_dir):
    pts, centers = _obj_input(spark, sf_dir)
    return objective.objective_points(pts, centers, OBJ_Z)


# ---------------------------------------------------------------- other sizes, dimensions and paths

MANY_Z = 1500
MANY_FIRST = 1000
MANY_CENTERS = 200
DENSE_RADIUS = 20_000.0
FLAT_RADIUS, FLAT_K = 9_000.0, 3


def _point_file(spark, sf_dir):
    part = tables.load(spark, sf_dir, "part")
    lines = part.select("p_partkey", F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_retailprice").cast("string")).alias("value"))
    return tables.written_lines(lines, "p_partkey")


def q_points_file(spark, sf_dir):
    """Point lines written to files and read again, numbered by their place in the files."""
    return _xy(read_points(spark, _point_file(spark, sf_dir))).select("id", "ord", "x0", "x1")


def q_points_file_joined(spark, sf_dir):
    """The same with the split table joined by shuffle instead of broadcast."""
    return _xy(read_points(spark, _point_file(spark, sf_dir), broadcast_splits=0)).select("id", "ord", "x0", "x1")


def q_nearest_center_large(spark, sf_dir):
    """Nearest line item of every supplier: as many centers as line items, in blocks."""
    return geometry.nearest_center(tables.points_supplier_line(spark, sf_dir), tables.points_lineitem(spark, sf_dir)) \
        .select("id", "center_id", "dist")


def q_initial_guess_many(spark, sf_dir):
    return geometry.initial_guess(tables.points_orders(spark, sf_dir), MANY_FIRST, 2)


def q_ball_weights_dense(spark, sf_dir):
    """Ball weights of the orders at a radius that crowds the grid's cells (summed per fine cell)."""
    pts = tables.points_orders(spark, sf_dir)
    return geometry.ball_weights(pts, pts, DENSE_RADIUS)


def _solved(res):
    return res.centers.select("step", "id", "ball_weight", F.lit(float(res.final_guess)).alias("final_guess"),
                              F.lit(res.guesses).cast("long").alias("guesses"))


def q_kcenter_duplicates(spark, sf_dir):
    """Part points: equal points, weights summed."""
    return _solved(kcenter.kcenter_outliers(tables.points_part(spark, sf_dir), K, Z))


def q_kcenter_1d(spark, sf_dir):
    """One dimension with 50 distinct values: the initial guess is 0."""
    return _solved(kcenter.kcenter_outliers(tables.points_part_1d(spark, sf_dir), K, Z))


def q_kcenter_3d(spark, sf_dir):
    return _solved(kcenter.kcenter_outliers(tables.points_customer_wide(spark, sf_dir, 3), K, Z))


def q_kcenter_4d(spark, sf_dir):
    return _solved(kcenter.kcenter_outliers(tables.points_customer_wide(spark, sf_dir, 4), K, Z))


def q_greedy_cover_flat(spark, sf_dir):
    """Orders on a line in the plane: a constant dimension."""
    centers, left = kcenter.greedy_cover(tables.points_orders_flat(spark, sf_dir), FLAT_RADIUS, FLAT_K)
    return centers.select("step", "id", "ball_weight", F.lit(left).cast("long").alias("left_weight"))


def q_fft_centers_many(spark, sf_dir):
    """Two hundred centers in each group of customers."""
    pts = coreset.assign_parts(tables.points_customer(spark, sf_dir), PARTS)
    return coreset.fft_centers(pts, MANY_CENTERS).select("part", "step", "id")


def q_fft_centers_joined(spark, sf_dir):
    """The traversal with new centers joined by shuffle instead of broadcast."""
    return coreset.fft_centers(_orders(spark, sf_dir), K + Z + 1, broadcast_values=0).select("part", "step", "id")


def _many_input(spark, sf_dir):
    pts = tables.points_orders(spark, sf_dir)
    return pts, pts.where(F.col("id") % 5000 == 1)


def q_objective_distinct_many(spark, sf_dir):
    return objective.objective_distinct(*_many_input(spark, sf_dir), MANY_Z)


def q_objective_partitioned_many(spark, sf_dir):
    return objective.objective_partitioned(*_many_input(spark, sf_dir), MANY_Z, PARTS)


def q_objective_points_many(spark, sf_dir):
    return objective.objective_points(*_many_input(spark, sf_dir), MANY_Z)


def q_objective_distinct_once(spark, sf_dir):
    """The same values as the ``_many`` queries, distances computed once."""
    return objective.distinct_in_one_pass(*_many_input(spark, sf_dir), MANY_Z)


def q_objective_partitioned_once(spark, sf_dir):
    return objective.partitioned_in_one_pass(*_many_input(spark, sf_dir), MANY_Z, PARTS)


def q_objective_points_once(spark, sf_dir):
    return objective.points_in_one_pass(*_many_input(spark, sf_dir), MANY_Z)


QUERIES = {
    "points_file": q_points_file,
    "points_file_joined": q_points_file_joined,
    "nearest_center_large": q_nearest_center_large,
    "initial_guess_many": q_initial_guess_many,
    "ball_weights_dense": q_ball_weights_dense,
    "kcenter_duplicates": q_kcenter_duplicates,
    "kcenter_1d": q_kcenter_1d,
    "kcenter_3d": q_kcenter_3d,
    "kcenter_4d": q_kcenter_4d,
    "greedy_cover_flat": q_greedy_cover_flat,
    "fft_centers_many": q_fft_centers_many,
    "fft_centers_joined": q_fft_centers_joined,
    "objective_distinct_many": q_objective_distinct_many,
    "objective_partitioned_many": q_objective_partitioned_many,
    "objective_points_many": q_objective_points_many,
    "objective_distinct_once": q_objective_distinct_once,
    "objective_partitioned_once": q_objective_partitioned_once,
    "objective_points_once": q_objective_points_once,
    "points_parse": q_points_parse,
    "euclidean_pairs": q_euclidean_pairs,
    "nearest_center": q_nearest_center,
    "dist_to_centers": q_dist_to_centers,
    "initial_guess": q_initial_guess,
    "ball_members": q_ball_members,
    "ball_weights": q_ball_weights,
    "heaviest_ball": q_heaviest_ball,
    "ball_removal": q_ball_removal,
    "greedy_cover": q_greedy_cover,
    "kcenter_outliers": q_kcenter_outliers,
    "kcenter_metrics": q_kcenter_metrics,
    "kcenter_guards": q_kcenter_guards,
    "fft_centers": q_fft_centers,
    "coreset_weights": q_coreset_weights,
    "partition_coreset": q_partition_coreset,
    "total_weight": q_total_weight,
    "mr_kcenter": q_mr_kcenter,
    "mr_kcenter_metrics": q_mr_kcenter_metrics,
    "objective_distinct": q_objective_distinct,
    "objective_partitioned": q_objective_partitioned,
    "objective_points": q_objective_points,
}

_EMB_SEEDS = (f"WITH e AS ({EMB}), s AS (SELECT label, min(id) AS sid FROM e GROUP BY label), "
              "sv AS (SELECT s.label, s.sid, e.v FROM s JOIN e ON e.id = s.sid) ")
_BALL = (f"WITH p AS ({PTS_S}), b AS (SELECT a.id, a.id AS ord, c.id AS member_id, {_sql_dist('a', 'c', XY)} AS dist "
         f"FROM p a JOIN p c ON {_sql_dist('a', 'c', XY)} <= {BALL_RADIUS}), "
         "bw AS (SELECT id, ord, count(*) AS ball_weight FROM b GROUP BY id, ord), "
         "hb AS (SELECT * FROM bw ORDER BY ball_weight DESC, ord LIMIT 1) ")
_OBJ = ("WITH p AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x FROM part), "
        "d AS (SELECT id, least(" + ", ".join(f"sqrt((x - {c[0]!r}) * (x - {c[0]!r}))" for c in OBJ_CENTERS)
        + ") AS dist FROM p) ")

ORACLES = {
    "points_parse": "SELECT p_partkey AS id, 2 AS dim, CAST(p_size AS DOUBLE) AS x0, p_retailprice AS x1 FROM part",
    "euclidean_pairs": _EMB_SEEDS + f"SELECT e.label, e.id, sv.sid AS other_id, {_sql_vec_dist('e.v', 'sv.v', EMB_DIM)} "
                       "AS dist FROM e JOIN sv ON e.label = sv.label",
    "dist_to_centers": _EMB_SEEDS + f"SELECT e.id, min({_sql_vec_dist('e.v', 'sv.v', EMB_DIM)}) AS dist "
                       "FROM e CROSS JOIN sv GROUP BY e.id",
    "nearest_center": f"WITH p AS ({PTS_C}), c AS (SELECT * FROM p WHERE id IN (SELECT min(id) FROM p GROUP BY nat)), "
                      f"d AS (SELECT p.id, c.id AS center_id, {_sql_dist('p', 'c', XY)} AS dist FROM p CROSS JOIN c) "
                      "SELECT id, center_id, dist FROM d "
                      "QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, center_id) = 1",
    "initial_guess": f"WITH p AS ({PTS_C}), f AS (SELECT * FROM p ORDER BY id LIMIT {K + Z + 1}) "
                     f"SELECT CAST({K + Z + 1} AS BIGINT) AS m, min({_sql_dist('a', 'b', XY)}) / 2 AS r0 "
                     "FROM f a JOIN f b ON a.id < b.id",
    "ball_members": _BALL + "SELECT id, member_id, dist FROM b",
    "ball_weights": _BALL + "SELECT id, ord, ball_weight FROM bw",
    "heaviest_ball": _BALL + "SELECT id, ord, ball_weight FROM hb",
    "ball_removal": _BALL + f"SELECT p.id FROM p, p c, hb WHERE c.id = hb.id AND NOT ({_sql_dist('p', 'c', XY)} "
                    f"<= {3 * BALL_RADIUS})",
    "kcenter_guards": "WITH c AS (SELECT count(*) AS n FROM supplier) "
                      f"SELECT 'k_eq_n' AS case_name, n, n AS k, CAST({Z} AS BIGINT) AS z, n AS centers, "
                      "CAST(0 AS BIGINT) AS guesses, 0.0::DOUBLE AS initial_guess, 0.0::DOUBLE AS final_guess FROM c "
                      f"UNION ALL SELECT 'k_gt_n', n, n + 1, {Z}, 0, 0, 0.0, 0.0 FROM c "
                      f"UNION ALL SELECT 'z_ge_n', n, {K}, n, 0, 0, 0.0, 0.0 FROM c",
    "total_weight": "SELECT count(*) AS total_weight FROM customer",
    "objective_distinct": _OBJ + f"SELECT min(dist) AS objective FROM "
                          f"(SELECT DISTINCT dist FROM d ORDER BY dist DESC LIMIT {OBJ_Z + 1})",
    "objective_partitioned": _OBJ + "SELECT min(dist) AS objective FROM (SELECT dist FROM "
                             f"(SELECT DISTINCT ((id % {PARTS}) + {PARTS}) % {PARTS} AS part, dist FROM d) "
                             f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY dist DESC) <= {OBJ_Z + 1} "
                             f"ORDER BY dist DESC LIMIT {OBJ_Z + 1})",
    "objective_points": _OBJ + f"SELECT min(dist) AS objective FROM (SELECT dist FROM d ORDER BY dist DESC LIMIT {OBJ_Z + 1})",
}


# ---------------------------------------------------------------- oracles of the iterative operators

_PART = f"CAST(((o_orderkey % {PARTS}) + {PARTS}) % {PARTS} AS INTEGER)"
_CUST_W = ("SELECT c_custkey AS id, c_custkey AS ord, c_acctbal AS x, CAST(c_nationkey * 100 AS DOUBLE) AS y, "
           "CAST(1 AS BIGINT) AS w FROM customer")
_ORD_PART = (f"SELECT o_orderkey AS id, o_orderkey AS ord, o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y, "
             f"{_PART} AS part FROM orders")
_SCALE = f"CASE WHEN {_PART} = 0 THEN CAST(0.001 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
_ORD_SKEW = (f"SELECT o_orderkey AS id, o_orderkey AS ord, o_totalprice * {_SCALE} AS x, "
             f"CAST(o_custkey AS DOUBLE) * {_SCALE} AS y, {_PART} AS part FROM orders")
_M = K + Z + 1
_CORE = "SELECT id, ord, x, y, w FROM {}_coreset"


def _kc_metrics_sql():
    ctes = isql.greedy_ctes(_CUST_W, K, Z, 0.0, 8, "g")
    obj = isql.objective_distinct_sql("g_pts", "g_centers", Z)
    return ("WITH RECURSIVE " + ctes + "\n"
            f"SELECT (SELECT count(*) FROM g_pts) AS n, CAST({K} AS BIGINT) AS k, CAST({Z} AS BIGINT) AS z, "
            "(SELECT r0 FROM g_r0) AS initial_guess, l.r AS final_guess, CAST(l.g + 1 AS BIGINT) AS guesses, "
            f"l.left_w AS left_weight, {obj} AS objective "
            "FROM g_left l WHERE l.g = (SELECT g FROM g_best)")


def _mr_chain(points: str, f: str, g: str) -> str:
    return isql.fft_ctes(points, _M, f) + ",\n" + isql.greedy_ctes(_CORE.format(f), K, Z, 2.0, 16, g)


def _mr_metrics_select(name: str, f: str, g: str) -> str:
    obj = isql.objective_partitioned_sql(f"{f}_pts", f"{g}_centers", Z)
    return (f"SELECT '{name}' AS input, (SELECT count(*) FROM {f}_pts) AS n, CAST({K} AS BIGINT) AS k, "
            f"CAST({Z} AS BIGINT) AS z, CAST({PARTS} AS BIGINT) AS parts, (SELECT r0 FROM {g}_r0) AS initial_guess, "
            f"l.r AS final_guess, CAST(l.g + 1 AS BIGINT) AS guesses, l.left_w AS left_weight, {obj} AS objective "
            f"FROM {g}_left l WHERE l.g = (SELECT g FROM {g}_best)")


ORACLES.update({
    "fft_centers": "WITH RECURSIVE " + isql.fft_ctes(_ORD_PART, _M, "f") + "\nSELECT part, step, id FROM f_centers",
    "coreset_weights": "WITH RECURSIVE " + isql.fft_ctes(_ORD_PART, _M, "f") + "\nSELECT part, step, w FROM f_weights",
    "partition_coreset": "WITH RECURSIVE " + isql.fft_ctes(_ORD_PART, _M, "f")
                         + "\nSELECT ord, part, step, id, w, x AS x0, y AS x1 FROM f_coreset",
    "greedy_cover": "WITH RECURSIVE " + isql.greedy_ctes(_CUST_W, K, Z, 0.0, 1, "g", fixed_radius=COVER_RADIUS)
                    + "\nSELECT step, id, x AS x0, y AS x1, ball_weight, (SELECT left_w FROM g_left) AS left_weight "
                      "FROM g_centers",
    "kcenter_outliers": "WITH RECURSIVE " + isql.greedy_ctes(_CUST_W, K, Z, 0.0, 8, "g")
                        + "\nSELECT step, id, x AS x0, y AS x1 FROM g_centers",
    "kcenter_metrics": _kc_metrics_sql(),
    "mr_kcenter": "WITH RECURSIVE " + _mr_chain(_ORD_SKEW, "f", "g")
                  + "\nSELECT step, id, x AS x0, y AS x1 FROM g_centers",
    "mr_kcenter_metrics": "WITH RECURSIVE " + _mr_chain(_ORD_PART, "f1", "g1") + ",\n" + _mr_chain(_ORD_SKEW, "f2", "g2")
                          + "\n" + _mr_metrics_select("orders", "f1", "g1") + " UNION ALL "
                          + _mr_metrics_select("orders_skewed", "f2", "g2"),
})


# ---------------------------------------------------------------- oracles of the other sizes, dimensions and paths

_WIDE = ("SELECT c_custkey AS id, c_custkey AS ord, c_acctbal AS x, CAST(c_nationkey * 100 AS DOUBLE) AS y, "
         "CAST(c_custkey AS DOUBLE) AS u, CAST(c_custkey % 97 * 50 AS DOUBLE) AS v, CAST(1 AS BIGINT) AS w FROM customer")
_PART_2D = ("SELECT p_partkey AS id, p_partkey AS ord, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(1 AS BIGINT) AS w FROM part")
_FLAT = ("SELECT o_orderkey AS id, o_orderkey AS ord, o_totalprice AS x, CAST(7 AS DOUBLE) AS y, CAST(1 AS BIGINT) AS w FROM orders")
_ORD = "SELECT o_orderkey AS id, o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y FROM orders"
_LINE = ["a", "b", "c", "d"]
_CUST_PART = (f"SELECT id, ord, x, y, CAST(((id % {PARTS}) + {PARTS}) % {PARTS} AS INTEGER) AS part FROM ({_CUST_W})")
_MANY = (f"WITH p AS ({_ORD}), s AS (SELECT * FROM p WHERE id % 5000 = 1), "
         f"d AS (SELECT p.id, min({_sql_dist('p', 's', XY)}) AS dist FROM p CROSS JOIN s GROUP BY p.id) ")


def _solve_sql(points: str, guesses: int, cols: tuple[str, ...]) -> str:
    return ("WITH RECURSIVE " + isql.greedy_ctes(points, K, Z, 0.0, guesses, "g", cols=cols)
            + "\nSELECT c.step, c.id, c.ball_weight, l.r AS final_guess, CAST(l.g + 1 AS BIGINT) AS guesses "
              "FROM g_centers c JOIN g_left l ON l.g = (SELECT g FROM g_best)")


ORACLES.update({
    "points_file": "SELECT n AS id, n AS ord, CAST(p_partkey AS DOUBLE) AS x0, p_retailprice AS x1 FROM "
                   "(SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part)",
    "nearest_center_large": "WITH p AS (SELECT s_suppkey AS id, s_acctbal * 10 AS a, CAST(s_nationkey AS DOUBLE) AS b, 0.0::DOUBLE AS c, "
                            "0.0::DOUBLE AS d FROM supplier), s AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_extendedprice AS a, "
                            f"l_quantity AS b, l_discount AS c, l_tax AS d FROM lineitem), m AS (SELECT p.id, s.id AS sid, "
                            f"{_sql_dist('p', 's', _LINE)} AS dist FROM p CROSS JOIN s) SELECT id, CAST(arg_min(sid, (dist, sid)) AS BIGINT) "
                            "AS center_id, min(dist) AS dist FROM m GROUP BY id",
    "initial_guess_many": f"WITH p AS ({_ORD}), f AS (SELECT * FROM p ORDER BY id LIMIT {MANY_FIRST}) "
                          f"SELECT CAST({MANY_FIRST} AS BIGINT) AS m, min({_sql_dist('a', 'b', XY)}) / 2 AS r0 FROM f a JOIN f b ON a.id < b.id",
    "ball_weights_dense": f"WITH p AS ({_ORD}) SELECT a.id, a.id AS ord, count(*) AS ball_weight FROM p a JOIN p c "
                          f"ON {_sql_dist('a', 'c', XY)} <= {DENSE_RADIUS!r} GROUP BY a.id",
    "kcenter_duplicates": _solve_sql(_PART_2D, 8, ("x", "y")),
    "kcenter_1d": _solve_sql(_PART_2D.replace(", p_retailprice AS y", ""), 8, ("x",)),
    "kcenter_3d": _solve_sql(_WIDE, 8, ("x", "y", "u")),
    "kcenter_4d": _solve_sql(_WIDE, 8, ("x", "y", "u", "v")),
    "greedy_cover_flat": "WITH RECURSIVE " + isql.greedy_ctes(_FLAT, FLAT_K, Z, 0.0, 1, "g", fixed_radius=FLAT_RADIUS)
                         + "\nSELECT step, id, ball_weight, (SELECT left_w FROM g_left) AS left_weight FROM g_centers",
    "fft_centers_many": "WITH RECURSIVE " + isql.fft_ctes(_CUST_PART, MANY_CENTERS, "f") + "\nSELECT part, step, id FROM f_centers",
    "fft_centers_joined": ORACLES["fft_centers"],
    "objective_distinct_many": _MANY + f"SELECT min(dist) AS objective FROM (SELECT DISTINCT dist FROM d ORDER BY dist DESC LIMIT {MANY_Z + 1})",
    "objective_partitioned_many": _MANY + "SELECT min(dist) AS objective FROM (SELECT dist FROM "
                                  f"(SELECT DISTINCT ((id % {PARTS}) + {PARTS}) % {PARTS} AS part, dist FROM d) "
                                  f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY dist DESC) <= {MANY_Z + 1} "
                                  f"ORDER BY dist DESC LIMIT {MANY_Z + 1})",
    "objective_points_many": _MANY + f"SELECT min(dist) AS objective FROM (SELECT dist FROM d ORDER BY dist DESC LIMIT {MANY_Z + 1})",
})
ORACLES["points_file_joined"] = ORACLES["points_file"]
for _form in ("distinct", "partitioned", "points"):
    ORACLES[f"objective_{_form}_once"] = ORACLES[f"objective_{_form}_many"]
