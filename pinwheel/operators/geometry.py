"""Distance, nearest-center and ball operators on point DataFrames.

A point DataFrame has ``id bigint`` (unique), ``ord bigint`` (input order; ties go to the
lowest), ``coords array<double>`` and optionally ``w bigint`` (weight, default 1).

Scale notes
- A small center set is inlined as literals, so distance-to-centers is a plain projection
  compiled by whole-stage codegen: no join and no shuffle. For one of bounded size every task
  gets a tree of boxes over the different centers, which Arrow batches of points descend
  (``_NearestTree``). Beyond that bound both sides are dealt out by space
  (``neighbours.nearest_by_cells``), and no center passes the driver.
- Balls (all y within r of x) are a theta join. It runs as an equi-join on grid cells of side
  >= r plus the exact distance test, never as a cross join. Ball weights go further where
  cells are crowded: blocks of points that certainly lie inside (or outside) of a ball are
  decided at once, the others are counted by a tree of boxes (``ball_weight_sums``). Identical points are merged before any of this, and AQE's skew-join
  split spreads a crowded cell over several tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product as iproduct

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pinwheel.functions.distance import UNROLL_LIMIT, euclidean, euclidean_sql
from pinwheel.operators.neighbours import LEAF, nearest_by_cells
from pinwheel.session import checkpoint_dir

# Grid dimensions used for the ball join; further dimensions only enter the exact test.
GRID_DIMS = 3
# Cells are widened by this factor and never made finer than span * 2^-30, which keeps the
# computed cell index of two points within distance r at most one apart (see ``cell_side``).
_WIDEN = 1.0 + 2.0 ** -20
_FINEST = 2.0 ** -30


@dataclass
class PointStats:
    n: int
    d: int
    span: float  # largest absolute coordinate
    lo: tuple = ()  # per-dimension minimum of the first GRID_DIMS dimensions
    hi: tuple = ()  # per-dimension maximum of the first GRID_DIMS dimensions


def validate_points(points: DataFrame) -> PointStats:
    """Count points and check that all have coordinates of the same dimension, none of them
    null or NaN."""
    row = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("coords").isNull() | F.array_contains(F.transform("coords", lambda v: v.isNull()), True), 1).otherwise(0)).alias("null_rows"),
        F.min(F.size("coords")).alias("dmin"),
        F.max(F.size("coords")).alias("dmax"),
        # Lambda-free array functions stay in generated code (Spark SQL treats NaN = NaN).
        F.sum(F.when(F.array_contains("coords", float("nan")), 1).otherwise(0)).alias("nan_rows"),
        F.max(F.greatest(F.abs(F.array_max("coords")), F.abs(F.array_min("coords")))).alias("span"),
        *[F.min(F.get(F.col("coords"), i)).alias(f"lo{i}") for i in range(GRID_DIMS)],
        *[F.max(F.get(F.col("coords"), i)).alias(f"hi{i}") for i in range(GRID_DIMS)],
    ).collect()[0]
    n = int(row["n"])
    if n == 0:
        return PointStats(0, 0, 0.0)
    if row["null_rows"]:
        raise ValueError(f"{row['null_rows']} points have a null coordinate")
    if row["dmin"] != row["dmax"]:
        raise ValueError(f"points have different dimensions ({row['dmin']} and {row['dmax']})")
    if row["nan_rows"]:
        raise ValueError(f"{row['nan_rows']} points have a NaN coordinate")
    span = float(row["span"]) if row["span"] is not None else 0.0
    if math.isinf(span):
        raise ValueError("points have an infinite coordinate")
    d = int(row["dmax"])
    g = min(d, GRID_DIMS)
    return PointStats(n, d, span, tuple(float(row[f"lo{i}"]) for i in range(g)),
                      tuple(float(row[f"hi{i}"]) for i in range(g)))


def with_weight(points: DataFrame) -> DataFrame:
    return points if "w" in points.columns else points.withColumn("w", F.lit(1).cast("long"))


def literal_distances(coords: str, centers: list[tuple], d: int) -> Column:
    """Array of distances from array column ``coords`` to the literal centers, in center
    order (each computed once)."""
    return F.expr("array(" + ", ".join(euclidean_sql(coords, c[2], d) for c in centers) + ")")


def nearest_literal(dists: Column, centers: list[tuple]) -> tuple[Column, Column]:
    """(distance, center id) of the nearest center given the ``literal_distances`` array;
    ties go to the earliest center."""
    best = F.array_min(dists)
    ids = F.array(*[F.lit(c[0]).cast("long") for c in centers])
    return best, F.element_at(ids, F.array_position(dists, best).cast("int"))


# Center sets up to this many coordinates are inlined as literals (compiled code).
LITERAL_CENTER_VALUES = 1024
# Beyond this many centers the generated code gets too long to be compiled, and points descend
# a tree of boxes instead.
LITERAL_CENTERS = 32
# Up to this many every task gets them; beyond it both sides are joined by space.
BLOCK_VALUES = 200_000


# Cells per center, at most so many cells, and so many pairs of a cell and a center.
CELLS_PER_CENTER, MOST_CELLS, CELL_TESTS = 8, 16_384, 100_000_000
# Lists of candidates up to this many coordinates in all are broadcast, longer ones shuffled.
CANDIDATE_VALUES = 2_000_000


# Neighbouring points that descend the tree of centers together, and the pairs of a block and a
# box (or a point and a center) that are held at once.
TOGETHER, BLOCK_PAIRS = 32, 4_000_000


def _with_candidates(points: DataFrame, block: DataFrame, n: int, d: int) -> DataFrame:
    """``points`` with ``_cs``: those of the ``n`` centers of ``block`` (one row, ``_cs``) that can be
    nearest to the point. All do in more than ``GRID_DIMS`` dimensions.

    A center whose smallest distance from a cell exceeds another's largest one is nearest to no
    point of the cell. Points with a coordinate that isn't finite have a cell of their own.
    """
    spark = points.sparkSession
    x = [F.when(F.abs(F.col("coords").getItem(i)) < float("inf"), F.col("coords").getItem(i)) for i in range(d)]
    row = points.agg(*[f(x[i]).alias(f"{e}{i}") for i in range(d) for f, e in ((F.min, "lo"), (F.max, "hi"))]).first() \
        if 0 < d <= GRID_DIMS else None
    if row is None or any(v is None for v in row):
        return points.withColumn("_k", F.lit(0)).join(F.broadcast(block), "_k").drop("_k")
    lo, extent = [row[f"lo{i}"] for i in range(d)], [row[f"hi{i}"] - row[f"lo{i}"] for i in range(d)]
    most = max(1, min(CELLS_PER_CENTER * n, MOST_CELLS, CELL_TESTS // n))
    width = max(max(extent), 1e-300)
    while math.isfinite(width) and math.prod(math.floor(e / (width / 1.1)) + 1 for e in extent) <= most and width > max(extent) / most:
        width /= 1.1
    res = [math.floor(e / width) + 1 if math.isfinite(width) else 1 for e in extent]
    strides = [math.prod(res[:i]) for i in range(d)]
    at = [F.least(F.greatest(F.floor((x[i] - F.lit(lo[i])) / F.lit(width)), F.lit(0)), F.lit(res[i] - 1)) * F.lit(strides[i]) for i in range(d)]
    finite = math.prod([F.when(v.isNotNull(), 1).otherwise(0) for v in x[1:]], start=F.when(x[0].isNotNull(), 1).otherwise(0))
    cell = F.when(finite == 1, sum(at[1:], at[0])).otherwise(F.lit(-1)).cast("long")

    # A point may lie a rounding error outside its computed cell.
    slack = [width * 1e-6 + max(abs(row[f"lo{i}"]), abs(row[f"hi{i}"])) * 1e-14 for i in range(d)]
    place = [F.pmod(F.floor(F.col("id") / F.lit(strides[i])), F.lit(res[i])) for i in range(d)]
    cells = spark.range(-1, math.prod(res)).select(
        F.col("id").alias("_cell"), F.lit(0).alias("_k"),
        *[(F.lit(lo[i]) + place[i] * F.lit(width) - F.lit(slack[i])).alias(f"_lo{i}") for i in range(d)],
        *[(F.lit(lo[i]) + (place[i] + 1) * F.lit(width) + F.lit(slack[i])).alias(f"_hi{i}") for i in range(d)])

    c = F.col("_c.c")
    ends = [(F.col(f"_lo{i}") - c.getItem(i), c.getItem(i) - F.col(f"_hi{i}")) for i in range(d)]
    near, far = [F.greatest(a, b, F.lit(0.0)) for a, b in ends], [F.greatest(-a, -b) for a, b in ends]
    met = cells.join(F.broadcast(block), "_k").withColumn("_c", F.explode("_cs"))
    bound = met.groupBy("_cell").agg((F.min(F.sqrt(sum((v * v for v in far[1:]), far[0] * far[0]))) * F.lit(1 + 1e-9)).alias("_most"))
    found = met.join(bound, "_cell").where((F.col("_cell") < 0) | (F.sqrt(sum((v * v for v in near[1:]), near[0] * near[0])) <= F.col("_most"))) \
        .groupBy("_cell").agg(F.sort_array(F.collect_list("_c")).alias("_cs"))
    checkpoint_dir(spark)
    found = found.checkpoint()
    few = found.agg(F.sum(F.size("_cs"))).first()[0] * d <= CANDIDATE_VALUES
    return points.withColumn("_cell", cell).join(F.broadcast(found) if few else found, "_cell").drop("_cell")


def _curve_order(ys: list) -> np.ndarray:
    """Order of the points (coordinates by dimension) along a space-filling curve."""
    extent = [float(y.max() - y.min()) for y in ys]
    wide = sorted(range(len(ys)), key=lambda i: -extent[i])[:4]
    bits, code = 60 // len(wide) if len(wide) > 2 else 20, np.zeros(len(ys[0]), np.int64)
    scale = (2 ** bits - 1) / max(extent) if max(extent) > 0 and np.isfinite(max(extent)) else 0.0
    at = [((ys[i] - ys[i].min()) * scale).astype(np.int64) for i in wide] if scale and np.isfinite(scale) else []
    for bit in range(bits - 1, -1, -1):
        for v in at:
            code = code << 1 | v >> bit & 1
    return np.argsort(code, kind="stable")


class _NearestTree:
    """Nearest of some different centers (d x n, in the order that decides ties) by nested boxes.

    A box's smallest and largest distance are the same left fold as distances; rounding is
    monotone, so a box beyond the smallest largest distance holds no nearest center, not even a
    tied one."""

    def __init__(self, ys: np.ndarray):
        self.all, finite = ys, np.flatnonzero(np.isfinite(ys).all(0))
        self.rank = finite[_curve_order(list(ys[:, finite]))] if len(finite) else finite
        lo = hi = self.ys = ys[:, self.rank]
        self.levels = [(lo, hi)] if len(finite) else []
        while lo.shape[1] > 1:
            start = np.arange(0, lo.shape[1], TREE_FAN)
            lo, hi = np.minimum.reduceat(lo, start, axis=1), np.maximum.reduceat(hi, start, axis=1)
            self.levels.append((lo, hi))

    def nearest(self, xs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, place of the center) of every point (d x n); infinity and -1 without any."""
        best, place = np.full(xs.shape[1], np.inf), np.full(xs.shape[1], -1, np.int64)
        finite = np.isfinite(xs).all(0) & bool(self.levels)
        with np.errstate(all="ignore"):
            todo = np.flatnonzero(finite)
            if len(todo):
                todo = todo[_curve_order(list(xs[:, todo]))]
                blocks = np.append(todo, np.repeat(todo[-1], -len(todo) % TOGETHER)).reshape(-1, TOGETHER)
                step = max(1, BLOCK_PAIRS // len(self.rank))
                for first in range(0, len(blocks), step):
                    at = blocks[first:first + step]
                    best[at], place[at] = self._descend(xs[:, at])
            # Where every distance overflows or the point isn't finite, all centers are met.
            for first in np.flatnonzero(~(finite & np.isfinite(best)) & ~np.isnan(xs).any(0)):
                total = np.zeros(self.all.shape[1])
                for y, x in zip(self.all, xs[:, first]):
                    total += (x - y) * (x - y)
                dist = np.where(np.isnan(total), np.nan, np.sqrt(total))
                if not np.isnan(dist).all():
                    place[first] = np.nanargmin(dist)
                    best[first] = dist[place[first]]
        return best, place

    def _descend(self, xs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``nearest``, of blocks of neighbours (d x blocks x points): a block meets the centers
        that can be nearest to a point of its box."""
        n = xs.shape[1]
        low, high = xs.min(2), xs.max(2)
        i, node, bound = np.arange(n), np.zeros(n, np.int64), np.full(n, np.inf)
        for level in range(len(self.levels) - 1, -1, -1):
            lo, hi = self.levels[level]
            near, far = np.zeros(len(i)), np.zeros(len(i))
            for v, w, a, b in zip(low, high, lo, hi):
                v, w, a, b = v[i], w[i], a[node], b[node]
                gap, reach = np.maximum(np.maximum(a - w, v - b), 0.0), np.maximum(b - v, w - a)
                near += gap * gap
                far += reach * reach
            # ``i`` ascends: every block has one run of boxes.
            bound = np.minimum(bound, np.minimum.reduceat(np.sqrt(far), _runs(i)))
            keep = np.sqrt(near) <= bound[i]
            i, node = i[keep], node[keep]
            if level:
                i, node = np.repeat(i, TREE_FAN), (node[:, None] * TREE_FAN + np.arange(TREE_FAN)).ravel()
                real = node < self.levels[level - 1][0].shape[1]
                i, node = i[real], node[real]
        best, place = np.empty(xs.shape[1:]), np.empty(xs.shape[1:], np.int64)
        ends = np.append(_runs(i), len(i))
        first = 0
        while first < n:  # so many blocks that their distances stay within bounds
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_PAIRS // TOGETHER, "right")) - 1)
            at, c = i[ends[first]:ends[last]], node[ends[first]:ends[last]]
            total = np.zeros((len(at), xs.shape[2]))
            for x, y in zip(xs, self.ys):
                v = x[at] - y[c][:, None]
                total += v * v
            dist, starts = np.sqrt(total), ends[first:last] - ends[first]
            best[first:last] = np.minimum.reduceat(dist, starts, axis=0)
            ranks = np.where(dist == best[at], self.rank[c][:, None], self.all.shape[1])
            place[first:last] = np.minimum.reduceat(ranks, starts, axis=0)
            first = last
        return best, place


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal ``keys`` start."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def _with_nearest_by_tree(points: DataFrame, centers: DataFrame, d: int) -> DataFrame:
    """``points`` with ``dist`` and ``center_id`` by a tree of boxes over the centers (at most
    ``BLOCK_VALUES`` coordinates), which every task gets. Equal centers are one, that of the
    lowest order; a null or NaN coordinate is at no distance (infinity, no center)."""
    rows = centers.select(F.col("o"), F.col("i"), *[F.col("c").getItem(i).alias(f"v{i}") for i in range(d)]) \
        .orderBy("o", "i", *[f"v{i}" for i in range(d)]).toArrow()
    ys = np.array([rows.column(f"v{i}").to_numpy() for i in range(d)], dtype=float).reshape(d, -1)
    first = np.sort(np.unique(ys, axis=1, return_index=True)[1])
    ys, ids = ys[:, first], rows.column("i").to_pylist()
    ids = [ids[j] for j in first]
    # Coordinates travel as plain columns; arrays are dear to convert and are rebuilt if asked for.
    names = [f"_v{i}" for i in range(d)]
    kept = [c for c in points.columns if c != "coords"]
    own = len(kept)

    def run(batches):
        tree = _NearestTree(ys)
        for batch in batches:
            xs = np.array([batch.column(own + i).to_numpy(zero_copy_only=False) for i in range(d)], dtype=float).reshape(d, -1)
            best, place = tree.nearest(xs)
            found = pa.array(ids, pa.int64()).take(pa.array(place, mask=place < 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best), found], names=[*batch.schema.names, "dist", "center_id"])

    schema = T.StructType([*[points.schema[c] for c in kept], *[T.StructField(v, T.DoubleType()) for v in names],
                           T.StructField("dist", T.DoubleType()), T.StructField("center_id", T.LongType())])
    near = points.select(*kept, *[F.col("coords").getItem(i).alias(v) for i, v in enumerate(names)]).mapInArrow(run, schema)
    return near.select(*[F.array(*names).alias(c) if c == "coords" else c for c in points.columns], "dist", "center_id")


def _with_nearest(points: DataFrame, centers: DataFrame, d: int, literal_values: int = LITERAL_CENTER_VALUES,
                  block_values: int = BLOCK_VALUES, leaf: int = LEAF) -> DataFrame:
    """Add ``dist`` and ``center_id`` of the nearest center (ties: lowest center ord); null
    without centers. ``centers`` has coords and id or ord or both."""
    names = centers.columns
    key = "ord" if "ord" in names else "id"
    cs = centers.select(F.col(key).cast("long").alias("o"), F.col("id" if "id" in names else key).cast("long").alias("i"),
                        F.col("coords").alias("c"))
    n = cs.count()
    values = n * max(d, 1)
    if not n:
        return points.withColumn("dist", F.lit(None).cast("double")).withColumn("center_id", F.lit(None).cast("long"))
    if values <= literal_values and (n <= LITERAL_CENTERS or d > GRID_DIMS):
        rows = [(r["i"], r["o"], [float(v) for v in r["c"]]) for r in cs.orderBy("o", "i").collect()]
        with_d = points.withColumn("_dists", literal_distances("coords", rows, d))
        best, choice = nearest_literal(F.col("_dists"), rows)
        return with_d.withColumn("dist", best).withColumn("center_id", choice).drop("_dists")
    if values > block_values:
        return points.join(nearest_by_cells(points, cs, d, leaf), "id", "left")
    if 0 < d <= UNROLL_LIMIT:
        return _with_nearest_by_tree(points, cs, d)
    unset = F.struct(F.lit(float("inf")).alias("d"), F.lit(2 ** 63 - 1).alias("o"), F.lit(None).cast("long").alias("i"))

    def closer(acc, c):
        dist = euclidean(F.col("coords"), c["c"], d)
        return F.when((dist < acc["d"]) | ((dist == acc["d"]) & (c["o"] < acc["o"])),
                      F.struct(dist.alias("d"), c["o"].alias("o"), c["i"].alias("i"))).otherwise(acc)

    block = cs.agg(F.sort_array(F.collect_list(F.struct("o", "i", "c"))).alias("_cs")).withColumn("_k", F.lit(0))
    near = points.withColumn("_k", F.lit(0)).join(F.broadcast(block), "_k") \
        .select(F.struct(*points.columns).alias("_p"), F.aggregate("_cs", unset, closer).alias("_best"))
    return near.select("_p.*", F.col("_best.d").alias("dist"), F.col("_best.i").alias("center_id"))


def dist_to_centers(points: DataFrame, centers: DataFrame, d: int | None = None, **limits) -> DataFrame:
    """Add ``dist``: distance from each point to its nearest center, null without centers (V4)."""
    d = validate_points(points).d if d is None else d
    return _with_nearest(points, centers, d, **limits).drop("center_id")


def nearest_center(points: DataFrame, centers: DataFrame, d: int | None = None, **limits) -> DataFrame:
    """Add ``center_id`` and ``dist`` of the nearest center (V3); ties go to the lowest center ord."""
    d = validate_points(points).d if d is None else d
    return _with_nearest(points, centers, d, **limits)


def pair_distances(left: DataFrame, right: DataFrame, on: list[str], d: int) -> DataFrame:
    """Distance between rows of ``left`` and ``right`` that agree on the ``on`` columns (V1).

    Output: on columns, ``id``, ``other_id``, ``dist``.
    """
    lhs = left.select(*on, "id", F.col("coords").alias("a"))
    rhs = right.select(*on, F.col("id").alias("other_id"), F.col("coords").alias("b"))
    joined = lhs.join(rhs, on)
    return joined.select(*on, "id", "other_id", euclidean(F.col("a"), F.col("b"), d).alias("dist"))


def initial_guess(points: DataFrame, m: int, d: int) -> DataFrame:
    """Half the smallest pairwise distance among the first ``m`` points by ord (V2).

    One row: ``m``, ``r0`` (null when fewer than two points). The smallest distance between
    neighbours along each of the first axes bounds it from above, so only pairs within that
    bound are compared, by the grid join: no task sees all m(m-1)/2 pairs.
    """
    checkpoint_dir(points.sparkSession)
    first = points.select("id", "ord", "coords").orderBy("ord").limit(m).checkpoint()
    span = F.max(F.greatest(F.abs(F.array_max("coords")), F.abs(F.array_min("coords")))).alias("span")
    steps = [F.min(euclidean(F.col("coords"), F.col(f"_p{i}"), d)) for i in range(min(d, GRID_DIMS))]
    near = first.select("coords", *[F.lag("coords").over(Window.orderBy(F.col("coords").getItem(i), "ord")).alias(f"_p{i}")
                                    for i in range(len(steps))])
    row = near.agg(span, *[c.alias(f"s{i}") for i, c in enumerate(steps)]).collect()[0]
    bounds = [row[f"s{i}"] for i in range(len(steps)) if row[f"s{i}"] is not None]
    if not bounds or min(bounds) == 0.0:
        found = points.sparkSession.range(1).select(F.lit(0.0 if bounds else None).cast("double").alias("r0"))
    else:
        rows = _single(first, min(bounds), float(row["span"]))
        pairs = ball_pairs(rows, rows, d, ["g"]).where(F.col("id") != F.col("y_id"))
        found = pairs.agg((F.min("dist") / 2.0).alias("r0"))
    return found.select(F.lit(m).cast("long").alias("m"), "r0")


def merge_duplicates(points: DataFrame) -> DataFrame:
    """One row per distinct coordinate vector: summed weight, earliest ord and its id.

    Equal vectors always share ball membership, so merging them changes no ball weight; it
    also collapses a hot spot of identical points before any pairwise work (partial
    aggregation runs map-side).
    """
    pts = with_weight(points)
    merged = pts.groupBy("coords").agg(
        F.sum("w").cast("long").alias("w"),
        F.min(F.struct("ord", "id")).alias("first"))
    return merged.select(F.col("first.id").alias("id"), F.col("first.ord").alias("ord"), "coords", "w")


def fine_steps(d: int) -> int:
    """Fine cells per coarse cell side: 32, 16, 4 for 1, 2, 3 dimensions; 1 beyond (the grid
    then covers only some dimensions and no cell pair can be known to lie inside a ball)."""
    return {1: 32, 2: 16, 3: 4}.get(d, 1)


def cell_side(radius: float, span: float, fine: int = 1) -> float:
    """Coarse grid cell side for radius ``radius``.

    With side S >= r(1 + 2^-20) and fine cells s = S / fine >= span * 2^-30, the computed
    x / s is within 2^-23 of the true quotient, so two points within r land in fine cells at
    most ``fine`` apart and in coarse cells at most one apart in every dimension: probing
    the 3^g neighbor coarse cells finds every pair.
    """
    side = max(radius, fine * span * _FINEST)
    if side <= 0.0:
        side = 1.0
    return side * _WIDEN


def _cells(coords: Column, side: Column, g: int) -> list[Column]:
    return [F.floor(coords.getItem(i) / side).cast("long") for i in range(g)]


def _offsets(g: int) -> Column:
    return F.explode(F.array(*[F.array(*[F.lit(v) for v in o]) for o in iproduct((-1, 0, 1), repeat=g)]))


def ball_pairs(left: DataFrame, right: DataFrame, d: int, keys: list[str]) -> DataFrame:
    """All (x, y) with equal ``keys`` and ``euclidean(x, y) <= radius`` (grid equi-join).

    ``left`` carries keys, ``radius``, ``side``, ``id``, ``ord``, ``coords``; ``right`` carries
    keys, ``side``, ``id``, ``coords``, ``w`` (same ``side`` per key as left). Output: keys,
    ``id``, ``ord``, ``coords``, ``y_id``, ``y_w``, ``dist``.
    """
    g = min(d, GRID_DIMS)
    cell_names = [f"_c{i}" for i in range(g)]
    lhs = left.select(*keys, "radius", "side", "id", "ord", "coords")
    if g:
        lhs = lhs.select("*", _offsets(g).alias("_off"))
        lhs = lhs.select(*keys, "radius", "id", "ord", "coords",
                         *[(c + F.col("_off").getItem(i)).alias(cell_names[i])
                           for i, c in enumerate(_cells(F.col("coords"), F.col("side"), g))])
    rhs = right.select(*keys, F.col("id").alias("y_id"), F.col("coords").alias("y_coords"),
                       F.col("w").alias("y_w"),
                       *[c.alias(cell_names[i]) for i, c in enumerate(_cells(F.col("coords"), F.col("side"), g))])
    joined = lhs.join(rhs, list(keys) + cell_names)
    dist = euclidean(F.col("coords"), F.col("y_coords"), d)
    return joined.select(*keys, "id", "ord", "coords", "y_id", "y_w", dist.alias("dist")) \
        .filter(F.col("dist") <= F.col("radius"))


# Blocks of points that crowded balls are counted by: this many at 100,000 points, growing with
# the root of their number (a block's tasks and what is sent to it then grow alike).
BLOCKS, BLOCK_POINTS, MOST_BLOCKS = 64, 100_000, 2048
# Points of a tree's leaf, children of a node, points that descend it together.
TREE_LEAF, TREE_FAN, TREE_AT_ONCE = 8, 4, 512


def _tree_sums(xs: list, radius: float, ys: list, w: np.ndarray) -> np.ndarray:
    """Summed ``w`` of the ys within ``radius`` of every x (coordinates by dimension).

    The ys are sorted along a space-filling curve, and boxes of neighbours are nested. A box's
    smallest and largest distance are the same left fold as distances, over its real ends;
    rounding is monotone, so a box inside or outside of a ball is decided exactly."""
    total = np.zeros(len(xs[0]), np.int64)
    if not len(w):
        return total
    order = _curve_order(ys)
    ys, w = [y[order] for y in ys], w[order]
    lo, hi, ws, size, levels = ys, ys, w, TREE_LEAF, []
    while not levels or len(ws) > 1:
        start = np.arange(0, len(ws), size)
        lo, hi = [np.minimum.reduceat(v, start) for v in lo], [np.maximum.reduceat(v, start) for v in hi]
        ws, size = np.add.reduceat(ws, start), TREE_FAN
        levels.append((lo, hi, ws))

    def split(i, node, fan, count):
        i, node = np.repeat(i, fan), (node[:, None] * fan + np.arange(fan)).ravel()
        real = node < count
        return i[real], node[real]

    for first in range(0, len(total), TREE_AT_ONCE):
        part = [x[first:first + TREE_AT_ONCE] for x in xs]
        i = np.arange(len(part[0]))
        node = np.zeros(len(i), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            lo, hi, ws = levels[level]
            near, far = np.zeros(len(i)), np.zeros(len(i))
            for x, a, b in zip(part, lo, hi):
                v = x[i]
                below, above = a[node] - v, v - b[node]
                near += np.maximum(np.maximum(below, above), 0.0) ** 2
                far += np.minimum(below, above) ** 2
            full = np.sqrt(far) <= radius
            np.add.at(total, first + i[full], ws[node[full]])
            cut = ~full & (np.sqrt(near) <= radius)
            i, node = split(i[cut], node[cut], TREE_FAN if level else TREE_LEAF, len(levels[level - 1][2]) if level else len(w))
        dist = np.zeros(len(i))
        for x, y in zip(part, ys):
            v = x[i] - y[node]
            dist += v * v
        inside = np.sqrt(dist) <= radius
        np.add.at(total, first + i[inside], w[node[inside]])
    return total


def ball_weight_sums(left: DataFrame, right: DataFrame, d: int, keys: list[str],
                     aggregate: bool = True) -> DataFrame:
    """Ball weight of every x in ``left``: summed ``w`` of the ``right`` rows within ``radius``.

    Same inputs as ``ball_pairs``. Output: keys, id, ord, coords, ball_weight (without
    ``aggregate``, points with an empty ball are omitted).

    With ``aggregate`` both sides are cut into the same blocks, along quantiles of their widest
    dimensions. The boxes of two blocks decide whether all y of one are inside every ball of the
    other (their summed weight counts), outside of all (skipped), or undecided; only the y
    of undecided pairs of blocks are sent to the block of the x, where a tree of boxes counts
    them (``_tree_sums``). No ball's points are ever listed as pairs.
    """
    if not aggregate or not d:
        pairs = ball_pairs(left, right, d, keys)
        return pairs.groupBy(*keys, "id", "ord").agg(
            F.sum("y_w").cast("long").alias("ball_weight"), F.any_value("coords").alias("coords"))
    names = [f"_v{i}" for i in range(d)]
    values = [F.col("coords").getItem(i).alias(v) for i, v in enumerate(names)]
    xs, ys = left.select(*keys, "radius", "id", "ord", *values), right.select(*keys, "w", *values)
    row = xs.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{e}{v}") for v in names for f, e in ((F.min, "lo"), (F.max, "hi"))]).first()
    extent = {v: row[f"hi{v}"] - row[f"lo{v}"] if row["n"] else 0.0 for v in names}
    wide = [v for v in sorted(names, key=lambda v: -extent[v])[:GRID_DIMS] if 0 < extent[v] < float("inf")]
    most = min(MOST_BLOCKS, int(BLOCKS * max(1.0, row["n"] / BLOCK_POINTS) ** 0.5))
    width = extent[wide[0]] if wide else 1.0
    while wide and math.prod(math.ceil(extent[v] * 1.1 / width) for v in wide) <= most:
        width /= 1.1
    cuts = {v: math.ceil(extent[v] / width) for v in wide}
    found = xs.agg(*[F.percentile_approx(v, [j / n for j in range(1, n)]).alias(v) for v, n in cuts.items() if n > 1]).first().asDict() \
        if any(n > 1 for n in cuts.values()) else {}

    def with_block(df):
        block, stride = F.lit(0), 1
        for v, at in found.items():
            ends = [-float("inf"), *sorted({e + 0.0 for e in at}), float("inf")]
            df = Bucketizer(splits=ends, inputCol=v, outputCol=f"_b{v}").transform(df)
            block, stride = block + F.col(f"_b{v}") * stride, stride * (len(ends) - 1)
        return df.withColumn("_block", block.cast("long")).drop(*[f"_b{v}" for v in found])

    checkpoint_dir(left.sparkSession)
    xs, ys = with_block(xs), with_block(ys)
    box = [f(v).alias(f"{e}{v}") for v in names for f, e in ((F.min, "lo"), (F.max, "hi"))]
    xb = xs.groupBy(*keys, "_block").agg(F.any_value("radius").alias("radius"), *box)
    yb = ys.groupBy(*keys, F.col("_block").alias("_from")).agg(F.sum("w").cast("long").alias("cw"), *[b for b in box])
    yb = yb.select(*keys, "_from", "cw", *[F.col(f"{e}{v}").alias(f"y{e}{v}") for v in names for e in ("lo", "hi")])
    near = far = None
    for v in names:
        below, above = F.col(f"ylo{v}") - F.col(f"hi{v}"), F.col(f"lo{v}") - F.col(f"yhi{v}")
        gap, reach = F.greatest(below, above, F.lit(0.0)), F.greatest(F.col(f"yhi{v}") - F.col(f"lo{v}"), F.col(f"hi{v}") - F.col(f"ylo{v}"))
        near, far = (gap * gap, reach * reach) if near is None else (near + gap * gap, far + reach * reach)
    met = xb.join(F.broadcast(yb), keys).where(F.sqrt(near) <= F.col("radius")) \
        .select(*keys, "_block", "_from", "cw", (F.sqrt(far) <= F.col("radius")).alias("_full")).checkpoint()
    whole = met.where("_full").groupBy(*keys, "_block").agg(F.sum("cw").cast("long").alias("_whole"))
    to = met.where(~F.col("_full")).groupBy(*keys, F.col("_from").alias("_block")).agg(F.collect_list("_block").alias("_to"))
    # Both sides may come from one table: other names keep their keys apart.
    sent = ys.join(F.broadcast(to), [*keys, "_block"]).select(*[F.col(k).alias(f"_y{k}") for k in keys], F.explode("_to").alias("_at"), "w", *names)
    mine = xs.join(F.broadcast(whole), [*keys, "_block"], "left").withColumn("_whole", F.coalesce("_whole", F.lit(0).cast("long")))

    def count(x, y):
        if not x.num_rows:
            return x.select([*keys, "id", "ord", *names]).append_column("bw", pa.array([], pa.int64()))
        one, two = ([t.column(v).to_numpy() for v in names] for t in (x, y))
        sums = _tree_sums(one, x.column("radius")[0].as_py(), two, y.column("w").to_numpy().astype(np.int64))
        return x.select([*keys, "id", "ord", *names]).append_column("bw", pa.array(sums + x.column("_whole").to_numpy(), pa.int64()))

    schema = T.StructType([*[xs.schema[k] for k in [*keys, "id", "ord"]], *[T.StructField(v, T.DoubleType()) for v in names], T.StructField("bw", T.LongType())])
    counted = mine.groupBy(*keys, "_block").cogroup(sent.groupBy(*[f"_y{k}" for k in keys], "_at")).applyInArrow(count, schema)
    return counted.groupBy(*keys, "id", "ord").agg(F.sum("bw").cast("long").alias("ball_weight"), F.any_value(F.array(*names)).alias("coords"))


# Right sides of at most this many rows per key are broadcast as one row per key.
SMALL_BALLS = 1000


def small_ball_weights(left: DataFrame, right: DataFrame, d: int, keys: list[str]) -> DataFrame:
    """``left`` with ``ball_weight`` (0 for an empty ball), as ``ball_weight_sums``, for a ``right``
    of at most ``SMALL_BALLS`` rows per key: no row of ``left`` is shuffled."""
    ys = right.groupBy(*keys).agg(F.collect_list(F.struct(F.col("coords").alias("c"), "w")).alias("_ys"))
    inside = F.aggregate(
        F.coalesce("_ys", F.expr("CAST(array() AS array<struct<c:array<double>,w:bigint>>)")), F.lit(0).cast("long"),
        lambda acc, y: acc + F.when(euclidean(F.col("coords"), y["c"], d) <= F.col("radius"), y["w"]).otherwise(F.lit(0)))
    return left.join(F.broadcast(ys), keys, "left").withColumn("ball_weight", inside).drop("_ys")


# A coarse cell with more points than this is hot: its ball weights are aggregated per fine
# cell instead of pairing its points one by one.
HOT_CELL = 500


def hottest_cells(points: DataFrame, d: int, keys: list[str]) -> dict:
    """Largest number of points in one coarse cell, per key (rows carry ``side``)."""
    g = min(d, GRID_DIMS)
    cells = [x.alias(f"_c{i}") for i, x in enumerate(_cells(F.col("coords"), F.col("side"), g))]
    counts = points.select(*keys, *cells).groupBy(*keys, *[f"_c{i}" for i in range(g)]).count()
    return {tuple(r[k] for k in keys): int(r["hot"]) for r in counts.groupBy(*keys).agg(F.max("count").alias("hot")).collect()}


def _single(points: DataFrame, radius: float, span: float, fine: int = 1) -> DataFrame:
    return with_weight(points).select(
        F.lit(0).alias("g"), F.lit(float(radius)).alias("radius"),
        F.lit(cell_side(radius, span, fine)).alias("side"), "id", "ord", "coords", "w")


def ball_members(points: DataFrame, radius: float, stats: PointStats | None = None) -> DataFrame:
    """Every pair (x, y) with ``d(x, y) <= radius`` (V5), x = y included."""
    stats = stats or validate_points(points)
    p = _single(points, radius, stats.span)
    pairs = ball_pairs(p, p, stats.d, ["g"])
    return pairs.select(F.col("id"), F.col("y_id").alias("member_id"), "dist")


def ball_weights(points: DataFrame, active: DataFrame, radius: float,
                 stats: PointStats | None = None, hot_cell: int = HOT_CELL) -> DataFrame:
    """Ball weight of every x in ``points``: summed ``w`` of active y within ``radius`` (V6).

    Points whose ball holds no active point get weight 0.
    """
    stats = stats or validate_points(points)
    fine = fine_steps(stats.d)
    p = _single(points, radius, stats.span, fine)
    z = _single(active, radius, stats.span, fine)
    hot = stats.n > hot_cell and max(hottest_cells(p, stats.d, ["g"]).values(), default=0) > hot_cell
    weights = ball_weight_sums(p, z, stats.d, ["g"], aggregate=hot).select("id", "ball_weight")
    return points.select("id", "ord").join(weights, "id", "left") \
        .select("id", "ord", F.coalesce("ball_weight", F.lit(0).cast("long")).alias("ball_weight"))


def heaviest_ball(weights: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The heaviest ball (V7): largest weight, ties to the lowest ord; weight must be > 0."""
    keys = keys or []
    best = F.max(F.struct(F.col("ball_weight"), (-F.col("ord")).alias("neg_ord"), F.col("id"))).alias("b")
    agg = weights.groupBy(*keys).agg(best) if keys else weights.agg(best)
    return agg.filter(F.col("b.ball_weight") > 0).select(
        *keys, F.col("b.id").alias("id"), (-F.col("b.neg_ord")).alias("ord"),
        F.col("b.ball_weight").alias("ball_weight"))


def ball_removal(active: DataFrame, centers: DataFrame, radius: float, d: int) -> DataFrame:
    """Active points left after removing every point within ``radius`` of a center (V8)."""
    left = _with_nearest(active, centers, d)
    return left.where(F.coalesce(F.col("dist") > F.lit(float(radius)), F.lit(True))).drop("dist", "center_id")
