"""Farthest-first coresets per group and the two-round k-center solver.

Round 1 builds, inside every group ``part``, k+z+1 centers by farthest-first traversal and
weighs each by the number of the group's points nearest to it. Round 2 solves weighted
k-center with outliers (alpha = 2) on that coreset of at most (k+z+1) * L points.

Execution
- Every point carries its distance to the nearest center of its group so far, so a traversal
  pass compares it with the new centers only, and the coreset weights are a count over the
  final state. The farthest point per group and grid cell is a ``max`` over a struct, which
  Catalyst aggregates partially in every task: no group is ever gathered into one task, and
  a group holding a third of all rows costs the same as any other. New centers travel as one
  row per group, broadcast if their size allows and joined by shuffle otherwise.
- The cached state of an input that few tasks read is spread over the parallelism at hand.
- The driver holds the centers themselves ((k+z+1) * L rows, the result of the operator) and
  per pass one row per cell of the certificate grid.
- The coreset is written to the shared checkpoint folder for round two.
- Groups come from the ``part`` column (``pmod(id, L)`` by default), never from physical
  partitions, so results do not depend on AQE or on the number of shuffle partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pinwheel.functions.distance import euclidean
from pinwheel.operators.geometry import PointStats, validate_points
from pinwheel.operators.kcenter import KCenterResult, kcenter_outliers, spread_over
from pinwheel.operators.objective import objective_value, partitioned_in_one_pass
from pinwheel.session import checkpoint_dir

# Largest per-group center table (rows x dimensions) broadcast to every task.
MAX_BROADCAST_VALUES = 5_000_000

FFT_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("coords", T.ArrayType(T.DoubleType())),
])


def assign_parts(points: DataFrame, parts: int) -> DataFrame:
    """Add ``part = pmod(id, parts)`` unless a ``part`` column is already present."""
    if parts < 1:
        raise ValueError("the number of groups L must be at least 1")
    if "part" in points.columns:
        return points
    return points.withColumn("part", F.pmod(F.col("id"), F.lit(parts)).cast("int"))


# Cells of the traversal's certificate grid per group (spread over up to 3 dimensions): at
# least this many, and so many per center to find.
CERT_CELLS, CELLS_PER_CENTER = 1024, 32
# Bound on the rows a traversal pass brings to the driver; with many groups each group gets
# fewer cells, at least one (the next center of every group is part of the result anyway).
CERT_ROWS = 200_000
_CERT_DIMS = 3
# Relative margin that keeps box-to-center distances below the computed point distances.
_BOX_MARGIN = 1e-9
# New centers per group after which the running minimum is written into the cached state,
# and how many such states follow each other before one goes to the checkpoint folder.
PENDING_CENTERS = 8
STATES_PER_CHECKPOINT = 8


class _GroupCells:
    """The farthest point per grid cell of one group after a pass."""

    def __init__(self, rows, keys, lo, width, whole: bool):
        self.whole = whole
        best = [r["b"] for r in rows]
        self.id = [b["id"] for b in best]
        self.coords = [[float(v) for v in b["coords"]] for b in best]
        self.ord = np.array([-b["neg_ord"] for b in best], dtype=np.int64)
        self.far = np.array([float(b["m"]) for b in best])
        self.exact = np.ones(len(best), dtype=bool)
        self.single = np.array([r["n"] == 1 for r in rows])
        self.points = np.array(self.coords, dtype=float).reshape(len(best), -1)
        cell = np.array([[r[k] for k in keys] for r in rows], dtype=float).reshape(len(best), len(keys))
        slack = width * 1e-6  # a point may sit a rounding error outside its computed cell
        self.low, self.high = lo + cell * width - slack, lo + (cell + 1) * width + slack

    def take(self, wanted: int) -> tuple[list[tuple], bool]:
        """Up to ``wanted`` next centers (id, ord, coords) that the cell maxima prove, and
        whether the farthest point is at distance 0."""
        out: list[tuple] = []
        while len(out) < wanted and self.exact.any():
            bound = self.far[~self.exact].max(initial=-np.inf)
            top = self.far[self.exact].max()
            if top <= 0 and bound <= 0:
                return out, True
            if not top > bound:
                break
            at = np.flatnonzero(self.exact & (self.far == top))
            best = int(at[np.argmin(self.ord[at])])
            out.append((self.id[best], int(self.ord[best]), self.coords[best]))
            c, before = np.array(self.coords[best][:self.low.shape[1]], dtype=float), self.far
            gap = np.sqrt((np.maximum(np.maximum(self.low - c, c - self.high), 0.0) ** 2).sum(1)) * (1 - _BOX_MARGIN)
            keep = self.exact & (gap >= self.far)  # no point of the cell gets closer
            keep[best] = False                     # its cell's maximum is now unknown
            if self.whole:                         # new distances are at most the box's reach
                reach = np.sqrt((np.maximum(np.abs(self.low - c), np.abs(self.high - c)) ** 2).sum(1)) * (1 + _BOX_MARGIN)
                self.far = np.where(keep, self.far, np.minimum(self.far, reach))
            # A cell's only point is known: so is its new distance (the same left fold).
            total = np.zeros(len(self.far))
            for j, v in enumerate(self.coords[best]):
                total = total + (self.points[:, j] - v) * (self.points[:, j] - v)
            self.far = np.where(self.single, np.minimum(before, np.sqrt(total)), self.far)
            self.exact = keep | self.single
        return out, False


@dataclass
class Traversal:
    """Centers of all groups, and every point's distance and step of its nearest center."""
    centers: DataFrame  # part, step, id, ord, coords
    state: DataFrame    # part, id, ord, coords, m, near
    cached: DataFrame   # what ``state`` reads; unpersist it once ``state`` is used up


def traverse(points: DataFrame, m: int, parts: int | None = None, stats: PointStats | None = None,
             cells: int | None = None, broadcast_values: int = MAX_BROADCAST_VALUES) -> Traversal:
    """Farthest-first traversal with ``m`` centers inside every group (C1, C2).

    Starts at the group's first point (lowest ord); each step adds the point farthest from
    the centers so far, ties to the lowest ord. A group stops early when its farthest point
    is at distance 0 (fewer than m distinct points).

    Every point keeps its distance to the nearest center so far and that center's step, and
    a pass compares it only with the centers added since (n * m distances in all, plus what a
    few pending centers cost more than once). A pass returns, per group and per cell of a
    coarse grid, the farthest point of the cell (a partial aggregate). Its overall maximum is
    the next center; further ones are chosen from the same rows as long as that is provably
    exact: a cell whose box is at least its maximum away from every new center keeps its
    maximum, a cell's only point stays known, other cells only keep an upper bound, and the
    best exact cell must beat every bound. ``cells=1`` gives one center per pass.
    """
    spark = points.sparkSession
    checkpoint_dir(spark)
    pts = assign_parts(points, parts) if parts else points
    stats = stats or validate_points(pts)
    d, g = stats.d, min(stats.d, _CERT_DIMS)
    pts = pts.select("part", "id", "ord", "coords")
    # One pass: every group's first point and bounding box (partial aggregates), and the input's tasks.
    first = pts.withColumn("_at", F.spark_partition_id()).groupBy("part").agg(
        F.max("_at").alias("at"),
        F.min(F.struct("ord", "id", "coords")).alias("c"),
        *[F.min(F.col("coords").getItem(i)).alias(f"lo{i}") for i in range(g)],
        *[F.max(F.col("coords").getItem(i)).alias(f"hi{i}") for i in range(g)]).collect()
    cells = max(CERT_CELLS, CELLS_PER_CENTER * m) if cells is None else cells
    per_group = max(1, min(cells, CERT_ROWS // max(len(first), 1)))
    res = max(1, int(per_group ** (1.0 / g) + 1e-9)) if g else 1
    boxes, chosen, pending = {}, {}, {}
    for r in first:
        part = int(r["part"])
        lo, hi = (np.array([r[f"{e}{i}"] for i in range(g)], dtype=float) for e in ("lo", "hi"))
        boxes[part] = (lo, np.where(hi > lo, (hi - lo) / res, 1.0))
        chosen[part] = [(r["c"]["id"], r["c"]["ord"], [float(v) for v in r["c"]["coords"]])]
        pending[part] = [(0, chosen[part][0][2])]
    done = {p for p in chosen if m <= 1}
    keys = [f"_g{i}" for i in range(g)]

    def attached(df: DataFrame, rows: list, schema: str, values: int) -> DataFrame:
        """``df`` joined with a table of one row per group: broadcast if its size allows."""
        table = spark.createDataFrame(rows, schema)
        return df.join(F.broadcast(table) if values <= broadcast_values else table, "part")

    box_rows = [(p, *[float(v) for v in lo], *[float(v) for v in w]) for p, (lo, w) in boxes.items()]
    box_schema = "part int" + "".join([f", _lo{i} double" for i in range(g)] + [f", _w{i} double" for i in range(g)])
    state = attached(pts, box_rows, box_schema, len(boxes) * (2 * g + 1)).select(
        "part", "id", "ord", "coords", F.lit(float("inf")).alias("m"), F.lit(None).cast("int").alias("near"),
        *[F.least(F.greatest(F.floor((F.col("coords").getItem(i) - F.col(f"_lo{i}")) / F.col(f"_w{i}")),
                             F.lit(0)), F.lit(res - 1)).cast("int").alias(keys[i]) for i in range(g)])
    # A small file is read by few tasks, but every pass compares its points with many centers.
    wide = spread_over(spark, stats.n)
    if max((r["at"] + 1 for r in first), default=wide) < wide:
        state = state.repartition(wide)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)

    def current() -> DataFrame:
        """The state with the pending centers taken into account."""
        rows = [(p, p in done, [(s, c) for s, c in cs]) for p, cs in pending.items()]
        values = sum(len(cs) for cs in pending.values()) * max(d, 1)

        def closer(acc, c):
            dist = euclidean(F.col("coords"), c["c"], d)
            # Only a strictly closer center replaces the current one: ties keep the lowest step.
            return F.when(dist < acc["m"], F.struct(dist.alias("m"), c["s"].alias("near"))).otherwise(acc)

        joined = attached(state, rows, "part int, _done boolean, _cs array<struct<s:int,c:array<double>>>", values)
        best = F.aggregate("_cs", F.struct("m", "near"), closer)
        return joined.select("part", "id", "ord", "coords", best.alias("_b"), *keys, "_done") \
            .select("part", "id", "ord", "coords", "_b.m", "_b.near", *keys, "_done")

    written, stale = 0, None
    while True:
        if max(map(len, pending.values()), default=0) > PENDING_CENTERS:
            # Lazy: the next pass fills the cache while it looks for the farthest points.
            written += 1
            later = current().drop("_done")
            later = later.checkpoint() if written % STATES_PER_CHECKPOINT == 0 else later.persist(StorageLevel.MEMORY_AND_DISK)
            stale, state, pending = state, later, {p: [] for p in chosen}
        fresh = current()
        if len(done) == len(chosen):
            break
        tops = fresh.where(~F.col("_done")).groupBy("part", *keys).agg(
            F.max(F.struct("m", (-F.col("ord")).alias("neg_ord"), "id", "coords")).alias("b"), F.count(F.lit(1)).alias("n")).collect()
        if stale is not None:
            stale.unpersist()
            stale = None
        by_part: dict[int, list] = {}
        for r in tops:
            by_part.setdefault(int(r["part"]), []).append(r)
        for part, rows in by_part.items():
            taken, exhausted = _GroupCells(rows, keys, *boxes[part], whole=g == d).take(m - len(chosen[part]))
            for center in taken:
                pending[part].append((len(chosen[part]), center[2]))
                chosen[part].append(center)
            if exhausted or len(chosen[part]) >= m:
                done.add(part)
    table = [(p, s, i, o, c) for p, cs in chosen.items() for s, (i, o, c) in enumerate(cs)]
    return Traversal(spark.createDataFrame(table, FFT_SCHEMA), fresh.select("part", "id", "ord", "coords", "m", "near"), state)


def fft_centers(points: DataFrame, m: int, parts: int | None = None, stats: PointStats | None = None,
                cells: int | None = None, broadcast_values: int = MAX_BROADCAST_VALUES) -> DataFrame:
    """Farthest-first centers of every group (C1): part, step, id, ord, coords."""
    found = traverse(points, m, parts, stats, cells, broadcast_values)
    found.cached.unpersist()
    return found.centers


def coreset_weights(points: DataFrame, centers: DataFrame, parts: int | None = None,
                    stats: PointStats | None = None, broadcast_values: int = MAX_BROADCAST_VALUES) -> DataFrame:
    """Number of the group's points nearest to each of some centers, ties to the lowest step
    (C2). Output: part, step, w."""
    pts = assign_parts(points, parts) if parts else points
    stats = stats or validate_points(pts)
    d = stats.d
    arrays = centers.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("step", "coords"))).alias("cs"))
    if centers.count() * max(d, 1) <= broadcast_values:
        arrays = F.broadcast(arrays)
    joined = pts.select("part", "coords").join(arrays, "part")

    def closer(acc, c):
        dist = euclidean(F.col("coords"), c["coords"], d)
        return F.when(dist < acc["d"], F.struct(dist.alias("d"), c["step"].alias("s"))).otherwise(acc)

    start = F.struct(F.lit(float("inf")).alias("d"), F.lit(None).cast("int").alias("s"))
    return joined.select("part", F.aggregate("cs", start, closer)["s"].alias("step")).groupBy("part", "step") \
        .agg(F.count(F.lit(1)).alias("w"))


def partition_coreset(points: DataFrame, k: int, z: int, parts: int,
                      stats: PointStats | None = None) -> DataFrame:
    """Weighted coreset: every group's k+z+1 traversal centers with their weights (C3-C5).

    The weights come from the traversal's own state. Output: ord (= part * (k+z+1) + step, the
    order of the union), part, step, id, coords, w.
    """
    if k < 1 or z < 0:
        raise ValueError("k must be at least 1 and z non-negative")
    m = k + z + 1
    pts = assign_parts(points, parts)
    found = traverse(pts, m, stats=stats or validate_points(pts))
    weights = found.state.groupBy("part", F.col("near").alias("step")).agg(F.count(F.lit(1)).alias("w")).checkpoint()
    found.cached.unpersist()
    core = found.centers.join(weights, ["part", "step"], "left")
    return core.select(
        (F.col("part").cast("long") * m + F.col("step")).alias("ord"), "part", "step",
        F.col("id"), "coords", F.coalesce("w", F.lit(0)).cast("long").alias("w"))


@dataclass
class TwoRoundResult:
    solution: KCenterResult
    coreset: DataFrame
    objective: float
    parts: int


def mr_kcenter(points: DataFrame, k: int, z: int, parts: int, alpha: float = 2.0) -> TwoRoundResult:
    """Two-round k-center with outliers (K8): coreset per group, then the weighted solver.

    Equal coreset points (from different groups, or a group with few distinct points) are
    merged with summed weights. The guards use the original number of points.
    """
    if k < 1 or z < 0 or parts < 1:
        raise ValueError("k must be at least 1, z non-negative and L at least 1")
    pts = assign_parts(points, parts)
    stats = validate_points(pts)
    # Written once to the checkpoint folder: round two carries no lineage back to the points.
    checkpoint_dir(points.sparkSession)
    core = partition_coreset(pts, k, z, parts, stats=stats).checkpoint()
    solution = kcenter_outliers(core.select("id", "ord", "coords", "w"), k, z, alpha, guard_n=stats.n)
    obj = objective_value(partitioned_in_one_pass(pts, solution.centers, z, stats=stats)) if stats.n else 0.0
    solution.extra = {"parts": parts}
    return TwoRoundResult(solution, core, obj, parts)
