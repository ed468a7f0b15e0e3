"""Greedy cover and k-center with z outliers (weighted), as DataFrame steps.

For a radius r the greedy cover repeats, at most k times: take the point x whose ball of
inner radius (1+2a)r holds the most active weight (ties to the lowest ord), make it a
center, and deactivate every point within the outer radius (3+4a)r of it. It stops early
when no active weight is left. The radius search starts at half the smallest distance
among the first k+z+1 points and doubles r until the uncovered weight is at most z.

Execution
- Several guesses run together: points are replicated per guess ``g``, every step handles all
  unfinished guesses in one job, and the answer is the lowest successful g. That turns
  (guesses x k) dependent jobs into about k per batch. Once a guess has succeeded, the larger
  ones of its batch are dropped: they cost most and no answer needs them.
- The state between steps is (guess, point, activity, ball weight), checkpointed. A step takes the weight of the points that new centers removed off the
  balls around them, and leaves all other weights alone. Guesses, radii, grid sizes and new
  centers travel in one small broadcast table (at most ``MAX_BATCH`` rows), not in the plan, so
  all steps have the same plan text and reuse its compiled code.
- Guesses that certainly fail are not run: grid cells bound what a ball can hold (``_BallBound``),
  and if k times that leaves more than z of the weight, no choice of centers succeeds.
- Ball weights are the grid equi-join of ``geometry.ball_weight_sums`` over
  identical-point-merged data, with per-guess cells; crowded cells are summed first. Inputs of
  at most ``SMALL_BALLS`` points (a coreset) are one broadcast row instead.
- One pass can yield several centers: it returns the heaviest ball per (guess, grid cell),
  and after each chosen center a cell is known to be emptied, unchanged or only bounded.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pinwheel.functions.distance import euclidean
from pinwheel.operators.geometry import (HOT_CELL, SMALL_BALLS, PointStats, ball_weight_sums, cell_side, fine_steps, hottest_cells,
                                         initial_guess, merge_duplicates, small_ball_weights, validate_points, with_weight)
from pinwheel.session import checkpoint_dir

GUESS_BATCH = 1
# Guesses per batch grow up to this when the input is small (point-guess rows per batch).
BATCH_ROWS = 8_000
MAX_BATCH = 16
# Coordinates of chosen centers that a batch may broadcast (at least one guess is tried).
BATCH_VALUES = 2_000_000
MAX_GUESSES = 2200  # doubling from the smallest positive double reaches any finite distance

CENTER_SCHEMA = T.StructType([
    T.StructField("g", T.IntegerType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("coords", T.ArrayType(T.DoubleType())),
    T.StructField("ball_weight", T.LongType()),
])


@dataclass
class CoverResult:
    """Result of one greedy cover per guess."""
    centers: DataFrame           # g, step, id, ord, coords, ball_weight
    left: dict[int, int]         # uncovered weight per guess


@dataclass
class KCenterResult:
    centers: DataFrame           # step, id, ord, coords, ball_weight
    n: int
    k: int
    z: int
    alpha: float
    initial_guess: float
    final_guess: float
    guesses: int
    left_weight: int
    extra: dict = field(default_factory=dict)
    stats: PointStats | None = None  # of the input points, for follow-up operators

    def metrics(self, spark: SparkSession, objective: float | None = None) -> DataFrame:
        row = {"n": self.n, "k": self.k, "z": self.z, "initial_guess": float(self.initial_guess),
               "final_guess": float(self.final_guess), "guesses": self.guesses,
               "left_weight": self.left_weight, **self.extra}
        if objective is not None:
            row["objective"] = float(objective)
        return spark.createDataFrame([row])


def _step_by_ord() -> Column:
    """Center numbers 0, 1, ... in input order, for the branches that return every point of a
    set of at most k points (a window over at most k rows)."""
    return (F.row_number().over(Window.orderBy("ord")) - 1).cast("int").alias("step")


def radii(alpha: float, r: float) -> tuple[float, float]:
    """Inner and outer radius for guess r."""
    return (1 + 2 * alpha) * r, (3 + 4 * alpha) * r


# Certified greedy steps ------------------------------------------------------------------
# Cells per guess of the certification grid (over up to 3 dimensions).
CERT_CELLS = 1024
_CERT_KEYS = ["_q0", "_q1", "_q2"]
_CERT_MARGIN = 1e-9


@dataclass
class _CertGrid:
    """Grid of one guess over the data's extent: origin, cell width, cells per dimension."""
    lo: np.ndarray
    width: float
    res: np.ndarray
    rin: float
    rout: float


def _cert_grid(rin: float, rout: float, stats: PointStats) -> _CertGrid:
    """Cells small enough that the chosen center's own cell lies inside the region whose balls
    are emptied (diagonal below outer - inner radius), widened until at most ``CERT_CELLS``
    cells cover the extent; a coarser grid only certifies fewer steps. A constant dimension
    has one cell, whatever the width."""
    dims = min(stats.d, len(_CERT_KEYS), len(stats.lo))
    lo = np.array(stats.lo[:dims], dtype=float)
    extent = np.array(stats.hi[:dims], dtype=float) - lo
    width = max((rout - rin) / max(dims, 1) ** 0.5 * 0.99, float(extent.max(initial=0.0)) * 1e-9, 1e-300)

    def cells(w):
        return np.floor(extent / w) + 1

    while cells(width).prod() > CERT_CELLS:
        width *= 1.25
    return _CertGrid(lo, width, cells(width).astype(np.int64), rin, rout)


class _CellMaxima:
    """The heaviest ball per grid cell of one guess after a pass, kept up to date without
    passes as far as geometry proves it."""

    def __init__(self, grid: _CertGrid, rows, d: int):
        self.grid, self.whole = grid, len(grid.lo) == d
        best = [r["b"] for r in rows]
        self.id = [b["id"] for b in best]
        self.coords = [[float(v) for v in b["coords"]] for b in best]
        self.ord = np.array([-b["neg_ord"] for b in best], dtype=np.int64)
        self.weight = np.array([float(b["bw"]) for b in best])
        self.exact = np.ones(len(best), dtype=bool)
        keys = _CERT_KEYS[:len(grid.lo)]
        cell = np.array([[r[key] for key in keys] for r in rows], dtype=float).reshape(len(best), len(keys))
        self.low = grid.lo + cell * grid.width - grid.width * 1e-6
        self.high = grid.lo + (cell + 1) * grid.width + grid.width * 1e-6

    def heaviest(self) -> int | None:
        """The certain heaviest ball (ties to the lowest ord); None if a pass is needed."""
        if not self.exact.any():
            return None
        bound = self.weight[~self.exact].max(initial=-np.inf)
        top = self.weight[self.exact].max()
        if not top > bound and not (top <= 0 and bound <= 0):
            return None
        at = np.flatnonzero(self.exact & (self.weight == top))
        return int(at[np.argmin(self.ord[at])])

    def remove_around(self, center: list[float]) -> None:
        """Take the outer ball of a new center out of all balls."""
        c = np.array(center[:len(self.grid.lo)], dtype=float)
        gap = np.sqrt((np.maximum(np.maximum(self.low - c, c - self.high), 0.0) ** 2).sum(1)) * (1 - _CERT_MARGIN)
        reach = np.sqrt((np.maximum(np.abs(self.low - c), np.abs(self.high - c)) ** 2).sum(1)) * (1 + _CERT_MARGIN)
        emptied = (reach + self.grid.rin <= self.grid.rout * (1 - _CERT_MARGIN)) & self.whole
        touched = gap <= (self.grid.rin + self.grid.rout) * (1 + _CERT_MARGIN)
        self.exact = np.where(emptied, True, self.exact & ~touched)
        self.weight = np.where(emptied, 0.0, self.weight)


def _take_certain(cells: _CellMaxima, chosen: list[tuple], k: int) -> bool:
    """Take the greedy steps that the cell maxima prove; whether no active weight is left."""
    while len(chosen) < k:
        at = cells.heaviest()
        if at is None:
            return False
        if cells.weight[at] <= 0:
            return True
        center = cells.coords[at]
        chosen.append((len(chosen), cells.id[at], int(cells.ord[at]), center, int(cells.weight[at])))
        cells.remove_around(center)
    return False


def _guess_schema(dims: int) -> str:
    return ("_k int, g int, radius double, outer double, side double, open boolean, cw double, cs array<array<double>>"
            + "".join(f", lo{i} double, top{i} long" for i in range(dims)))


# Up to this many new centers are compared by compiled code, more by a lambda.
UNROLLED = 4
STATE = ["g", "id", "ord", "coords", "w", "act", "bw"]


def _within(bound: Column, most: int, d: int) -> Column:
    """Whether one of the new centers ``cs`` (at most ``most``) is within ``bound`` of a point."""
    if most > UNROLLED:
        return F.exists("cs", lambda c: euclidean(F.col("coords"), c, d) <= bound)
    near = [F.coalesce(euclidean(F.col("coords"), F.get("cs", F.lit(j)), d) <= bound, F.lit(False)) for j in range(UNROLLED)]
    return near[0] | near[1] | near[2] | near[3]


class _BallState:
    """Ball weight and activity of every point for every running guess, kept from step to step.

    The first state counts whole balls. After new centers, the points within the outer radius
    of one are deactivated, and only their weight is taken off the balls that held them: those
    of points within inner + outer radius. All other weights stay as they are, so a step's
    joins handle what it removed and its neighbourhood, not the table. Every state is written
    to the checkpoint folder, so neither lineage nor plan grows and a lost executor costs one
    step. For few points (``small``) every step counts afresh, in one job without a state.
    """

    def __init__(self, merged: DataFrame, n: int, d: int, aggregate: bool):
        self.merged, self.small, self.d, self.aggregate = merged, n <= SMALL_BALLS, d, aggregate
        self.state: DataFrame | None = None

    def advance(self, guess: DataFrame, most: int, balls: bool) -> DataFrame:
        """The state after the centers ``cs`` of ``guess`` (at most ``most`` per guess; all centers
        if ``small``, else the new ones); without ``balls`` only the activity is brought up to date."""
        g, cols = ["g"], ["g", "radius", "side", "id", "ord", "coords", "w"]
        if self.small:
            xs = self.merged.join(guess, "_k").withColumn("act", ~_within(F.col("outer"), most, self.d))
            ys = xs.where(F.col("act") & F.col("open")) if balls else xs.limit(0)
            return small_ball_weights(xs, ys, self.d, g).withColumnRenamed("ball_weight", "bw").select(*STATE)
        old = self.state
        if old is None:
            xs = self.merged.join(guess, "_k").select(*cols)
            new = ball_weight_sums(xs, xs, self.d, g, aggregate=self.aggregate).join(self.merged.select("id", "w"), "id") \
                .select("g", "id", "ord", "coords", "w", F.lit(True).alias("act"), F.col("ball_weight").alias("bw"))
        else:
            # Guesses that are done have no row in ``guess`` and leave the state here.
            upd = old.join(guess, "g").withColumn("gone", F.col("act") & _within(F.col("outer"), most, self.d))
            if balls:
                reach = (F.col("radius") + F.col("outer")) * F.lit(1 + _CERT_MARGIN)
                near = upd.where(F.col("open") & (F.col("bw") > 0) & _within(reach, most, self.d))
                lost = upd.where(F.col("gone") & F.col("open"))
                less = ball_weight_sums(near.select(*cols), lost.select(*cols), self.d, g, aggregate=self.aggregate) \
                    .select("g", "id", "ball_weight")
                upd = upd.join(less, ["g", "id"], "left").withColumn("bw", F.col("bw") - F.coalesce("ball_weight", F.lit(0)))
            new = upd.withColumn("act", F.col("act") & ~F.col("gone"))
        checkpoint_dir(self.merged.sparkSession)
        self.state = new.select(*STATE).checkpoint()
        return self.state


def greedy_batch(merged: DataFrame, stats: PointStats, guesses: list[tuple[int, float, float]],
                 k: int, enough: int | None = None, hot_cell: int = HOT_CELL, n: int | None = None) -> CoverResult:
    """Run the greedy cover for several (g, inner radius, outer radius) at once.

    ``merged`` has id, ord, coords, w with identical points already merged, ``n`` rows (if
    known). With ``enough``, guesses above one that leaves at most that weight are dropped
    (they miss in ``left``).
    """
    spark = merged.sparkSession
    d, fine = stats.d, fine_steps(stats.d)
    spec = {g: (rin, rout, cell_side(rin, stats.span, fine)) for g, rin, rout in guesses}
    grids = {g: _cert_grid(rin, rout, stats) for g, (rin, rout, _) in spec.items()}
    dims = len(stats.lo)
    keys = _CERT_KEYS[:dims]
    rows = merged.withColumn("_k", F.lit(0))
    chosen: dict[int, list[tuple]] = {g: [] for g in spec}
    seen = dict.fromkeys(spec, 0)  # centers that the kept state takes into account
    running, left = set(spec), {}

    def table(gs):
        """One row per running guess, at most MAX_BATCH; a constant key replicates the points."""
        return F.broadcast(spark.createDataFrame(
            [(0, g, float(spec[g][0]), float(spec[g][1]), float(spec[g][2]), len(chosen[g]) < k, float(grids[g].width),
              [c[3] for c in chosen[g][seen[g]:]], *[v for i in range(dims) for v in (float(grids[g].lo[i]), int(grids[g].res[i]) - 1)])
             for g in gs], _guess_schema(dims)))

    n = merged.count() if n is None else n
    aggregate = False
    if n > max(hot_cell, SMALL_BALLS):  # no cell of fewer points can be hot
        load = hottest_cells(rows.join(table(sorted(running)), "_k"), d, ["g"])
        aggregate = max(load.values(), default=0) > hot_cell
    best = F.max(F.struct("bw", (-F.col("ord")).alias("neg_ord"), "id", "coords")).alias("b")
    balls = _BallState(rows, n, d, aggregate)
    while running:
        now = sorted(running)
        guess = table(now)
        is_open = any(len(chosen[g]) < k for g in now)
        state = balls.advance(guess, max(len(chosen[g]) - seen[g] for g in now), is_open)
        if not balls.small:
            seen.update({g: len(chosen[g]) for g in now})
        cell = [F.least(F.greatest(F.floor((F.col("coords").getItem(i) - F.col(f"lo{i}")) / F.col("cw")), F.lit(0)),
                        F.col(f"top{i}")).cast("long").alias(key) for i, key in enumerate(keys)]
        found = state.join(guess, "g").select(*STATE, *cell).groupBy("g", *keys) \
            .agg(best, F.sum(F.when(F.col("act"), F.col("w")).otherwise(F.lit(0))).cast("long").alias("lw"))
        by_guess: dict[int, list] = {}
        for r in found.collect():  # at most CERT_CELLS rows per guess
            by_guess.setdefault(r["g"], []).append(r)
        for g in now:
            rs = by_guess.get(g, [])
            lw = sum(int(r["lw"]) for r in rs)
            done = lw == 0 or len(chosen[g]) >= k
            if not done and _take_certain(_CellMaxima(grids[g], rs, d), chosen[g], k):
                done, lw = True, 0
            if done:
                left[g] = lw
                running.discard(g)
        if enough is not None:
            first = min((g for g, lw in left.items() if lw <= enough), default=None)
            running = {g for g in running if first is None or g < first}
    out = [(g, s, i, o, c, bw) for g, cs in chosen.items() for (s, i, o, c, bw) in cs]
    return CoverResult(spark.createDataFrame(out, CENTER_SCHEMA), left)


# The work per cached point is far larger than its size, so the input is spread over the
# parallelism at hand as soon as each partition gets LEAST_ROWS rows, and beyond it by
# ROWS_PER_PARTITION.
LEAST_ROWS = 500
ROWS_PER_PARTITION = 250_000


def spread_over(spark: SparkSession, n: int) -> int:
    """Partitions for ``n`` cached points."""
    return max(1, min(spark.sparkContext.defaultParallelism, n // LEAST_ROWS), -(-n // ROWS_PER_PARTITION))


def _cached_merge(points: DataFrame) -> tuple[DataFrame, int]:
    """Duplicate-merged points, cached, and their count."""
    merged = merge_duplicates(points).persist(StorageLevel.MEMORY_AND_DISK)
    n = merged.count()
    spread = merged.repartition(spread_over(points.sparkSession, n)).persist(StorageLevel.MEMORY_AND_DISK)
    spread.count()
    merged.unpersist()
    return spread, n


def greedy_cover(points: DataFrame, radius: float, k: int, alpha: float = 0.0,
                 stats: PointStats | None = None) -> tuple[DataFrame, int]:
    """One greedy cover at a fixed radius (K1, K2): centers and the uncovered weight."""
    stats = stats or validate_points(points)
    merged, distinct_n = _cached_merge(points)
    try:
        rin, rout = radii(alpha, radius)
        res = greedy_batch(merged, stats, [(0, rin, rout)], k, n=distinct_n)
    finally:
        merged.unpersist()
    return res.centers.drop("g"), res.left[0]


def _guess_sequence(r0: float, r_pos: float | None):
    """Yield the radius of guess 0, 1, 2, ...

    r0 > 0: r0 * 2^g. r0 == 0 (duplicates among the first points): 0 once, then r_pos * 2^(g-1).
    """
    if r0 > 0:
        r = r0
        while True:
            yield r
            r = 2 * r
    yield 0.0
    r = r_pos
    while True:
        yield r
        r = 2 * r


# Cells per input that bound what a ball can hold; so many pairs of them are compared at once.
BOUND_CELLS, BOUND_PAIRS = 4096, 1_000_000


class _BallBound:
    """How much weight a ball of any radius around any point can hold at most, from the weights
    and real boxes of at most ``BOUND_CELLS`` grid cells (one aggregate)."""

    def __init__(self, merged: DataFrame, stats: PointStats):
        g = len(stats.lo)
        lo, extent = stats.lo, [b - a for a, b in zip(stats.lo, stats.hi)]
        widest = max(extent)
        width = max(widest, 1e-300)
        while width > widest / BOUND_CELLS > 0 and math.isfinite(width) \
                and math.prod(math.floor(e / (width / 1.1)) + 1 for e in extent) <= BOUND_CELLS:
            width /= 1.1
        x = [F.col("coords").getItem(i) for i in range(g)]
        cell = [F.least(F.greatest(F.floor((x[i] - F.lit(lo[i])) / F.lit(width)), F.lit(0)),
                        F.lit(math.floor(extent[i] / width) if math.isfinite(width) else 0)).alias(f"_q{i}") for i in range(g)]
        ends = [f(x[i]).alias(f"{e}{i}") for i in range(g) for f, e in ((F.min, "lo"), (F.max, "hi"))]
        rows = merged.groupBy(*cell).agg(F.sum("w").cast("double").alias("w"), F.min("w").alias("least"), *ends).collect()
        self.weight = np.array([r["w"] or 0.0 for r in rows])
        self.sound = all((r["least"] or 0) >= 0 for r in rows)
        self.lo, self.hi = (np.array([[r[f"{e}{i}"] for r in rows] for i in range(g)]).reshape(g, len(rows)) for e in ("lo", "hi"))

    def most(self, radius: float) -> float:
        """Upper bound of the weight within ``radius`` of a point: a point's cell with all cells
        whose box is that near (over some dimensions, which never exceeds the distance)."""
        best, step = 0.0, max(1, BOUND_PAIRS // max(len(self.weight), 1))
        with np.errstate(over="ignore"):
            for first in range(0, len(self.weight), step):
                near = 0.0
                for a, b in zip(self.lo, self.hi):
                    low, high = a[first:first + step, None], b[first:first + step, None]
                    near = near + np.maximum(np.maximum(a - high, low - b), 0.0) ** 2
                inside = np.sqrt(near) <= radius * (1 + _CERT_MARGIN)
                best = max(best, float((np.broadcast_to(inside, (len(low), len(self.weight))) @ self.weight).max()))
        return best

    def fails(self, outer: float, k: int, z: int) -> bool:
        """Whether ``k`` balls of the ``outer`` radius certainly leave more than ``z``."""
        return self.sound and k * self.most(outer) * (1 + _CERT_MARGIN) + z < self.weight.sum() * (1 - _CERT_MARGIN)


def kcenter_outliers(points: DataFrame, k: int, z: int, alpha: float = 0.0, guard_n: int | None = None,
                     batch: int | None = None, stats: PointStats | None = None) -> KCenterResult:
    """Weighted k-center with z outliers (K3-K7). ``points`` may carry a weight column ``w``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    if z < 0:
        raise ValueError("z must be non-negative")
    spark = points.sparkSession
    pts = with_weight(points)
    stats = stats or validate_points(pts)  # a caller that already validated passes its stats
    n = stats.n if guard_n is None else guard_n
    empty = spark.createDataFrame([], CENTER_SCHEMA).drop("g")
    if k > n or n == 0 or n <= z:
        return KCenterResult(empty, n, k, z, alpha, 0.0, 0.0, 0, 0, stats=stats)
    if n == k and guard_n is None:
        allp = pts.select(_step_by_ord(), "id", "ord", "coords",
                          F.col("w").alias("ball_weight"))
        return KCenterResult(allp, n, k, z, alpha, 0.0, 0.0, 0, 0, stats=stats)

    merged, distinct_n = _cached_merge(pts)
    try:
        if distinct_n <= k:
            # Every distinct point is a center; nothing is left uncovered at radius 0.
            cs = merged.select(_step_by_ord(), "id", "ord", "coords",
                               F.col("w").alias("ball_weight"))
            return KCenterResult(cs, n, k, z, alpha, 0.0, 0.0, 1, 0, stats=stats)
        m = min(k + z + 1, stats.n)
        r0 = initial_guess(pts, m, stats.d).collect()[0]["r0"]
        r0 = float(r0) if r0 is not None else 0.0
        r_pos = None
        if r0 == 0.0:
            r_pos = initial_guess(merged, m, stats.d).collect()[0]["r0"]
            r_pos = float(r_pos) if r_pos else None
        seq = _guess_sequence(r0, r_pos)
        if batch is None:
            # Small inputs (e.g. a coreset) try many radii per job; large ones few, since the
            # ball join of a large radius is the expensive part.
            batch = max(GUESS_BATCH, min(MAX_BATCH, BATCH_ROWS // max(distinct_n, 1)))
        batch = max(1, min(batch, BATCH_VALUES // (k * max(stats.d, 1))))
        g0, r = 0, next(seq)
        if distinct_n > SMALL_BALLS and stats.lo:
            # Guesses whose k outer balls can't hold enough fail whatever centers they choose.
            bound = _BallBound(merged, stats)
            while g0 < MAX_GUESSES and bound.fails(radii(alpha, r)[1], k, z):
                g0, r = g0 + 1, next(seq)
        seq = chain([r], seq)
        while g0 < MAX_GUESSES:
            rs = [next(seq) for _ in range(batch)]
            specs = [(g0 + i, *radii(alpha, r)) for i, r in enumerate(rs)]
            res = greedy_batch(merged, stats, specs, k, enough=z, n=distinct_n)
            ok = sorted(g for g, lw in res.left.items() if lw <= z)
            if ok:
                g = ok[0]
                centers = res.centers.filter(F.col("g") == g).drop("g")
                return KCenterResult(centers, n, k, z, alpha, r0, rs[g - g0], g + 1, res.left[g], stats=stats)
            g0 += batch
        raise RuntimeError("radius search did not finish")
    finally:
        merged.unpersist()
