"""Objective functions of a center set: the radius that covers all but z points.

All three take a (z+1)-th largest distance d(x, S):
- ``objective_distinct`` (direct form): over the distinct distance values;
- ``objective_partitioned`` (distributed form): over the distinct values of every ``part``.
  Its top z+1 of each part hold the top z+1 of their union, so the pairs (part, value) are
  ranked together;
- ``objective_points``: over all points, duplicates included (drop the z farthest points).

Few values move: the entries are hashed into 4(z+1) buckets and each task sends one maximum
per bucket. Maxima of different buckets belong to different entries, so the (z+1)-th largest
of them can't exceed the answer; the second pass only ranks what reaches that bound, usually
little more than z+1 entries. Nothing depends on the size of z otherwise.

``distinct_in_one_pass``, ``partitioned_in_one_pass`` and ``points_in_one_pass`` give the same
values and compute the distances once. For points, every task keeps its z+1 largest (a limit
after a sort). For distinct values a task keeps a state of at most z+1 distinct entries,
updated batch by batch; the states of all tasks are merged and ranked. They also check the
points on the way, without a pass of their own. The solvers use them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pinwheel.operators.geometry import PointStats, dist_to_centers, validate_points

BUCKETS_PER_RANK = 4


def _kth_largest(values: DataFrame, z: int, entry: list[str], distinct: bool) -> DataFrame:
    """The (z+1)-th largest ``dist``. Rows that agree in ``entry`` are one entry if ``distinct``;
    otherwise ``entry`` tells the rows apart."""
    bucket = F.pmod(F.xxhash64(*entry), F.lit(BUCKETS_PER_RANK * (z + 1)))
    maxima = values.groupBy(bucket.alias("b")).agg(F.max("dist").alias("m")).orderBy(F.desc("m")).limit(z + 1)
    row = maxima.agg(F.count(F.lit(1)).alias("c"), F.min("m").alias("m")).collect()[0]
    reach = values.where(F.col("dist") >= F.lit(float(row["m"]))) if row["c"] > z else values
    if distinct:
        reach = reach.select(*entry).distinct()
    top = reach.orderBy(F.desc("dist")).limit(z + 1)
    return top.agg(F.count(F.lit(1)).alias("c"), F.min("dist").alias("m")).select(
        F.when(F.col("c") >= z + 1, F.col("m"))
         .otherwise(F.raise_error(F.lit(f"fewer than {z + 1} distance values")).cast("double"))
         .alias("objective"))


def _zero(points: DataFrame) -> DataFrame:
    return points.sparkSession.range(1).select(F.lit(0.0).alias("objective"))


def objective_distinct(points: DataFrame, centers: DataFrame, z: int,
                       stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest distinct value of d(x, S); 0 when |P| = |S| or S is empty (O1).

    ``stats`` (from ``validate_points``) saves a pass when the caller already has it."""
    stats = stats or validate_points(points)
    if centers.count() in (0, stats.n):
        return _zero(points)
    return _kth_largest(dist_to_centers(points, centers, stats.d), z, ["dist"], distinct=True)


def objective_partitioned(points: DataFrame, centers: DataFrame, z: int, parts: int | None = None,
                          stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest of the distinct d(x, S) of every group ``part`` (``pmod(id, parts)``
    when given), equal values of different groups counted each (O2). 0 when S is empty."""
    stats = stats or validate_points(points)
    if centers.isEmpty():
        return _zero(points)
    pts = points if parts is None else points.withColumn("part", F.pmod(F.col("id"), F.lit(parts)))
    return _kth_largest(dist_to_centers(pts, centers, stats.d), z, ["part", "dist"], distinct=True)


def objective_points(points: DataFrame, centers: DataFrame, z: int,
                     stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest d(x, S) over all points, duplicates kept (O3). 0 when S is empty."""
    stats = stats or validate_points(points)
    if centers.isEmpty():
        return _zero(points)
    return _kth_largest(dist_to_centers(points, centers, stats.d), z, ["id", "ord"], distinct=False)


# Entries that a task gathers before it cuts its state down to z+1 again.
GATHERED = 1 << 16


def largest_entries(dist: np.ndarray, part: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest distinct (dist, part)."""
    order = np.lexsort((part, -dist))
    dist, part = dist[order], part[order]
    new = np.ones(len(dist), bool)
    new[1:] = (dist[1:] != dist[:-1]) | (part[1:] != part[:-1])
    return dist[new][:most], part[new][:most]


def _states(values: DataFrame, z: int) -> DataFrame:
    """Per task its z+1 largest distinct (``dist``, ``part``), and a row with null dist whose
    ``n`` is the number of its rows."""
    def run(batches):
        dist, part, n, held = [np.zeros(0)], [np.zeros(0, np.int64)], 0, 0
        for batch in batches:
            d, p = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            n += len(d)
            if held > z:  # the smallest entry kept bounds the answer
                far = d >= dist[0][-1]
                d, p = d[far], p[far]
            dist.append(d)
            part.append(p.astype(np.int64))
            if sum(map(len, dist)) > held + max(GATHERED, z + 1):
                one, two = largest_entries(np.concatenate(dist), np.concatenate(part), z + 1)
                dist, part, held = [one], [two], len(one)
        one, two = largest_entries(np.concatenate(dist), np.concatenate(part), z + 1)
        yield pa.RecordBatch.from_pydict({
            "dist": pa.array([*one.tolist(), None], pa.float64()), "part": pa.array([*two.tolist(), 0], pa.int64()),
            "n": pa.array([0] * len(one) + [n], pa.int64())})

    return values.mapInArrow(run, "dist double, part long, n long")


def _objective(top: DataFrame, z: int, zero: Column | None = None) -> DataFrame:
    """From the z+1 largest entries as ``dist`` (rows of null dist don't count)."""
    row = top.agg(F.count("dist").alias("c"), F.min("dist").alias("m"), F.sum("n").alias("n"))
    value = F.when(F.col("c") >= z + 1, F.col("m")) \
        .otherwise(F.raise_error(F.lit(f"fewer than {z + 1} distance values")).cast("double"))
    return row.select((value if zero is None else F.when(zero, F.lit(0.0)).otherwise(value)).alias("objective"))


def _distances(points: DataFrame, centers: DataFrame, stats: PointStats | None) -> DataFrame:
    """``points`` with ``dist``. Without ``stats`` the points are checked on the way: one with
    a null or NaN coordinate, or of another dimension than the centers, fails the job."""
    if stats is not None:
        return dist_to_centers(points, centers, stats.d)
    d = len(centers.first()["coords"])
    bad = F.col("dist").isNull() | F.isnan("dist") | ~F.col("_fits")
    fits = F.coalesce(F.size("coords") == d, F.lit(False))
    return dist_to_centers(points.withColumn("_fits", fits), centers, d).withColumn("dist", F.when(bad, F.raise_error(F.lit("points have null, NaN, missing or further coordinates")).cast("double")).otherwise(F.col("dist")))


def _kth_distinct(values: DataFrame, z: int, zero: Column | None = None) -> DataFrame:
    """The (z+1)-th largest distinct (``dist``, ``part``) of ``values``."""
    merged = _states(values.select("dist", F.col("part").cast("long")), z).groupBy("dist", "part").agg(F.sum("n").alias("n"))
    return _objective(merged.orderBy(F.desc_nulls_first("dist")).limit(z + 2), z, zero)


def distinct_in_one_pass(points: DataFrame, centers: DataFrame, z: int,
                       stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest distinct value of d(x, S); 0 when |P| = |S| or S is empty (O1).

    ``stats`` (from ``validate_points``) tells that the points are valid; else they are checked
    in the same pass."""
    k = centers.count()
    if not k:
        return _zero(points)
    near = _distances(points.select("id", "coords"), centers, stats)
    return _kth_distinct(near.withColumn("part", F.lit(0)), z, zero=F.col("n") == k)


def partitioned_in_one_pass(points: DataFrame, centers: DataFrame, z: int, parts: int | None = None,
                          stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest of the distinct d(x, S) of every group ``part`` (``pmod(id, parts)``
    when given), equal values of different groups counted each (O2). 0 when S is empty."""
    if centers.isEmpty():
        return _zero(points)
    pts = points if parts is None else points.withColumn("part", F.pmod(F.col("id"), F.lit(parts)))
    return _kth_distinct(_distances(pts.select("id", "part", "coords"), centers, stats), z)


def points_in_one_pass(points: DataFrame, centers: DataFrame, z: int,
                     stats: PointStats | None = None) -> DataFrame:
    """(z+1)-th largest d(x, S) over all points, duplicates kept (O3). 0 when S is empty."""
    if centers.isEmpty():
        return _zero(points)
    near = _distances(points.select("id", "coords"), centers, stats)
    top = near.select("dist", F.lit(0).alias("n")).orderBy(F.desc("dist")).limit(z + 1)
    return _objective(top, z)


def objective_value(df: DataFrame) -> float:
    return float(df.collect()[0]["objective"])
