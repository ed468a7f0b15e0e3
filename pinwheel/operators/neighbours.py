"""Nearest-neighbour join of two tables of any size by a tree of grid cells.

The centers are cut by a grid over their widest dimensions (at most ``GRID_DIMS``) of about
one cell per ``LEAF`` centers, and its cells are summed up into the coarser ones of each level
(``SHIFT`` bits a dimension) until one cell holds everything. A cell knows how many centers it
has, the box they really fill and one of them.

The points descend this tree level by level, each with the cells that may still hold its
nearest center: a cell's box bounds the distance from below, its known center bounds the
answer from above, and cells beyond that bound are dropped. Every level is one equi-join on the
cell and one window by point. At the end a point meets the blocks of cells around its last ones:
only the centers of blocks that a point reaches are shuffled, once, and a tree of boxes (numpy)
finds the nearest ones in a block without listing pairs. Blocks of more than ``SPLIT`` points or
centers are cut into pieces. Both sides are dealt out by space, no center passes the driver
or is broadcast, and the number of jobs doesn't grow (the levels grow with the logarithm of
the number of centers).

Box bounds are computed by the same left fold as distances, over some of the dimensions;
rounding is monotone, so a bound never exceeds the computed distance of a center in the box,
and cells at exactly the best distance stay, so ties are found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pinwheel.functions.distance import euclidean
from pinwheel.session import checkpoint_dir

GRID_DIMS, BOX_DIMS = 3, 8
LEAF, SHIFT, MOST_ALONG = 256, 2, 2 ** 30
# Points or centers of a block that one task takes at most (about), and blocks (numbers and counts
# of those that points reach) that are listed on the driver.
SPLIT, MOST_LISTED = 1 << 17, 200_000
# Dimensions beyond this one are never chosen for grid and boxes (they count in distances).
LOOKED_AT = 128


def _box_distance(coords: Column, lo: Column, hi: Column, dims: list[int]) -> Column:
    """Lower bound of the distance from a point to any point of a box, over ``dims`` ascending."""
    total = None
    for k, i in enumerate(dims):
        x = coords.getItem(i)
        gap = F.greatest(lo.getItem(k) - x, x - hi.getItem(k), F.lit(0.0))
        total = gap * gap if total is None else total + gap * gap
    return F.sqrt(total) if total is not None else F.lit(0.0)


def nearest_by_cells(points: DataFrame, centers: DataFrame, d: int, leaf: int = LEAF, split: int = SPLIT) -> DataFrame:
    """``id``, ``dist`` and ``center_id`` of the nearest center of every point (``id`` unique,
    ``coords``); ``centers`` has ``o`` (order: ties go to the lowest), ``i`` (id) and ``c``
    (coordinates), at least one row. A point whose distances are all NaN or infinite is left out."""
    from pinwheel.operators.geometry import _NearestTree
    checkpoint_dir(points.sparkSession)
    # Centers without a null, NaN or infinite coordinate; the others are at no finite distance.
    sound = centers.where(F.forall("c", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    seen = range(min(d, LOOKED_AT))
    row = sound.agg(F.count(F.lit(1)).alias("n"), *[f(F.col("c").getItem(i)).alias(f"{name}{i}") for i in seen
                                                    for f, name in ((F.min, "lo"), (F.max, "hi"))]).first()
    extent = {i: row[f"hi{i}"] - row[f"lo{i}"] if row["n"] else 0.0 for i in seen}
    wide = sorted(seen, key=lambda i: (-extent[i], i))
    grid = [i for i in wide[:GRID_DIMS] if 0 < extent[i] < float("inf")]
    box = sorted(wide[:BOX_DIMS])
    side = extent[grid[0]] if grid else 1.0
    while grid and math.prod(math.floor(extent[i] / side) + 1 for i in grid) * leaf < row["n"] and extent[grid[0]] / side < MOST_ALONG:
        side /= 1.2
    res = [math.floor(extent[i] / side) + 1 for i in grid]
    levels = math.ceil(math.log2(max(res)) / SHIFT) if grid else 0
    keys = [f"k{j}" for j in range(len(grid))]
    blocks = [F.expr(f"shiftright({k}, {SHIFT})").alias(f"b{j}") for j, k in enumerate(keys)] or [F.lit(0).alias("b0")]
    block = [f"b{j}" for j in range(len(blocks))]
    cell = [F.least(F.greatest(F.floor((F.col("c").getItem(i) - F.lit(float(row[f"lo{i}"]))) / F.lit(side)), F.lit(0)), F.lit(r - 1)).cast("long").alias(k)
            for i, k, r in zip(grid, keys, res)]
    # Plain numbers only, so that the aggregate hashes and needs no sort. The first values of a
    # group's columns are those of one row.
    known = [f"c{i}" for i in range(d)]
    kept = [*[F.first(v).alias(v) for v in known], *[F.min(f"lo{i}").alias(f"lo{i}") for i in box], *[F.max(f"hi{i}").alias(f"hi{i}") for i in box]]
    finest = sound.select(*cell, F.lit(1).cast("long").alias("n"), *[F.col("c").getItem(i).alias(v) for i, v in enumerate(known)],
                          *[F.col("c").getItem(i).alias(f"{e}{i}") for i in box for e in ("lo", "hi")]) \
        .groupBy(*keys).agg(F.sum("n").alias("n"), *kept).checkpoint()

    def cells(level: int) -> DataFrame:
        """One row per cell of a level."""
        up = [F.expr(f"shiftright({k}, {SHIFT * level})").alias(k) for k in keys]
        at = finest.select(*up, "n", *known, *[f"{e}{i}" for e in ("lo", "hi") for i in box]).groupBy(*keys).agg(F.sum("n").alias("n"), *kept) if level else finest
        return at.select(*keys, "n", F.array(*known).alias("kc"), F.array(*[F.col(f"lo{i}") for i in box]).alias("lo"),
                         F.array(*[F.col(f"hi{i}") for i in box]).alias("hi"))

    x = F.col("x")
    root = cells(levels).select(*keys, "kc", F.lit(0).alias("_one"))
    state = points.select("id", F.col("coords").alias("x"), F.lit(0).alias("_one")).join(F.broadcast(root), "_one") \
        .select("id", "x", *keys, euclidean(x, F.col("kc"), d).alias("best"))
    for level in range(levels, 0, -1):
        child = cells(level - 1).select(*[F.expr(f"shiftright({k}, {SHIFT})").alias(k) for k in keys],
                                        *[F.col(k).alias(f"_{k}") for k in keys], "kc", "lo", "hi")
        met = state.join(child, keys).select(
            "id", "x", *[F.col(f"_{k}").alias(k) for k in keys], F.least("best", euclidean(x, F.col("kc"), d)).alias("best"),
            _box_distance(x, F.col("lo"), F.col("hi"), box).alias("_low"))
        state = met.withColumn("best", F.min("best").over(W.partitionBy("id"))).where(F.col("_low") <= F.col("best")).drop("_low")
    # A point meets the blocks (cells of one level up) around its last cells. Crowded blocks are
    # cut into pieces on both sides, which all meet.
    state = state.select("id", "x", *blocks).distinct().checkpoint()
    sizes = finest.select(*blocks, "n").groupBy(*block).agg(F.sum("n").alias("n"))
    cuts = state.groupBy(*block).agg(F.count(F.lit(1)).alias("p")).join(sizes, block) \
        .select(*block, F.ceil(F.col("p") / split).alias("_ps"), F.ceil(F.col("n") / split).alias("_cs")).checkpoint()
    if cuts.count() <= MOST_LISTED:  # a list of known size: Spark sees whether a broadcast is worth it
        cuts = points.sparkSession.createDataFrame(cuts.toArrow(), cuts.schema)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = state.join(cuts, block).select("id", "x", *block, F.pmod(F.xxhash64("id"), F.col("_ps")).alias("_p"), each("_cs").alias("_c"))
    met = sound.select(*cell, "o", "i", F.slice("c", 1, d).alias("y")).select(*blocks, "o", "i", "y").join(cuts, block) \
        .select("o", "i", "y", *block, F.pmod(F.xxhash64("i"), F.col("_cs")).alias("_c"), each("_ps").alias("_p"))

    def values(column) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d).T

    def nearest(left, right):
        ids, o, i = left.column("id"), right.column("o").to_numpy(), right.column("i").to_numpy()
        if not len(ids) or not len(o):
            return pa.table({"id": ids.slice(0, 0), "d": pa.array([], pa.float64()), "o": pa.array([], pa.int64()), "i": pa.array([], pa.int64())})
        order = np.lexsort((i, o))
        ys = values(right.column("y"))[:, order]
        first = np.sort(np.unique(ys, axis=1, return_index=True)[1])  # equal centers are one, that of the lowest order
        best, place = _NearestTree(np.ascontiguousarray(ys[:, first])).nearest(np.ascontiguousarray(values(left.column("x"))))
        own, ok = order[first[place]], (place >= 0) & np.isfinite(best)
        return pa.table({"id": ids, "d": best, "o": o[own], "i": i[own]}).filter(pa.array(ok))

    schema = T.StructType([points.schema["id"], T.StructField("d", T.DoubleType()), T.StructField("o", T.LongType()), T.StructField("i", T.LongType())])
    by = [*block, "_p", "_c"]
    found = mine.groupBy(*by).cogroup(met.groupBy(*by)).applyInArrow(nearest, schema)
    best = found.groupBy("id").agg(F.min(F.struct("d", "o", "i")).alias("b"))
    return best.select("id", F.col("b.d").alias("dist"), F.col("b.i").alias("center_id"))
