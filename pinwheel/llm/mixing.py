"""Mixing sources to target weights on a time-varying curriculum.

Sources in code point order (null last) weigh ``WEIGHTS`` in turn and share ``SHARE`` times
all words; a target stops at ``LIMIT`` times its source's words and the excess is shared
again by weight: the target is min(limit, level * weight) at the one level that spends the
whole share. That level is the largest of the levels one gets by capping the first k sources
in order of limit / weight, so one window over the (few) sources finds it.

Every source also has a weight schedule over training time 0 to 1, linear between nodes.
Its integral, scaled to the target, is the source's cumulative token demand. The source's
documents stand in a fixed random order (md5 of the id), pass after pass; the middle of a
copy in that token sequence is sent through the inverse of the cumulative demand, which is
its training position. Copies beyond the whole demand have none and aren't taken. A last
range sort by position gives the curriculum.

Cumulative sizes need no window over a whole source: sizes are summed per source and
``BUCKETS`` slices of the md5 range first, and rows are only ordered within a slice. A hot
source is thereby spread over that many groups.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pinwheel.llm.common import WORD, saved

WEIGHTS = (3, 1, 2)
SHARE, LIMIT = 1.5, 2
# Relative weight at times 0, 1/2 and 1 for each place in WEIGHTS: steady, rising, falling.
SHAPES = ((1.0, 1.0, 1.0), (0.5, 1.0, 1.5), (1.5, 1.0, 0.5))
BUCKETS = 4096  # three hex digits


def position_sql(spent: str, place: str, shapes=SHAPES) -> str:
    """SQL for the time at which the share ``spent`` (0 to 1) of a source's demand is reached.

    In a segment of length h with weights a to b, the time x after its start at which demand y
    has come up solves a x + (b - a) x^2 / (2 h) = y.
    """
    num = lambda v: f"CAST({v!r} AS DOUBLE)"
    cases = []
    for k, shape in enumerate(shapes):
        h = 1 / (len(shape) - 1)
        areas = [(a + b) / 2 * h for a, b in zip(shape, shape[1:])]
        whole, at, arms = sum(areas), 0.0, []
        for j, (a, b) in enumerate(zip(shape, shape[1:])):
            y = f"({spent} * {num(whole)} - {num(at)})"
            time = f"{num(j * h)} + 2 * {y} / ({num(a)} + sqrt({num(a * a)} + {num(2 * (b - a) / h)} * {y}))"
            at += areas[j]
            arms.append(f"WHEN {spent} * {num(whole)} < {num(at)} THEN {time}" if j < len(areas) - 1 else f"ELSE {time}")
        cases.append(f"WHEN {place} = {k} THEN CASE {' '.join(arms)} END")
    return f"CASE {' '.join(cases)} END"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``key``, ``source_size``, ``place`` (in ``weights``) and ``target`` from (``key``, ``source_size``).

    ``key`` sorts as the sources do. One row per source goes through one task.
    """
    every = W.partitionBy()
    ranked = sizes.withColumn("place", ((F.row_number().over(W.orderBy("key")) - 1) % len(weights)).cast("int"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(limit)) * F.col("source_size"))
    before = W.orderBy(F.col("most") / F.col("weight"), "key").rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level_here", left / weights_left)
    level = F.max("level_here").over(every)
    return ranked.withColumn("target", F.least(F.col("most"), level * F.col("weight"))) \
        .select("key", "source_size", "place", "target")


# Rows per (source, slice) that are broadcast; more are joined by a shuffle.
BROADCAST_STARTS = 100_000


def allocate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep`` of ``docs`` (only the id if None) as struct ``row``, ``size`` in
    words, ``source_size``, ``target``, ``positions`` (the training position of every copy that
    the mix takes, ascending) and ``digest``.

    A copy's place in its source's token sequence is its middle: ``before`` (words of the source
    ahead of the row) plus half its size, plus the source's size for every pass before. The
    place is sent through the inverse of the cumulative demand; a copy that lies beyond all the
    demand has no position and isn't taken.

    Every row is a document of its own, repeated ones too. A null text has size 0; rows of
    size 0 take 0 words. Null sources form one source; rows with null id are ordered by text.
    A source without words has no demand. An empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    # "s" keeps a source's order and tells an empty name from null; "t" sorts after all of them.
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), text, F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or [id_col]]).alias("row"), F.col(id_col).alias("doc"), key.alias("key"),
                       digest.alias("digest"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")) \
        .withColumn("slice", F.substring("digest", 1, 3))
    if keep is None:
        rows = saved(rows)  # narrow: the texts are read once
    slices = saved(rows.groupBy("key", "slice").agg(F.sum("size").alias("words")))
    targets = source_targets(slices.groupBy("key").agg(F.sum("words").alias("source_size")))
    ahead = W.partitionBy("key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = saved(slices.withColumn("start", F.coalesce(F.sum("words").over(ahead), F.lit(0))).join(targets, "key").drop("words"))
    inside = W.partitionBy("key", "slice").orderBy("digest", "doc", "size").rowsBetween(W.unboundedPreceding, -1)
    # The size of a checkpointed table is unknown to Spark, which would then broadcast the documents.
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_STARTS else starts.hint("merge")
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["key", "slice"]) \
        .withColumn("before", F.col("start") + F.col("inside"))
    passes = [F.expr(copy_position_sql(k)) for k in range(math.ceil(LIMIT))]
    return placed.select("row", "size", "source_size", "target", F.filter(F.array(*passes), lambda p: p.isNotNull()).alias("positions"), "digest")


def copy_position_sql(k: int) -> str:
    """SQL for the training position of a row's copy in pass ``k`` (from 0); null if not taken."""
    middle = f"(before + {k} * source_size + size / CAST(2 AS DOUBLE))"
    return f"CASE WHEN target > 0 AND {middle} <= target THEN {position_sql(f'({middle} / target)', 'place')} END"


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (copies * size), copies, first_position and
    second_position (null if not taken), range-sorted by first_position (nulls last)."""
    out = allocate(docs.select("doc_id", "text", "source")).withColumn("copies", F.size("positions").cast("long"))
    return out.orderBy(F.expr("get(positions, 0)").asc_nulls_last(), "digest").select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        F.expr("get(positions, 0)").alias("first_position"), F.expr("get(positions, 1)").alias("second_position"))


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every taken copy of a row of ``docs`` that has words, range-sorted by
    training position (ties by md5 of the id). Columns unchanged."""
    names = docs.columns
    copies = allocate(docs, id_col, text_col, source_col, keep=names).where(F.col("size") > 0) \
        .select("row", "digest", F.explode("positions").alias("position"))
    return copies.orderBy("position", "digest").select(*[F.col(f"row.`{c}`").alias(c) for c in names])


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE place WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight
  FROM (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM s)),
c AS (
  SELECT *, CAST({LIMIT} AS DOUBLE) * source_size AS most FROM w),
l AS (
  SELECT *, (CAST({SHARE} AS DOUBLE) * sum(source_size) OVER ()
             - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM c),
t AS (SELECT source, source_size, place, least(most, max(lev) OVER () * weight) AS target FROM l),
o AS (
  SELECT d.*, t.source_size, t.place, t.target,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, {copy_position_sql(0)} AS first_position, {copy_position_sql(1)} AS second_position FROM o),
n AS (SELECT *, CAST(first_position IS NOT NULL AS BIGINT) + CAST(second_position IS NOT NULL AS BIGINT) AS copies FROM k)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, first_position, second_position
FROM n
"""
