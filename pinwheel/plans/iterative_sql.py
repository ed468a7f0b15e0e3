"""DuckDB oracles for the iterative operators, written as recursive CTEs over 2-D points.

A points CTE must expose (id, ord, w) and the coordinate columns (x, y by default). Each builder returns CTE text (to follow
``WITH RECURSIVE``) defining named relations that the final SELECT of a query reads.
Distances use the same left-fold form as the Spark expressions.
"""

from __future__ import annotations


XY = ("x", "y")


def dist(a: str, b: str, cols: tuple[str, ...] = XY) -> str:
    return "sqrt(" + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols) + ")"


def _of(table: str, cols: tuple[str, ...]) -> str:
    return ", ".join(f"{table}.{c}" for c in cols)


def fft_ctes(points: str, m: int, prefix: str = "f") -> str:
    """``{prefix}_centers(part, step, id, x, y)``: farthest-first traversal per ``part``.

    ``points`` must expose (id, ord, x, y, part)."""
    return f"""
{prefix}_pts AS ({points}),
{prefix}_st(step, part, id, ord, x, y, m, cid) AS (
  SELECT 0, part, id, ord, x, y, CAST('inf' AS DOUBLE), arg_min(id, ord) OVER (PARTITION BY part) FROM {prefix}_pts
  UNION ALL
  SELECT step, part, id, ord, x, y, m, cid FROM (
    SELECT step, part, id, ord, x, y, m,
           first_value(id) OVER (PARTITION BY part ORDER BY m DESC, ord) AS cid,
           max(m) OVER (PARTITION BY part) AS far
    FROM (SELECT s.step + 1 AS step, s.part, s.id, s.ord, s.x, s.y, least(s.m, {dist('s', 'c')}) AS m
          FROM {prefix}_st s JOIN {prefix}_pts c ON c.id = s.cid WHERE s.step < {m - 1}))
  WHERE far > 0),
{prefix}_centers AS (
  SELECT DISTINCT s.part, s.step, s.cid AS id, c.ord, c.x, c.y FROM {prefix}_st s JOIN {prefix}_pts c ON c.id = s.cid),
{prefix}_near AS (
  SELECT p.part, c.step FROM {prefix}_pts p JOIN {prefix}_centers c ON p.part = c.part
  QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY {dist('p', 'c')}, c.step) = 1),
{prefix}_weights AS (SELECT part, step, count(*) AS w FROM {prefix}_near GROUP BY part, step),
{prefix}_coreset AS (
  SELECT CAST(c.part AS BIGINT) * {m} + c.step AS ord, c.part, c.step, c.id, c.x, c.y,
         CAST(coalesce(w.w, 0) AS BIGINT) AS w
  FROM {prefix}_centers c LEFT JOIN {prefix}_weights w ON c.part = w.part AND c.step = w.step)"""


def greedy_ctes(points: str, k: int, z: int, alpha: float, guesses: int, prefix: str = "g",
                fixed_radius: float | None = None, cols: tuple[str, ...] = XY) -> str:
    """Radius search with the greedy cover for guesses g = 0 .. guesses-1.

    Defines ``{prefix}_r0(r0)``, ``{prefix}_state``, ``{prefix}_left(g, left_w)``,
    ``{prefix}_best(g)`` (lowest successful guess) and ``{prefix}_centers(step, id, coordinates,
    ball_weight)`` of that guess. An initial guess of 0 (equal points among the first) is tried
    once, then half the smallest distance among the first distinct points is doubled.
    ``fixed_radius`` runs one cover at that radius instead.
    """
    # A fixed-radius cover reports its centers whether or not they cover all but z.
    best = "SELECT 0 AS g" if fixed_radius is not None else f"SELECT min(g) AS g FROM {prefix}_left WHERE left_w <= {z}"
    inner = 1 + 2 * alpha
    outer = 3 + 4 * alpha
    first = k + z + 1
    xs = ", ".join(cols)
    if fixed_radius is None:
        radius = ("CASE WHEN r0 > 0 THEN r0 * pow(2, g) WHEN g = 0 THEN 0.0::DOUBLE ELSE rp * pow(2, g - 1) END")
        gs = (f"SELECT CAST(g AS INTEGER) AS g, {radius} AS r FROM range(0, {guesses}) t(g), {prefix}_r0, {prefix}_rp")
    else:
        gs = f"SELECT 0 AS g, CAST({fixed_radius!r} AS DOUBLE) AS r"
    return f"""
{prefix}_pts AS ({points}),
{prefix}_first AS (SELECT * FROM {prefix}_pts ORDER BY ord LIMIT {first}),
{prefix}_r0 AS (SELECT min({dist('a', 'b', cols)}) / 2 AS r0 FROM {prefix}_first a JOIN {prefix}_first b ON a.ord < b.ord),
{prefix}_merged AS (SELECT arg_min(id, ord) AS id, min(ord) AS ord, {xs}, CAST(sum(w) AS BIGINT) AS w
                    FROM {prefix}_pts GROUP BY {xs}),
{prefix}_mfirst AS (SELECT * FROM {prefix}_merged ORDER BY ord LIMIT {first}),
{prefix}_rp AS (SELECT min({dist('a', 'b', cols)}) / 2 AS rp FROM {prefix}_mfirst a JOIN {prefix}_mfirst b ON a.ord < b.ord),
{prefix}_gs AS ({gs}),
{prefix}_state(g, r, it, id, ord, {xs}, w, act, cid, cbw) AS (
  SELECT g, r, 0, id, ord, {xs}, w, true, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM {prefix}_merged CROSS JOIN {prefix}_gs
  UNION ALL
  SELECT s.g, s.r, s.it + 1, s.id, s.ord, {_of('s', cols)}, s.w,
         s.act AND NOT ({dist('s', 'b', cols)} <= {outer!r} * s.r), b.id, b.bw
  FROM {prefix}_state s
  JOIN (SELECT g FROM {prefix}_state WHERE act GROUP BY g HAVING sum(w) > 0) lw ON lw.g = s.g
  JOIN (SELECT g, id, {xs}, bw FROM (
          SELECT a.g, a.id, a.ord, {_of('a', cols)}, CAST(sum(c.w) AS BIGINT) AS bw
          FROM {prefix}_state a JOIN {prefix}_state c
            ON a.g = c.g AND c.act AND {dist('a', 'c', cols)} <= {inner!r} * a.r
          GROUP BY a.g, a.id, a.ord, {_of('a', cols)})
        QUALIFY row_number() OVER (PARTITION BY g ORDER BY bw DESC, ord) = 1) b ON b.g = s.g
  WHERE s.it < {k}),
{prefix}_last AS (SELECT g, max(it) AS it FROM {prefix}_state GROUP BY g),
{prefix}_left AS (
  SELECT s.g, CAST(coalesce(sum(s.w) FILTER (WHERE s.act), 0) AS BIGINT) AS left_w, any_value(s.r) AS r
  FROM {prefix}_state s JOIN {prefix}_last l ON s.g = l.g AND s.it = l.it GROUP BY s.g),
{prefix}_best AS ({best}),
{prefix}_centers AS (
  SELECT DISTINCT s.it - 1 AS step, s.cid AS id, {_of('m', cols)}, s.cbw AS ball_weight
  FROM {prefix}_state s JOIN {prefix}_merged m ON m.id = s.cid
  WHERE s.it > 0 AND s.g = (SELECT g FROM {prefix}_best))"""


def objective_distinct_sql(points: str, centers: str, z: int) -> str:
    """Scalar subquery: (z+1)-th largest distinct d(x, S)."""
    return (f"(SELECT min(dist) FROM (SELECT DISTINCT dist FROM (SELECT p.id, min({dist('p', 'c')}) AS dist "
            f"FROM {points} p CROSS JOIN {centers} c GROUP BY p.id) ORDER BY dist DESC LIMIT {z + 1}))")


def objective_partitioned_sql(points: str, centers: str, z: int) -> str:
    """Scalar subquery: distinct d(x, S) per part, top z+1 per part, (z+1)-th largest of the union."""
    return (f"(SELECT min(dist) FROM (SELECT dist FROM (SELECT DISTINCT part, dist FROM "
            f"(SELECT p.id, any_value(p.part) AS part, min({dist('p', 'c')}) AS dist "
            f"FROM {points} p CROSS JOIN {centers} c GROUP BY p.id)) "
            f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY dist DESC) <= {z + 1} "
            f"ORDER BY dist DESC LIMIT {z + 1}))")
