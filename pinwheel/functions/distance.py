"""Euclidean distance as JVM-side column expressions.

Every path sums squared coordinate differences left to right, starting from the first
dimension, and takes the square root of that sum. Radii are power-of-two multiples of
actual distances and ball membership is ``d <= r``, so distances must come out bit-equal
wherever they are computed (the SQL oracles use the same left fold).

For the dimensions seen in practice the sum is unrolled into plain arithmetic, which
whole-stage code generation compiles; very wide vectors fall back to ``aggregate``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNROLL_LIMIT = 128


def _item(vec: Column | Sequence[float], i: int) -> Column:
    if isinstance(vec, Column):
        return vec.getItem(i)
    return F.lit(float(vec[i]))


def sqdist(a: Column | Sequence[float], b: Column | Sequence[float], d: int) -> Column:
    """Squared distance between two ``d``-dimensional vectors (columns or literal lists)."""
    if d == 0:
        return F.lit(0.0)
    if d <= UNROLL_LIMIT:
        total = None
        for i in range(d):
            diff = _item(a, i) - _item(b, i)
            term = diff * diff
            total = term if total is None else total + term
        return total
    a_col = a if isinstance(a, Column) else F.array(*[F.lit(float(v)) for v in a])
    b_col = b if isinstance(b, Column) else F.array(*[F.lit(float(v)) for v in b])
    return F.aggregate(F.zip_with(a_col, b_col, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def euclidean(a: Column | Sequence[float], b: Column | Sequence[float], d: int) -> Column:
    """``sqrt(sqdist(a, b))``."""
    return F.sqrt(sqdist(a, b, d))


def double_sql(v: float) -> str:
    """A double literal in SQL text that parses back to exactly ``v`` (shortest repr)."""
    return f"({float(v)!r}D)"


def euclidean_sql(col: str, center: Sequence[float], d: int) -> str:
    """SQL text of the left-fold distance from array column ``col`` to a literal center.

    Building long expressions as one SQL string costs one parse on the JVM instead of
    thousands of small column calls from Python; the arithmetic is the same as ``euclidean``.
    """
    if d == 0:
        return "CAST(0.0 AS DOUBLE)"
    terms = []
    for i in range(d):
        c = double_sql(center[i])
        terms.append(f"({col}[{i}] - {c}) * ({col}[{i}] - {c})")
    return "sqrt(" + " + ".join(terms) + ")"
