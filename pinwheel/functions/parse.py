"""Column expressions that parse comma-separated text the way the original programs did.

All of them stay JVM-side (no UDF). Bad input fails the job instead of turning into nulls,
because the original parsed every line before filtering and a malformed line was fatal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and the integer pattern accepted by a strict integer parse.
SEPARATOR = ","
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def split_fields(value: Column | str) -> Column:
    """Split on commas, dropping trailing empty fields (``"a,b,,"`` has two fields)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.split(F.regexp_replace(value, SEPARATOR + "+$", ""), SEPARATOR)


def is_int(token: Column) -> Column:
    """Whether a token is a 32-bit integer without surrounding blanks (false for null)."""
    return F.coalesce(token.rlike(INTEGER_PATTERN) & token.try_cast("int").isNotNull(), F.lit(False))


def strict_double(token: Column) -> Column:
    """Parse a double; a missing or malformed number raises an error (whatever the
    session's ANSI setting)."""
    parsed = token.try_cast("double")
    return F.when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(token, F.lit("null")))).cast("double"))


def to_vector(value: Column | str) -> Column:
    """A point line: every comma-separated token as a double."""
    return F.transform(split_fields(value), lambda t: strict_double(t))
