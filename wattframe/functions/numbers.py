"""Exact decimal means and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_rounded(value: str | Column, scale: int) -> Column:
    """Mean of a decimal column rounded half away from zero.

    ``avg`` on a decimal keeps only four extra digits, or goes through a
    double for narrow types; rounding that again can turn a near tie the
    wrong way in large groups.  Sum over count keeps the quotient exact enough.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(F.sum(column) / F.nullif(F.count(column), F.lit(0)), scale)


def exact_mean(value: str) -> Column:
    """Unrounded mean: an exact decimal sum, one division at the end."""
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


# Fixed value: digits joined into groups by single underscores.
GROUPED = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"


def safe_double(text: Column) -> Column:
    """Text as a finite double; anything else (bad text, nan, inf, NULL) is NULL.

    Letters other than the exponent's keep out forms that only a cast would
    accept, such as ``1.0d``.  Grouped digits are rare and take the second way.
    """
    simple = F.when(~text.rlike("[A-DF-Za-df-z]"), text.try_cast("double"))
    grouped = F.when(text.rlike(GROUPED), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    number = F.coalesce(simple, grouped)
    return F.when(F.abs(number) < F.lit(float("inf")), number)

