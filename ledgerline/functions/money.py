"""Money and ratio expressions.

Rules that keep Spark and an independent SQL engine bit-for-bit equal:

* measures are DECIMAL, so sums are exact whatever the partitioning;
* a money total is the DECIMAL sum rounded to 2 places (HALF_UP, exact) and
  only then turned into DOUBLE;
* ratios and means are computed in DOUBLE from the exact sums/counts with a
  NULL instead of a division-by-zero error (ANSI mode raises otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: Column | str) -> Column:
    return _c(c).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(as_double(num), as_double(den))


def pct(num: Column | str, den: Column | str) -> Column:
    """100 * num / den in DOUBLE; NULL when den is 0."""
    return ratio(num, den) * F.lit(100)
