"""Display formatting: '$12,345', '1,234', '12.5%'.

``format_number`` rounds half-even like Python's ``format``; a negative amount
prints as ``$-17,725`` exactly as an f-string ``${v:,.0f}`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def currency_label(c: Column | str, decimals: int = 0) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(c).cast("double"), decimals))


def thousands_label(c: Column | str) -> Column:
    return F.format_number(_c(c).cast("double"), 0)


def percent_label(c: Column | str) -> Column:
    """Value already rounded upstream, printed with a trailing '%'.

    Python prints a float's shortest repr (``12.5%``, ``-3.0%``); Spark's
    DOUBLE->STRING cast does the same for the magnitudes used here.
    """
    return F.concat(_c(c).cast("string"), F.lit("%"))
