"""Row predicates and sign classes used by filters, KPIs and charts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, AnalyticsConfig


def is_profitable(profit: str = "profit") -> Column:
    return F.col(profit) > 0


def is_loss(profit: str = "profit") -> Column:
    return F.col(profit) < 0


def is_high_discount(cfg: AnalyticsConfig = DEFAULT, discount: str = "discount") -> Column:
    return F.col(discount) >= F.lit(cfg.high_discount)


def is_zero_discount(discount: str = "discount") -> Column:
    return F.col(discount) == 0


def table_sign(c: Column | str) -> Column:
    """Breakdown tables colour a value 'pos' only when strictly positive;
    zero counts as 'neg'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, F.lit("pos")).otherwise(F.lit("neg"))


def scatter_sign(c: Column | str) -> Column:
    """The scatter colours a point 'loss' only when strictly negative; zero
    counts as 'profit'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < 0, F.lit("loss")).otherwise(F.lit("profit"))
