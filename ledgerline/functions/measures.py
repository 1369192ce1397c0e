"""Decomposable measures: one vocabulary over an order-line fact or a rollup.

Every aggregate the report needs is a SUM or a COUNT, possibly conditional
(profitable lines, the high-discount band, ...). Such an aggregate can be
computed in two steps: once per row of a rollup (``ledgerline.plans.rollup``:
the fact grouped by its dimensions) and then summed again over the rollup
rows - exactly, since the money measures are DECIMAL and the rest are counts.

``measure(src, name, cfg)`` returns the aggregate column for either input: the
direct expression on a line fact, the sum of the stored partial on a rollup.
Operators ask for measures by name and form ratios, means and shares only
after the last step, from the exact sums and counts.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, AnalyticsConfig
from ledgerline.functions.predicates import (
    is_high_discount, is_loss, is_profitable, is_zero_discount,
)

# A rollup stores measure ``x`` in column ``m_x``.
ROLLUP_PREFIX = "m_"

# Measures that depend on the discount threshold.
BANDED = frozenset({"hi_orders", "hi_loss", "hi_profit", "hi_profit_n", "lo_orders", "lo_profit"})

# Measures that are counts (a count over no rows is 0, a sum over none NULL).
COUNTS = frozenset({"orders", "sales_n", "disc_n", "profitable", "loss", "hi_orders",
                    "hi_loss", "hi_profit_n", "lo_orders", "zero_profit_n"})


def _line_factories(cfg: AnalyticsConfig) -> dict[str, Callable[[], Column]]:
    """Builders of every measure over order lines. Building a Column costs
    calls into the JVM, so only the measures a query asks for are built."""
    def hi() -> Column:
        return is_high_discount(cfg)

    def lo() -> Column:
        return ~F.coalesce(hi(), F.lit(False))

    def one() -> Column:
        return F.lit(1)

    def profit() -> Column:
        return F.col("profit")

    zero = is_zero_discount
    return {
        "sales": lambda: F.sum("sales"),
        "profit": lambda: F.sum("profit"),
        "orders": lambda: F.count(one()),
        "sales_n": lambda: F.count("sales"),
        "disc_sum": lambda: F.sum(F.col("discount").cast("decimal(4,2)")),
        "disc_n": lambda: F.count("discount"),
        "profitable": lambda: F.count(F.when(is_profitable(), one())),
        "loss": lambda: F.count(F.when(is_loss(), one())),
        "hi_orders": lambda: F.count(F.when(hi(), one())),
        "hi_loss": lambda: F.count(F.when(hi() & is_loss(), one())),
        "hi_profit": lambda: F.sum(F.when(hi(), profit())),
        "hi_profit_n": lambda: F.count(F.when(hi(), profit())),
        "lo_orders": lambda: F.count(F.when(lo(), one())),
        "lo_profit": lambda: F.sum(F.when(lo(), profit())),
        "zero_profit": lambda: F.sum(F.when(zero(), profit())),
        "zero_profit_n": lambda: F.count(F.when(zero(), profit())),
    }


MEASURES = tuple(_line_factories(DEFAULT))


def line_measures(cfg: AnalyticsConfig = DEFAULT,
                  names: Iterable[str] | None = None) -> dict[str, Column]:
    """Measures (all, or ``names``) as aggregates over order lines.

    ``hi_*`` is the band discount >= threshold, ``lo_*`` every other line
    (a NULL discount counts as low), ``zero_*`` discount = 0.
    """
    factories = _line_factories(cfg)
    return {n: factories[n]() for n in (names if names is not None else MEASURES)}


def is_rollup(src: DataFrame) -> bool:
    return f"{ROLLUP_PREFIX}orders" in src.columns


def measure(src: DataFrame, name: str, cfg: AnalyticsConfig = DEFAULT,
            rollup: bool | None = None) -> Column:
    """The aggregate ``name`` over ``src`` (a line fact or a rollup).

    A rollup carries the discount threshold it was built with: asking it for a
    band measure at another threshold fails. ``rollup`` saves the schema
    lookup when the caller already knows what ``src`` is.
    """
    if rollup is None:
        rollup = is_rollup(src)
    if rollup:
        value = F.col(ROLLUP_PREFIX + name)
        if name in BANDED:
            asked = float(cfg.high_discount)
            value = F.when(F.col("high_discount") == F.lit(asked), value).otherwise(F.raise_error(
                F.concat(F.lit(f"{name} at threshold {asked} is not in a rollup built for "),
                         F.col("high_discount").cast("string"))))
        total = F.sum(value)
        return F.coalesce(total, F.lit(0).cast("bigint")) if name in COUNTS else total
    return _line_factories(cfg)[name]()


def aggregate(src: DataFrame, keys: Sequence[str | Column], names: Iterable[str],
              cfg: AnalyticsConfig = DEFAULT, null_keys: bool = False) -> DataFrame:
    """Group ``src`` by ``keys`` (a global aggregate when empty) and compute the
    named measures as columns ``_<name>``: one partial + final aggregation.
    Rows with a null key form no group (as in pandas) unless ``null_keys``."""
    rollup = is_rollup(src)
    if keys and not null_keys:
        src = src.where(reduce(operator.and_, [
            (F.col(k) if isinstance(k, str) else k).isNotNull() for k in keys]))
    cols = [measure(src, n, cfg, rollup).alias(f"_{n}") for n in names]
    return src.groupBy(*keys).agg(*cols) if keys else src.agg(*cols)


def require_lines(src: DataFrame, what: str) -> None:
    """Row-level outputs need the line fact, not a rollup."""
    if is_rollup(src):
        raise ValueError(f"{what} needs the order-line fact; a rollup has no single lines")
