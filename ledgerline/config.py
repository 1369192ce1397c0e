"""Parameters of the analytics model.

Every public operator takes an ``AnalyticsConfig`` (or uses ``DEFAULT``), so a
caller can point the same code at the flat retail CSV (threshold 0.4) or at the
star-schema test tables (threshold 0.08) without editing anything.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------
# Discount at or above which an order counts as "high discount" on the flat
# retail CSV; the scatter chart draws its vertical guide line at the same x.
RETAIL_HIGH_DISCOUNT = 0.4
# Regression: ridge penalty and iteration cap, 80/20 split with seed 42.
RIDGE_REG_PARAM = 0.3
RIDGE_MAX_ITER = 10
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
# Top-k sizes: top/bottom five sub-categories, top ten in the bar chart, of
# which the first three are highlighted.
TOP_K = 5
CHART_TOP_K = 10
CHART_HIGHLIGHT = 3
# Rounding: money to 2 decimals, average discount in the SQL query to 3,
# margins and shares in the tables to 1, KPI margin to 2, KPI percents to 1.
MONEY_SCALE = 2
AVG_DISCOUNT_SCALE = 3
TABLE_PCT_SCALE = 1
KPI_MARGIN_SCALE = 2
KPI_PCT_SCALE = 1
# Text the pandas reader treats as missing (besides empty), in exactly this case.
DEFAULT_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# ---------------------------------------------------------------------------

# Star-schema binding: "high discount" on l_discount (0.00 .. 0.10).
STAR_HIGH_DISCOUNT = 0.08

# The model's dimension columns (snake_case) and the flat CSV's header names.
DIMENSIONS = ("region", "category", "sub_category", "ship_mode", "segment")
CSV_HEADER_TO_MODEL = {
    "Region": "region",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Ship Mode": "ship_mode",
    "Segment": "segment",
    "Quantity": "quantity",
    "Discount": "discount",
    "Sales": "sales",
    "Profit": "profit",
}


@dataclass(frozen=True)
class AnalyticsConfig:
    high_discount: float = STAR_HIGH_DISCOUNT
    # Width of a profit bin for the discount/profit density (V4 at scale).
    profit_bin_width: float = 10000.0
    null_tokens: tuple[str, ...] = field(default=DEFAULT_NULL_TOKENS)
    top_k: int = TOP_K
    chart_top_k: int = CHART_TOP_K
    chart_highlight: int = CHART_HIGHLIGHT


DEFAULT = AnalyticsConfig()
RETAIL = AnalyticsConfig(high_discount=RETAIL_HIGH_DISCOUNT, profit_bin_width=100.0)
